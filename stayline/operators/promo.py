"""Listing of patients with many free promotions or memberships."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.numeric import as_flag
from stayline.operators.visits import with_uid_day


def promo_listing(
    transactions: DataFrame, products: DataFrame, animals: DataFrame, contacts: DataFrame, appointments: DataFrame,
    visits: DataFrame, wellness: DataFrame, promo_prefix: str = P.PROMO_PREFIX, more_than: int | None = None,
) -> DataFrame:
    """The joined lines with their patient's membership and promo counts: equal rows are one, with how often it ``repeats``.

    Contacts and appointments add no column, only repeats, so they enter as row counts
    per (contact, clinic). The per-patient counts are sums of (uid, day) sums: a busy
    patient's lines never meet in one task. ``more_than`` keeps patients with more promo
    rows than that, and is applied to the counts, before the lines are listed.
    """
    lines = with_uid_day(transactions).select("uid", "day", "location_id", "animal_id", "product_id", "product_name", "revenue")
    sold = products.select(F.col("ezyvet_id").alias("product_id"), "location_id", "is_medical")
    owner = animals.select(F.col("id").alias("animal_id"), "contact_id")
    pair = ["contact_id", "location_id"]

    def copies(df: DataFrame, name: str) -> DataFrame:
        keys = df.select(F.col("ezyvet_id").alias("contact_id"), "location_id").where("contact_id is not null and location_id is not null")
        return keys.groupBy(*pair).agg(F.count("*").alias(name))

    # Repeats depend on (contact, clinic); both tables meet on it before the lines do.
    repeats = copies(contacts, "c_n").join(copies(appointments, "a_n"), pair, "full").select(
        *pair, (F.coalesce("c_n", F.lit(1)) * F.coalesce("a_n", F.lit(1))).alias("repeats")
    )
    owner = owner.join(repeats, "contact_id", "left").select("animal_id", F.col("location_id").alias("r_location"), "repeats")
    owner = owner.where("repeats is not null").select("animal_id", F.col("r_location").alias("location_id"), "repeats")
    known = animals.select(F.col("id").alias("animal_id"))
    joined = lines.join(sold, ["product_id", "location_id"]).join(known, "animal_id")
    plans = wellness.groupBy("uid", "day").agg(F.count("*").alias("w_rows"), F.count("wellness_plan").alias("w_plans"))
    # The lines once, equal ones as one; counts per day are sums over these.
    lines = joined.groupBy("uid", "day", "animal_id", "location_id", "is_medical", "product_name", "revenue").agg(F.count("*").alias("lines"))
    per_day = lines.groupBy("uid", "day", "animal_id", "location_id").agg(
        F.sum("lines").alias("rows"), F.sum(F.col("lines") * as_flag(F.col("product_name").startswith(promo_prefix))).alias("promos")
    )
    # Only paid days count. Tested here on day rows; listing joins the counts, so it holds there too.
    per_day = per_day.join(visits.select("uid", "day"), ["uid", "day"], "left_semi")
    per_day = per_day.join(owner, ["animal_id", "location_id"], "left").join(plans, ["uid", "day"], "left")
    times = F.coalesce("repeats", F.lit(1))
    whole = Window.partitionBy("uid")
    counts = (
        per_day.withColumn("times", times)
        .withColumn("wellness_plan_count", F.sum(F.col("rows") * F.col("times") * F.coalesce("w_plans", F.lit(0))).over(whole))
        .withColumn("free_count", F.sum(F.col("promos") * F.col("times") * F.greatest(F.coalesce("w_rows", F.lit(0)), F.lit(1))).over(whole))
        .withColumn("rank_", F.dense_rank().over(whole.orderBy("day")))
        .select("uid", "day", "animal_id", "location_id", "times", "wellness_plan_count", "free_count", "rank_")
    )
    if more_than is not None:
        counts = counts.where(F.col("free_count") > more_than)
    held = wellness.groupBy("uid", "day", "wellness_plan").agg(F.count("*").alias("plans"))
    listed = lines.join(counts, ["uid", "day", "animal_id", "location_id"]).join(held, ["uid", "day"], "left")
    keys = ["is_medical", "wellness_plan", "wellness_plan_count", "product_name", "free_count", "revenue", "rank_"]
    repeats = F.sum(F.col("lines") * F.col("times") * F.coalesce("plans", F.lit(1)))
    return listed.groupBy("uid", F.col("day").alias("date"), *keys).agg(repeats.alias("repeats"))
