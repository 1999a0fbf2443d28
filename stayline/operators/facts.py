"""Line facts: transactions with product and animal attributes, one row per distinct line kind."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.dates import as_date, epoch_to_timestamp, months_crossed, years_crossed
from stayline.functions.keys import composite_key
from stayline.functions.numeric import as_flag, money, times
from stayline.functions.text import merged_product_group
from stayline.operators.visits import with_uid_day

FACT_KEYS = ("uid", "breed", "day", "weight", "is_medical", "product_group", "product_name")


def animal_attributes(animals: DataFrame, as_of: dt.date) -> DataFrame:
    born = epoch_to_timestamp(F.col("date_of_birth"))
    return animals.select(
        F.col("id").alias("animal_id"), "breed", "weight", years_crossed(born, as_date(as_of)).alias("ani_age")
    )


def line_facts(
    lines: DataFrame, products: DataFrame, animals: DataFrame, as_of: dt.date, unknown_animals: bool = False,
    only_days: DataFrame | None = None,
) -> DataFrame:
    """Revenue and age per (uid, breed, day, weight, medical flag, group, product).

    ``lines`` are daily lines (transactions are accepted too). Products are a left join; animals are inner by ``id`` alone, or left with
    ``unknown_animals``. ``only_days`` keeps lines of given (uid, day) rows, before any
    other join. The joins are equi joins whose other side is unique per key, which
    adaptive execution splits when one product or animal is hot; the aggregation combines
    map-side before its shuffle.
    """
    lines = (lines if "uid" in lines.columns else with_uid_day(lines)).select(
        "uid", "day", "location_id", "animal_id", "product_id", "product_name", "revenue"
    )
    if only_days is not None:
        lines = lines.join(only_days.select("uid", "day"), ["uid", "day"], "left_semi")
    catalogue = products.select(
        F.col("ezyvet_id").alias("product_id"),
        "location_id",
        "is_medical",
        merged_product_group(F.col("product_group")).alias("product_group"),
    )
    how = "left" if unknown_animals else "inner"
    return (
        lines.join(catalogue, ["product_id", "location_id"], "left")
        .join(animal_attributes(animals, as_of), "animal_id", how)
        .groupBy(*FACT_KEYS)
        .agg(F.max("ani_age").alias("ani_age"), money(F.sum("revenue")).alias("revenue"))
    )


def contact_copies(animals: DataFrame, contacts: DataFrame) -> DataFrame:
    """How many contact rows each uid's lines meet.

    Joining contacts to the lines adds no column and only repeats lines. The number of
    repeats depends on the uid alone, so it is kept as a factor per uid, and the lines
    are not shuffled for it. Missing uids have factor one.
    """
    stored = contacts.where("ezyvet_id is not null and location_id is not null").groupBy("ezyvet_id", "location_id").agg(F.count("*").alias("copies"))
    owners = animals.select("id", F.col("contact_id").alias("ezyvet_id"))
    return owners.join(stored, "ezyvet_id").select(composite_key("location_id", "id").alias("uid"), "copies")


def with_contact_copies(frame: DataFrame, copies: DataFrame, *amounts: str) -> DataFrame:
    out = frame.join(copies, "uid", "left")
    factor = F.coalesce("copies", F.lit(1))
    for amount in amounts:
        out = out.withColumn(amount, times(F.col(amount), factor))
    return out.drop("copies")


def fact_days(facts: DataFrame, promo_prefix: str = P.PROMO_PREFIX, keep: Sequence[str] = ()) -> DataFrame:
    """Spend, number of fact rows and number of promo rows per (uid, day) and kept attributes."""
    promo = as_flag(F.col("product_name").startswith(promo_prefix))
    return facts.groupBy("uid", "day", *keep).agg(
        money(F.sum("revenue")).alias("day_spend"), F.count("*").alias("n_rows"), F.sum(promo).alias("n_promo")
    )


def with_patient_flags(days: DataFrame, as_of: dt.date, horizon: int = P.HORIZON_DAYS, maturity: int = P.MATURITY_DAYS) -> DataFrame:
    """First day, day rank, and the two training filters, over day-grain rows."""
    whole = Window.partitionBy("uid")
    return (
        days.withColumns({"first_day": F.min("day").over(whole), "day_rank": F.dense_rank().over(whole.orderBy("day"))})
        .withColumn("within_horizon", as_flag(F.datediff("day", "first_day") <= horizon))
        .withColumn("mature_patient", as_flag(F.datediff(as_date(as_of), F.col("first_day")) >= maturity))
    )


def active_days(transactions: DataFrame, animals: DataFrame) -> DataFrame:
    """Distinct (uid, day) of known animals: a narrow scan without products or money."""
    days = with_uid_day(transactions).select("uid", "day", "animal_id").distinct()
    return days.join(animals.select(F.col("id").alias("animal_id")), "animal_id", "left_semi").drop("animal_id")


def facts_with_flags(facts: DataFrame, days: DataFrame, as_of: dt.date) -> DataFrame:
    """Facts with their day's flags joined on (uid, day)."""
    return facts.join(with_patient_flags(days, as_of), ["uid", "day"])


def wellness_memberships(
    membership: DataFrame, plans: DataFrame, as_of: dt.date, animals: DataFrame | None = None
) -> DataFrame:
    """Membership starts per (uid, day) with plan name and age in calendar months."""
    named = plans.select("location_id", F.col("ezyvet_id").alias("wellness_plan"), F.col("name").alias("plan_name"))
    out = membership.join(named, ["location_id", "wellness_plan"], "left")
    if animals is not None:
        out = out.join(
            animals.select("location_id", F.col("ezyvet_id").alias("animal_id")), ["location_id", "animal_id"], "left"
        )
    return out.select(
        composite_key("location_id", "animal_id").alias("uid"),
        F.to_date("datetime_start_date").alias("day"),
        F.col("wellness_plan").alias("wellness_plan_num"),
        months_crossed(F.col("datetime_start_date"), as_date(as_of)).alias("months_a_member"),
        F.col("plan_name").alias("wellness_plan"),
    )


def wellness_days(wellness: DataFrame) -> DataFrame:
    """Membership rows and named plans per (uid, day)."""
    return wellness.groupBy("uid", "day").agg(F.count("*").alias("w_rows"), F.count("wellness_plan").alias("w_plans"))
