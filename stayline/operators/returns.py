"""The return study: who comes back, after how long, buying what."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.dates import as_date, epoch_to_timestamp, months_before, years_crossed
from stayline.functions.numeric import as_flag, money, row_scaled, times
from stayline.functions.text import first_words
from stayline.operators.order_stats import histogram
from stayline.session import shuffled

PRODUCT_KEYS = ("product_id", "location_id")


def _medical(products: DataFrame, *columns: str) -> DataFrame:
    return products.where("is_medical = 1").select(F.col("ezyvet_id").alias("product_id"), "location_id", *columns)


def line_kinds(transactions: DataFrame) -> DataFrame:
    """Equal lines of an animal, clinic, product and day as one, with how many there are. Returners and the profile both read
    this, so that the lines are read and shuffled once and only kinds meet products and animals."""
    keys = ["animal_id", "location_id", "division_id", "product_id", F.to_date("datetime_date").alias("day"), "revenue"]
    return transactions.groupBy(*keys).agg(F.count("*").alias("lines")).where("lines > 0")


def returners(
    transactions: DataFrame, products: DataFrame, animals: DataFrame, divisions: DataFrame | None = None,
    *, match_clinic: bool = True, drop_excluded: bool = True, day_revenue: float = P.RETURN_DAY_REVENUE,
) -> DataFrame:
    """Living, active animals with at least two medical days of revenue above the bound.

    A second qualifying day and a day rank above one say the same, so days are counted,
    not ranked. ``match_clinic=False, drop_excluded=False`` is the laxer variant.
    """
    medical = _medical(products, "product_group")
    if drop_excluded:
        medical = medical.where(F.col("product_group") != P.EXCLUDED_GROUP)
    alive = animals.where("is_dead = 0 and active = 1").select(F.col("id").alias("animal_id"), "location_id")
    lines = line_kinds(transactions)
    if divisions is not None:
        lines = lines.join(divisions.select("division_id"), "division_id", "left")
    paid = lines.join(medical.drop("product_group"), list(PRODUCT_KEYS))
    paid = paid.join(alive, ["animal_id", "location_id"]) if match_clinic else paid.join(alive.select("animal_id"), "animal_id")
    days = paid.groupBy("animal_id", "day").agg(F.sum(times(F.col("revenue"), F.col("lines"))).alias("r")).where(F.col("r") > day_revenue)
    return days.groupBy("animal_id").agg(F.count("*").alias("days")).where("days > 1").select("animal_id")


def with_return_flag(df: DataFrame, returned: DataFrame) -> DataFrame:
    """1 for animals in ``returned`` (distinct ids), else 0."""
    hit = returned.select("animal_id", F.lit(1).alias("_hit"))
    return df.join(hit, "animal_id", "left").withColumn("visit_more_than_once", F.coalesce("_hit", F.lit(0))).drop("_hit")


PROFILE_KEYS = ("animal_id", "species", "day", "weight", "name", "type", "tracking_level", "product_group", "visit_more_than_once")


def return_profile(
    transactions: DataFrame, products: DataFrame, animals: DataFrame, returned: DataFrame, as_of: dt.date,
    contacts: DataFrame | None = None, species_part: str | None = None, breed: bool = False,
) -> DataFrame:
    """Medical lines per animal, day and product, with day rank and day total.

    Lines equal in every column, amount included, collapse before ranks and totals, so a
    contact stored twice changes nothing and ``contacts`` may be left out. Ranks and
    totals are taken on one row per (animal, day) and joined back.
    """
    subject = "breed" if breed else "species"
    keep = animals
    if species_part:
        keep = keep.where(F.col("species").contains(species_part) & (F.col("breed") != P.DIRTY_BREED))
    born = epoch_to_timestamp(F.col("date_of_birth"))
    who = with_return_flag(
        keep.select(F.col("id").alias("animal_id"), "contact_id", subject, "weight", years_crossed(born, as_date(as_of)).alias("ani_age")), returned
    )
    what = _medical(products, "name", "type", "tracking_level", "product_group").where(
        ~F.col("name").contains(P.EXCLUDED_NAME_PART) & (F.col("product_group") != P.EXCLUDED_GROUP)
    )
    lines = line_kinds(transactions).select("animal_id", "location_id", "product_id", "day", "revenue")
    # Where the flag is not asked for, ``who`` is the animals alone.
    joined = lines.join(what, list(PRODUCT_KEYS)).join(shuffled(who), "animal_id")
    if contacts is not None:
        stored = contacts.select(F.col("ezyvet_id").alias("contact_id"), "location_id")
        joined = joined.join(stored, ["contact_id", "location_id"], "left")
    keys = [subject if k == "species" else k for k in PROFILE_KEYS]
    kinds = joined.groupBy(*keys, "revenue").agg(F.max("ani_age").alias("ani_age"))
    # ``rank_`` and the day total follow from (animal, day), so the closing aggregation
    # comes first, and both sides of the join share its shuffles.
    lines = kinds.groupBy(*keys, "ani_age").agg(money(F.sum("revenue")).alias("revenue"))
    days = lines.groupBy("animal_id", "day").agg(money(F.sum("revenue")).alias("rev_day_total"))
    animal = Window.partitionBy("animal_id")
    days = days.withColumns({"rank_": F.dense_rank().over(animal.orderBy("day")), "first_day": F.min("day").over(animal)})
    return lines.join(days, ["animal_id", "day"])


def seen_before(profile: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """Rows of animals first seen before the cutoff.

    A membership test that repeats nothing. The profile carries each animal's first day,
    so it is a filter; the profile is not built a second time to find the animals.
    """
    return profile.where(F.col("first_day") < months_before(as_of, months))


def animal_days(profile: DataFrame) -> DataFrame:
    return profile.select("animal_id", "day", "rank_", "visit_more_than_once").distinct()


def visit_gaps(profile: DataFrame) -> DataFrame:
    """Days between an animal's first and second day, without a self join."""
    first = F.min(F.when(F.col("rank_") == 1, F.col("day")))
    second = F.min(F.when(F.col("rank_") == 2, F.col("day")))
    gaps = profile.where("rank_ <= 2").groupBy("animal_id").agg(first.alias("d1"), second.alias("d2"))
    return gaps.where("d1 is not null and d2 is not null").select("animal_id", F.datediff("d2", "d1").alias("gap_days"))


def visit_gap_histogram(profile: DataFrame, bins: int = P.HIST_BINS) -> DataFrame:
    return histogram(visit_gaps(profile), "gap_days", bins)


def shorten_names(profile: DataFrame, subject: str = "species") -> DataFrame:
    """Revenue per animal, day and two-word product name."""
    keys = ["animal_id", subject, "day", "name", "type", "tracking_level", "product_group", "visit_more_than_once", "rank_"]
    return profile.withColumn("name", first_words(F.col("name"))).groupBy(*keys).agg(money(F.sum("revenue")).alias("revenue"))


def max_visit_distribution(profile: DataFrame) -> DataFrame:
    per_animal = profile.groupBy("animal_id").agg(F.max("rank_").alias("max_rank"))
    return per_animal.groupBy("max_rank").agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str, order: str | None = None) -> DataFrame:
    """Rows per value, unordered or ordered by ``"frequency"`` or ``"key"``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    if order is None:
        return counts
    return counts.orderBy(F.desc("n"), column) if order == "frequency" else counts.orderBy(column)


def return_rate(profile: DataFrame) -> DataFrame:
    """Animals by return flag and the share that returned."""
    return (
        profile.groupBy("animal_id", "visit_more_than_once").agg(F.lit(1).alias("one"))
        .agg(F.count("*").alias("animals"), F.sum("visit_more_than_once").alias("returned"), F.avg("visit_more_than_once").alias("rate"))
    )


def facet_shares(profile: DataFrame, facets: Sequence[str] = ("species", "ani_age", "type", "product_group")) -> DataFrame:
    """Animals per facet value and return flag, with the share inside the facet value.

    All facets come from one pass: each row offers its facet values, which then collapse
    to distinct animals map-side.
    """
    offered = F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("facet_value")) for f in facets]))
    animals = profile.select("animal_id", "species", "visit_more_than_once", offered.alias("f")).select(
        "animal_id", "species", "visit_more_than_once", "f.facet", "f.facet_value"
    ).where("facet_value is not null").distinct()
    counts = animals.groupBy("facet", "facet_value", "visit_more_than_once").agg(F.count("*").alias("n"))
    # At most two rows per facet value.
    total = F.sum("n").over(Window.partitionBy("facet", "facet_value"))
    return counts.withColumn("share", F.col("n") / total)


def group_transition(profile: DataFrame) -> DataFrame:
    """Product groups of returners at their first and second day."""
    rows = profile.where("visit_more_than_once = 1 and rank_ in (1, 2)")
    counts = rows.groupBy("product_group").pivot("rank_", [1, 2]).count()
    return counts.select("product_group", F.coalesce("1", F.lit(0)).alias("visit_1"), F.coalesce("2", F.lit(0)).alias("visit_2"))


def group_columns(groups: Sequence[str]) -> dict[str, str]:
    """Column name per product group: lower case, words joined by underscores."""
    return {g: "_".join("".join(c if c.isalnum() else " " for c in g).lower().split()) for g in groups}


def one_hot_sums(lines: DataFrame, keys: Sequence[str], groups: Sequence[str], column: str = "product_group") -> DataFrame:
    """Rows per key and product group, one column per group of a fixed list."""
    return lines.groupBy(*keys).agg(
        *[F.sum(as_flag(F.col(column) == g)).alias(name) for g, name in group_columns(groups).items()]
    )


def mean_profile(sums: DataFrame, by: str, groups: Sequence[str]) -> DataFrame:
    return sums.groupBy(by).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in group_columns(groups).values()])


def scale_profile(profile: DataFrame, by: str, groups: Sequence[str]) -> DataFrame:
    """Each profile row scaled to 0..1 over its own columns."""
    names = list(group_columns(groups).values())
    scaled = profile.select(by, row_scaled(F.array(*names)).alias("s"))
    return scaled.select(by, *[F.element_at("s", i + 1).alias(c) for i, c in enumerate(names)])


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def frequent_rows(df: DataFrame, column: str = "name", more_than: int = P.FREQUENT_NAME_ROWS, excluded: str = P.EXCLUDED_PROCEDURE) -> DataFrame:
    """Rows whose value occurs more than a number of times.

    Values are counted with partial sums and tested by a semi join; no window gathers all
    rows of one frequent value.
    """
    rows = df.where(F.col(column) != excluded)
    often = rows.groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") > more_than)
    return rows.join(often, column, "left_semi")
