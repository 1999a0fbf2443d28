"""Running sums over an order, without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def splitters_at_or_below(splitters: Column, value: Column, parts: int) -> Column:
    """How many of at most ``parts`` - 1 sorted splitters are not above ``value``, by binary search."""
    powers = [1 << b for b in reversed(range((parts - 1).bit_length()))]
    step = lambda at, by: at + F.when(F.coalesce(F.get(splitters, at + by - 1) <= value, F.lit(False)), by).otherwise(0)
    return F.aggregate(F.array(*map(F.lit, powers)), F.lit(0), step) if powers else F.lit(0)


def running_sums(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False, parts: int = 64) -> DataFrame:
    """``df`` (one row for each value of ``order`` in a group) with <c>_before, the sum of c over the group's rows that come
    earlier, and <c>_total, for every c of ``sums``.

    The values of a group are cut into ranges by splitters that are percentiles of the values themselves, so ranges hold about
    as many values each wherever these lie. Totals per range, at most ``parts`` a group, are carried to the next ranges; only
    a range is sorted.
    """
    by = list(by)
    probs = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    # Group totals come with the splitters, and every branch below keeps both, so that all share the shuffles of this part.
    whole = [F.percentile_approx(order, probs, F.lit(20 * parts)).alias("_splitters"), *[F.sum(c).alias(f"{c}_total") for c in sums]]
    if by:
        groups = df.groupBy(*by).agg(*whole).withColumnsRenamed({k: f"_of_{k}" for k in by})
        ranged = df.join(groups, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]).drop(*[f"_of_{k}" for k in by])
    else:
        ranged = df.withColumn("_whole", df.agg(F.struct(*whole)).scalar()).select(*df.columns, "_whole.*")
    ranged = ranged.withColumn("_range", splitters_at_or_below(F.col("_splitters"), F.col(order), parts)).drop("_splitters")

    totals = ranged.groupBy(*by, "_range", *[f"{c}_total" for c in sums]).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    group = Window.partitionBy(*(by or [F.lit(0)]))  # over the totals only: a row a range
    ends = F.desc if descending else F.asc
    earlier = group.orderBy(ends("_range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_of_{k}") for k in by], F.col("_range").alias("_of_range"),
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_start_{c}") for c in sums],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(ends(order)).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumns({f"_own_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by] + [F.col("_range") == F.col("_of_range")]
    joined = own.join(carried if by else F.broadcast(carried), same)  # without groups it has at most ``parts`` rows
    return joined.select(*df.columns, *[(F.col(f"_start_{c}") + F.col(f"_own_{c}")).alias(f"{c}_before") for c in sums], *[f"{c}_total" for c in sums])
