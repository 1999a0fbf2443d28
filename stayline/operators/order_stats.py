"""Exact percentiles by counting, for groups too large to sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.operators.prefix import running_sums


def _coarse_slot(value: Column) -> Column:
    """Slot number that never decreases with the value; fine near zero, wide far out."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * 64).cast("long")


def percentiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), pieces: int = 4096
) -> DataFrame:
    """Linear-interpolated percentiles of ``value`` per group; nulls ignored.

    Returns ``by..., prob, value``. The result is exact, yet no task sees a whole group:
    rows collapse to counts per distinct value; counts per coarse slot locate the slots
    that hold the wanted order statistics; only those slots are cut into even pieces,
    and only the pieces that hold them are sorted.

    The located slots and pieces number at most two per percentile and group, so they are
    broadcast if there are no groups; else Spark decides.
    """
    by = list(by)
    hint = F.broadcast if not by else (lambda frame: frame)
    values = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    values = values.withColumn("slot", _coarse_slot(F.col("v")))
    # The later join implies these filters on one of its sides. Stated here, both readers of
    # ``values`` have them, stay identical, and share one shuffle.
    for key in [*by, "slot"]:
        values = values.where(F.col(key).isNotNull())

    # The slot table is bounded by the slot function. ``wants`` holds the positions
    # (prob, k) that fall into a slot or piece, of which there are two per percentile.
    slots = values.groupBy(*by, "slot").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    slots = slots.withColumns({"start": F.sum("n").over(group.orderBy("slot")) - F.col("n"), "total": F.sum("n").over(group)})
    all_wants = F.flatten(F.array(*[_positions(float(p)) for p in probs]))
    located = _hit(slots.withColumn("wants", all_wants), "start", "n").select(*by, "slot", "lo", "hi", "start", "total", "wants")

    where_in = F.coalesce(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0))
    near = values.join(hint(located), [*by, "slot"]).withColumn("piece", F.floor(where_in * (pieces - 1)).cast("int"))
    sums = near.groupBy(*by, "slot", "piece", "start", "total", "wants").agg(F.sum("n").alias("pn"))
    before = F.sum("pn").over(Window.partitionBy(*by, "slot").orderBy("piece")) - F.col("pn")
    exact = _hit(sums.withColumn("start", F.col("start") + before), "start", "pn").select(*by, "slot", "piece", "start", "total", "wants")

    few = near.select(*by, "slot", "piece", "v", "n").join(hint(exact), [*by, "slot", "piece"])
    inside = Window.partitionBy(*by, "slot", "piece").orderBy("v")
    ranked = few.withColumn("start", F.col("start") + F.sum("n").over(inside) - F.col("n"))
    hits = _hit(ranked, "start", "n").select(*by, "v", "total", F.explode("wants").alias("w"))
    position = F.col("w.prob") * (F.col("total") - 1)
    found = hits.select(*by, F.col("w.prob").alias("prob"), "v", (position - F.floor(position)).alias("part"))
    return (
        found.groupBy(*by, "prob")
        .agg(F.min("v").alias("below"), F.max("v").alias("above"), F.max("part").alias("part"))
        .select(*by, "prob", (F.col("below") + F.col("part") * (F.col("above") - F.col("below"))).alias("value"))
    )


def _positions(prob: float) -> Column:
    """The one or two row positions between which a percentile lies."""
    at = F.lit(prob) * (F.col("total") - 1)
    return F.array(*[F.struct(F.lit(prob).alias("prob"), k.alias("k")) for k in (F.floor(at), F.ceil(at))])


def _hit(df: DataFrame, start: str, n: str) -> DataFrame:
    """Rows whose position range holds wanted positions, keeping only those."""
    kept = F.filter("wants", lambda w: (w["k"] >= F.col(start)) & (w["k"] < F.col(start) + F.col(n)))
    return df.withColumn("wants", kept).where(F.size("wants") > 0)


def box_stats(df: DataFrame, values: str | Sequence[str], by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, outliers and rows per group, nulls left out; for several columns one
    row each, told by ``measure``.

    One pass over the rows gives counts per distinct value. With the rows before each value these counts are a weighted rank
    structure: quartiles are read at their positions, and whiskers and outlier counts from the same counts again.
    """
    names, by = [values] if isinstance(values, str) else list(values), list(by)
    offered = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in names]))
    rows = df.select(*by, offered.alias("m")).select(*by, "m.measure", "m.v").where("v is not null")
    keys = [*by, "measure"]
    counts = rows.groupBy(*keys, "v").agg(F.count("*").alias("n"))
    ranked = running_sums(counts, "v", ["n"], keys)

    def at(position: Column) -> Column:
        """The value whose rows take up a position."""
        return F.max(F.when((F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n")), F.col("v")))

    picks = {}
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        place = F.lit(p) * (F.col("n_total") - 1)
        picks |= {f"{name}_below": at(F.floor(place)), f"{name}_above": at(F.ceil(place)), f"{name}_part": F.max(place - F.floor(place))}
    found = ranked.groupBy(*keys).agg(*[c.alias(k) for k, c in picks.items()])
    quartile = lambda q: (F.col(f"{q}_below") + F.col(f"{q}_part") * (F.col(f"{q}_above") - F.col(f"{q}_below"))).alias(q)
    boxes = found.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *map(quartile, ("q1", "median", "q3")))
    boxes = boxes.withColumn("reach", 1.5 * (F.col("q3") - F.col("q1")))
    inside = (F.col("v") >= F.col("q1") - F.col("reach")) & (F.col("v") <= F.col("q3") + F.col("reach"))
    out = counts.join(boxes, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("low_whisker"), F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"), F.sum("n").alias("n"),
    )
    return out.drop("measure") if isinstance(values, str) else out


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in even bins between the smallest and largest value; the last bin is closed."""
    x = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))
    # One scalar subquery over the same counts, whose shuffle it shares.
    span = x.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("span")).scalar()
    at = F.coalesce(F.try_divide((F.col("x") - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(0.0))
    return (
        x.select("x", "n", span.alias("span"))
        .select("x", "n", "span.lo", "span.hi")
        .withColumn("bin", F.least(F.floor(at), F.lit(bins - 1)).cast("int"))
        .groupBy("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"))
        .agg(F.sum("n").alias("n"))
    )


def density(df: DataFrame, value: str, by: str | Sequence[str], grid: Sequence[float]) -> DataFrame:
    """Gaussian kernel density on a fixed grid, with Scott's bandwidth per group of one or several keys.

    The grid is a short list of literals, so each grid point is one partial sum: rows are
    neither multiplied by the grid nor brought together before they are summed. Squares are
    taken from the group's mean, so large values cost no precision. A group without spread
    (one value, or all equal) has no bandwidth; its densities are null.
    """
    keys = [by] if isinstance(by, str) else list(by)
    rows = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("x")).agg(F.count("*").alias("m"))
    means = rows.groupBy(*keys).agg(F.sum("m").alias("n"), F.sum(F.col("x") * F.col("m")).alias("s1"))
    centred = rows.join(means, keys).withColumn("d", F.col("x") - F.col("s1") / F.col("n"))
    spread = centred.groupBy(*keys).agg(F.sum(F.col("d") * F.col("d") * F.col("m")).alias("s2"))
    deviation = F.sqrt(F.try_divide(F.col("s2"), F.col("n") - 1))
    near = centred.join(spread, keys).withColumn("h", F.nullif(deviation * F.pow(F.col("n"), F.lit(-0.2)), F.lit(0.0)))

    def kernel(g: float):
        z = (F.lit(float(g)) - F.col("x")) / F.col("h")
        return F.sum(F.col("m") * F.exp(-0.5 * z * z))

    sums = near.groupBy(*keys, "n", "h").agg(F.array(*[kernel(g) for g in grid]).alias("k"))
    points = F.arrays_zip(F.array(*[F.lit(float(g)) for g in grid]).alias("g"), F.col("k"))
    scale = F.col("n") * F.col("h") * F.lit(2.5066282746310002)
    return sums.withColumn("p", F.explode(points)).select(*keys, F.col("p.g").alias("at"), (F.col("p.k") / scale).alias("density"))
