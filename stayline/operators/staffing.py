"""Staff utilisation and revenue per hour."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.dates import dow_monday0, dow_sunday0
from stayline.functions.numeric import as_flag, money, ratio, two_sided_p, utilisation
from stayline.functions.text import leading


def _medical_appointments(lines: DataFrame) -> DataFrame:
    return lines.where("appt_is_medical = 1 and appointment_id is not null")


def revenue_by_dow(lines: DataFrame) -> DataFrame:
    """Mean invoice revenue per network and weekday (Sunday is 0)."""
    invoices = (
        _medical_appointments(lines)
        .groupBy(leading(F.col("division_name"), 3).alias("network"), "transaction_at", "invoice_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    mean = F.sum("revenue").cast("double") / F.count("revenue")
    return invoices.groupBy("network", dow_sunday0(F.col("transaction_at")).alias("appointment_dow")).agg(mean.alias("average_rev"))


def revenue_pivot(by_dow: DataFrame) -> DataFrame:
    wide = by_dow.groupBy("network").pivot("appointment_dow", list(range(7))).agg(F.avg("average_rev"))
    return wide.select("network", *[F.col(str(d)).alias(f"dow_{d}") for d in range(7)])


def doctor_days(lines: DataFrame) -> DataFrame:
    """Appointments, first appointments and revenue per division, day and doctor."""
    keys = ["division_name", "network_id", F.to_date("revenue_at").alias("appointment_at_date"), "veterinarian"]
    visits = _medical_appointments(lines).groupBy(*keys, "appointment_id", "first_appt").agg(money(F.sum("revenue")).alias("revenue"))
    return visits.groupBy("division_name", "network_id", "appointment_at_date", "veterinarian").agg(
        F.countDistinct("appointment_id").alias("appointment_count"),
        F.sum("first_appt").alias("first_appointment_count"),
        money(F.sum("revenue")).alias("revenue"),
    )


def doctor_utilisation(availability: DataFrame, days: DataFrame) -> DataFrame:
    """Availability joined with revenue, and the measures derived from both."""
    keys = {"appointment_at_date": "appointment_date", "veterinarian": "primary_resource_name"}
    earned = days.drop("network_id").withColumnsRenamed(keys)
    # The date leads the key: sorting starts on it, and divisions share long name prefixes.
    joined = availability.join(earned, ["appointment_date", "primary_resource_name", "division_name"])
    minutes = F.col("minutes_in_office") - F.col("block_minutes")
    return (
        joined.withColumn("weekday", dow_monday0(F.col("appointment_date")))
        .withColumn("doctor_utilization", utilisation(F.col("free_time"), F.col("minutes_in_office"), F.col("block_minutes")))
        .withColumn("rev_per_min", ratio(F.col("revenue"), minutes))
        .withColumn("rev_per_hour", F.col("rev_per_min") * 60)
        .withColumn("first_appt_ratio", F.coalesce(ratio(F.col("first_appointment_count"), F.col("appointment_count")), F.lit(0.0)))
        .withColumn("network", leading(F.col("division_name"), 3))
    )


def in_study(util: DataFrame, after: str, before: str, below: float = P.REV_PER_HOUR_MAX) -> DataFrame:
    """Rows strictly inside the dates with revenue per hour strictly between 0 and the bound."""
    day, rate = F.col("appointment_date"), F.col("rev_per_hour")
    inside = (day > F.lit(after).cast("date")) & (day < F.lit(before).cast("date"))
    return util.where(inside & (rate > 0) & (rate < below))


def outliers(util: DataFrame, bound: float = P.OUTLIER_REV_PER_HOUR) -> DataFrame:
    return util.where(F.col("rev_per_hour") > bound)


def without_outliers(util: DataFrame, bound: float = P.OUTLIER_REV_PER_HOUR) -> DataFrame:
    return util.where(F.col("rev_per_hour") <= bound)


def mean_and_count(util: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return util.where(F.col(value).isNotNull()).groupBy(*by).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def rows_per_doctor_day(util: DataFrame) -> DataFrame:
    """Rows per doctor and day, most first."""
    counts = util.groupBy("primary_resource_name", "appointment_date").agg(F.count("division_name").alias("n"))
    return counts.orderBy(F.desc("n"), "primary_resource_name", "appointment_date")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, each over the rows where both are present.

    All pairs are partial aggregates of one pass.
    """
    pairs = [(a, b) for a in columns for b in columns]
    unique = {tuple(sorted(p)) for p in pairs if p[0] != p[1]}
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in sorted(unique)])

    def cell(a: str, b: str) -> Column:
        return F.lit(1.0) if a == b else F.col("|".join(sorted((a, b))))

    cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), cell(a, b).alias("r")) for a, b in pairs]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def in_networks(codes: Sequence[str], division: str = "division_name") -> Column:
    """True where the division name holds any of the codes."""
    out = F.lit(False)
    for code in codes:
        out = out | F.col(division).contains(code)
    return out


def split_per_code(util: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One copy of each row per code: side A where the division holds it, else side B.

    This is how the split was written: a division of a listed network is on side B once
    per other code. ``in_networks`` is the split that was meant.
    """
    code = F.explode(F.array(*[F.lit(c) for c in codes]))
    return util.withColumn("code", code).withColumn("side", F.when(F.col("division_name").contains(F.col("code")), "A").otherwise("B"))


def t_tests(df: DataFrame, value: str, samples: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Student's t (equal variances) with its two-sided p for named pairs of row conditions, in one pass."""
    v = F.col(value).cast("double")
    aggs = []
    for name, (first, second) in samples.items():
        for side, cond in (("a", first), ("b", second)):
            x = F.when(cond, v)
            aggs += [F.count(x).alias(f"{name}|n{side}"), F.avg(x).alias(f"{name}|m{side}"), F.var_samp(x).alias(f"{name}|v{side}")]
    rows = [
        F.struct(F.lit(name).alias("test"), *[F.col(f"{name}|{s}{side}").alias(f"{s}_{side}") for side in "ab" for s in "nmv"])
        for name in samples
    ]
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumn("df", F.col("n_a") + F.col("n_b") - 2)
    pooled = F.try_divide((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_b") - 1) * F.col("v_b"), F.col("df"))
    spread = F.sqrt(pooled * (F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b"))))
    out = out.withColumn("t", F.try_divide(F.col("m_a") - F.col("m_b"), spread))
    return out.withColumn("p", two_sided_p(F.col("t"), F.col("df")))
