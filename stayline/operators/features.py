"""Feature matrix: one row per (visit number, uid), imputed and one-hot encoded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.dates import as_date, local_day, years_crossed
from stayline.functions.numeric import as_flag, clip, zero_to_null
from stayline.operators.breeds import with_breed_attributes
from stayline.operators.spend import SPENDS

ONE_HOT = (*P.BREED_SIZES, *P.TIERS.values())
MEASURES = ("ani_age", "weight", "is_medical_max", "is_medical_count", "wellness_plan_max", "wellness_plan_count")
MODEL_COLUMNS = (*MEASURES, "most_recent_visit_spend", "total_past_spend", *ONE_HOT)


def one_hot(column: str, vocabulary: Sequence[str] | Mapping[str, str]) -> list[Column]:
    """0/1 columns over a fixed vocabulary; null and unknown values are all zeros.

    A fixed vocabulary keeps training and scoring columns the same.
    """
    names = vocabulary if isinstance(vocabulary, Mapping) else {v: v for v in vocabulary}
    return [as_flag(F.col(column) == value).alias(name) for value, name in names.items()]


ATTRIBUTES = ("breed", "ani_age", "weight", "is_medical")


def patient_rows(days: DataFrame, breeds: DataFrame) -> DataFrame:
    """Distinct attribute rows of the chosen visits, from day totals that kept ``ATTRIBUTES``.

    Day rows shrink to a few rows per uid and visit here; lines are not read again.
    """
    rows = days.select("uid", "visit_number", "wellness_plan", "max_num_visit", *SPENDS, *ATTRIBUTES)
    return with_breed_attributes(rows, breeds).drop("breed").distinct()


def imputation_table(rows: DataFrame, levels: int = 2, by: str = "visit_number") -> DataFrame:
    """Fill values per (visit number, age, size), null age included.

    A missing age becomes the mean age of the visit number. A missing weight becomes the
    mean of its (age, size), else, with two levels, the mean of its size, which includes
    the weights the first level filled in. All means follow from sums and counts per
    (age, size), so windows run over that small table and never over patients.
    """
    stats = rows.groupBy(by, "ani_age", "breed_size").agg(
        F.sum("weight").cast("double").alias("w_sum"), F.count("weight").alias("w_n"), F.count("*").alias("n")
    )
    aged = F.when(F.col("ani_age").isNotNull(), F.col("n"))
    visit = Window.partitionBy(by)
    level_1 = Window.partitionBy(by, "age", "breed_size")
    level_2 = Window.partitionBy(by, "breed_size")
    mean_age = F.try_divide(F.sum(F.col("ani_age") * F.col("n")).over(visit), F.sum(aged).over(visit))
    table = stats.withColumn("age", F.coalesce(F.col("ani_age").cast("double"), mean_age)).withColumn(
        "mean_1", F.try_divide(F.sum("w_sum").over(level_1), F.sum("w_n").over(level_1))
    )
    usable = F.col("mean_1").isNotNull()
    total = F.coalesce("w_sum", F.lit(0.0)) + (F.col("n") - F.col("w_n")) * F.col("mean_1")
    mean_2 = F.try_divide(F.sum(F.when(usable, total)).over(level_2), F.sum(F.when(usable, F.col("n"))).over(level_2))
    fill = F.coalesce("mean_1", mean_2) if levels > 1 else F.col("mean_1")
    return table.select(by, "ani_age", "breed_size", F.col("age").alias("age_filled"), fill.alias("weight_filled"))


def impute(rows: DataFrame, levels: int = 2, zero_missing: bool = True, by: str = "visit_number") -> DataFrame:
    """Rows with ``ani_age`` and ``weight`` filled from the imputation table."""
    if zero_missing:
        rows = rows.withColumn("weight", zero_to_null(F.col("weight")))
    table = imputation_table(rows, levels, by).withColumnRenamed("ani_age", "_age").withColumnRenamed("breed_size", "_size").withColumnRenamed(by, "_by")
    match = (F.col(by) == F.col("_by")) & F.col("ani_age").eqNullSafe(F.col("_age")) & F.col("breed_size").eqNullSafe(F.col("_size"))
    return (
        rows.join(table, match)
        .withColumn("ani_age", F.col("age_filled"))
        .withColumn("weight", F.coalesce(F.col("weight").cast("double"), "weight_filled"))
        .drop("_by", "_age", "_size", "age_filled", "weight_filled")
    )


def feature_frame(rows: DataFrame, clip_future: bool = True, levels: int = 2, zero_missing: bool = True) -> DataFrame:
    """One row per (visit number, uid): maxima and counts over attribute rows, which must be distinct.

    One aggregation gives the counts and the one-hot columns, which are constant per uid.
    Rows that still lack age or weight drop out, as null keys do in a grouped frame.
    """
    measured = ["visit_number", "uid", "ani_age", "weight", "breed_size", "tier", "is_medical", "wellness_plan", "max_num_visit", *SPENDS]
    rows = impute(rows.select(*measured), levels, zero_missing).where("ani_age is not null and weight is not null")
    coded = rows.select("*", *one_hot("breed_size", P.BREED_SIZES), *one_hot("tier", P.TIERS))
    out = coded.groupBy("visit_number", "uid", "ani_age", "weight", "max_num_visit", *SPENDS).agg(
        F.max("is_medical").alias("is_medical_max"),
        F.count("is_medical").alias("is_medical_count"),
        F.max("wellness_plan").alias("wellness_plan_max"),
        F.count("wellness_plan").alias("wellness_plan_count"),
        *[F.max(c).alias(c) for c in ONE_HOT],
    )
    if clip_future:
        out = out.withColumn("total_future_spend", clip(F.col("total_future_spend").cast("double"), 0.0, float(P.SPEND_CAP)))
    return out


def sanity_counters(patients: DataFrame) -> DataFrame:
    """Distinct-uid counters per visit number. Flags are folded per uid first, so one shuffle serves all five."""
    future = F.col("total_future_spend")
    per_uid = patients.groupBy("visit_number", "uid").agg(
        F.max(as_flag(F.col("weight").isNull() | (F.col("weight") == 0))).alias("w"),
        F.max(as_flag(F.col("ani_age").isNull())).alias("a"),
        F.max(as_flag(future > P.SPEND_CAP)).alias("o"),
        F.max(as_flag(future < 0)).alias("u"),
    )
    return per_uid.groupBy("visit_number").agg(
        F.count("*").alias("uids"), F.sum("w").alias("missing_weight"), F.sum("a").alias("missing_age"),
        F.sum("o").alias("over_cap"), F.sum("u").alias("below_zero"),
    )


def breed_weight_avg(animals: DataFrame, transactions: DataFrame, as_of: dt.date) -> DataFrame:
    """Mean weight per (breed, baby), each animal weighted by its number of transactions.

    Transactions shrink to a count per animal before the join.
    """
    counts = transactions.groupBy("animal_id").agg(F.count("*").alias("n"))
    age = years_crossed(local_day(F.col("date_of_birth"), P.LOCAL_ZONE), as_date(as_of))
    banded = animals.select(F.col("id").alias("animal_id"), "breed", "weight", F.when(age <= 1, "baby").otherwise("adult").alias("baby"))
    seen = banded.join(counts, "animal_id")
    weighed = F.when(F.col("weight").isNotNull(), F.col("n"))
    return seen.groupBy("breed", "baby").agg(
        F.try_divide(F.sum(F.col("weight") * F.col("n").cast("decimal(12,0)")).cast("double"), F.sum(weighed)).alias("avg_weight")
    )


def fill_weight(rows: DataFrame, averages: DataFrame, literal: bool = False) -> DataFrame:
    """Unknown weights (zero, negative, null) from the breed's average for its age band.

    Unknown ages of those rows become ten; below one year is a baby. By default a row
    without a matching average keeps a null weight for later imputation, and null weights
    count as unknown. ``literal`` drops both kinds of rows.
    """
    weight = F.col("weight")
    unknown = (weight <= 0) if literal else (weight.isNull() | (weight <= 0))
    age = F.when(unknown, F.coalesce("ani_age", F.lit(P.DEFAULT_AGE))).otherwise(F.col("ani_age"))
    marked = (rows.where(weight.isNotNull()) if literal else rows).withColumn("_unknown", unknown).withColumn("ani_age", age)
    marked = marked.withColumn("baby", F.when(F.col("ani_age") < 1, "baby").otherwise("adult"))
    filled = marked.join(averages, ["breed", "baby"], "left")
    if literal:
        filled = filled.where(~F.col("_unknown") | F.col("avg_weight").isNotNull())
    return filled.withColumn("weight", F.when(F.col("_unknown"), F.col("avg_weight")).otherwise(weight.cast("double"))).drop("_unknown", "baby", "avg_weight")


def drop_dirty(animals: DataFrame, dirty_breed: str = P.DIRTY_BREED) -> DataFrame:
    """Drop rows bad in both weight and breed; null differs from every value here."""
    weight_ok = F.col("weight").isNull() | (F.col("weight") != 0)
    breed_ok = F.col("breed").isNull() | (F.col("breed") != dirty_breed)
    return animals.where(weight_ok | breed_ok)
