"""Spend snapshots: what a patient had spent before, at, and after each visit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.numeric import money, times
from stayline.operators.facts import fact_days, wellness_days, with_contact_copies, with_patient_flags

SPENDS = ("total_past_spend", "most_recent_visit_spend", "total_future_spend")


def visit_days(
    facts: DataFrame,
    visits: DataFrame,
    wellness: DataFrame | None = None,
    copies: DataFrame | None = None,
    *,
    as_of: dt.date,
    promo_prefix: str = P.PROMO_PREFIX,
    training: bool = True,
    dedupe_wellness: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows per (uid, paid day) with spend totals around the day's visit, for every visit at once.

    ``keep`` splits a day by a few attributes that features need; totals stay the same,
    and the lines need not be read again to attach them.

    Joining memberships to lines repeats the lines of a day once per membership that
    starts that day, and spend with them (``dedupe_wellness`` turns that off). Here the
    repeats are a factor on day totals, so no line is repeated.

    ``training`` applies the horizon and maturity filters before the totals.
    """
    days = fact_days(facts, promo_prefix, keep)
    if wellness is not None:
        days = days.join(wellness_days(wellness), ["uid", "day"], "left")
    else:
        days = days.withColumn("w_rows", F.lit(0)).withColumn("w_plans", F.lit(0))
    # Unpaid days stay until the first day is known, hence a left join here.
    days = days.join(visits.select("uid", "day", "visit_number", "max_num_visit", "visit_more_than_once"), ["uid", "day"], "left")
    if copies is not None:
        days = with_contact_copies(days, copies, "day_spend")
    days = with_patient_flags(days, as_of).where("visit_number is not null")
    if training:
        days = days.where("within_horizon = 1 and mature_patient = 1")

    repeats = F.lit(1) if dedupe_wellness else F.greatest(F.coalesce("w_rows", F.lit(0)), F.lit(1))
    whole = Window.partitionBy("uid")
    by_visit = whole.orderBy("visit_number")
    to_here = by_visit.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    this_visit = by_visit.rangeBetween(Window.currentRow, Window.currentRow)
    return (
        days.withColumn("repeats", repeats)
        .withColumns({
            "_spend": times(F.col("day_spend"), F.col("repeats")),
            "_plans": F.coalesce(F.col("n_rows") * F.col("w_plans"), F.lit(0)),
            "_promo": F.col("n_promo") * F.col("repeats"),
        })
        .withColumns({
            "_total": F.sum("_spend").over(whole),
            "wellness_plan": F.sum("_plans").over(whole),
            "_through": F.sum("_spend").over(to_here),
            "_here": F.sum("_spend").over(this_visit),
            "product_count": F.sum("_promo").over(this_visit),
        })
        .withColumns({
            "total_past_spend": money(F.col("_through") - F.col("_here")),
            "most_recent_visit_spend": money(F.col("_here")),
            "total_future_spend": money(F.col("_total") - F.col("_through")),
        })
        .drop("_spend", "_plans", "_promo", "_total", "_through", "_here", "w_rows", "w_plans")
    )


def snapshot_patients(days: DataFrame) -> DataFrame:
    """One row per (uid, visit_number)."""
    return days.select("uid", "visit_number", "max_num_visit", "visit_more_than_once", "wellness_plan", "product_count", *SPENDS).distinct()


def pick_visit(days: DataFrame, visit_number: int | None = None, up_to: int | None = None) -> DataFrame:
    """Keep one visit number, or all up to a limit, once the totals exist."""
    if visit_number is not None:
        days = days.where(F.col("visit_number") == visit_number)
    if up_to is not None:
        days = days.where(F.col("visit_number") <= up_to)
    return days


SNAPSHOT_COLUMNS = (
    "uid", "breed", "ani_age", "day", "weight", "is_medical", "product_group", "product_name", "product_count",
    "wellness_plan", "visit_number", "visit_more_than_once", "max_num_visit", *SPENDS,
)


def snapshot_lines(facts: DataFrame, days: DataFrame, wellness: DataFrame | None = None) -> DataFrame:
    """Fact rows of the chosen visits with their patient's totals (one row per uid and day).

    With ``wellness`` the rows are repeated per membership of the day, as a plain join
    gives them. Both joins hash on (uid, day), which spreads a busy uid over its days.
    """
    out = facts.drop("revenue").join(days, ["uid", "day"])
    if wellness is not None:
        out = out.join(wellness.select("uid", "day"), ["uid", "day"], "left")
    return out.select(*SNAPSHOT_COLUMNS)


def first_and_future(days: DataFrame) -> DataFrame:
    """Visit-1 variant: first-visit spend and everything that is not visit 1."""
    return pick_visit(days, 1).withColumn("first_visit_spend", F.col("most_recent_visit_spend"))
