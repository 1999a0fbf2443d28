"""Visits: runs of consecutive paid days of one patient."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.keys import composite_key
from stayline.functions.numeric import as_flag, money


def with_uid_day(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("uid", composite_key("location_id", "animal_id")).withColumn("day", F.to_date("datetime_date"))


def daily_lines(transactions: DataFrame) -> DataFrame:
    """Revenue per (uid, day, product): the one line-grain aggregation that jobs share.

    Sums are linear, so repeating joins may follow it. It combines map-side and shrinks a
    house account with a huge share of all lines to its days times products before any
    join shuffles them. Visits and facts built from the same frame read and shuffle the
    lines once. Lines without a clinic or patient belong to no uid and are left out; the
    filters are those later joins imply, stated so that all readers stay identical.
    """
    lines = with_uid_day(transactions).where("uid is not null and animal_id is not null and location_id is not null and day is not null")
    return lines.groupBy("uid", "day", "location_id", "animal_id", "product_id", "product_name").agg(money(F.sum("revenue")).alias("revenue"))


def known_uids(animals: DataFrame) -> DataFrame:
    """uids whose (clinic, external id) is a registered animal."""
    return animals.select(composite_key("location_id", "ezyvet_id").alias("uid")).distinct()


def paid_days(lines: DataFrame, animals: DataFrame, rule: str = "net") -> DataFrame:
    """One row per (uid, day) with paid activity, from transactions or daily lines.

    ``rule="net"`` keeps days whose revenue sums above zero; ``rule="line"`` keeps days
    with any positive line, and needs transactions, not daily sums. Registration is tested by a semi join after the aggregation:
    it decides membership only, so lines need not be shuffled for it.
    """
    lines = lines if "uid" in lines.columns else with_uid_day(lines)
    lines = lines.select("uid", "day", "revenue")
    if rule == "net":
        days = lines.groupBy("uid", "day").agg(F.sum("revenue").alias("day_revenue")).where("day_revenue > 0")
    elif rule == "line":
        days = lines.where("revenue > 0").groupBy("uid", "day").agg(F.sum("revenue").alias("day_revenue"))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return days.join(known_uids(animals), "uid", "left_semi")


def number_visits(days: DataFrame, key: str = "uid", day: str = "day", numbering: str = "dense") -> DataFrame:
    """Number the runs of consecutive days within each key.

    ``days`` must hold one row per (key, day). One sort serves everything: a day opens a
    run unless the previous row is the day before. ``numbering="dense"`` counts runs
    1, 2, 3; ``numbering="rank"`` skips by run length (1, 1, 3).
    """
    ordered = Window.partitionBy(key).orderBy(day)
    whole = Window.partitionBy(key)
    position = F.row_number().over(ordered)
    opens = F.coalesce(F.datediff(F.col(day), F.lag(day).over(ordered)) != 1, F.lit(True))
    out = days.withColumn("rank_group", F.date_sub(F.col(day), position)).withColumn("_opens", opens)
    if numbering == "dense":
        visit = F.sum(as_flag(F.col("_opens"))).over(ordered)
    elif numbering == "rank":
        visit = F.max(F.when(F.col("_opens"), position)).over(ordered)
    else:
        raise ValueError(f"unknown numbering {numbering!r}")
    return (
        out.withColumn("visit_number", visit.cast("int"))
        .withColumn("max_num_visit", F.max("visit_number").over(whole))
        .withColumn("visit_more_than_once", as_flag(F.col("max_num_visit") > 1))
        .drop("_opens")
    )


def visits(lines: DataFrame, animals: DataFrame, rule: str = "net", numbering: str = "dense") -> DataFrame:
    """(uid, day) rows with run group, visit number, number of visits and returner flag."""
    return number_visits(paid_days(lines, animals, rule).drop("day_revenue"), numbering=numbering)


def global_visit_rank(numbered: DataFrame) -> DataFrame:
    """Dense rank of visit numbers over all rows.

    Ranks the distinct numbers, of which there are at most as many as a patient has
    visits, and joins them back, instead of sorting every row in one partition.
    """
    distinct = numbered.select("visit_number").distinct()
    ranks = distinct.withColumn("global_rank", F.dense_rank().over(Window.orderBy("visit_number")))
    # Bounded by the calendar: a patient has at most one visit per day.
    return numbered.join(F.broadcast(ranks), "visit_number")
