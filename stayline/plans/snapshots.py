"""Visit snapshots of every patient, for all visit numbers in one plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stayline import params as P
from stayline.operators import facts as ops
from stayline.operators import spend
from stayline.operators.visits import daily_lines, visits


@dataclass(frozen=True)
class Snapshot:
    """Daily lines, line facts, numbered visits, memberships, and day totals around each visit."""

    lines: DataFrame
    facts: DataFrame
    visits: DataFrame
    wellness: DataFrame
    days: DataFrame


def build(
    tables, as_of: dt.date, *, training: bool = True, promo_prefix: str = P.PROMO_PREFIX, contacts: bool = True, plans: bool = True,
    keep: Sequence[str] = (),
) -> Snapshot:
    """Scan once, number visits once, and total spend for every visit number at once.

    Training and scoring differ only by the horizon and maturity filters.
    """
    lines = daily_lines(tables.transactions)
    numbered = visits(lines, tables.animals)
    facts = ops.line_facts(lines, tables.products, tables.animals, as_of)
    wellness = ops.wellness_memberships(tables.wellness_membership, tables.wellness_plans, as_of)
    if not plans:
        wellness = wellness.withColumn("wellness_plan", wellness["wellness_plan_num"].cast("string"))
    copies = ops.contact_copies(tables.animals, tables.contacts) if contacts else None
    days = spend.visit_days(facts, numbered, wellness, copies, as_of=as_of, promo_prefix=promo_prefix, training=training, keep=keep)
    return Snapshot(lines, facts, numbered, wellness, days)


def visit_lines(tables, snap: Snapshot, as_of: dt.date, visit_number: int, ordered: bool = False) -> DataFrame:
    """The line rows of one visit number with their patient's totals.

    Lines are first narrowed to the days of that visit, so products, animals and the
    closing joins see only those. ``snap`` must be built without ``keep``. ``ordered`` sorts
    by patient and day; a range sort at the end, so ask for it only at a sink.
    """
    days = spend.pick_visit(snap.days, visit_number)
    facts = ops.line_facts(snap.lines, tables.products, tables.animals, as_of, only_days=days)
    out = spend.snapshot_lines(facts, days, snap.wellness)
    return out.orderBy("uid", "day") if ordered else out
