"""Refreshing stored predictions of patients who came back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stayline.operators import facts as ops
from stayline.operators import lifecycle
from stayline.operators.visits import daily_lines, visits
from stayline.sources.sinks import SCORE_KEY, keyed_update
from stayline.sources.versioned import KeyedTable

REFRESHED = ("total_num_visit", "total_future_spend")


def update_rows(tables, as_of: dt.date, scored: DataFrame | None = None) -> DataFrame:
    """id, key, total_num_visit and total_future_spend of every stored prediction to refresh."""
    scored = tables.scored if scored is None else scored
    lines = daily_lines(tables.transactions)
    facts = ops.line_facts(lines, tables.products, tables.animals, as_of)
    numbered = visits(lines, tables.animals)
    copies = ops.contact_copies(tables.animals, tables.contacts)
    back = lifecycle.returning_patients(facts, numbered, scored, copies)
    return lifecycle.refresh_rows(back, scored)


def refreshed(tables, as_of: dt.date) -> DataFrame:
    """The scores table with the refreshed columns, to be written as its next snapshot."""
    return keyed_update(tables.scored, update_rows(tables, as_of), SCORE_KEY, REFRESHED)


def refresh_table(tables, as_of: dt.date, table: KeyedTable) -> int:
    """Refresh a stored table: only buckets with a returning patient are written anew. Returns how many."""
    return table.update(update_rows(tables, as_of, table.read()), REFRESHED)
