"""The return study's profile of medical lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stayline.operators import returns


def profile(tables, as_of: dt.date, cutoff: bool = True, dogs_by_breed: bool = False) -> DataFrame:
    """Profile of animals seen before the cutoff; by species, or dogs by breed."""
    back = returns.returners(tables.transactions, tables.products, tables.animals, tables.divisions)
    out = returns.return_profile(
        tables.transactions, tables.products, tables.animals, back, as_of,
        species_part="Dog" if dogs_by_breed else None, breed=dogs_by_breed,
    )
    return returns.seen_before(out, as_of) if cutoff else out
