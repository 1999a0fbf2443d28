"""Adding unknown breed names to the breeds table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stayline.operators.breeds import enrich_new
from stayline.sources.sinks import append_breeds


def enrich(df: DataFrame, known: DataFrame, labelled: DataFrame, rules: Mapping[str, Sequence[str]], path: str | None = None) -> DataFrame:
    """The breeds table completed for ``df``; new rows are also appended to ``path``."""
    fresh = enrich_new(df, known, labelled, rules)
    if path:
        append_breeds(fresh, path)
    return known.select("breed", "tier", "tier_score", "breed_size").unionByName(fresh)
