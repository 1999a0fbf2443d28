"""Composite keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def composite_key(*parts: str | Column, sep: str = "_") -> Column:
    """Parts joined by ``sep``. Null if any part is null (``concat_ws`` would skip it)."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append((F.col(part) if isinstance(part, str) else part).cast("string"))
    return F.concat(*pieces)


def hash_bucket(key: str | Column, seed: int, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of md5(key|seed).

    Depends on the row alone, so a split made with it does not change under
    repartitioning or task retries, unlike ``randomSplit``.
    """
    text = F.concat((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(f"|{seed}"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
