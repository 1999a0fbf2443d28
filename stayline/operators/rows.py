"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeat_rows(df: DataFrame, factor: str, block: int = 1024) -> DataFrame:
    """Each row ``factor`` times. Generated block by block, so no row builds a long array."""
    n = F.col(factor).cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / block).cast("long"))
    size = F.least(F.lit(block).cast("long"), n - F.col("_block") * block).cast("int")
    return (
        df.where(n > 0)
        .withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0).cast("tinyint"), size)))
        .drop("_block", "_copy", factor)
    )


def split_by(df: DataFrame, condition) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and rows where it is false. Null goes to neither."""
    return df.where(condition), df.where(~condition)
