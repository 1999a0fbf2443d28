"""Spend bands and the train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.keys import hash_bucket
from stayline.functions.numeric import right_closed_band

LABEL = "total_future_spend_bin"


def with_label(df: DataFrame, binary: bool = False) -> DataFrame:
    edges = P.BINARY_EDGES if binary else P.BAND_EDGES
    return df.withColumn(LABEL, right_closed_band(F.col("total_future_spend"), edges))


def with_split(df: DataFrame, key: str = "uid", percent: int = P.TRAIN_PERCENT, seed: int = P.SPLIT_SEED) -> DataFrame:
    """``is_train`` from a hash of the key: the same row always falls on the same side."""
    return df.withColumn("is_train", hash_bucket(key, seed) < percent)
