"""Exact top-k search by inner product, in three phases with a uniform threshold.

Every vector is cut into slices of its dimensions; a pair's score is the sum of its slice scores. Queries and candidates
meet in blocks: each block of queries with each shard of candidates, two sides of bounded size in one task.

1. Each task takes the k best of every slice's score list, adds up their full scores and keeps the k best sums.
2. The k-th best of these over all shards is a cutoff that the true k-th best score cannot be below; it goes back to every
   shard with its query. A pair can only reach it if some slice score is at least an equal share of it: those are collected.
3. The collected entries' scores are resolved exactly, and what reaches the cutoff is ranked, ties by the smaller id.

Vectors that are null or hold a null or non-finite component, and rows with a null id, take no part. Shorter vectors count
as padded with zeros. If a query's id is repeated, its smallest vector is searched for; each repeated candidate row is a
candidate, and rows with the query's own id are none. Fewer candidates than k: all are returned; empty tables give an
empty result. Scores beyond 64 bits are set to the nearest long. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LONG = np.iinfo(np.int64)
_AT_ONCE = 64  # queries whose score lists are held at a time


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def scaled(vector: Column, factor: int = 1024) -> Column:
    """Whole numbers floor(factor * x), kept as doubles: floor() to a long would clip the largest."""
    def whole(x: Column) -> Column:
        y = x.cast("double") * factor
        return F.when(F.abs(y) < 2**52, F.floor(y).cast("double")).otherwise(y)  # a double that large is whole

    return F.transform(vector, whole)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _slice_scores(queries: np.ndarray, candidates: np.ndarray, slices: list[np.ndarray]) -> list[np.ndarray]:
    """Integer scores of each slice; in Python integers where doubles could not hold them exactly."""
    most = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(1, queries.shape[1])
    if most < 2**53:
        return [queries[:, s] @ candidates[:, s].T for s in slices]
    exact = np.frompyfunc(int, 1, 1)
    return [exact(queries[:, s]).dot(exact(candidates[:, s]).T) for s in slices]


def _meet(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, parts: int, search: bool) -> pd.DataFrame:
    """One block of queries against one shard. Phase 1 (no ``search``): the k best sums found in the slices' lists;
    phases 2 and 3: the k best of what reaches the cutoff."""
    out: list[tuple[int, int, int]] = []
    if not len(queries) or not len(candidates):
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    width = max(queries["vector"].map(len).max(), candidates["vector"].map(len).max(), 1)
    own, others = _matrix(queries["vector"], width), _matrix(candidates["vector"], width)
    slices = [s for s in np.array_split(np.arange(width), parts) if len(s)]
    query_ids, ids = queries["query_id"].to_numpy(np.int64), candidates["vec_id"].to_numpy(np.int64)
    cutoffs = queries["cutoff"].tolist() if search else [None] * len(queries)
    for lo in range(0, len(own), _AT_ONCE):
        scores = _slice_scores(own[lo : lo + _AT_ONCE], others, slices)
        for row in range(len(scores[0])):
            at = lo + row
            other = ids != query_ids[at]
            cutoff = cutoffs[at]
            if search:
                # whole scores: a share of the cutoff is compared as slices * score >= cutoff
                kept = other if pd.isna(cutoff) else other & np.logical_or.reduce([len(slices) * s[row] >= int(cutoff) for s in scores])
                found = np.flatnonzero(kept)
            else:
                lists = []
                for s in scores:
                    shown = np.flatnonzero(other)
                    if len(shown) > k:
                        shown = shown[np.argpartition(s[row][shown], len(shown) - k)[-k:]]
                    lists.append(shown)
                found = np.unique(np.concatenate(lists))
            sums = sum(s[row][found] for s in scores)
            if search and not pd.isna(cutoff):
                reached = np.flatnonzero(sums >= int(cutoff))
                found, sums = found[reached], sums[reached]
            if len(found) > 4 * k and sums.dtype != object:
                least = np.partition(sums, len(sums) - k)[len(sums) - k]
                found, sums = found[sums >= least], sums[sums >= least]
            best = sorted(zip([-int(x) for x in sums], ids[found].tolist()))[:k]
            out += [(int(query_ids[at]), i, min(max(-s, _LONG.min), _LONG.max)) for s, i in best]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def search(queries: DataFrame, candidates: DataFrame, k: int = 10, parts: int = 4, block_rows: int = 1_024, shard_rows: int = 16_384) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best of ``candidates`` for each of ``queries`` (both: vec_id,
    vector of whole doubles). A task holds about ``block_rows`` queries and ``shard_rows`` candidates."""
    spark = queries.sparkSession
    asked = queries.where(F.col("vec_id").isNotNull()).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    others = candidates.where(F.col("vec_id").isNotNull()).select("vec_id", "vector")
    n_asked, n_others = asked.count(), others.count()
    blocks = max(1, math.ceil(n_asked / block_rows))
    shards = max(1, math.ceil(n_others / shard_rows), min(spark.sparkContext.defaultParallelism, n_others // 512))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    to_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    to_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    dealt = others.select("*", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard")).select("*", to_blocks)
    shape = "query_id long, vec_id long, score long"

    def meet(side: DataFrame, searching: bool) -> DataFrame:
        left = side.select("*", to_shards).groupBy("block", "shard")
        return left.cogroup(dealt.groupBy("block", "shard")).applyInPandas(lambda q, c: _meet(q, c, k, parts, searching), shape)

    def best(rows: DataFrame, order: list[Column]) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)

    lists = best(meet(asked, False), [F.col("score").desc()])
    cutoffs = lists.groupBy(F.col("query_id").alias("of")).agg(F.when(F.count("*") == k, F.min("score")).alias("cutoff"))
    told = asked.join(cutoffs, F.col("query_id") == F.col("of"), "left").drop("of")
    return best(meet(told, True), [F.col("score").desc(), F.col("vec_id")]).select("query_id", "rank", "vec_id", "score")
