"""Mixes sources to target weights by Pfair scheduling.

The rows of a source stand in blocks of ``block_rows``, in an order by hash of their id, one block to a slot: block i of a
source with share w is released at floor(i / w) and due at ceil((i + 1) / w). Earliest deadline first over the released
blocks fills the slots, so at every slot each source that still has blocks is within one block of its weight, however long
the table. The driver deals the slots, one step to a block, from the row counts of the sources; every block finds its slot
by its number. When a source is used up, slots for which no other block is released yet stay empty.

Null sources are a source of their own; rows with a null id come at the hash of null. A source without a given weight, or
with one that is null, infinite or not positive, gets a small share, so that no row is lost; shares under 1e-12 count as
1e-12. Rows that repeat an id are rows of their own and stand next to each other, in any order. An empty table gives an
empty result.
Columns of the input may have any names: they travel inside one struct.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from fractions import Fraction
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks of a source whose times travel in one row.
CHUNK = 1_024
#: Schedules up to this many blocks, 24 bytes each, are broadcast.
BROADCAST_BLOCKS = 1_000_000
LEAST_SHARE = 1e-12


def natural_weights(docs: DataFrame, power: float = 0.7) -> DataFrame:
    """source and weight: row counts to a power below one, which lifts small sources."""
    return docs.groupBy("source").agg(F.pow(F.count("*").cast("double"), power).alias("weight"))


def quotas(docs: DataFrame, weights: DataFrame, resolution: int) -> DataFrame:
    """source, place (from 0), quota, its weight in the mixture, and n, its rows; one row for each source of ``docs``. The
    weights count in proportion."""
    good = F.col("weight").cast("double")
    usable = weights.where((good > 0) & (good < F.lit(math.inf))).groupBy(F.col("source").alias("_of")).agg(F.sum(good).alias("_weight"))
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    named = counts.join(usable, F.col("source").eqNullSafe(F.col("_of")), "left")
    everything = Window.orderBy(F.col("source").asc_nulls_first())  # a row per source
    total = F.coalesce(F.sum("_weight").over(Window.partitionBy(F.lit(0))), F.lit(1.0))
    quota = F.greatest(F.coalesce(F.col("_weight"), total / resolution), total * LEAST_SHARE)
    return named.select("source", (F.row_number().over(everything) - 1).alias("place"), quota.alias("quota"), "n")


def deal(quotas: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """place, release, due and slot of each block, by slot. A source's blocks come in their order.

    Whole numbers throughout: a weight stands for its shortest decimal form, so nothing is rounded however many blocks there
    are. Each step gives the slot to the released block that is due first; if there is none, slots pass empty.
    """
    exact = [Fraction(repr(q)) for q in quotas]
    scale = math.lcm(*(q.denominator for q in exact))
    share = [int(q * scale) for q in exact]
    total = sum(share)
    given = [0] * len(share)
    waiting = [(0, place) for place, n in enumerate(blocks) if n]
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, place = heappop(waiting)
            heappush(ready, (-(-(given[place] + 1) * total // share[place]), place, release))
        due, place, release = heappop(ready)
        yield place, release, due, slot
        given[place] += 1
        if given[place] < blocks[place]:
            heappush(waiting, (given[place] * total // share[place], place))
        slot += 1


def schedule(spark: SparkSession, quota_rows: list[Row], block_rows: int) -> DataFrame:
    """place, chunk and times, the release, due and slot of up to ``CHUNK`` blocks of a source, which have the numbers from
    chunk * CHUNK."""
    places: list[int] = []
    chunks: list[int] = []
    times: list[array] = []
    open_, done = {}, [0] * len(quota_rows)
    for place, *own in deal([r.quota for r in quota_rows], [-(-r.n // block_rows) for r in quota_rows]):
        if done[place] % CHUNK == 0:
            open_[place] = array("q")
            places.append(place)
            chunks.append(done[place] // CHUNK)
            times.append(open_[place])
        open_[place].extend(own)
        done[place] += 1
    ends = list(accumulate(map(len, times), initial=0))
    joined = array("q")
    for own in times:
        joined.extend(own)
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(joined, np.int64) if joined else [], pa.int64()))
    return spark.createDataFrame(pa.table({"place": pa.array(places, pa.int32()), "chunk": pa.array(chunks, pa.int64()), "times": lists}), "place int, chunk long, times array<long>")


def scheduled(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = 64, resolution: int = 1_000, bucket_rows: int = 4_096) -> DataFrame:
    """row (a struct of the columns of ``docs``), source, block (from 0), release, due, slot and place_in_block. The order
    of the mixture is by slot and place_in_block. A source without a usable weight gets one over ``resolution`` of the sum
    of the others."""
    spark = docs.sparkSession
    spread = quotas(docs, natural_weights(docs) if weights is None else weights, resolution).orderBy("place").collect()  # a row per source
    rows = sum(r.n for r in spread)
    turns = schedule(spark, spread, block_rows)
    if rows // block_rows + len(spread) <= BROADCAST_BLOCKS:
        turns = F.broadcast(turns)
    shape = T.StructType([docs.schema["source"], T.StructField("place", T.IntegerType())])
    places = F.broadcast(spark.createDataFrame(pa.table({"source": pa.array([r.source for r in spread], pa.string()), "place": pa.array([r.place for r in spread], pa.int32())}), shape))
    places = places.select(F.col("source").alias("_q"), F.col("place").alias("_of"))
    bits = max(0, math.ceil(math.log2(max(1, rows / bucket_rows))))

    # The place of a row in its source: rows before its bucket of hashes, plus its place in the bucket. No source is sorted
    # as a whole. A source goes by its number, which is never null, so that rows dealt by (_of, _bucket) for their place meet
    # the sizes of the buckets where they are: whole rows move for their place, and once more into the order of the slots (and
    # to meet the schedule, if it is too long to be broadcast).
    hashed = docs.select(F.struct("*").alias("row"), F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.xxhash64("doc_id").alias("_hash"))
    hashed = hashed.withColumn("_bucket", F.shiftrightunsigned("_hash", 64 - bits) if bits else F.lit(0).cast("long"))
    hashed = hashed.join(places, F.col("_source").eqNullSafe(F.col("_q"))).drop("_q")
    sizes = hashed.groupBy("_of", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_of").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("_of").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_of", "_bucket").orderBy("_hash", "_id")) - 1
    placed = hashed.withColumn("_place", place).join(sizes, (F.col("_of") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    at = F.col("_before") + F.col("_place")
    placed = placed.select("row", "_source", "_of", F.expr(f"(_before + _place) div {block_rows}").alias("block"), (at % block_rows).cast("int").alias("place_in_block"))

    dealt = placed.withColumn("_chunk", F.expr(f"block div {CHUNK}")).join(turns, (F.col("_of") == F.col("place")) & (F.col("_chunk") == F.col("chunk")))
    first = (F.col("block") % CHUNK * 3).cast("int")
    return dealt.select(
        "row", F.col("_source").alias("source"), "block", F.get("times", first).alias("release"), F.get("times", first + 1).alias("due"),
        F.get("times", first + 2).alias("slot"), "place_in_block",
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` in the order of the mixture: dealt to partitions by slot and sorted within them."""
    spark = docs.sparkSession
    rows = scheduled(docs, **how)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(count, "slot", "place_in_block").sortWithinPartitions("slot", "place_in_block").select("row.*")
