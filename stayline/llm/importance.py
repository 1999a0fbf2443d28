"""Importance resampling towards a target: the documents that look most like it, drawn with Gumbel noise.

A text's features are its words and pairs of neighbouring words, hashed to buckets. The counts of all buckets over the corpus
and over the target make one array of gains; a document's weight is the mean gain of its features, and its score adds noise
that its id alone decides. The highest scores are drawn.

Ranks come from parallel sorting by regular sampling. Each task writes its rows as a sorted run; rows at regular places of
the runs give the splitters; segments between splitters are exchanged and merged, and the row counts of the ranges, summed
from the front, turn the place in a range into the exact rank. Ranges past the last draw are not exchanged.

Null and empty texts have no features, the weight 0, and are never drawn. A null doc_id hashes as the empty string and stands
after the others in ties. Rows that repeat id and score get ranks of their own, in the order of the written runs. Texts are
worked on in pieces of about 1 MB, so a very long one needs little more memory than itself. An empty corpus gives an empty
result, an empty target equal gains from it. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.ranges import longs, place
from stayline.session import work_path

#: Lower-cases A-Z; every other ASCII character but digits and a-z parts words.
CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Ranges of the sort at most, rows of one beyond as many as there are shuffle tasks, and sampled rows for each: at most
#: 65,536 rows come to the driver.
RANGES, RANGE_ROWS, SAMPLES = 4_096, 4_096, 16


def pieces(text: str, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in lists; but for the first, each starts with the last word of the one before."""
    clean, at, last = text.encode("utf-8", "surrogatepass").translate(CLEAN), 0, []
    while at < len(clean):
        end = at + step
        if end < len(clean):
            end = clean.rfind(b" ", at, end) if clean.rfind(b" ", at, end) > at else clean.find(b" ", end)
        words = clean[at : end if end >= 0 else None].split()
        at = end if end >= 0 else len(clean)
        if words:
            yield last + words
            last = words[-1:]


def hashes(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a text the words that are new in it and the hashes of its features."""
    for i, words in enumerate(pieces(text)):
        single = list(map(crc32, words))
        pairs = map(crc32, words[1:], map(crc32, repeat(b" "), single))  # as if joined by a space
        fresh = single[1:] if i else single
        yield len(fresh), np.fromiter((*fresh, *pairs), np.uint32, len(fresh) + len(words) - 1)


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket. Each task adds up its own; the driver gets one number a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in hashes(text.as_py() or ""):
                    total += np.bincount(found % buckets, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    out[[r.bucket for r in rows]] = [r.n for r in rows]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus by bucket, rounded down, each count one more than it is."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1_000 * np.log(ratio)).astype(np.int64)


def weighed(text: Column, gain: np.ndarray) -> Column:
    """struct<n_words, n_features, weight>: the weight is the mean gain, rounded down."""

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weigh(texts: pa.Array) -> pa.Array:
        out = np.zeros((3, len(texts)), np.int64)
        for i, text in enumerate(texts):
            n_words = n_features = total = 0
            for fresh, found in hashes(text.as_py() or ""):
                n_words, n_features, total = n_words + fresh, n_features + len(found), total + int(gain[found % len(gain)].sum())
            out[:, i] = n_words, n_features, total // n_features if n_features else 0
        return pa.StructArray.from_arrays([pa.array(row) for row in out], names=["n_words", "n_features", "weight"])

    return weigh(text)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that seed and id decide, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1_000 * F.log(-F.log((h + 0.5) / 4_294_967_296.0)))


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row: of those with ``least_words`` or more, ``percent`` in a
    hundred are drawn and ranked from 1, by score and then by smaller id; the others' rank is null."""
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    said = docs.select("doc_id", weighed(F.col("text"), gain).alias("w"))
    scored = said.select(
        "doc_id", "w.n_features", "w.weight", (F.col("w.weight") + noise(F.col("doc_id"), seed)).alias("score"), (F.col("w.n_words") >= least_words).alias("open"),
    )
    path = work_path(spark, "runs")
    scored.sortWithinPartitions(F.desc("open"), F.desc("score"), F.asc_nulls_last("doc_id")).write.parquet(path)
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    runs = spark.read.parquet(path)
    keys = [-F.col("score"), F.coalesce("doc_id", F.lit(2**63 - 1)), F.xxhash64(file, row)]  # the last parts rows that repeat
    runs = runs.select(*runs.columns, file.alias("_file"), row.alias("_row"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    names = ["_k0", "_k1", "_k2"]

    n = runs.where("open").count()
    drawn = n * percent // 100
    ranges = max(1, min(RANGES, max(n // RANGE_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions"))), n // (2 * SAMPLES)))
    stride = max(1, n // (ranges * SAMPLES))
    regular = (F.col("_row") + F.pmod(F.xxhash64("_file"), F.lit(stride))) % stride == 0
    sample = sorted(map(tuple, runs.where(F.col("open") & regular).select(*names).collect()))
    splitters = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    dealt = runs.withColumn("range", F.when(F.col("open"), place([F.col(k) for k in names], splitters)))

    sizes = dict(dealt.where("open").groupBy("range").agg(F.count("*").alias("n")).collect())  # a row a range
    before = list(accumulate([sizes.get(r, 0) for r in range(len(splitters) + 1)], initial=0))
    last = sum(b < drawn for b in before[:-1])  # ranges that hold a drawn row
    at = F.row_number().over(Window.partitionBy("range").orderBy(*names)) + F.get(longs(before), F.col("range"))
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = dealt.where(F.col("range") < last).select(*out, at.alias("rank")).select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    rest = dealt.where(F.col("range").isNull() | (F.col("range") >= last)).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
