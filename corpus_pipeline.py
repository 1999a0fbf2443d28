"""From raw documents to token ids: quality rules, near-duplicate join, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the columns of
documents. ``run`` writes what a stage returns to the session's shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm import bpe, jaccard, mixing, pii, quality
from stayline.llm.queries import table, tokenizer_path
from stayline.session import work_path


#: Words and pairs that a worker remembers while it codes: a fifth of what it would alone, as workers of all stages share
#: an executor's memory. Speed and memory only.
REMEMBERED = 60_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the rules learned from ``labels`` reject."""
    rules = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, rules).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the smallest id; rows without an id stay."""
    gone = jaccard.join(docs, words=5, percent=80).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    path = work_path(spark, "gone")
    gone.write.parquet(path)
    gone = spark.read.parquet(path)
    if gone.count() <= jaccard.BROADCAST_IDS:
        gone = F.broadcast(gone)  # else all texts would be shuffled to meet a few ids
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the new text."""
    hidden = docs.withColumn("text", pii.mask(F.col("text")))
    return hidden.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the mixture of their sources; none is dropped. The order is that of the rows in
    the written files, the files taken by name."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, whether they decode to it, and its place in the mixture, from 0; ``docs`` is what ``mixture``
    returned, read from its files. A scan takes files in any order, so the place is told from file and row."""
    bpe.bound_batches(spark)
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    # A row per file, so it may be broadcast and numbered in one task.
    before = F.sum("_rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    files = docs.groupBy(file.alias("_file")).agg(F.count("*").alias("_rows")).select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    docs = docs.select("doc_id", "lang", "source", "text", file.alias("_of"), row.alias("_row")).join(F.broadcast(files), F.col("_of") == F.col("_file"))
    place = F.col("_before") + F.col("_row")
    coded = docs.select("doc_id", "lang", "source", place.alias("place"), "text", bpe.round_trip(F.col("text"), tokenizer_path(), REMEMBERED).alias("coded"))
    same = F.col("coded.decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", "place", F.size("coded.ids").cast("long").alias("n_tokens"), "coded.ids", same.alias("decodes"))


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("token_ids", token_ids),
]

#: The learned rules and the ids cannot be stated in SQL; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
