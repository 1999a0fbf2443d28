"""The registered queries of the operators: each applies its operator to a whole table of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import bpe, fingerprints, importance, interactions, jaccard, langid, licences, mixing, pii, quality, repeats, topk, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~_held_out()), langid.pieces(tokenizer_path("piece_bpe_32k.model")))
    said = docs.select("doc_id", _held_out().alias("held_out"), langid.predict(F.col("text"), model).alias("said"))
    return said.select("doc_id", "held_out", F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the bytes of 100-byte strings that also start earlier."""
    left = repeats.remove(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every text; the rules are learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(docs, table(spark, sf_dir, "labels"))
    said = quality.judged(docs, rules)
    counts = [F.col(f"stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return said.select("row.doc_id", *counts, "base_failed", "kept", "rule")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to, as digests."""
    bpe.bound_batches(spark)
    coded = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text"), tokenizer_path()).alias("coded"))
    return coded.select(
        "doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("coded.ids", ","), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in a mixture of the sources by the power 0.7 of their sizes."""
    said = mixing.scheduled(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return said.select("row.doc_id", "source", "block", "release", "due", "slot", "place_in_block")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every vector whose id is divisible by 100, among all others."""
    vectors = table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding"))).select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    return topk.search(vectors.where("vec_id % 100 = 0"), vectors)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraphs of all documents that are licence notices, with their family."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs, licences.fit(docs))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: counts and digest of the base spans, and all spans."""
    found = table(spark, sf_dir, "documents").select("doc_id", pii.spans(F.col("text")).alias("spans"))
    base = F.filter("spans", lambda s: ~s["added"])
    of_kind = lambda kind: lambda s: s["kind"] == kind
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.filter(base, of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    added = F.size(F.filter("spans", lambda s: s["added"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), added)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents connected by links of 85 % or more of their four-word shingles."""
    return jaccard.join(table(spark, sf_dir, "documents"), words=4, percent=85)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back."""
    return warc.archived(spark, table(spark, sf_dir, "pages")).drop("url", "payload")


def op11_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in every order: what each step removes, and each filter's Shapley value."""
    return interactions.audit(interactions.profile(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn by their likeness to the benchmark texts, with exact ranks."""
    return importance.draw(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness."""
    told = fingerprints.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return told.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


#: SQL that states op6: every query against every other vector.
OP6_SQL = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM scored QUALIFY rank <= 10
"""

#: SQL that states op11 from the texts: every order step by step, and the Shapley value as the sum of what it removes.
OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS found
  FROM documents
), marks AS (
  SELECT doc_id AS id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad
  FROM labels GROUP BY doc_id
), firsts AS (
  SELECT sha256(body) AS digest, min(doc_id) AS first_id FROM words GROUP BY 1
), failed AS (
  SELECT w.part, coalesce(m.good, false) AS good, coalesce(m.bad, false) AS bad, MAP {
    'A': len(found) < 200,
    'B': 100 * len(list_distinct(found)) < 50 * len(found),
    'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body),
    'D': regexp_matches(body, '[#$%&*|]'),
    'E': coalesce(w.doc_id > f.first_id, false)} AS fails
  FROM words w JOIN firsts f ON f.digest = sha256(w.body) LEFT JOIN marks m ON m.id = w.doc_id
), kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad FROM failed GROUP BY 1, 2
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, string_split(filter_order[1:step - 1], '') AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), told AS (
  SELECT part, filter_order, step, own, n, n_good, n_bad, fails[own] AS hit,
         len([x for x in earlier if x <> '' AND fails[x]]) > 0 AS gone,
         len([x for x in ['A', 'B', 'C', 'D', 'E'] if fails[x]]) AS n_fails
  FROM kinds, steps
), summed AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant, coalesce(sum(n) FILTER (hit AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (NOT gone AND hit), 0) AS good_lost, coalesce(sum(n_bad) FILTER (NOT gone AND hit), 0) AS toxic_lost
  FROM told GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""

QUERIES = {f.__name__: f for f in (
    op1_langid, op2_repeats, op3_quality, op4_bpe, op5_mixing, op6_topk, op7_licences, op8_pii, op9_jaccard, op10_warc,
    op11_interactions, op12_importance, op13_fingerprints,
)}
ORACLES: dict[str, str] = {"op6_topk": OP6_SQL, "op11_interactions": OP11_SQL}
