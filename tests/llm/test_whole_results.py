"""Results that earlier versions cut short."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

import corpus_pipeline
from stayline.llm import licences, mixing, pii, quality


def test_disguises_are_found_whatever_else_the_text_holds():
    shown = {
        "write to jane.doe at example.com": (9, 32, "email"), "mail bob AT mail.example.co.uk.": (5, 30, "email"), "card 4111 1111 1111 one one one 1": (5, 33, "card"),
        "plus one 555 123 4567": (0, 21, "phone"), "+49 301 234 five 67": (0, 19, "phone"), "10.0.0.one": (0, 10, "ip"), "jane (at) example.com": (0, 21, "email"), "+๑ 555 123 4567": (0, 15, "phone"),
    }
    for text, span in shown.items():
        for whole in (text, text + "\nA dot. Nothing dot here [at] all; one two three four"):
            assert (*span, True) in pii.find(whole), whole
    for text in ("prices grew at 3.5 percent", "landed at U.S. bases", "met at home. Then at 10.30 they left", "ſix or ſeven, number ONE 2 fİve one", "someone 3 at work"):
        assert pii.find(text) == []


def test_gate_passes_every_text_with_a_disguised_span(monkeypatch):
    rng = random.Random(4)
    parts = ["jane", "example.com", " at ", " dot ", "[at]", "(dot)", "one", "seven", "ſix", "plus ", "+", "4111 1111 1111 1", "555 123", "@", " ", "-", ".", ", ", "а", "９", "\n", "10.0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 14))) for _ in range(4_000)]
    gated = [pii.find(t) for t in texts]

    class Always:
        def search(self, _):
            return True

    monkeypatch.setattr(pii, "_DOT", Always())
    assert [pii.find(t) for t in texts] == gated and sum(any(s[3] for s in own) for own in gated) > 100


def test_added_spans_hold_base_spans_whole():
    shown = {
        "аdmin@example.com": [(0, 17, "email", True), (1, 17, "email", False)],
        "mail mariа.gonzalez@example.com now": [(5, 31, "email", True), (10, 31, "email", False)],
        "+49 301 234 567 ８９": [(0, 15, "phone", False), (0, 18, "phone", True)],
        "jane at 10.0.0.1 or jаne@10.0.0.1": [(8, 16, "ip", False), (20, 33, "email", True), (22, 33, "email", False), (25, 33, "ip", False)],
        "two-one@example.com": [(0, 19, "email", False)],
    }
    for text, spans in shown.items():
        assert pii.find(text) == spans, text
    assert pii.masked("x аdmin@example.com, mariа.gonzalez@example.com; +49 301 234 567 ８９.") == "x <email>, <email>; <phone>."
    assert pii.masked("jаne@10.0.0.1 x") == "<email> x"


def test_mixture_keeps_within_one_block_of_given_weights_on_many_blocks():
    cases = [[1 / 3, 0.6663, 0.0003667], [0.12345678, 0.5, 0.0004321, 0.3761109], [5_000.0 / 2] + [1.0] * 5_000]
    for weights in cases:
        exact = [Fraction(repr(w)) for w in weights]
        share = [w / sum(exact) for w in exact]
        blocks = [int(w * 30_000) + 1 for w in share]
        given = [0] * len(weights)
        seen = -1
        for place, release, due, slot in mixing.deal(weights, blocks):
            assert release <= slot < due and slot > seen
            # Released when less than the share was given, due before more is owed: within one block at every slot.
            assert release == math.floor(given[place] / share[place]) and due == math.ceil((given[place] + 1) / share[place])
            given[place] += 1
            seen = slot
        assert given == blocks
        assert seen <= max(math.ceil(b / w) for b, w in zip(blocks, share))


def test_mixture_of_a_table_follows_the_given_weights(spark):
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 45_000, "a").when(F.col("id") < 59_990, "b").alias("source"))
    weights = spark.createDataFrame([("a", 0.7504), ("b", 0.2494), (None, 0.0002)], "source string, weight double")
    rows = mixing.scheduled(docs, weights, block_rows=1).select("source", "slot").collect()
    assert len(rows) == 60_000 == len({r.slot for r in rows})
    order = {r.slot: r.source for r in rows}
    share, given = {"a": 0.7504, "b": 0.2494, None: 0.0002}, {"a": 0, "b": 0, None: 0}
    for slot in range(45_000):  # until b is nearly used up
        given[order[slot]] += 1
        assert all(abs(given[s] - (slot + 1) * w) < 1 + 1e-9 for s, w in share.items())


def test_mixture_with_odd_weights_loses_no_row(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 5).alias("source"))
    weights = spark.createDataFrame([("s0", float("inf")), ("s1", float("nan")), ("s2", 1e-300), ("s3", 2.0), ("s4", -1.0)], "source string, weight double")
    for given in (weights, weights.limit(0)):
        assert sorted(r.row.doc_id for r in mixing.scheduled(docs, given, block_rows=4).collect()) == list(range(500))


def shuffled(node):
    """The columns of every shuffle of a plan as it is before it runs."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return shuffled(node.initialPlan())
    own = [node.output().mkString(" ")] if node.nodeName() == "Exchange" else []
    return own + [x for i in range(node.children().size()) for x in shuffled(node.children().apply(i))]


def test_mixture_moves_whole_rows_twice(spark, documents):
    docs = documents([(i, f"t{i}") for i in range(900)] + [(None, "x"), (None, "y")]).drop("row")
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 500, "big").when(F.col("doc_id") < 800, "mid"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as on a table too large for Spark to broadcast by its estimate
    try:
        mixed = mixing.mixed(docs, block_rows=8, bucket_rows=64)
        assert sum("row#" in columns for columns in shuffled(mixed._jdf.queryExecution().executedPlan())) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert mixed.exceptAll(docs).count() == 0 and mixed.count() == 902


def test_learning_counts_a_text_once(spark, documents, tmp_path, monkeypatch):
    docs = documents([(i, " ".join(f"w{i * j}" for j in range(1, 70)) + " $$$" * (i % 2)) for i in range(200)] + [(300, None), (301, "short")], tmp_path)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)] + [(300, 0), (301, 0)], "doc_id long, quality int")
    plans, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    rules = quality.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"), labels)
    assert [p.count("ArrowEvalPython") for p in plans] == [1] and len(rules) == 1


def test_pipeline_result_carries_the_place_in_the_mixture(spark, documents, tmp_path):
    docs = documents([(i, "word " * (1 + (7 * i) % 900)) for i in range(700)])
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 500, "big").otherwise("small"))
    corpus_pipeline.mixture(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/mixed")
    table = spark.read.parquet(f"{tmp_path}/mixed")
    assert len(table.inputFiles()) > 1
    out = corpus_pipeline.token_ids(spark, table, str(tmp_path))
    out.write.parquet(f"{tmp_path}/ids")
    rows = spark.read.parquet(f"{tmp_path}/ids").select("doc_id", "place").orderBy("place").collect()
    assert [r.place for r in rows] == list(range(700))
    want = mixing.scheduled(docs).select("row.doc_id").orderBy("slot", "place_in_block").collect()
    assert [r.doc_id for r in rows] == [r.doc_id for r in want]


def every_paragraph(docs, model):
    rows = licences.paragraphs(docs).withColumn("grams", licences.grams(licences.words(F.col("paragraph"))))
    return {(r.doc_id, r.line) for r in licences.with_chances(rows, model).where(F.element_at("chances", 1) < 0.5).collect()}


def test_licence_scan_equals_scoring_every_paragraph(documents):
    rng = random.Random(2)
    words = ["the", "of", "licensed", "under", "License", "river", "MIT", "licenſed", "released", "work", "foo", "gnu"]
    docs = documents([(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(4))) for i in range(80)] + [(100, "Licensed under the Foo License")])
    families = [licences.PROSE, *sorted(licences.TEMPLATES)]
    weights = {f: {} for f in families} | {licences.PROSE: {"licensed": -2.5, "licensed under": -2.5, "the": 1.0}, "mit": {"mit": 3.0, "the": 0.5}, "gpl": {"gnu": -1.0}}
    model = licences.Model(weights, {f: 4.0 if f == licences.PROSE else 0.0 for f in families}, 0.9)
    assert model.prose_by_default() and model.markers == ("licensed", "licensed under", "mit")
    found = {(r.doc_id, r.line): r.family for r in licences.scan(docs, model).collect()}
    assert set(found) == every_paragraph(docs, model) and found[100, 0] == licences.UNKNOWN
    assert 10 < len(found) < 320
    fitted = licences.fit(docs)
    assert {(r.doc_id, r.line) for r in licences.scan(docs, fitted).collect()} == every_paragraph(docs, fitted)
