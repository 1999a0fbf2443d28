"""Filter audit, importance resampling and fingerprints against brute force."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import fingerprints, importance, interactions, queries, ranges


# --- the audit of filters


def _brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    by_part = {}
    for doc, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        caps = sum("A" <= c <= "Z" for c in text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * caps > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": doc is not None and doc > first[text]}
        good = any(d == doc and q == 1 for d, q, _ in labels) and doc is not None
        toxic = any(d == doc and t == 1 for d, _, t in labels) and doc is not None
        by_part.setdefault(lang or "", []).append((fails, good, toxic))
    out = {}
    for part, docs in by_part.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                redundant = sum(d[0][f] for d in docs) - len(gone)
                unique = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, unique, sum(d[1] for d in gone), sum(d[2] for d in gone), f]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = shapley[out[key][-1]]
    return out


def _texts(rng, n):
    words = ["the", "of", "Überaus", "BIG", "x#1", "año", " ", "100%"]
    made = [None, "", " \t\n", "ABC", "#", "\U0001f600 a"]
    while len(made) < n:
        made.append(" ".join(rng.choice(words[: rng.randint(1, 8)]) if rng.random() < 0.4 else f"w{rng.randint(0, 900)}" for _ in range(rng.choice([3, 40, 199, 200, 230]))))
    return made


def test_audit_equals_every_order_step_by_step(spark):
    rng = random.Random(1)
    texts = _texts(rng, 40)
    rows = [(rng.choice([None, *range(150)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(400)]
    rows += [(7, texts[9], "en")] * 3 + [(900 + i, "copied", "en") for i in range(150)]
    labels = [(rng.choice([None, *range(150)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("part", "n", "first", "digest", "bits", "q")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(0))
    got = interactions.audit(interactions.profile(docs, marks)).collect()
    want = _brute_audit(rows, labels)
    assert len(got) == len(want) == 3 * 600
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got} == want


def test_audit_sql_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else None) for i, t in enumerate(_texts(random.Random(2), 50))], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, i % 5 == 0) for i in range(30)], "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int")).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op11_interactions(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.execute(queries.OP11_SQL).df()
    key = ["part", "filter_order", "step"]
    assert got.sort_values(key).values.tolist() == want[list(got.columns)].sort_values(key).values.tolist() and len(got) == 1_200
    assert interactions.audit(interactions.profile(docs.limit(0), spark.read.parquet(f"{tmp_path}/labels.parquet").limit(0))).count() == 0


def test_potentials_give_shapley_values_of_any_game(spark):
    rng = random.Random(3)
    v = [0] + [rng.randint(0, 1_000) for _ in range(15)]
    q = spark.range(1).select(interactions.potentials(F.array(*map(F.lit, v)).cast("array<bigint>"), 4).alias("q")).first().q
    for i in range(4):
        want = 0
        for order in permutations(range(4)):
            before = sum(1 << j for j in order[: order.index(i)])
            want += v[before + (1 << i)] - v[before]
        assert q[15] - 4 * q[15 - (1 << i)] == want


# --- importance resampling


def _features(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    return len(words), [zlib.crc32(w) % 10_000 for w in words] + [zlib.crc32(a + b" " + b) % 10_000 for a, b in zip(words, words[1:])]


def _brute_draw(rows, target, percent=25):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for b in _features(text)[1]:
                counts[b] += 1
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for doc, text in rows:
        n_words, found = _features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    return out, drawn


@pytest.mark.parametrize("small_ranges", [False, True])
def test_draw_equals_brute_force(spark, monkeypatch, small_ranges):
    if small_ranges:
        monkeypatch.setattr(importance, "RANGE_ROWS", 8)
    rng = random.Random(4)
    words = ["alpha", "Beta", "ΓΆΜΑ", "a-b", "x1", "été", "don't", "zz\x00z"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 19, 20, 45])))) for i in range(300)]
    rows += [(None, "null id " * 15), (None, "null id " * 15), (5, rows[5][1]), (400, None), (401, ""), (402, "\n-- \t")] + [(6, "same row " * 11)] * 40
    target = ["alpha beta w1 w2 w3", None, "x1 x1"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("open", "rank", "range", "score", "w", "_row")}).repartition(5)
    got = importance.draw(docs, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    want, drawn = _brute_draw(rows, target)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=order) == sorted((w[:4] for w in want), key=order)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(d[0], d[3]) for d in drawn]


def test_draw_of_long_texts_in_pieces_and_of_nothing(spark):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abÄ") for _ in range(rng.randint(1, 300))) for _ in range(4_000)) + " " + "y" * 5_000 + ", Z"
    for step in (1, 7, 100, 1 << 20):
        own = list(importance.pieces(text, step))
        assert own[0] + [w for later in own[1:] for w in later[1:]] == text.encode().translate(importance.CLEAN).split()
        assert all(a[-1] == b[0] for a, b in zip(own, own[1:]))
    assert [len(p) for p in importance.pieces("x" * 1_000 + " y", 10)] == [1, 2] or [w for p in importance.pieces("x" * 1_000 + " y", 10) for w in p][-1] == b"y"
    long_ = "word " * 600_000
    n, found = _features(long_)
    pieces = list(importance.hashes(long_))
    assert sum(f for f, _ in pieces) == n and sum(len(h) for _, h in pieces) == len(found) and len(pieces) > 2
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert importance.draw(docs, spark.createDataFrame([("a b",)], "text string")).count() == 0
    one = importance.draw(spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string"), docs.select("text"), percent=100).first()
    assert one["rank"] == 1 and one.n_features == 59


# --- fingerprints


def _pieces(text):
    return {p for p in re.findall(r"[^\r\n]{1,256}", text or "")}


def _alike(a, b):
    a, b = _pieces(a), _pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def _documents(rng, n):
    lines = [f"line {i} " + "x" * rng.randint(0, 400) for i in range(60)] + ["", "ä\U0001f600" * 200]
    return ["\n".join(rng.choice(lines) for _ in range(rng.choice([0, 1, 2, 9, 60, 300]))) for _ in range(n)]


def test_fingerprints_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SAMPLES", 2)
    texts = _documents(random.Random(6), 80) + [None, "", "same", "same", "z\n" * 500]
    rows = [(3 * i - 50, t) for i, t in enumerate(texts)]
    random.Random(7).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("keys", "edited", "of", "next_text", "_id", "_at")}).repartition(4)
    got = {r.doc_id: r for r in fingerprints.compared(docs).collect()}
    rows.sort()
    prints = {}
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after, r = text or "", after or "", got[doc]
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        assert r.text == text and r.edited == edit
        assert r.near_edited == pytest.approx(_alike(text, edit), abs=1e-12) and r.near_next == pytest.approx(_alike(text, after), abs=1e-12)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint and prints.setdefault(edit, r.edited_fingerprint) == r.edited_fingerprint
    assert len(got) == len(rows) and max(r.to_next.attempts for r in got.values()) > 2
    assert {len(_pieces(t)) for t in prints} == {int(p.split(";")[0]) for p in prints.values()}


def test_peeling_recovers_the_paragraphs_of_one_side(spark):
    a = "\n".join(f"shared {i}" for i in range(400)) + "\nonly here\nand here"
    b = "new\n" + "\n".join(f"shared {i}" for i in reversed(range(400)))
    pair = spark.createDataFrame([(a, b)], "a string, b string").withColumns({k: fingerprints.digests(F.col(k[0])) for k in ("ak", "bk")})
    told = fingerprints.difference(F.col("ak"), F.col("bk"), fingerprints.sketch(F.col("ak")), fingerprints.sketch(F.col("bk")))
    r = pair.withColumn("told", told).select("told", fingerprints.changed(F.col("a"), F.col("told.only_a")).alias("in_a"), fingerprints.changed(F.col("b"), F.col("told.only_b")).alias("in_b")).first()
    assert r.told.peeled and r.told.attempts == 1  # 3 differences among 402 paragraphs fit 30 cells
    assert r.in_a == ["only here", "and here"] and r.in_b == ["new"]


def test_next_rows_of_repeated_null_and_no_rows(spark):
    rows = [(None, "n1"), (None, "n2"), (4, "a"), (4, "a"), (4, "b"), (9, "c"), (-(2**63), "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.with_next(docs, ["text"]).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted((False, *r) for r in rows if r[0] is not None)
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)
    assert next(r for r in got if r.doc_id == 9).next_text in ("n1", "n2", "d")
    single = fingerprints.compared(docs.where("doc_id = 9")).first()
    assert single.near_next == 1.0 and single.edited == "c"
    assert fingerprints.compared(docs.limit(0)).count() == 0


def test_fingerprint_of_a_very_long_text(spark):
    text = "\n".join(f"paragraph {i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    r = {r.doc_id: r for r in fingerprints.compared(docs).collect()}
    assert r[1].near_next == 0.0 and r[1].to_next.attempts > 6 and r[1].near_edited == pytest.approx(_alike(text, r[1].edited))


def test_place_among_splitters(spark):
    rng = random.Random(8)
    for n in (0, 1, 3, 8, 100):
        splitters = sorted({(rng.randint(-5, 5), rng.randint(-3, 3)) for _ in range(n)})
        keys = [(a, b) for a in range(-6, 7) for b in range(-4, 5)]
        got = spark.createDataFrame(keys, "a long, b long").select("a", "b", ranges.place([F.col("a"), F.col("b")], splitters).alias("p")).collect()
        assert all(r.p == sum(s <= (r.a, r.b) for s in splitters) for r in got)
