"""Repeats, near duplicates, top-k, mixing, licences and archives against brute force."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stayline.llm import jaccard, licences, mixing, queries, repeats, topk, warc


def brute_repeats(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def pieces_of(rng, count):
    words = ["the", "of", "a", "éb", "ing ", "zz\n", "long", "1", "\0"]
    base = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(5)]
    rows = []
    for i in range(count):
        text = "".join(x[rng.randint(0, 60) : rng.randint(60, len(x))] for x in rng.sample(base, 2))
        if i % 7 == 0:
            text = "a" * rng.randint(0, 700) + text
        if i % 11 == 0:
            text = base[0]
        rows.append((i * 3, text))
    return [*rows, (1, None), (2, ""), (4, "x" * 99), (5, base[1] * 3)]


def test_repeats_equal_brute_force(spark, documents, tmp_path):
    rows = pieces_of(random.Random(5), 120)
    documents(rows, tmp_path)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_repeats(spark, str(tmp_path)).collect()}
    assert got == brute_repeats(rows)


def test_repeats_over_many_buckets_and_repeated_rows(documents):
    rows = pieces_of(random.Random(6), 40)
    df = documents([*rows, rows[3], (None, rows[0][1])])
    got = {}
    for r in repeats.remove(df, buckets=23).collect():
        own = (r.n_bytes, sum(x["end"] - x["start"] for x in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest())
        assert got.setdefault(r.doc_id, own) == own
    assert got.pop(None)[1] == 0 and got == brute_repeats(rows)
    assert repeats.remove(documents([])).count() == 0


def brute_components(rows, words, percent):
    sets = {}
    for doc, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {doc: (len(sets[doc]), find(doc)) for doc in ids}


def near_copies(rng, count):
    words = [f"w{i}" for i in range(300)] + ["the", "A", "b"] * 20
    base = [[rng.choice(words) for _ in range(rng.choice([3, 5, 20, 80, 200]))] for _ in range(12)]
    rows = []
    for i in range(count):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i * 2 + 1, " ".join(own) if i % 40 else [None, "", "\n ", " a  B\tc"][i // 40 % 4]))
    return rows


def test_components_equal_brute_force(spark, documents, tmp_path):
    rows = near_copies(random.Random(7), 320)
    documents(rows, tmp_path)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_jaccard(spark, str(tmp_path)).collect()}
    assert got == brute_components(rows, 4, 85)


def test_components_with_repeated_and_null_ids(documents):
    rows = near_copies(random.Random(8), 60)
    found = jaccard.join(documents([*rows, rows[5], (None, rows[5][1])])).collect()
    assert len(found) == len(rows) + 2
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got.pop(None)[1] is None and got == brute_components(rows, 5, 80)
    assert jaccard.join(documents([])).count() == 0


def test_stars_connect_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.id: r.root for r in jaccard.components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


def test_top_k_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(0, 420)]
    rows += [(1000 + i, rows[100][1], 1) for i in range(30)]  # ties
    rows += [(500, None, 1), (600, [1.0, None] + [0.0] * 6, 1), (700, [float("nan")] * 8, 1), (701, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (702, [3.0] * 5, 1), (703, [], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").write.parquet(f"{tmp_path}/embeddings.parquet")
    good = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:10]
        want += [(q, place, i, -s) for place, (s, i) in enumerate(scored, 1)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in queries.op6_topk(spark, str(tmp_path)).collect())
    assert got == sorted(want)


def test_top_k_with_few_candidates_and_large_numbers(spark):
    df = spark.createDataFrame([(0, [2.0**40, 1.0]), (1, [2.0**40, 3.0]), (2, [-(2.0**20), 5.0])], "vec_id long, vector array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df, df).collect())
    whole = {0: (2**40, 1), 1: (2**40, 3), 2: (-(2**20), 5)}
    for q, place, i, score in got:
        exact = sum(a * b for a, b in zip(whole[q], whole[i]))
        assert score == max(-(2**63), min(2**63 - 1, exact))
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 1), (2, 2, 0)]
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df, df.limit(0)).count() == 0


def test_mixture_is_within_one_block_and_whole(spark, documents):
    docs = documents([(i, f"t{i}") for i in range(900)] + [(900, None), (5, "again"), (None, "x")])
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 500, "big").when(F.col("doc_id") < 800, "mid").when(F.col("doc_id") < 890, "small"))
    weights = spark.createDataFrame([("big", 0.45), ("mid", 0.35), ("small", 0.15), (None, 0.05), ("absent", 0.4), ("mid", None)], "source string, weight double")
    out = mixing.scheduled(docs, weights, block_rows=8, resolution=40, bucket_rows=64).collect()
    assert len(out) == 903 and sum(r.row.doc_id == 5 for r in out) == 2
    blocks = {(r.source, r.block): (r.release, r.due, r.slot) for r in out}
    assert len({s for _, _, s in blocks.values()}) == len(blocks)
    assert all(release <= slot < due for release, due, slot in blocks.values())
    shares = {s: q for s, q in mixing.quotas(docs, weights, 40).select("source", "quota").collect()}
    total = sum(shares.values())
    last = min(max(x[2] for (s, _), x in blocks.items() if s == name) for name in shares)  # until the first source ends
    for slot in range(last + 1):
        for name, quota in shares.items():
            given = sum(1 for (s, _), x in blocks.items() if s == name and x[2] <= slot)
            assert abs(given - (slot + 1) * quota / total) < 1
    mixed = mixing.mixed(docs, weights=weights, block_rows=8)
    assert mixed.columns == docs.columns and mixed.exceptAll(docs).count() == 0 and mixed.count() == 903
    assert mixing.scheduled(docs.limit(0)).count() == 0


def test_archives_give_back_every_record(spark, tmp_path):
    big = "<p>" + "long words " * 60_000
    rows = [(i, f"http://x.org/{i} a", f"<html>page {i % 7} " + "lorem ipsum " * 30) for i in range(60)] + [(100, None, None), (101, "u", ""), (102, "u\r\nX: y", big), (103, "é", big), (103, "é", big), (None, "u", big)]
    spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(((r.page_id or -1), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in queries.op10_warc(spark, str(tmp_path)).collect())
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", -1))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = page is not None and page < largest[html or ""]
        want.append((page or -1 if page is None else page or -1, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", largest[html or ""] if revisit else -1))
    assert got == sorted(want)
    pages = spark.read.parquet(f"{tmp_path}/pages.parquet")
    manifest = warc.write(pages, file_bytes=300_000, sample_bytes=20_000, least_bytes=1)
    assert manifest.count() > 1
    whole = {(r.page_id, r.payload.decode()) for r in warc.read(manifest).collect() if r.record_type == "response"}
    assert {(102, ""), (103, big)} - whole == {(102, "")} and (100, "") in whole and (101, "") in whole
    assert warc.archived(spark, pages.limit(0)).count() == 0


def test_licence_notices(spark, documents):
    rng = random.Random(9)
    prose = [" ".join(rng.choice(["the", "of", "a", "this", "by", "under", "work", "river", "house", "version", "any"]) for _ in range(40)) for _ in range(60)]
    notices = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.", "gpl": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    rows = [(i, p) for i, p in enumerate(prose)] + [(100 + i, f"{prose[i]}\n{n}\n{prose[i]}") for i, n in enumerate(notices.values())] + [(200, None), (201, ""), (None, notices["mit"]), (103, prose[3] + "\n" + notices["cc-by-nc"])]
    docs = documents(rows)
    model = licences.fit(docs)
    found = licences.scan(docs, model).collect()
    assert sorted((r.doc_id or -1, r.family) for r in found) == sorted([(100 + i, f) for i, f in enumerate(notices)] + [(-1, "mit"), (103, "cc-by-nc")])
    assert all(r.confirmed and 0.5 <= r.probability <= 1 for r in found)
    assert licences.scan(docs.limit(0), model).count() == 0
    plan = licences.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
