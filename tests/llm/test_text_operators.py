"""Language identification, quality rules, BPE and personal data against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import bpe, langid, pii, quality, queries
from stayline.llm.queries import tokenizer_path

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "a", "é", "a" * 30_000, "x y " * 9_000, "one two one two one two", "12.34.5.6 a@b.c +1 (555) 123-4567"]


def test_bpe_equals_the_library(spark, documents):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    library, rng = Tokenizer.from_file(path), random.Random(2)
    parts = ["the", " ", "  ", "\n", "ing", "é", "1", "²", "'s", "<|endoftext|>", "中", "aaaa", "\x1c", "\xa0", "--", "🎉", "́"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    df = documents(list(enumerate(texts)))
    rows = df.select("doc_id", bpe.encode(F.col("text"), path).alias("ids")).select("*", bpe.decode(F.col("ids"), path).alias("back")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.back == library.decode(want, skip_special_tokens=False)
    assert documents([]).select(bpe.encode(F.col("text"), path)).count() == 0
    assert bpe.Codec(open(path, encoding="utf-8").read()).decode([-1, 64, 10**6]) == "a"


def brute_spans(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = list("ab@@..-+ 0123456789()%é\n") + ["1.2.3.4", "@x.y", "+1 (555) 123-4567", "4111 1111 1111 1111", "255.", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert sorted(pii.base_spans(text)) == sorted(brute_spans(text)), text


@pytest.mark.parametrize("text, kind", [
    ("mail bob [at] mail5 [dot] example [dot] com now", "email"), ("write to jane.doe at example dot com", "email"), ("аdmin@exаmple.com x", "email"),
    ("plus one five five five one two three four five six seven", "phone"), ("card ４１１１ １１１１ １１１１ １１１１ end", "card"), ("ip one nine two dot one six eight dot one dot one", "ip"),
])
def test_disguises_are_found_in_place(text, kind):
    ((start, end, found, added),) = pii.find(text)
    assert (found, added) == (kind, True)
    assert pii.masked(text) == text[:start] + f"<{kind}>" + text[end:]


def test_clean_text_has_no_spans():
    for text in ["meet me at home dot", "one two three", "look at this. dot", "on 12.5.2020 at 10:30", ""]:
        assert pii.find(text) == [] and pii.masked(text) == text


def test_pii_query(spark, documents, tmp_path):
    rows = list(enumerate(ODD)) + [(1, ODD[-1])]
    documents(rows, tmp_path)
    got = sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in queries.op8_pii(spark, str(tmp_path)).collect())
    want = []
    for doc, text in rows:
        spans = brute_spans(text or "")
        listed = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
        want.append((doc, *[sum(k == x for _, _, x in spans) for k in pii.KINDS], hashlib.sha256(listed.encode()).hexdigest()))
    assert got == sorted(want)
    masked = documents(rows).select(pii.mask(F.col("text")).alias("m")).collect()
    assert sum(r.m is None for r in masked) == 1


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_quality_statistics_and_verdict(spark, documents, tmp_path):
    rng = random.Random(4)
    good = [" ".join(rng.choice("abcdefghij") * rng.randint(2, 9) + str(rng.randint(0, 999)) for _ in range(80)) for _ in range(60)]
    bad = [t.replace(" ", "$$$ ") for t in good]
    texts = ODD + good + bad + ["a b\n\na b\na b\n c"]
    rows = list(enumerate(texts)) + [(12, texts[12])]
    documents(rows, tmp_path)
    first = len(ODD)
    labels = [(i, 1, 0) for i in range(first, first + 60)] + [(i, 0, 0) for i in range(first + 60, first + 120)] + [(None, 0, 0), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = queries.op3_quality(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
        if first <= r.doc_id < first + 120:
            assert r.kept == (r.doc_id < first + 60)


def test_rules_are_pruned_conjunctions_and_none_without_labels(spark, documents):
    rng = np.random.default_rng(0)
    values = rng.random((3_000, 2))
    bad = (values[:, 0] > 0.7) & (values[:, 1] <= 0.4)
    rules = quality.cover(values, bad, ["a", "b"])
    found = np.logical_or.reduce([quality._covered(r, values, ["a", "b"]) for r in rules])
    assert (found & ~bad).sum() <= 30 and (found & bad).sum() >= 0.9 * bad.sum()
    assert quality.cover(values[:0], bad[:0], ["a", "b"]) == []
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a " * 10), (2, " ".join(map(str, range(60))))])
    rules = quality.learn(docs, empty)
    assert rules == [] and {r.row.doc_id: r.kept for r in quality.judged(docs, rules).collect()} == {1: False, 2: True}


def test_languages_of_held_out_texts(spark, documents, tmp_path):
    out = queries.op1_langid(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet"), "doc_id")
    hit, rows = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 20 and hit > 0.95
    model = langid.fit(spark.read.parquet(f"{DATA}/documents.parquet"), langid.pieces(tokenizer_path("piece_bpe_32k.model")), rows_per_language=20)
    marks = ["²½ ①", "Ⅷ ⅷ", "⑴ 3/4 ¾"]  # numbers, not letters
    assert all(not c.isalpha() for text in marks for c in text)
    said = documents(list(enumerate(ODD + ["12 34", *marks]))).select("text", langid.predict(F.col("text"), model).alias("p")).collect()
    for r in said:
        assert (r.p.lang == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.p.score <= 1
    nothing = langid.fit(documents([]), model.keys)
    assert nothing.languages == () and documents([(1, "abc")]).select(langid.predict(F.col("text"), nothing).alias("p")).first().p.lang == "und"


def test_forward_pass_sums_all_segmentations():
    keys = langid.pieces(tokenizer_path("piece_bpe_32k.model"))
    number = {int(k): i for i, k in enumerate(keys)}
    chances = np.random.default_rng(0).random((len(keys), 2))
    chances /= chances.sum(axis=0)

    def brute(word, p):
        ahead = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for length in range(1, min(8, end) + 1):
                at = number.get(int.from_bytes(word[end - length : end], "little"))
                ahead[end] += ahead[end - length] * p[at] if at is not None else 0
        return np.log(ahead[-1])

    words = [w.encode() for w in ["thing", "a", "été", "thinbleringerly", "ж", "houseofcardsandmore"]]
    scores = langid.word_scores(words, keys, chances)
    for i, w in enumerate(words):
        assert np.allclose(scores[i], [brute(w, chances[:, j]) for j in (0, 1)])
    counts = langid.expected_counts(words, np.ones(len(words)), keys, chances[:, 0])
    moved = chances[:, 0].copy()
    k = int(np.argmax(counts))
    moved[k] *= 1 + 1e-6
    slope = sum(brute(w, moved) - brute(w, chances[:, 0]) for w in words) / 1e-6
    assert np.isclose(counts[k], slope, rtol=1e-4)


def test_bpe_gives_its_memory_back_when_idle(monkeypatch):
    import time

    import pyarrow as pa

    content = bpe._content(tokenizer_path())
    monkeypatch.setattr(bpe._Idle, "seconds", 0.3)
    before = bpe._encoded(bpe.codec(content), pa.array(["some words to code", None])).to_pylist()
    assert bpe.codec.cache_info().currsize == 1
    for _ in range(50):
        time.sleep(0.1)
        if not bpe.codec.cache_info().currsize:
            break
    assert bpe.codec.cache_info().currsize == 0
    assert bpe._encoded(bpe.codec(content), pa.array(["some words to code", None])).to_pylist() == before
