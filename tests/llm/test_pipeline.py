"""The whole pipeline on a small fixture against a plain version of each stage."""

import random
import re

import corpus_pipeline
from stayline.llm import pii, quality
from test_corpus_operators import brute_components


def test_pipeline_equals_brute_force(spark, documents, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    words = [f"word{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(90)] for _ in range(25)]
    rows = []
    for i in range(120):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 9])):
            own[rng.randrange(len(own))] = rng.choice(words)
        text = " ".join(own)
        text = text.replace(" ", "$$$ ") if i % 6 == 5 else text + " a@b.org" * (i % 4 == 0)
        rows.append((i, text))
    rows += [(500, None), (501, ""), (502, "short text"), (503, "same same " * 60)]
    documents(rows, tmp_path)
    labels = [(i, 0 if i % 6 == 5 else 1, 0) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    shown = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/out-{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        out = spark.read.parquet(path)
        if name != "token_ids":
            assert out.columns == docs.columns
        docs = out
        shown[name] = {r.doc_id: r for r in docs.collect()}

    rules = quality.learn(documents(rows), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert len(rules) == 1
    kept = {d: t for d, t in rows if t and len(t.split()) >= 50 and "$" not in t and d != 503}
    assert set(shown["quality_rules"]) == set(kept)
    parts = brute_components(list(kept.items()), 5, 80)
    alone = {d: t for d, t in kept.items() if parts[d][1] == d}
    assert {d: r.text for d, r in shown["near_duplicates"].items()} == alone and len(alone) < len(kept)
    hidden = {d: re.sub(r"a@b\.org", "<email>", t) for d, t in alone.items()}
    assert {d: r.text for d, r in shown["personal_data"].items()} == hidden == {d: pii.masked(t) for d, t in alone.items()}
    assert all(r.n_chars == len(r.text) for r in shown["personal_data"].values())
    assert {d: r.text for d, r in shown["mixture"].items()} == hidden
    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    assert {d: r.ids for d, r in shown["token_ids"].items()} == {d: library.encode(t, add_special_tokens=False).ids for d, t in hidden.items()}
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in shown["token_ids"].values())
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert final.exceptAll(docs).count() == 0 and final.count() == docs.count()
