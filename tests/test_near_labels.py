"""The nearest label among names and labels that nearly all share words."""

import random

from pyspark.sql import functions as F

from stayline.operators import breeds


def _joined(df) -> list[int]:
    """Rows out of every join of an executed plan, without adaptive execution."""
    stack, found = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_few_pairs_of_a_small_vocabulary_are_joined(spark):
    """150 names and 1,500 labels of 10 to 20 out of 40 words: every pair shares words, and few are let through."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    text = lambda: " ".join(rng.sample(words, rng.randint(10, 20)))
    names, labels = sorted({text() for _ in range(150)}), sorted({text() for _ in range(1500)})
    split = lambda c: F.split(c, " ")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = breeds.nearest_labels(
            spark.createDataFrame([(n,) for n in names], "text string").withColumn("name_tokens", split("text")),
            spark.createDataFrame([(x, "t") for x in labels], "label string, label_tier string").withColumn("label_tokens", split("label")),
        )
        got = {r.text: (-r.score, r.label) for r in df.collect()}
        most = max(_joined(df))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sets = {x: set(x.split()) for x in names + labels}
    assert got == {n: min((-len(sets[n] & sets[x]) / len(sets[n] | sets[x]), x) for x in labels) for n in names}
    assert most < 0.3 * len(names) * len(labels), most


def test_marks_never_hide_a_shared_word(spark):
    """Hundreds of words share the bits of a mark; the nearest label is found all the same."""
    rng = random.Random(6)
    words = [f"x{i}" for i in range(600)]
    labels = sorted({" ".join(rng.sample(words, rng.randint(60, 120))) for _ in range(40)})
    names = [" ".join(rng.sample(x.split(), 40) + rng.sample(words, 5)) for x in labels]
    df = breeds.tier_lookup(
        spark.createDataFrame([(n,) for n in names], "breed string"), spark.createDataFrame([(x, x) for x in labels], "unique_breed string, matching_breed string")
    )
    got = {r.breed: (r.tier, r.tier_score) for r in df.collect()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    want = {}
    for n in names:
        score, label = min((-jaccard(set(n.split()), set(x.split())), x) for x in labels)
        want[n] = (label, -score)
    assert got == want
