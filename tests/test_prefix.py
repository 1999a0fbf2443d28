"""Running sums over ranges, box statistics, ROC on crowded scores, keyword index and tier lookup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import breeds, metrics, prefix
from stayline.operators.order_stats import box_stats
from stayline.sources.tables import LABELLED_BREEDS


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_by_brute_force(spark, descending):
    rng = random.Random(1)
    rows = sorted({(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1e-9), rng.gauss(0, 1e9), float(rng.randint(0, 3))])) for _ in range(400)}, key=str)
    rows = [(g, x, rng.randint(0, 5), rng.randint(0, 5)) for g, x in rows]
    df = spark.createDataFrame(rows, "g string, x double, p int, q int")
    got = {(r.g, r.x): r for r in prefix.running_sums(df, "x", ["p", "q"], ["g"], descending, parts=7).collect()}
    assert len(got) == len(rows)
    for g, x, *_ in rows:
        own = [r for r in rows if r[0] == g]
        before = [r for r in own if (r[1] > x if descending else r[1] < x)]
        assert [got[g, x][c] for c in ("p_before", "q_before", "p_total", "q_total")] == [sum(r[2] for r in before), sum(r[3] for r in before), sum(r[2] for r in own), sum(r[3] for r in own)]
    assert prefix.running_sums(df.limit(0), "x", ["p"]).count() == 0 and prefix.running_sums(df.limit(0), "x", ["p"], ["g"]).count() == 0


@pytest.mark.parametrize("scores", [lambda r: r.random() / 4096, lambda r: 1 + r.random(), lambda r: -r.random() * 1e6])
def test_crowded_scores_are_spread(spark, scores):
    """Scores within 1/4096, above 1 and below 0: exact points, and no range holds more than a few hundredths of them."""
    rng = random.Random(2)
    rows = [(int(rng.random() < 0.3), scores(rng)) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "target int, score double")
    got = {r.threshold: (r.tpr, r.fpr) for r in metrics.roc_points(df).collect()}
    target, score = np.array([t for t, _ in rows]), np.array([s for _, s in rows])
    for s in score[::100]:
        assert got[s] == (target[score >= s].sum() / target.sum(), (1 - target)[score >= s].sum() / (1 - target).sum())
    cut = F.percentile_approx("score", F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(1_280))
    ranged = df.withColumn("s", df.agg(cut).scalar()).withColumn("range", prefix.splitters_at_or_below(F.col("s"), F.col("score"), 64))
    sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 0.05 * len(rows)


def test_box_stats_of_several_measures(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", None]), rng.randint(0, 2), rng.choice([None, round(rng.gauss(0, 9), 1), 300.0]), rng.randint(0, 4)) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, d int, a double, b int")
    got = {(r.k, r.d, r.measure): r for r in box_stats(df, ["a", "b"], ["k", "d"]).collect()}
    assert len(got) == 12
    for (k, d, m), r in got.items():
        x = np.array([row[2 if m == "a" else 3] for row in rows if row[:2] == (k, d) and row[2 if m == "a" else 3] is not None], float)
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert np.allclose([r.q1, r.median, r.q3, r.low_whisker, r.high_whisker], [q1, q2, q3, inside.min(), inside.max()]) and (r.outliers, r.n) == (len(x) - len(inside), len(x))
    assert box_stats(df, "a", ["d"]).columns == ["d", "q1", "median", "q3", "low_whisker", "high_whisker", "outliers", "n"]


def test_box_stats_reads_its_input_once(spark, tmp_path):
    spark.range(50_000).select((F.col("id") % 7).alias("d"), F.rand(1).alias("a"), F.rand(2).alias("b")).write.parquet(str(tmp_path / "rows"))
    df = box_stats(spark.read.parquet(str(tmp_path / "rows")), ["a", "b"], ["d"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("- Exchange") + plan.count("- BroadcastExchange") <= 12, plan


def test_keyword_hits_by_brute_force(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abc ä") for _ in range(n))
    names = [text(rng.randint(0, 12)) for _ in range(120)] + [None, "", "pug (toy)", "a"]
    words = sorted({text(rng.randint(0, 6)) for _ in range(150)} | {"", "(toy", "zzz", "pug (toy) and more"})
    got = breeds.keyword_hits(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(w,) for w in words + [None, "a"]], "keyword string"))
    pairs = [tuple(r) for r in got.collect()]
    assert sorted(pairs) == sorted((n, w) for n in set(names) - {None} for w in words if w in n)


def test_keyword_table_of_100_000_rows(spark):
    """No list of all keywords is made: the plan joins on grams, and each name meets a few keywords."""
    classes = F.element_at(F.array(*map(F.lit, ("small", "medium", "large", "cat", "other_animal"))), (F.col("id") % 5 + 1).cast("int"))
    rules = spark.range(100_000).select(classes.alias("size_class"), F.format_string("k%06dq", F.col("id")).alias("keyword"))
    names = spark.createDataFrame([("a K000003Q b",), ("k000004q k000000Q",), ("k00000q",), (None,), ("k099999q k099995q",)], "breed string")
    df = breeds.with_size(names, rules)
    assert {r.breed: r.breed_size for r in df.collect()} == {"a K000003Q b": "cat", "k000004q k000000Q": "other_animal", "k00000q": "medium", None: None, "k099999q k099995q": "other_animal"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def _nearest(wanted, labelled):
    out = {}
    for w in wanted:
        a = set(w.lower().split())
        scores = [(-len(a & set(x.lower().split())) / len(a | set(x.lower().split())), x.lower(), tier) for x, tier in labelled.items() if a & set(x.lower().split())]
        exact = [tier for x, tier in labelled.items() if x.lower() == w.lower()]
        out[w] = (exact[0], 1.0) if exact else (min(scores)[2], -min(scores)[0]) if scores else ("oth", 0.0)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_tier_lookup_of_any_length_by_brute_force(spark, seed):
    """One common word in nearly all names and labels, many ties, lengths from 1 to 30 tokens."""
    rng = random.Random(seed)
    words = ["mix", "the"] + [f"w{i}" for i in range((12, 40, 200)[seed])]

    def name(most):
        own = rng.sample(words, min(len(words), rng.randint(1, most)))
        return " ".join(own + ["mix"] * (rng.random() < 0.8 and "mix" not in own))

    labelled = {name(30): f"tier_{rng.randrange(1, 5)}" for _ in range(120)} | {name(4): f"tier_{rng.randrange(1, 5)}" for _ in range(60)}
    wanted = sorted({name(rng.choice([2, 5, 30])) for _ in range(200)} | {"nothing known", "mix", "the unknown"} | set(list(labelled)[:5]))
    got = breeds.tier_lookup(spark.createDataFrame([(w,) for w in wanted], "breed string"), spark.createDataFrame(list(labelled.items()), LABELLED_BREEDS))
    want = _nearest(wanted, labelled)
    assert {r.breed: (r.tier, r.tier_score) for r in got.collect()} == want


def test_common_word_pairs_little(spark):
    """3,000 names and 3,000 labels that share one word each with all: no name meets all labels."""
    names = spark.range(3_000).select(F.concat(F.lit("n"), "id", F.lit(" common")).alias("text")).withColumn("name_tokens", F.split("text", " "))
    labels = spark.range(3_000).select(F.concat(F.lit("l"), "id", F.lit(" common")).alias("label"), F.lit("t").alias("label_tier")).withColumn("label_tokens", F.split("label", " "))
    df = breeds.nearest_labels(names, labels)
    assert df.where("label = 'l0 common' and score = 1 / 3D").count() == 3_000
    df.collect()
