import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import metrics as M
from stayline.operators import order_stats as O
from stayline.operators import staffing as S


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(3)
    rows = [("a", rng.choice([rng.gauss(0, 1), rng.lognormvariate(5, 2), -7.25, 7.25, 1e9 + rng.random()])) for _ in range(700)]
    rows += [("b", 42.0)] * 300 + [("c", 1.0), ("c", None), ("d", None)]
    return rows, spark.createDataFrame(rows, "g string, x double").cache()


@pytest.mark.parametrize("pieces", [1, 4096])
def test_percentiles_equal_numpy(sample, pieces):
    rows, df = sample
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {(r.g, r.prob): r.value for r in O.percentiles(df, "x", probs, ["g"], pieces).collect()}
    for g in "abc":
        xs = [x for k, x in rows if k == g and x is not None]
        for p in probs:
            assert math.isclose(got[(g, p)], np.percentile(xs, p * 100), rel_tol=1e-12, abs_tol=1e-12)
    assert len(got) == 3 * len(probs)
    whole = {r.prob: r.value for r in O.percentiles(df, "x", (0.33,)).collect()}
    assert math.isclose(whole[0.33], np.percentile([x for _, x in rows if x is not None], 33), rel_tol=1e-12)


def test_histogram_equals_numpy(spark):
    xs = [float(x) for x in (1, 2, 2, 3, 8, 9, 10, 10)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.bin: r.n for r in O.histogram(df, "x", 5).collect()}
    want = np.histogram(xs, 5)[0]
    assert got == {i: n for i, n in enumerate(want) if n}
    assert O.histogram(df.where("x = 8"), "x", 5).first().bin == 0


def test_density_of_shifted_values_and_constant_groups(spark):
    rows = [("a", float(i % 10)) for i in range(1000)] + [("c", 5.0)] * 4
    base = spark.createDataFrame(rows, "g string, x double")
    plain = {(r.g, r["at"]): r.density for r in O.density(base, "x", ["g"], [4.5]).collect()}
    far = {(r.g, r["at"] - 1e9): r.density for r in O.density(base.withColumn("x", F.col("x") + 1e9), "x", "g", [1e9 + 4.5]).collect()}
    assert plain[("c", 4.5)] is None and far[("c", 4.5)] is None
    assert math.isclose(plain[("a", 4.5)], far[("a", 4.5)], rel_tol=1e-9)


def test_density_equals_direct_sum(spark):
    xs = [1.0, 2.0, 2.0, 5.0]
    df = spark.createDataFrame([(1, x) for x in xs], "g int, x double")
    h = np.std(xs, ddof=1) * len(xs) ** -0.2
    for r in O.density(df, "x", "g", [0.0, 2.5]).collect():
        want = sum(math.exp(-0.5 * ((r.at - x) / h) ** 2) for x in xs) / (len(xs) * h * math.sqrt(2 * math.pi))
        assert math.isclose(r.density, want, rel_tol=1e-9)


def test_weighted_metrics_by_hand(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (3, 1)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = M.weighted_metrics(M.confusion_cells(df), [1, 2, 3, 4]).first()
    # Class 1: precision 2/4, recall 1; classes 2 and 3: zero; supports 2, 1, 1.
    assert (got.precision, got.recall) == (0.25, 0.5) and math.isclose(got.f1, 2 / 3 * 2 / 4)
    table = {r.metric: r.value for r in M.metric_table(df).collect()}
    assert len(table) == 9 and math.isclose(table["Recall"], 3 / 6) and math.isclose(table["Recall_Binary"], 4 / 6)
    empty = M.weighted_metrics(M.confusion_cells(df), [5]).first()
    assert (empty.f1, empty.recall, empty.precision) == (0.0, 0.0, 0.0)


def test_roc_cutoff_by_brute_force(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(300)]
    rows += [(1, 1.7), (0, -0.3)]
    df = spark.createDataFrame(rows, "target int, score double")
    pos, neg = sum(t for t, _ in rows), sum(1 - t for t, _ in rows)

    def point(cut):
        return sum(t for t, s in rows if s >= cut) / pos, sum(1 - t for t, s in rows if s >= cut) / neg

    got = {r.threshold: (r.tpr, r.fpr) for r in M.roc_points(df).collect()}
    assert got == {s: point(s) for s in {s for _, s in rows}}
    best = min(got, key=lambda s: (abs(got[s][0] - (1 - got[s][1])), -s))
    assert M.roc_cutoff(df).first().threshold == best
    flagged = M.apply_cutoff(df, M.roc_cutoff(df)).where("prediction = 1").count()
    assert flagged == sum(s > best for _, s in rows)


def test_t_test(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, x double")
    row = S.t_tests(df, "x", {"ab": (F.col("g") == "a", F.col("g") == "b")}).first()
    pooled = (3 * np.var(a, ddof=1) + 2 * np.var(b, ddof=1)) / 5
    assert row.df == 5 and math.isclose(row.t, (2.5 - 4.0) / math.sqrt(pooled * (1 / 4 + 1 / 3)))


def test_correlation_ignores_missing_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (4.0, None)], "a double, b double")
    got = {(r.column_a, r.column_b): r.r for r in S.correlations(df, ("a", "b")).collect()}
    assert got[("a", "a")] == 1.0 and math.isclose(got[("a", "b")], np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])
