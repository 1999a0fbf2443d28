"""Rank, score equations, early stop, split counts and p-values, against closed forms and NumPy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.functions.numeric import log_gamma, two_sided_p
from stayline.operators import models


def test_independent_columns_by_rank():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 5, (200, 4)).astype(float)
    x = np.column_stack([base[:, 0], 0 * base[:, 0], base[:, 1], base[:, 0] - 2 * base[:, 1], base[:, 2] * 1e6, base[:, 0] + base[:, 2], base[:, 3]])
    kept = models.independent(x.T @ x)
    assert kept == [0, 2, 4, 6]  # zero columns and combinations of earlier ones are aliased
    for j in range(x.shape[1]):
        assert np.linalg.matrix_rank(x[:, : j + 1]) == sum(k <= j for k in kept)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    made = []
    for _ in range(600):
        dog = rng.randint(0, 1)
        a, b = rng.randint(0, 3), rng.randint(0, 2)
        made.append((dog, 1 - dog, a, b, a + b, 0, int(rng.random() < 1 / (1 + math.exp(-(0.4 * a - 0.7 * b + 0.5 * dog))))))
    return spark.createDataFrame(made, "dog int, cat int, a int, b int, both int, none int, y int")


TERMS = ("dog", "cat", "a", "b", "both", "none")


def test_binomial_solves_its_score_equations(spark, rows):
    model = models.fit_binomial(rows, TERMS, "y")
    got = model.coefficients()
    assert [c for c in TERMS if got[c] is None] == ["both", "none"]
    for r in models.binomial_score(model, rows, "y").collect():
        assert r.observed == pytest.approx(r.expected, abs=1e-6)
    x = np.array(rows.select("dog", "cat", "a", "b").collect(), float)
    y = np.array([r.y for r in rows.collect()], float)
    beta = np.zeros(4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x.T * (p * (1 - p))) @ x, x.T @ (y - p))
    assert np.allclose([got[c] for c in ("dog", "cat", "a", "b")], beta, atol=1e-6)
    summary = {r.term: r for r in models.binomial_summary(spark, model).collect()}
    errors = np.sqrt(np.diag(np.linalg.inv((x.T * (p * (1 - p))) @ x)))
    assert np.allclose([summary[c].std_error for c in ("dog", "cat", "a", "b")], errors, rtol=1e-4)
    assert summary["both"].estimate is None and summary["none"].p is None


def test_network_stops_and_keeps_the_best_round(rows):
    fit, stop = rows.where("a < 3"), rows.where("a >= 2")
    net = models.fit_network(fit, stop, ("dog", "a", "b"), "y", rounds=12, steps=5, patience=2)
    assert 1 <= len(net.losses) <= 12 and net.losses[net.best_round - 1] == min(net.losses)
    assert len(net.losses) in (net.best_round + 2, 12)
    assert models.log_loss(models.predict_network(net.fitted, stop, ("dog", "a", "b")), "y") == pytest.approx(min(net.losses), abs=1e-12)


def test_fit_within_equals_indicators(spark):
    rng = np.random.default_rng(3)
    n = 400
    g = rng.integers(0, 12, n)
    x = np.column_stack([rng.normal(1e4, 1, n), rng.normal(0, 5, n), 3.0 * g, np.zeros(n)])
    x[:, 3] = x[:, 0] * 2 - x[:, 1]
    y = x[:, 0] * 1.5 - 0.3 * x[:, 1] + g * 7 + rng.normal(0, 1, n)
    rows = [(f"g{a}", *map(float, row), float(v)) for a, row, v in zip(g, x, y)] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0), ("g0", None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double, y double").repartition(5)
    fitted = models.fit_within(df, ("a", "b", "c", "d"), "y", "g")
    dummies = (g[:, None] == np.unique(g)).astype(float)
    want = np.linalg.lstsq(np.column_stack([x[:, :2], dummies]), y, rcond=None)[0]
    assert fitted.slopes["c"] is None and fitted.slopes["d"] is None  # one level a group; a combination
    assert np.allclose([fitted.slopes["a"], fitted.slopes["b"]], want[:2], rtol=1e-6)
    levels = {r.g: r.level for r in fitted.levels.collect()}
    assert np.allclose([levels[f"g{k}"] for k in np.unique(g)], want[2:], rtol=1e-5)
    assert models.fit_within(df.limit(0), ("a",), "y", "g").slopes == {"a": None}


def test_log_loss_by_hand(spark):
    df = spark.createDataFrame([(1, 0.25), (0, 0.5), (1, 0.0)], "y int, score double")
    assert models.log_loss(df, "y") == pytest.approx(-(math.log(0.25) + math.log(0.5) + math.log(1e-15)) / 3)


def test_split_counts_add_up_to_inner_nodes(spark, rows):
    train = rows.withColumn("total_future_spend_bin", (F.col("a") + F.col("b")) % 6)
    for fit in (models.fit_bands, models.fit_forest):
        model = fit(train, ("dog", "cat", "a", "none"), 3, 4)
        counts = models.split_counts(spark, model, ("dog", "cat", "a", "none")).collect()
        members = getattr(model.stages[-1], "models", None)
        for band, m in enumerate(members) if members else [(None, model.stages[-1])]:
            own = {r.feature: r.splits for r in counts if r.band == band}
            assert sum(own.values()) == sum((t.numNodes - 1) // 2 for t in m.trees)  # a binary tree
            assert set(own) == {"dog", "cat", "a", "none"} and own["none"] == 0


def test_two_sided_p(spark):
    ts = [0.0, 1e-8, 0.3, 1.0, 2.5, 7.0, 60.0, -2.5]
    df = spark.createDataFrame([(t, d) for t in ts for d in (1, 2, 4, 1_483, 10**7, 0)] + [(None, 3)], "t double, df int")
    got = {(r.t, r.df): r.p for r in df.withColumn("p", two_sided_p(F.col("t"), F.col("df"))).collect()}
    for t in ts:
        a = abs(t)
        assert got[t, 1] == pytest.approx(1 - 2 / math.pi * math.atan(a), abs=1e-11)
        assert got[t, 2] == pytest.approx(1 - a / math.sqrt(2 + a * a), abs=1e-11)
        s = a / math.sqrt(4 + a * a)
        assert got[t, 4] == pytest.approx(1 - s * (1 + 0.5 * (1 - s * s)), abs=1e-11)
        assert got[t, 10**7] == pytest.approx(math.erfc(a / math.sqrt(2)), abs=2e-7)
        assert got[t, 0] is None
    assert got[None, 3] is None and got[2.5, 1_483] == pytest.approx(0.012527, abs=1e-5)


def test_log_gamma(spark):
    xs = [0.5, 1.0, 1.5, 2.0, 7.3, 1e3, 1e7]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(log_gamma(F.col("x"))).collect()
    assert all(r[0] == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-11) for r, x in zip(got, xs))
