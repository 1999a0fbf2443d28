"""Imputation, lookups, sinks, refresh and registry on small frames."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.operators import breeds, features, labels, lifecycle, models, returns, scoring
from stayline.operators.breeds import with_size
from stayline.operators.rows import repeat_rows, split_by
from stayline.plans.enrichment import enrich
from stayline.session import shared_folder, work_path
from stayline.sources import sinks
from stayline.sources.tables import LABELLED_BREEDS, SCORES_SCHEMA, read_csv, read_size_keywords, to_target


def test_repeat_rows_crosses_blocks(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2049)], "k string, n int")
    assert {r.k: r["count"] for r in repeat_rows(df, "n").groupBy("k").count().collect()} == {"b": 1, "c": 2049}


def test_split_leaves_null_out(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    high, low = split_by(df, F.col("x") > 0)
    assert (high.count(), low.count()) == (1, 1)


def test_imputation_levels(spark):
    rows = spark.createDataFrame(
        [(1, "a", 2, 10.0, "small"), (1, "b", 2, None, "small"), (1, "c", 3, 0.0, "small"), (1, "d", None, 6.0, "small"), (1, "e", 9, None, "cat"), (2, "f", 2, 1.0, "small")],
        "visit_number int, uid string, ani_age int, weight double, breed_size string",
    )
    got = {r.uid: (r.ani_age, r.weight) for r in features.impute(rows).collect()}
    mean_age = (2 + 2 + 3 + 9) / 4
    # b: mean of (2, small); c: mean of small over 10, 10 and 6, filled b included; e: no cat weight known.
    assert got == {"a": (2.0, 10.0), "b": (2.0, 10.0), "c": (3.0, 26 / 3), "d": (mean_age, 6.0), "e": (9.0, None), "f": (2.0, 1.0)}
    one = {r.uid: r.weight for r in features.impute(rows, levels=1).collect()}
    assert one["c"] is None and one["b"] == 10.0


def test_weight_fill_switch(spark):
    rows = spark.createDataFrame(
        [("a", "x", 5, 0.0), ("b", "x", None, -1.0), ("c", "x", 0, None), ("d", "y", 5, 0.0), ("e", "x", 5, 7.0)], "uid string, breed string, ani_age int, weight double"
    )
    averages = spark.createDataFrame([("x", "adult", 20.0), ("x", "baby", 2.0)], "breed string, baby string, avg_weight double")
    full = {r.uid: (r.ani_age, r.weight) for r in features.fill_weight(rows, averages).collect()}
    assert full == {"a": (5, 20.0), "b": (10, 20.0), "c": (0, 2.0), "d": (5, None), "e": (5, 7.0)}
    assert {r.uid for r in features.fill_weight(rows, averages, literal=True).collect()} == {"a", "b", "e"}


def test_one_hot_of_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("cat",), ("dragon",), (None,)], "s string").select(*features.one_hot("s", ("cat", "small")))
    assert [tuple(r) for r in df.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_split_is_stable_and_label_is_null_outside(spark):
    df = spark.createDataFrame([("u", -5.0), ("v", 200.0)], "uid string, total_future_spend double")
    got = {r.uid: r[labels.LABEL] for r in labels.with_label(df).collect()}
    assert got == {"u": None, "v": 1}
    assert labels.with_split(df).collect() == labels.with_split(df.repartition(3)).orderBy("uid").collect()


def test_tier_lookup_exact_near_and_default(spark):
    labelled = spark.createDataFrame([("Great Dane", "tier_1"), ("Dane Mix", "tier_2"), ("Poodle", "None")], LABELLED_BREEDS)
    names = spark.createDataFrame([("great dane",), ("old great dane",), ("poodle mix",), ("zebra",), (None,), ("zebra",)], "breed string")
    got = {r.breed: (r.tier, round(r.tier_score, 3)) for r in breeds.tier_lookup(names, labelled).collect()}
    # "poodle mix" shares one of two tokens with Poodle and one of three with Dane Mix.
    assert got == {"great dane": ("tier_1", 1.0), "old great dane": ("tier_1", 0.667), "poodle mix": ("None", 0.5), "zebra": ("oth", 0.0)}


def test_tier_lookup_paths_agree_with_brute_force(spark):
    rng = random.Random(11)
    words = ["mix", "terrier", "dane", "lab", "toy", "blue", "old", "great"]

    def name():
        return " ".join(rng.sample(words, rng.randrange(1, 6)))

    labelled = {name(): f"tier_{rng.randrange(1, 5)}" for _ in range(25)}
    wanted = sorted({name() for _ in range(80)})
    want = {}
    for w in wanted:
        scores = []
        for label, tier in labelled.items():
            a, b = set(w.split()), set(label.split())
            if a & b:
                scores.append((-len(a & b) / len(a | b), label, tier))
        want[w] = (labelled[w], 1.0) if w in labelled else (min(scores)[2], -min(scores)[0]) if scores else ("oth", 0.0)
    names, labels_df = spark.createDataFrame([(w,) for w in wanted], "breed string"), spark.createDataFrame(list(labelled.items()), LABELLED_BREEDS)
    assert {r.breed: (r.tier, r.tier_score) for r in breeds.tier_lookup(names, labels_df).collect()} == want


def test_enrichment_appends_only_new_names(spark):
    labelled = spark.createDataFrame([("Pug", "tier_1")], LABELLED_BREEDS)
    known = spark.createDataFrame([("Pug", "tier_1", 1.0, "small")], "breed string, tier string, tier_score double, breed_size string")
    seen = spark.createDataFrame([("Pug",), ("Pug mix",), (None,)], "breed string")
    path = work_path(spark, "breeds")
    done = enrich(seen, known, labelled, {"small": ["pug"]}, path)
    assert {(r.breed, r.breed_size) for r in done.collect()} == {("Pug", "small"), ("Pug mix", "small")}
    assert [r.breed for r in sinks.read_back(spark, path).collect()] == ["Pug mix"]
    assert breeds.new_categories(seen, done).count() == 0


def test_csv_keeps_quoted_commas_and_quotes(spark, tmp_path):
    rows = [("Welsh Corgi, Pembroke", "tier_1"), ('the "big" one', "None")]
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame(rows, LABELLED_BREEDS), path)
    assert sorted(tuple(r) for r in read_csv(spark, path, LABELLED_BREEDS).collect()) == sorted(rows)


def test_size_keywords_file(spark, tmp_path):
    (tmp_path / "k.csv").write_text('size_class,keyword\nsmall,pug\nsmall,"king, charles"\ncat,tabby\n')
    rules = read_size_keywords(spark, str(tmp_path / "k.csv"))
    names = spark.createDataFrame([("Pug mix",), ("tabby pug",), ("KING, CHARLES",), ("other",), (None,)], "breed string")
    got = {r.breed: r.breed_size for r in with_size(names, rules).collect()}
    lists = {"small": ["pug", "king, charles"], "cat": ["tabby"]}
    assert got == {r.breed: r.breed_size for r in with_size(names, lists).collect()} and got["Pug mix"] == "small" and got[None] is None


def score_frame(spark, uids):
    probs = F.array(*[F.lit(p) for p in (0.1, 0.3, 0.3, 0.1, 0.1, 0.1)])
    df = spark.createDataFrame([(u, 1, 2, Decimal("12.60"), Decimal("1.5"), Decimal("0")) for u in uids], "uid string, visit_number int, max_num_visit int, total_future_spend decimal(12,2), most_recent_visit_spend decimal(12,2), total_past_spend decimal(12,2)")
    return scoring.score_rows(df.withColumn("probability", probs), dt.date(2021, 5, 1))


def test_scores_are_typed_and_appended_once(spark):
    path = work_path(spark, "scores")
    sinks.append_scores(score_frame(spark, ["1_1", "1_2"]), path)
    stored = sinks.scores_table(spark, path).read()
    row = stored.where("uid = '1_1'").first()
    assert (row.final_category, row.final_category_prob, row.total_future_spend) == (1, Decimal("0.300"), 13)
    assert dict(stored.dtypes)["predicted_val_prob_5"] == "decimal(4,3)" and stored.select("id").distinct().count() == 2
    again = score_frame(spark, ["1_1", "1_2", "1_3"]).withColumn("visit_number", F.lit(1))
    sinks.append_scores(scoring.not_yet_scored(again, stored), path)
    sinks.append_scores(score_frame(spark, []), path)
    assert sorted(r.uid for r in sinks.scores_table(spark, path).read().collect()) == ["1_1", "1_2", "1_3"]
    assert to_target(score_frame(spark, ["x"]), SCORES_SCHEMA).columns == list(SCORES_SCHEMA)


def test_anti_join_by_visit_or_at_all(spark):
    candidates = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "uid string, visit_number int")
    scored = spark.createDataFrame([("a", 1)], "uid string, predict_for_visit_number smallint")
    assert {tuple(r) for r in scoring.not_yet_scored(candidates, scored).select("uid", "visit_number").collect()} == {("a", 2), ("b", 1)}
    assert {r.uid for r in scoring.not_yet_scored(candidates, scored, any_visit=True).collect()} == {"b"}


def test_keyed_update(spark):
    target = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "id long, uid string, n smallint")
    updates = spark.createDataFrame([(2, 9), (3, 1)], "id long, n int")
    out = sinks.keyed_update(target, updates, ["id"], ["n"])
    with pytest.raises(Exception, match="more than one update"):
        sinks.keyed_update(target, updates.unionByName(updates), ["id"], ["n"]).collect()
    assert out.schema == target.schema and {tuple(r) for r in out.collect()} == {(1, "x", 5), (2, "y", 9)}
    path = work_path(spark, "target")
    sinks.recreate(target, path)
    sinks.recreate(out.limit(1), path)
    assert sinks.read_back(spark, path).count() == 1


def test_registry(spark):
    runs = spark.createDataFrame(
        [(i, i % 2, dt.datetime(2020, 1, 1 + i), 0.5 if i < 12 else 0.9, i / 20) for i in range(14)],
        "run_uuid long, experiment_id int, start_time timestamp_ntz, Precision_Binary double, F1_Binary double",
    )
    assert {(r.experiment_id, r.run_uuid) for r in lifecycle.best_run(runs).collect()} == {(0, 12), (1, 13)}
    assert {r.run_uuid for r in lifecycle.runs_to_keep(runs).collect()} == set(range(4, 14))
    experiments = spark.createDataFrame([(0, "deleted"), (1, "active")], "experiment_id int, lifecycle_stage string")
    tags = runs.select("run_uuid", F.lit("k").alias("key"))
    kept = lifecycle.without_deleted(experiments, runs, {"tags": tags}, {})
    assert {name: df.count() for name, df in kept.items()} == {"tags": 7, "runs": 7, "experiments": 1}


def test_frequent_rows_and_top_values(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5 + [("c",)] * 2 + [("Examination",)] * 9, "name string")
    assert returns.frequent_rows(df, more_than=4).groupBy("name").count().count() == 2
    assert [r.name for r in returns.top_values(df, "name", 2).collect()] == ["Examination", "a"]


def test_gaps_and_cutoff(spark):
    rows = [(1, dt.date(2020, 1, 1), 1), (1, dt.date(2020, 1, 31), 2), (2, dt.date(2020, 5, 1), 1)]
    df = spark.createDataFrame(rows, "animal_id long, day date, rank_ int").withColumn("first_day", F.when(F.col("animal_id") == 1, F.lit("2020-01-01")).otherwise("2020-05-01").cast("date"))
    assert [tuple(r) for r in returns.visit_gaps(df).collect()] == [(1, 30)]
    assert {r.animal_id for r in returns.seen_before(df, dt.date(2020, 10, 1)).collect()} == {1}


def test_band_model_probabilities(spark):
    rows = [(float(i % 12), float(i % 5), i % 3) for i in range(240)]
    df = spark.createDataFrame(rows, f"a double, b double, {labels.LABEL} int")
    for fit in (lambda d: models.fit_bands(d, ("a", "b"), depth=2, rounds=2), lambda d: models.fit_forest(d, ("a", "b"), depth=4, trees=5)):
        out = models.predict_bands(fit(df), df.withColumn("b", F.when(F.col("b") > 0, F.col("b"))), ("a", "b"))
        sums = out.select(F.size("probability").alias("k"), F.aggregate("probability", F.lit(0.0), lambda x, y: x + y).alias("s")).agg(F.min("k"), F.max("k"), F.min("s"), F.max("s")).first()
        assert tuple(sums)[:2] == (6, 6) and abs(sums[2] - 1) < 1e-9 and abs(sums[3] - 1) < 1e-9
        assert out.where(F.col("prediction") == F.col(labels.LABEL)).count() > 150


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_group_columns_are_plain_names():
    assert returns.group_columns(["RX Diets", "Supplements/OTCs"]) == {"RX Diets": "rx_diets", "Supplements/OTCs": "supplements_otcs"}
    with pytest.raises(KeyError):
        returns.group_columns(["a"])["b"]
