"""Train, record, score, append and refresh on the smallest data folder."""

import datetime as dt

from pyspark.sql import functions as F

from stayline.operators import scoring
from stayline.plans import refresh, registry, snapshots, training
from stayline.plans import scoring as score_plan
from stayline.session import cut_lineage, work_path
from stayline.sources import sinks
from stayline.sources.inputs import AS_OF, Inputs


def test_train_record_score_and_append(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    rows = cut_lineage(training.training_rows(inputs, AS_OF, up_to=1))
    folder = work_path(spark, "registry")
    for i, rounds in enumerate((1, 2)):
        fitted = training.train(rows, 1, depth=2, rounds=rounds)
        assert fitted.holdout.count() == rows.where("not is_train").count()
        registry.record_run(spark, fitted, 1, f"run{i}", dt.datetime(2021, 1, 1 + i), folder)
    assert registry.runs(spark, folder).count() == 2
    model = registry.load_best(spark, folder, 1)

    table = work_path(spark, "scores")
    score_plan.score_and_append(inputs, {1: model}, AS_OF, table)
    stored = cut_lineage(sinks.scores_table(spark, table).read())
    assert stored.count() == stored.select("uid").distinct().count() > 0
    assert not score_plan.score_and_append(inputs, {1: model}, AS_OF, table)
    assert sinks.scores_table(spark, table).read().count() == stored.count()
    sums = stored.select(sum(F.col(c) for c in scoring.PROBS).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert 0.99 <= sums[0] <= sums[1] <= 1.01


def test_refresh_touches_only_returning_patients(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    new, old = refresh.refreshed(inputs, AS_OF), inputs.scored
    assert new.schema == old.schema and new.count() == old.count()
    changed = new.join(old, ["id", "uid", "predict_for_visit_number", "total_num_visit", "total_future_spend"], "left_anti").count()
    assert 0 < changed <= refresh.update_rows(inputs, AS_OF).count()


def test_spend_adds_up(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    snap = snapshots.build(inputs, AS_OF, training=False)
    total = F.col("total_past_spend") + F.col("most_recent_visit_spend") + F.col("total_future_spend")
    per_uid = snap.days.groupBy("uid").agg(F.countDistinct(total).alias("totals"), F.max("visit_number").alias("top"), F.countDistinct("visit_number").alias("seen"), F.max("max_num_visit").alias("most"))
    assert per_uid.where("totals <> 1 or top > most").count() == 0


def test_lines_can_be_ordered(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    snap = snapshots.build(inputs, AS_OF)
    rows = [(r.uid, r.day) for r in snapshots.visit_lines(inputs, snap, AS_OF, 1, ordered=True).select("uid", "day").collect()]
    assert rows == sorted(rows) and rows
