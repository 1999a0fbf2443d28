"""Properties of the physical plans that scale depends on."""

import re

import pytest

from __spark_entry__ import entry, queries
from stayline.contract import ALL

FOLDER = "/root/testdata/sf0.001"
LAZY = [n for n in ALL if n not in {"train_score", "train_binary", "forest_score", "importance", "split_counts", "split_checks", "train_visits", "visit_metrics", "score_visits", "score_new", "glm_fit", "glm_summary", "glm_score", "mlp_fit", "mlp_rounds", "mlp_checks", "linreg_fit", "linreg_divisions"}
        and not n.startswith(("append", "overwrite", "csv", "refresh_", "keyed_update"))]


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["feature_frame", "snapshot_all_n", "score_candidates", "label_bands", "scoring_features"])
def test_lines_are_read_once(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER), run=True)
    amounts = [scan for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_extendedprice" in scan]
    assert len(amounts) == 1


def test_windows_over_patients_sit_above_day_grain_aggregates(spark):
    plan = plan_of(queries()["feature_frame"](spark, FOLDER))
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        assert "product" not in spec


def test_best_runs_are_cut_before_the_shuffle(spark):
    assert plan_of(queries()["runs_keep5"](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_only_needed_columns_are_read(spark):
    plan = plan_of(queries()["visit_islands"](spark, FOLDER))
    assert "l_tax" not in plan and "l_shipdate" not in plan and "o_totalprice" not in plan


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["visit_number", "total_future_spend_bin", "patients"] and df.count() > 0
