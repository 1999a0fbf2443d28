"""Refreshing stored predictions, and the model-run registry as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.numeric import money
from stayline.operators.facts import with_contact_copies


def returning_patients(facts: DataFrame, visits: DataFrame, scored: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """Tracked patients who came back: visits so far and spend after the first visit.

    Tracked means having any stored prediction, whatever their number, so spend is not
    repeated per prediction. Spend is summed per uid with map-side partial sums.
    """
    days = facts.groupBy("uid", "day").agg(money(F.sum("revenue")).alias("spend"))
    later = visits.where("visit_number > 1").select("uid", "day", F.col("max_num_visit").alias("total_num_visit"))
    kept = days.join(later, ["uid", "day"]).join(scored.select("uid").distinct(), "uid", "left_semi")
    out = kept.groupBy("uid", "total_num_visit").agg(money(F.sum("spend")).alias("total_future_spend"))
    if copies is not None:
        out = with_contact_copies(out, copies, "total_future_spend")
    return out


def refresh_rows(returning: DataFrame, scored: DataFrame) -> DataFrame:
    """One update row per stored prediction of a returning patient."""
    stored = scored.select("id", "uid", "predict_for_visit_number")
    return stored.join(returning, "uid").select("id", "uid", "predict_for_visit_number", "total_num_visit", "total_future_spend")


def best_run(runs: DataFrame, by: str = "experiment_id") -> DataFrame:
    """Per experiment, the run with the best binary precision; the latest on ties.

    A maximum over one struct combines map-side, so a long experiment is never sorted.
    """
    best = F.max(F.struct("Precision_Binary", "start_time", "run_uuid")).alias("b")
    return runs.groupBy(by).agg(best).select(by, "b.Precision_Binary", "b.start_time", "b.run_uuid")


def runs_to_keep(runs: DataFrame, keep: int = P.KEEP_RUNS, by: str = "experiment_id") -> DataFrame:
    """The best runs by binary F1 per experiment. Tasks pass on only their own best few."""
    order = Window.partitionBy(by).orderBy(F.desc("F1_Binary"), F.desc("start_time"), F.desc("run_uuid"))
    return runs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def without_deleted(
    experiments: DataFrame, runs: DataFrame, by_run: dict[str, DataFrame], by_experiment: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Every registry table without the rows that hang on a deleted experiment.

    Keys removed are found once; each table is filtered with an anti join and can be
    written as its new snapshot.
    """
    gone = experiments.where("lifecycle_stage = 'deleted'").select("experiment_id")
    gone_runs = runs.join(gone, "experiment_id", "left_semi").select("run_uuid")
    kept = {name: df.join(gone, "experiment_id", "left_anti") for name, df in by_experiment.items()}
    kept |= {name: df.join(gone_runs, "run_uuid", "left_anti") for name, df in by_run.items()}
    kept["runs"] = runs.join(gone, "experiment_id", "left_anti")
    kept["experiments"] = experiments.where("lifecycle_stage is distinct from 'deleted'")
    return kept
