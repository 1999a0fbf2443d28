"""Model runs as a table: record a fitted model with its metrics, load the best one."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from stayline.operators.lifecycle import best_run
from stayline.plans.training import Trained

RUNS_SCHEMA = (
    "run_uuid string, experiment_id string, start_time timestamp_ntz, artifact_uri string, Precision_Binary double, F1_Binary double"
)


def experiment(visit_number: int) -> str:
    return f"visit_{visit_number}"


def record_run(spark: SparkSession, trained: Trained, visit_number: int, run_id: str, started: dt.datetime, folder: str) -> None:
    """Save the model, append its nine metrics, and append one row to the runs table.

    The row is written last, so a run that failed half-way is never chosen.
    """
    uri = f"{folder}/models/{experiment(visit_number)}/{run_id}"
    trained.model.write().overwrite().save(uri)
    # Nine scalars of one fit.
    values = {r["metric"]: r["value"] for r in trained.metrics.collect()}
    rows = [(run_id, name, value) for name, value in values.items()]
    spark.createDataFrame(rows, "run_uuid string, key string, value double").coalesce(1).write.mode("append").parquet(f"{folder}/metrics")
    run = (run_id, experiment(visit_number), started, uri, values["Precision_Binary"], values["F1_Binary"])
    spark.createDataFrame([run], RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/runs")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(f"{folder}/runs")


def load_best(spark: SparkSession, folder: str, visit_number: int) -> PipelineModel:
    """The model of the visit number's best run."""
    table = runs(spark, folder)
    chosen = best_run(table.where(table.experiment_id == experiment(visit_number))).select("run_uuid")
    return PipelineModel.load(table.join(chosen, "run_uuid", "left_semi").select("artifact_uri").first()[0])
