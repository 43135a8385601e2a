"""Experiment run records: numbering, the best run per model, logging."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnspark.sources.io import RUN_SCHEMA

METRICS = ("pr_auc", "roc_auc", "f1", "precision", "recall", "accuracy", "threshold")


def numeric_metrics(runs: DataFrame) -> DataFrame:
    """(run_id, key, value): the numeric entries of ``metrics``; others are dropped."""
    rows = runs.select("run_id", F.explode("metrics").alias("key", "_v"))
    return rows.withColumn("value", F.col("_v").try_cast("double")).where("value IS NOT NULL").drop("_v")


def flat_params(runs: DataFrame) -> DataFrame:
    """(run_id, key, value) with dotted keys for ``params`` and ``dataset``."""
    def entries(c: str):
        return F.transform(F.map_entries(F.coalesce(F.col(c), F.create_map().cast("map<string,string>"))), lambda e: F.struct(
            F.concat(F.lit(f"{c}."), e["key"]).alias("key"), e["value"].alias("value")))
    return runs.select("run_id", F.inline(F.concat(entries("params"), entries("dataset"))))


def leaderboard(runs: DataFrame) -> DataFrame:
    """Best successful run per model by PR-AUC then ROC-AUC (NULL counts as -1, the earlier run wins ties).

    Lines without a status or without both metrics drop out. ``run_number`` gives the order of the runs of a model. The
    best run is an aggregate, not a window, so a model with very many runs is reduced on the map side.
    """
    values = {m: F.try_element_at("metrics", F.lit(m)).try_cast("double") for m in METRICS}
    rows = runs.where(F.col("status") == "success").select(
        F.coalesce("model_name", F.lit("unknown")).alias("model_name"), "run_id", "run_number",
        *[v.alias(m) for m, v in values.items()],
    ).where("pr_auc IS NOT NULL OR roc_auc IS NOT NULL")
    order = F.struct(F.coalesce("pr_auc", F.lit(-1.0)).alias("a"), F.coalesce("roc_auc", F.lit(-1.0)).alias("b"),
                     (-F.col("run_number")).alias("c"))
    best = rows.groupBy("model_name").agg(F.max_by(F.struct(*rows.columns[1:]), order).alias("r"))
    return best.select("model_name", "r.*").orderBy(
        F.col("pr_auc").desc_nulls_last(), F.col("roc_auc").desc_nulls_last(), "model_name"
    )


def next_run_number(runs: DataFrame) -> DataFrame:
    return runs.groupBy("model_name").agg((F.coalesce(F.max("run_number"), F.lit(0)) + 1).alias("next_run_number"))


def number_runs(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Numbers a batch of new runs (model_name, started_at_utc, ...) after the ones already logged.

    Runs that started at the same time are numbered by their content, so that a rerun gives the same numbers.
    """
    order = Window.partitionBy("model_name").orderBy("started_at_utc", F.to_json(F.struct(*sorted(new.columns))))
    start = next_run_number(existing)
    numbered = new.withColumn("_i", F.row_number().over(order)).join(start, "model_name", "left")
    out = numbered.withColumn("run_number", F.col("_i") - 1 + F.coalesce("next_run_number", F.lit(1)))
    return out.drop("_i", "next_run_number").withColumn(
        "run_id", F.format_string("%s-%04d", F.col("model_name"), F.col("run_number"))
    )


def run_record(spark: SparkSession, model_name: str, run_number: int, work: Callable[[], dict], dataset: dict | None = None,
               params: dict | None = None, artifacts: dict | None = None, notes: str = "") -> DataFrame:
    """Run ``work`` (returns a dict of metrics) and describe it in one row; a failure is recorded, not raised."""
    started, clock = datetime.now(timezone.utc), time.monotonic()
    extra = dict(artifacts or {})
    try:
        metrics, status = work(), "success"
    except Exception as error:  # a failed run is a record too
        metrics, status = {}, "failed"
        extra["error"] = repr(error)
    finished = datetime.now(timezone.utc)

    def text(d: dict | None) -> dict[str, str]:
        return {str(k): str(v) for k, v in (d or {}).items()}

    row = (f"{model_name}-{run_number:04d}", model_name, run_number, status, started.isoformat(timespec="seconds"),
           finished.isoformat(timespec="seconds"), time.monotonic() - clock, text(dataset), text(params), text(metrics),
           text(extra), notes)
    return spark.createDataFrame([row], RUN_SCHEMA)
