"""Experiment log as append-only tables (params, metrics, texts per run).

A parent run (the benchmark) has one child run per fleet. Wide metric rows
are turned into (run_id, key, value) rows with ``unpivot``, so one write
logs every fleet.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_run_id() -> str:
    return uuid.uuid4().hex


class RunLog:
    """Writes ``runs``, ``run_params``, ``run_metrics`` and ``run_texts`` under
    ``root`` (append mode; each write is one small job)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(os.path.join(self.root, name))

    def start_run(self, name: str, parent_run_id: str | None = None) -> str:
        run_id = new_run_id()
        now = datetime.now(timezone.utc).isoformat()
        df = self.spark.createDataFrame(
            [(run_id, parent_run_id, name, now)],
            "run_id string, parent_run_id string, run_name string, started_at_utc string",
        )
        self._append(df, "runs")
        return run_id

    def log_params(self, run_id: str, params: dict) -> None:
        rows = [(run_id, str(k), _text(v)) for k, v in params.items()]
        self._append(self.spark.createDataFrame(rows, "run_id string, key string, value string"), "run_params")

    def log_metrics_frame(self, metrics: DataFrame, run_id_col: str, metric_cols: Sequence[str]) -> None:
        """Wide metric rows (one per run) -> (run_id, key, value)."""
        long = metrics.select(
            F.col(run_id_col).alias("run_id"), *[F.col(c).cast("double").alias(c) for c in metric_cols]
        ).unpivot(["run_id"], list(metric_cols), "key", "value")
        self._append(long.where(F.col("value").isNotNull()), "run_metrics")

    def log_metrics(self, run_id: str, metrics: dict[str, float]) -> None:
        rows = [(run_id, k, float(v)) for k, v in metrics.items() if v is not None]
        self._append(self.spark.createDataFrame(rows, "run_id string, key string, value double"), "run_metrics")

    def log_text(self, run_id: str, name: str, text: str) -> None:
        df = self.spark.createDataFrame([(run_id, name, text)], "run_id string, name string, text string")
        self._append(df, "run_texts")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.root, name))


def _text(v) -> str:
    if isinstance(v, (list, tuple)):
        return ",".join(str(x) for x in v)
    if isinstance(v, bool):
        return str(int(v))
    return str(v)
