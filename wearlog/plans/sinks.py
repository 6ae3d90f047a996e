"""Table, report and model sinks.

Feature / label / sequence tables are parquet partitioned by fleet, so a
later job for one fleet reads only its folder. Reports (one row per fleet and
model) are small by construction and written as single CSV / JSON files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("dataset_id",), mode: str = "overwrite"
) -> None:
    """Labeled / feature / sequence tables as parquet, partitioned by fleet."""
    writer = df.write.mode(mode)
    cols = [c for c in partition_by if c in df.columns]
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report of a handful of rows (fleets x models) as one CSV with header;
    NULLs are written as empty fields."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """The same report as JSON lines, NULL fields kept as ``null``."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def union_results(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several models / fleets; columns missing on one side are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def run_metadata_frame(
    spark: SparkSession,
    config: dict,
    available: Sequence[str],
    missing: dict[str, list[str]],
    created_at: datetime | None = None,
) -> DataFrame:
    """One row: created_at_utc, config (as a struct via JSON), the available
    fleets and the missing files per fleet."""
    created = (created_at or datetime.now(timezone.utc)).isoformat()
    schema = T.StructType(
        [
            T.StructField("created_at_utc", T.StringType()),
            T.StructField("config_json", T.StringType()),
            T.StructField("available_datasets", T.ArrayType(T.StringType())),
            T.StructField("missing_by_dataset", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        ]
    )
    row = (created, json.dumps(config, default=str, sort_keys=True), list(available), dict(missing))
    df = spark.createDataFrame([row], schema)
    config_schema = spark.range(1).select(F.schema_of_json(F.lit(row[1]))).first()[0]
    return df.select(
        "created_at_utc",
        F.from_json("config_json", config_schema).alias("config"),
        "available_datasets",
        "missing_by_dataset",
    )


def write_run_metadata(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_model(model: PipelineModel, path: str, metadata: dict | None = None) -> None:
    """Save the pipeline; ``metadata`` (input features, sequence length, best
    round, metrics, ...) goes to a one-row JSON table beside it."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    meta = {"feature_columns": list(model.stages[0].getInputCols()) if hasattr(model.stages[0], "getInputCols") else []}
    meta.update(metadata or {})
    row = spark.createDataFrame([(json.dumps(meta, default=str, sort_keys=True),)], "metadata string")
    row.coalesce(1).write.mode("overwrite").text(path.rstrip("/") + "_metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model_metadata(spark: SparkSession, path: str) -> dict:
    text = spark.read.text(path.rstrip("/") + "_metadata").first()[0]
    return json.loads(text)
