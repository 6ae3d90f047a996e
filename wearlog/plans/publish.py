"""Runs published whole or not at all: several tables, one manifest.

A run writes its tables under folders that carry the attempt's own name, then one
manifest that lists them. The manifest is put in place by a rename that fails if
the run has one already, so a run is visible with all its tables or with none, a
retried run is published once, and two writers of one run cannot both win. Readers
take the folders from the manifests and never list data folders; what a failed
attempt left is seen by nobody.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import write_report_csv, write_report_json
from .tracking import _text

MANIFEST = "run_key string, created_at_utc string, tables map<string,string>, reports map<string,string>"
METRICS = (
    "rmse", "mae", "nasa_score", "loss", "best_epoch", "train_units", "validation_units", "train_rows",
    "validation_rows", "train_sequence_samples", "validation_sequence_samples",
)


def run_key(config: dict, inputs: str) -> str:
    """The same run, tried again, has the same key: a hash of its settings and of its input's fingerprint."""
    text = json.dumps(config, sort_keys=True, default=str) + "\n" + inputs
    return hashlib.sha256(text.encode()).hexdigest()[:32]


class RunStore:
    """Published runs under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, place: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(place)

    def _files(self):
        hadoop = self.spark._jsparkSession.sessionState().newHadoopConf()
        return self._path(self.root).getFileSystem(hadoop), hadoop

    def is_published(self, key: str) -> bool:
        return self._files()[0].exists(self._path(f"{self.root}/manifests/{key}.json"))

    def publish(self, key: str, tables: dict[str, DataFrame], reports: dict[str, DataFrame] | None = None) -> bool:
        """Write and commit; False if the run was published before (nothing is written then, or it stays unseen)."""
        if self.is_published(key):
            return False
        attempt = f"{key}-{uuid.uuid4().hex[:12]}"
        places = {name: f"{self.root}/tables/{name}/{attempt}" for name in tables}
        for name, df in tables.items():
            df.write.parquet(places[name])
        files = {}
        for name, df in (reports or {}).items():
            for kind, write in (("csv", write_report_csv), ("json", write_report_json)):
                if kind == "json" or not any("<" in t for _, t in df.dtypes):
                    files[f"{name}.{kind}"] = f"{self.root}/reports/{attempt}/{name}.{kind}"
                    write(df, files[f"{name}.{kind}"])
        now = self.spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").first()[0]
        return self._commit(key, attempt, {"run_key": key, "created_at_utc": now, "tables": places, "reports": files})

    def _commit(self, key: str, attempt: str, manifest: dict) -> bool:
        jvm = self.spark._jvm
        system, hadoop = self._files()
        system.mkdirs(self._path(f"{self.root}/manifests"))
        draft, final = self._path(f"{self.root}/drafts/{attempt}.json"), self._path(f"{self.root}/manifests/{key}.json")
        out = system.create(draft, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), hadoop)
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(final), options)
        except Exception:
            if self.is_published(key):
                return False
            raise
        return True

    def runs(self) -> DataFrame:
        """run_key, created_at_utc, tables, reports of every published run."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.root}/manifests")
        except AnalysisException:
            return self.spark.createDataFrame([], MANIFEST)

    def table(self, name: str) -> DataFrame:
        """The rows of all published runs' tables of that name (a path per run is listed)."""
        paths = [r[0] for r in self.runs().select(F.col("tables")[name]).where(F.col("tables")[name].isNotNull()).collect()]
        if not paths:
            raise ValueError(f"no published run has a table {name!r}")
        return self.spark.read.option("mergeSchema", True).parquet(*paths)


def run_tables(key: str, config: dict, summary: DataFrame, name: str = "benchmark") -> dict[str, DataFrame]:
    """The experiment log of a benchmark as tables: ``runs`` (the parent and a child for each
    summary row), ``run_params`` of the parent, ``run_metrics`` of the children, ``summary``."""
    spark = summary.sparkSession
    child = F.concat_ws(":", F.lit(key), "dataset_id", "model")
    runs = summary.select(child.alias("run_id"), F.lit(key).alias("parent_run_id"), F.concat_ws(" ", "dataset_id", "model").alias("run_name"))
    parent = spark.createDataFrame([(key, None, name)], "run_id string, parent_run_id string, run_name string")
    params = spark.createDataFrame([(key, str(k), _text(v)) for k, v in config.items()], "run_id string, key string, value string")
    columns = [c for c in METRICS if c in summary.columns]
    long = summary.select(child.alias("run_id"), *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(["run_id"], columns, "key", "value")
    return {"runs": parent.unionByName(runs), "run_params": params, "run_metrics": long.where("value IS NOT NULL"), "summary": summary}


def publish_benchmark(spark: SparkSession, root: str, config: dict, inputs: str, summary: DataFrame, metadata: DataFrame | None = None) -> tuple[str, bool]:
    """Publish a benchmark's log, summary and metadata as one run: (run key, whether this call published it)."""
    key = run_key(config, inputs)
    reports = {"summary": summary} | ({"run_metadata": metadata} if metadata is not None else {})
    return key, RunStore(spark, root).publish(key, run_tables(key, config, summary), reports)
