"""Which fleets have all their files (train, test and truth)?

Listing is file-system metadata read on the driver through Hadoop's
FileSystem API (works for any Hadoop-compatible store); the grid logic runs
as DataFrame set operations. Empty files count as present: Spark's file
readers skip empty files, so they cannot be used to list.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import normalize_fd_id
from .cycle_files import SPLITS, split_file_name


def list_files(spark: SparkSession, directory: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    # A folder of part files counts as the file it is named after.
    return [st.getPath().getName() for st in fs.listStatus(path)]


def availability(
    spark: SparkSession, raw_dir: str, requested: Iterable[str | int]
) -> tuple[DataFrame, DataFrame]:
    """(available fleets, missing files) as DataFrames.

    ``available`` has one row per fleet with every split present, in request
    order (``ordinal``); ``missing`` has (dataset_id, paths) with the sorted
    missing paths of each incomplete fleet.
    """
    ids = []
    for r in requested:
        fd = normalize_fd_id(r)
        if fd not in ids:
            ids.append(fd)
    grid = spark.createDataFrame(
        [(i, fd, split, split_file_name(fd, split)) for i, fd in enumerate(ids) for split in SPLITS],
        "ordinal int, dataset_id string, split string, file string",
    )
    present = spark.createDataFrame([(n,) for n in list_files(spark, raw_dir)], "file string")
    missing_rows = grid.join(present, "file", "left_anti").select(
        "dataset_id", F.concat_ws("/", F.lit(raw_dir.rstrip("/")), "file").alias("path")
    )
    missing = missing_rows.groupBy("dataset_id").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    available = (
        grid.select("ordinal", "dataset_id")
        .distinct()
        .join(missing.select("dataset_id"), "dataset_id", "left_anti")
        .orderBy("ordinal")
    )
    return available, missing


def collect_available_datasets(
    spark: SparkSession, raw_dir: str, requested: Iterable[str | int], skip_missing: bool = True
) -> tuple[list[str], dict[str, list[str]]]:
    """Driver-side form (a handful of rows): raises like the reference when a
    fleet is incomplete and ``skip_missing`` is false, or when none is left."""
    available_df, missing_df = availability(spark, raw_dir, requested)
    missing = {r["dataset_id"]: list(r["paths"]) for r in missing_df.collect()}
    available = [r["dataset_id"] for r in available_df.collect()]
    if missing and not skip_missing:
        told = "; ".join(f"{fleet} lacks {len(paths)} files, {paths}" for fleet, paths in sorted(missing.items()))
        raise FileNotFoundError(f"incomplete fleets: {told} (skip_missing=True goes on without them)")
    if not available:
        raise FileNotFoundError(f"{raw_dir} has all files of none of the fleets {sorted(missing)}")
    return available, missing
