"""Readers for whitespace-delimited run-to-failure text files.

File naming (fixed values of the format): ``train_FD00x.txt``,
``test_FD00x.txt`` and ``RUL_FD00x.txt``. Many files and fleets are read by
one job; the fleet id comes from the file name (``_metadata.file_name``).

Cycle lines hold 26 blank-separated numbers (unit, cycle, 3 settings, 21
sensors); leading / trailing blanks are ignored and blank lines skipped. A
shorter line is padded with NULLs (as the reference's reader does); a longer
line, a non-numeric token, or a file whose widest line is not 26 wide is an
error (``mode="strict"``) or goes to the rejects (``mode="reject"``).
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import normalize_fd_id
from ..schema import CYCLE_FILE_COLUMNS, OP_SETTING_COLUMNS, SENSOR_COLUMNS

SPLITS = ("train", "test", "rul")
N_COLUMNS = len(CYCLE_FILE_COLUMNS)
# A logical file is either ``<split>_FD00x.txt`` or a folder of that name
# holding ordered part files (what Spark writes); lines are ordered by
# (part file name, block start, position in block).
_FILE_RE = r"(train|test|RUL)_(FD[0-9]{3})\.txt(/[^/]+)?$"


def split_file_name(fd_id: str, split: str) -> str:
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}")
    fd = normalize_fd_id(fd_id)
    return f"RUL_{fd}.txt" if split == "rul" else f"{split}_{fd}.txt"


def split_paths(raw_dir: str, fd_ids: Iterable[str | int], split: str) -> list[str]:
    return [os.path.join(raw_dir, split_file_name(str(i) if isinstance(i, str) else i, split)) for i in fd_ids]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    raw = spark.read.text(paths).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("part_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ).where(~F.col("part_name").startswith("_") & ~F.col("part_name").startswith("."))
    text = F.regexp_replace(F.col("value"), r"^\s+|\s+$", "")
    logical = F.regexp_replace(F.col("_path"), r"(\.txt)/[^/]+$", "$1")
    return raw.select(
        F.regexp_extract("_path", _FILE_RE, 2).alias("dataset_id"),
        F.regexp_extract(logical, r"([^/]+)$", 1).alias("file_name"),
        "part_name",
        "block_start",
        text.alias("line"),
    ).where(F.col("line") != "")


def _nan_to_null(c: F.Column) -> F.Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def parse_cycle_lines(lines: DataFrame) -> DataFrame:
    """(dataset_id, file_name, line) -> canonical columns + ``_problem``."""
    tokens = F.split(F.col("line"), r"\s+")
    nums = [F.get(F.col("_tok"), i).try_cast("double") for i in range(N_COLUMNS)]
    bad_token = F.exists(F.col("_tok"), lambda t: t.try_cast("double").isNull())
    with_tok = lines.select("*", tokens.alias("_tok"))
    unit, cycle = nums[0], nums[1]
    problem = (
        F.when(F.size("_tok") > N_COLUMNS, F.lit("too many columns"))
        .when(bad_token, F.lit("non-numeric value"))
        .when(unit.isNull() | cycle.isNull(), F.lit("missing unit or cycle"))
        .when(unit.try_cast("long").isNull() | cycle.try_cast("int").isNull(), F.lit("unit or cycle out of range"))
        .when((unit != F.floor(unit)) | (cycle != F.floor(cycle)), F.lit("non-integer unit or cycle"))
    )
    return with_tok.select(
        "dataset_id",
        "file_name",
        unit.try_cast("long").alias("unit_id"),
        cycle.try_cast("int").alias("cycle"),
        *[_nan_to_null(nums[2 + i]).alias(c) for i, c in enumerate(OP_SETTING_COLUMNS)],
        *[_nan_to_null(nums[5 + i]).alias(c) for i, c in enumerate(SENSOR_COLUMNS)],
        F.size("_tok").alias("_width"),
        problem.alias("_problem"),
        "line",
    )


def read_cycle_files(
    spark: SparkSession, paths: list[str], mode: str = "strict"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Cycle rows of many files (``dataset_id`` from each file name).

    ``mode="strict"`` raises on the first problem (one aggregate job over the
    parsed lines); ``mode="reject"`` returns ``(rows, rejects)`` lazily, with
    rejects as (dataset_id, file_name, line, problem).
    """
    if mode not in ("strict", "reject"):
        raise ValueError("mode must be 'strict' or 'reject'")
    parsed = parse_cycle_lines(_lines(spark, paths))
    if mode == "strict":
        # One aggregate pass (a row per file) decides every error; the data
        # is then read once more, with no per-file join.
        _raise_on_file_problems(parsed, paths, N_COLUMNS)
        return parsed.select("dataset_id", *CYCLE_FILE_COLUMNS)
    # A file whose widest line is narrower than 26 columns has the wrong
    # shape. One row per listed file: a bounded broadcast.
    widths = parsed.groupBy("file_name").agg(F.max("_width").alias("_file_width"))
    checked = parsed.join(F.broadcast(widths), "file_name").withColumn(
        "_problem",
        F.coalesce(
            F.col("_problem"),
            F.when(F.col("_file_width") < N_COLUMNS, F.lit("wrong column count")),
        ),
    )
    rows = checked.where(F.col("_problem").isNull()).select("dataset_id", *CYCLE_FILE_COLUMNS)
    rejects = checked.where(F.col("_problem").isNotNull()).select(
        "dataset_id", "file_name", "line", F.col("_problem").alias("problem")
    )
    return rows, rejects


def _raise_on_file_problems(parsed: DataFrame, paths: list[str], min_width: int | None) -> None:
    """Per-file line count, widest line and first problem, in one job."""
    first = F.first(
        F.when(F.col("_problem").isNotNull(), F.struct("line", "_problem")), ignorenulls=True
    )
    stats = {
        r["file_name"]: r
        for r in parsed.groupBy("file_name")
        .agg(F.max("_width").alias("w"), first.alias("p"))
        .collect()
    }
    empty = [p for p in paths if os.path.basename(p.rstrip("/")) not in stats]
    if empty:
        raise ValueError(f"No data lines in: {empty}")
    for name, r in sorted(stats.items()):
        if r["p"] is not None:
            raise ValueError(f"Unexpected content in {name}: {r['p']['_problem']} ({r['p']['line'][:80]!r})")
        if min_width is not None and r["w"] < min_width:
            raise ValueError(f"Unexpected content in {name}: wrong column count ({r['w']})")


def read_truth_files(
    spark: SparkSession, paths: list[str], mode: str = "strict"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Truth rows (dataset_id, unit_id, final_rul): unit = 1-based ordinal of
    the non-blank line in its file. ``mode`` as in :func:`read_cycle_files`;
    a rejected line keeps its ordinal, so the units after it stay in place.

    Ordinals are exact without reading a file in one task: each file block is
    read in order by one task, the rank inside a block comes from a window
    over that block only, and block offsets from a prefix sum over the
    per-block counts.
    """
    lines = _lines(spark, paths).withColumn("_seq", F.monotonically_increasing_id())
    # _seq grows along the lines of a block (one task reads a block in order);
    # it is used only to order rows inside their own block, never across.
    block = ["file_name", "part_name", "block_start"]
    in_block = lines.withColumn("_k", F.row_number().over(Window.partitionBy(*block).orderBy("_seq")))
    counts = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy("file_name")
        .orderBy("part_name", "block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(*block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = in_block.join(offsets, block)
    tokens = F.split(F.col("line"), r"\s+")
    value = F.get(tokens, 0).try_cast("double")
    problem = (
        F.when(F.size(tokens) != 1, F.lit("expected 1 column"))
        .when(value.isNull(), F.lit("non-numeric value"))
        .when(value.try_cast("int").isNull(), F.lit("value out of range"))
    )
    if mode not in ("strict", "reject"):
        raise ValueError("mode must be 'strict' or 'reject'")
    if mode == "strict":
        checks = lines.select("file_name", "line", F.lit(1).alias("_width"), problem.alias("_problem"))
        _raise_on_file_problems(checks, paths, None)
    out = ranked.select(
        "dataset_id",
        "file_name",
        "line",
        (F.col("_off") + F.col("_k")).cast("long").alias("unit_id"),
        value.alias("_v"),
        problem.alias("_problem"),
    )
    rows = out.where(F.col("_problem").isNull()).select(
        "dataset_id", "unit_id", F.col("_v").try_cast("int").alias("final_rul")
    )
    if mode == "strict":
        return rows
    rejects = out.where(F.col("_problem").isNotNull()).select(
        "dataset_id", "file_name", "unit_id", "line", F.col("_problem").alias("problem")
    )
    return rows, rejects


def load_split(
    spark: SparkSession, raw_dir: str, fd_ids: Iterable[str | int], split: str, mode: str = "strict"
):
    """All requested fleets of one split in one DataFrame."""
    ids = [normalize_fd_id(i) for i in fd_ids]
    paths = split_paths(raw_dir, ids, split)
    if split == "rul":
        return read_truth_files(spark, paths, mode)
    return read_cycle_files(spark, paths, mode)


def load_dataset(spark: SparkSession, raw_dir: str, fd_ids: Iterable[str | int]):
    """(train, test, truth) for the requested fleets, all lazy."""
    ids = list(fd_ids)
    return (
        load_split(spark, raw_dir, ids, "train"),
        load_split(spark, raw_dir, ids, "test"),
        load_split(spark, raw_dir, ids, "rul"),
    )
