"""Exact dedup by content sort.

Sampled splitters (a text's first characters and a hash of all of it, so that a
sample stays small) range-partition the normalised texts, each partition is
sorted (spilling to disk as needed), equal texts become neighbours, and full
comparisons of neighbours form the groups; the smallest id of a group stays.

A text that more than 1/4096 of all rows share (at most 4096 such texts exist)
is cut into 64 runs by a hash of the id, so no task gets a hot group whole. The
heads of its runs, at most 64 rows a text, are grouped again on the full text.

Null text counts as empty. Of rows that repeat both id and text one stays;
null ids come last in a group (a group of null ids only has a null keep_id).
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlog.session import materialize

HOT_SHARE = 4096
RUNS = 64
LEAD = 24


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    base = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    sums = base.groupBy(F.xxhash64("norm").alias("h")).agg(F.count("*").alias("n"))
    least = docs.count() / HOT_SHARE
    hot = [r.h for r in sums.where((F.col("n") > least) & (F.col("n") > 1)).select("h").collect()]
    run = F.when(F.xxhash64("norm").isin(hot), F.pmod(F.xxhash64("doc_id"), F.lit(RUNS)).cast("int")).otherwise(-1)
    # splitters are of bounded size: the first characters, then a hash of the whole text; equal texts
    # share a range, so the window needs no further exchange, and it compares the texts in full
    keyed = base.withColumns({"lead": F.substring("norm", 1, LEAD), "h": F.xxhash64("norm"), "run": run})
    sorted_runs = keyed.repartitionByRange("lead", "h", "run")
    near = Window.partitionBy("lead", "h", "run", "norm").orderBy(F.col("doc_id").asc_nulls_last())
    whole = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = materialize(
        sorted_runs.select(
            "doc_id",
            F.sha2("norm", 256).alias("text_sha256"),
            F.first("doc_id").over(whole).alias("run_keep"),
            F.count("*").over(whole).alias("run_size"),
            F.row_number().over(near).alias("place"),
            F.when((F.col("run") >= 0) & (F.row_number().over(near) == 1), F.col("norm")).alias("head"),
        ),
        "content-runs",
    )
    heads = (
        rows.where("head IS NOT NULL")
        .groupBy("head")
        .agg(F.min("run_keep").alias("keep"), F.sum("run_size").alias("size"), F.first("text_sha256").alias("text_sha256"))
        .drop("head")
    )
    keep_id = F.when(F.col("size").isNull(), F.col("run_keep")).otherwise(F.col("keep"))
    return rows.join(heads, "text_sha256", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("size", "run_size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("place") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without exact copies, all columns."""
    stay = content_groups(docs).where("kept").select(F.col("doc_id").alias("__own_id"), F.col("text_sha256").alias("__own_sha"))
    keyed = docs.withColumn("__own_key", F.sha2(normalised(F.col("text")), 256))
    return (
        keyed.join(stay, keyed["doc_id"].eqNullSafe(stay["__own_id"]) & (keyed["__own_key"] == stay["__own_sha"]), "left_semi")
        .dropDuplicates(["doc_id", "__own_key"])
        .drop("__own_key")
    )
