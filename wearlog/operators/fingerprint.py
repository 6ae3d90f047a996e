"""Content fingerprint of a table (for run tracking), with or without its row order.

Each row is digested to a 60-bit integer (first 15 hex digits of the md5 of
its text form, in which every value follows its length, so neither a separator
inside a value nor the text of the NULL marker can be mistaken); the table digest combines the exact sum, the xor and the row
count with SHA-256. Equal tables give equal fingerprints whatever the
partitioning; any changed value or added / removed row changes it. It is one
aggregate with map-side partial sums.

With ``order_by`` the fingerprint depends on the order of rows too. A run of rows
has the value ``sum(digest_i * BASE ** i) mod PRIME`` and a length; two adjacent
runs join to ``(v1 + BASE ** n1 * v2, n1 + n2)``, which is associative, so each
range partition folds its own sorted rows to one pair and the pairs are joined in
partition order: no row gets a global number and no task sees all rows. Rows that
tie on ``order_by`` are ordered by their digests, so any partitioning gives the
same fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import require_columns

NULL_MARKER = "\\N"
PRIME = (1 << 61) - 1
BASE = 1_000_000_000_000_037


def row_digest(columns: Sequence[str]) -> Column:
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARKER)) for t in texts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def join_runs(left: tuple[int, int], right: tuple[int, int]) -> tuple[int, int]:
    """(value, length) of two adjacent runs of rows as one run."""
    return (left[0] + pow(BASE, left[1], PRIME) * right[0]) % PRIME, left[1] + right[1]


def fold_digests(digests: Sequence[int]) -> tuple[int, int]:
    """(value, length) of a run of row digests."""
    value = 0
    for d in reversed(digests):
        value = (value * BASE + d) % PRIME
    return value, len(digests)


def _fold_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = (0, 0)
    for batch in batches:
        run = join_runs(run, fold_digests(batch.column(0).to_pylist()))
    yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "value": [run[0]], "rows": [run[1]]})


def _join_partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = (0, 0)
    for batch in batches:
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            run = join_runs(run, pair)
    yield pa.RecordBatch.from_pydict({"digest_fold": [run[0]], "rows": [run[1]]})


def ordered_fingerprint(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row: ``rows``, ``digest_fold``, ``fingerprint`` of the rows in ``order_by`` order (NULLs first)."""
    require_columns(df, [*columns, *order_by])
    keys = [f"_o{i}" for i in range(len(order_by))]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(order_by, keys, strict=True)), row_digest(columns).alias("_h"))
    sorted_rows = rows.repartitionByRange(*keys, "_h").sortWithinPartitions(*keys, "_h")
    parts = sorted_rows.select("_h").mapInArrow(_fold_partition, "part long, value long, rows long")
    # an empty run beside those of the partitions: a table may have none
    empty = df.sparkSession.range(1).select(F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("value"), F.lit(0).cast("long").alias("rows"))
    parts = parts.unionByName(empty)
    # one row per partition, whatever the size of the table
    joined = parts.repartition(1).sortWithinPartitions("part").select("value", "rows").mapInArrow(_join_partitions, "digest_fold long, rows long")
    text = F.concat_ws(":", F.col("digest_fold").cast("string"), F.col("rows").cast("string"))
    return joined.select("rows", "digest_fold", F.sha2(text, 256).alias("fingerprint"))


def dataframe_fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row: ``rows``, ``digest_sum``, ``digest_xor``, ``fingerprint``; with
    ``order_by`` the row of :func:`ordered_fingerprint`.

    Digest doubles only within one engine: their text form differs between
    engines.
    """
    columns = list(df.columns if columns is None else columns)
    require_columns(df, columns)
    if order_by:
        return ordered_fingerprint(df, columns, list(order_by))
    h = row_digest(columns)
    agg = df.select(h.alias("_h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("digest_sum"),
        F.bit_xor("_h").alias("digest_xor"),
    )
    text = F.concat_ws(
        ":",
        F.coalesce(F.col("digest_sum").cast("string"), F.lit("0")),
        F.coalesce(F.col("digest_xor").cast("string"), F.lit("0")),
        F.col("rows").cast("string"),
    )
    return agg.select(
        "rows",
        F.col("digest_sum").cast("string").alias("digest_sum"),
        "digest_xor",
        F.sha2(text, 256).alias("fingerprint"),
    )


def fingerprint_value(
    df: DataFrame, columns: Sequence[str] | None = None, order_by: Sequence[str] | None = None
) -> str:
    """The hex fingerprint as a string (one small aggregate job)."""
    return dataframe_fingerprint(df, columns, order_by).first()["fingerprint"]
