"""Skew-safe layout for per-unit sequential work (rolling, lag, sequences).

A plain ``Window.partitionBy(dataset_id, unit_id)`` sends every row of a unit
to one task; a unit holding a third of all rows would then be one task.

The layout is hybrid. One partial aggregate counts rows per unit; units above
``hot_rows`` rows are *hot*. Their list is at most ``rows / hot_rows`` long,
so it is broadcast. Ordinary units keep one window partition each (part 0, one
shuffle, the cheapest plan). A hot unit is cut into *parts* of at most
``width`` rows, and each part also gets a read-only *halo*: copies of the
``halo`` rows that precede it in cycle order. A window with
``rowsBetween(-halo, 0)`` evaluated per part therefore sees the same rows as
one evaluated over the whole unit; the halo rows are dropped afterwards.
Windows use ``partitionBy(*keys, PART).orderBy(cycle, PRE_POS, *ties)``; positions
and last cycles come from :func:`position` and :func:`unit_last`. ``ties`` are the
unit's other columns: rows that share a cycle are ordered by their values, so which
path lays a unit out never shows in a result.

Hot units are laid out with one of two strategies, chosen from a small
pre-aggregated *bucket index* (one row per unit and bucket of ``width`` cycle
values):

* ``dense`` - every unit has unique, gap-free cycles (the run-to-failure
  contract). Parts are cycle buckets, the halo is a cycle-value range, the
  position is ``cycle - min_cycle + 1``. One shuffle of the data.
* ``general`` - any unit has gaps or repeated cycles. Positions are computed
  exactly by :func:`with_ordinals` (range partitions split even the rows of one
  cycle), then parts are cut by position. Two shuffles of the data.

For hot units, unit-level facts (row count, first and last cycle) travel
with the index, so their rows are never joined on the unit key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CYCLE, KEYS
from ..session import materialize

PART = "_part"
HALO = "_halo"
POS = "_pos"
UNIT_ROWS = "_unit_rows"
UNIT_MIN = "_unit_min_cycle"
UNIT_MAX = "_unit_max_cycle"
_BUCKET = "_bucket"
_BUCKET_ROWS = "_bucket_rows"
_OFFSET = "_bucket_offset"
_DENSE = "_unit_dense"

PRE_POS = "_pre_pos"  # exact position, set on rows of hot units only
PRE_MAX = "_pre_last_cycle"  # last cycle of the unit, hot units only

HELPER_COLUMNS = (PART, HALO, PRE_POS, PRE_MAX)

DEFAULT_WIDTH = 4096
# A unit with more rows than this is split into parts (one window partition
# of up to a million rows is an ordinary task).
HOT_ROWS = 1 << 20


def bucket_of(order_col: str, width: int) -> Column:
    return F.floor(F.col(order_col) / F.lit(width)).cast("long")


def bucket_index(
    df: DataFrame, keys: Sequence[str] = KEYS, order_col: str = CYCLE, width: int = DEFAULT_WIDTH
) -> DataFrame:
    """One row per (unit, cycle bucket): rows, offset and unit totals.

    Built with a partial (map-side) aggregate, so a hot unit costs one small
    row per bucket, and the per-unit window afterwards runs over at most
    ``2**31 / width`` bucket rows of a unit.
    """
    keys = list(keys)
    per_bucket = df.groupBy(*keys, bucket_of(order_col, width).alias(_BUCKET)).agg(
        F.count(F.lit(1)).alias(_BUCKET_ROWS),
        F.min(order_col).alias("_lo"),
        F.max(order_col).alias("_hi"),
        # at most `width` values, so the set stays small however hot the bucket
        F.size(F.collect_set(order_col)).alias("_values"),
    )
    unit = Window.partitionBy(*keys)
    before = unit.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *keys,
        _BUCKET,
        _BUCKET_ROWS,
        F.coalesce(F.sum(_BUCKET_ROWS).over(before), F.lit(0)).alias(_OFFSET),
        F.sum(_BUCKET_ROWS).over(unit).alias(UNIT_ROWS),
        F.min("_lo").over(unit).alias(UNIT_MIN),
        F.max("_hi").over(unit).alias(UNIT_MAX),
        # cycle arithmetic gives positions only where cycles have neither gaps nor repeats
        (
            (F.sum(_BUCKET_ROWS).over(unit) == F.max("_hi").over(unit) - F.min("_lo").over(unit) + 1)
            & (F.sum(_BUCKET_ROWS).over(unit) == F.sum("_values").over(unit))
        ).alias(_DENSE),
    )


def all_units_dense(index: DataFrame) -> bool:
    """One scalar job over the bucket index (never over the data rows)."""
    return index.where(~F.col(_DENSE)).limit(1).count() == 0


def hot_units(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (partial aggregate). At most
    ``total rows / hot_rows`` keys qualify, which bounds a broadcast of it."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else df.agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.where(F.col("_n") > hot_rows).select(*keys)


def tie_columns(df: DataFrame, keys: Sequence[str], order_col: str, first: Sequence[str] = ()) -> list[str]:
    """The columns that order rows of one unit and cycle: ``first``, then all others that Spark can sort by."""
    sortable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    rest = [c for c in sortable if c not in (*keys, order_col, *first, *HELPER_COLUMNS)]
    return [*first, *rest]


def with_ordinals(
    df: DataFrame, order_cols: Sequence[str], keys: Sequence[str] = (), out: str = "_ordinal"
) -> DataFrame:
    """Exact 0-based ordinals in ``order_cols`` order (per key), whatever one key or one
    order value holds.

    Rows are dealt out by ranges of (key, order) and written once; a row's place in
    its partition comes with the write, and the rows of its key in earlier
    partitions are a prefix sum over one row per key and partition. Only rows equal
    in all these columns must share a partition, and those are interchangeable.
    """
    keys, by = list(keys), [*keys, *order_cols]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return table_ordinals(dealt, out, keys)


def table_ordinals(df: DataFrame, out: str = "_ordinal", keys: Sequence[str] = ()) -> DataFrame:
    """Exact 0-based ordinals in the order the table has (per key, whose rows must lie together)."""
    keys = list(keys)
    rows = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "ordinals")
    rows = rows.withColumn("_run", F.shiftright("_at", 33))
    runs = rows.groupBy(*keys, "_run").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_run", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(runs, [*keys, "_run"])
    return placed.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_from")).alias(out))


def unit_layout(
    df: DataFrame,
    halo: int,
    keys: Sequence[str] = KEYS,
    order_col: str = CYCLE,
    width: int = DEFAULT_WIDTH,
    strategy: str = "auto",
    hot_rows: int | None = HOT_ROWS,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` plus ``_part``, ``_halo`` and the hot-unit helpers.

    ``halo`` is how many preceding rows a part must see (``max window - 1``,
    ``max lag`` or ``sequence length - 1``). Rows with ``_halo`` true are
    copies that only feed windows; callers drop them with :func:`own_rows`.

    ``strategy``: ``auto`` (hybrid, see module doc), ``chunked`` (every unit
    split, dense/general chosen from the index), ``dense`` or ``general``
    (every unit split with that method; for tests and known layouts).
    ``hot_rows=None`` skips the hot-unit count job: for callers that know
    every unit is small (one window partition per unit, no check).
    ``ties`` order rows of one cycle (:func:`tie_columns` if not given); windows
    over the result must use the same.
    """
    keys = list(keys)
    ties = tie_columns(df, keys, order_col) if ties is None else list(ties)
    if halo < 0:
        raise ValueError("halo must be >= 0")
    if width <= halo:
        raise ValueError("width must exceed the halo")
    if strategy not in ("auto", "chunked", "dense", "general"):
        raise ValueError("strategy must be 'auto', 'chunked', 'dense' or 'general'")
    # Null keys or cycles cannot be placed in cycle order (the reference fails
    # on them as well); they are left out of the sequential layout.
    df = df.where(F.col(order_col).isNotNull())
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    cols = df.columns
    if strategy != "auto":
        return _chunked(df, halo, keys, order_col, width, strategy, ties)
    normal = df.select(
        *cols,
        F.lit(0).cast("long").alias(PART),
        F.lit(False).alias(HALO),
        F.lit(None).cast("long").alias(PRE_POS),
        F.lit(None).cast(df.schema[order_col].dataType).alias(PRE_MAX),
    )
    if hot_rows is None:
        return normal
    hot = hot_units(df, keys, hot_rows)
    if hot.limit(1).count() == 0:  # one aggregate job; the usual outcome
        return normal
    normal = normal.join(hot, keys, "left_anti")
    split = _chunked(df.join(hot, keys, "left_semi"), halo, keys, order_col, width, "chunked", ties)
    return normal.unionByName(split)


def _chunked(df, halo, keys, order_col, width, strategy, ties):
    index = bucket_index(df, keys, order_col, width)
    if strategy == "chunked":
        strategy = "dense" if all_units_dense(index) else "general"
    if strategy == "dense":
        laid = _dense_layout(df, index, halo, keys, order_col, width)
    else:
        laid = _general_layout(df, index, halo, keys, order_col, width, ties)
    return laid.select(*df.columns, PART, HALO, F.col(POS).alias(PRE_POS), F.col(UNIT_MAX).alias(PRE_MAX))


def targets(bucket: Column, in_tail: Column) -> Column:
    own = F.struct(bucket.alias("p"), F.lit(False).alias("h"))
    nxt = F.struct((bucket + 1).alias("p"), F.lit(True).alias("h"))
    return F.when(in_tail, F.array(own, nxt)).otherwise(F.array(own))


def _dense_layout(df, index, halo, keys, order_col, width):
    bucket = bucket_of(order_col, width)
    # The last `halo` cycle values of a bucket are also copied to the next one.
    in_tail = F.col(order_col) >= (bucket + 1) * width - halo if halo else F.lit(False)
    placed = df.select(*df.columns, F.explode(targets(bucket, in_tail)).alias("_t")).select(
        *df.columns, F.col("_t.p").alias(_BUCKET), F.col("_t.h").alias(HALO)
    )
    idx = index.select(*keys, _BUCKET, UNIT_ROWS, UNIT_MIN, UNIT_MAX)
    # Inner join: a copy aimed at a bucket the unit does not have is dropped.
    out = placed.join(idx, [*keys, _BUCKET], "inner")
    return out.withColumnRenamed(_BUCKET, PART).withColumn(
        POS, (F.col(order_col) - F.col(UNIT_MIN) + 1).cast("long")
    )


def _general_layout(df, index, halo, keys, order_col, width, ties):
    facts = index.select(*keys, UNIT_ROWS, UNIT_MIN, UNIT_MAX).distinct()
    placed = with_ordinals(df, [order_col, *ties], keys, POS).withColumn(POS, F.col(POS) + 1)
    positioned = placed.join(facts, keys)
    part = F.floor((F.col(POS) - 1) / F.lit(width)).cast("long")
    in_tail = ((F.col(POS) - 1) % width) >= (width - halo) if halo else F.lit(False)
    cols = positioned.columns
    return positioned.select(*cols, F.explode(targets(part, in_tail)).alias("_t")).select(
        *cols, F.col("_t.p").alias(PART), F.col("_t.h").alias(HALO)
    )


def part_window(keys: Sequence[str] = KEYS, order_col: str = CYCLE, ties: Sequence[str] = ()) -> Window:
    """Window spec for sequential work on a :func:`unit_layout` frame."""
    return Window.partitionBy(*keys, PART).orderBy(order_col, PRE_POS, *ties)


def position(keys: Sequence[str] = KEYS, order_col: str = CYCLE, ties: Sequence[str] = ()) -> Column:
    """1-based position of a row in its unit's cycle order."""
    return F.coalesce(F.col(PRE_POS), F.row_number().over(part_window(keys, order_col, ties)).cast("long"))


def unit_last(keys: Sequence[str] = KEYS, order_col: str = CYCLE, ties: Sequence[str] = ()) -> Column:
    """Last cycle of the row's unit. Uses the same partitioning and order as
    the feature windows (full frame), so it shares their Window node and
    sort instead of adding one."""
    whole = part_window(keys, order_col, ties).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.col(PRE_MAX), F.max(order_col).over(whole))


def own_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop halo copies and the layout's helper columns (except ``keep``)."""
    drop = [c for c in HELPER_COLUMNS if c not in keep and c in df.columns]
    return df.where(~F.col(HALO)).drop(*drop)


def unit_stats(
    df: DataFrame, keys: Sequence[str] = KEYS, order_col: str = CYCLE
) -> DataFrame:
    """Per-unit row count and first/last cycle (partial aggregate)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(order_col).alias("first_cycle"),
        F.max(order_col).alias("last_cycle"),
    )


def row_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    coarse: Column,
    fine: Column,
    out: str = "_ordinal",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact 1-based ``row_number()`` per key in ``order_cols`` order, skew-safe.

    Keys with at most ``hot_rows`` rows use a plain ranked window. Hot keys
    (a broadcast list bounded by ``rows / hot_rows``) are ranked without one
    task holding the key: ``coarse`` and ``fine`` must be non-decreasing in
    ``order_cols`` (for example the day of a timestamp and a high-order slice
    of a tie-breaker id); offsets come from a two-level prefix sum over
    per-bucket counts, so no window spans more than one key's coarse buckets
    or one coarse bucket's fine buckets, and the final ``row_number`` runs per
    fine bucket.
    """
    keys = list(keys)
    plain = df.withColumn(
        out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)).cast("long")
    )
    hot = hot_units(df, keys, hot_rows)
    if hot.limit(1).count() == 0:
        return plain
    if not keys:
        return _bucketed_ordinal(df, keys, order_cols, coarse, fine, out)
    hot_b = F.broadcast(hot)
    normal = df.join(hot_b, keys, "left_anti").withColumn(
        out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)).cast("long")
    )
    split = _bucketed_ordinal(df.join(hot_b, keys, "left_semi"), keys, order_cols, coarse, fine, out)
    return normal.unionByName(split)


def _bucketed_ordinal(df, keys, order_cols, coarse, fine, out):
    with_b = df.select("*", coarse.alias("_cb"), fine.alias("_fb"))
    counts = with_b.groupBy(*keys, "_cb", "_fb").agg(F.count(F.lit(1)).alias("_n"))
    coarse_tot = counts.groupBy(*keys, "_cb").agg(F.sum("_n").alias("_cn"))
    before_c = Window.partitionBy(*keys).orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    coarse_off = coarse_tot.select(
        *keys, "_cb", F.coalesce(F.sum("_cn").over(before_c), F.lit(0)).alias("_coff")
    )
    before_f = Window.partitionBy(*keys, "_cb").orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    fine_off = counts.select(
        *keys, "_cb", "_fb", F.coalesce(F.sum("_n").over(before_f), F.lit(0)).alias("_foff")
    )
    offsets = fine_off.join(coarse_off, [*keys, "_cb"]).select(
        *keys, "_cb", "_fb", (F.col("_coff") + F.col("_foff")).alias("_off")
    )
    located = with_b.join(offsets, [*keys, "_cb", "_fb"])
    w = Window.partitionBy(*keys, "_cb", "_fb").orderBy(*order_cols)
    return located.withColumn(out, (F.col("_off") + F.row_number().over(w)).cast("long")).drop(
        "_cb", "_fb", "_off"
    )
