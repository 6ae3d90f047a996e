"""Exact quantiles (linear interpolation) without one task holding a group.

``F.percentile`` keeps one count per distinct value of a group in a single
task. Here values are first counted per (group, value) - a partial
aggregate. A group with at most ``max_distinct`` distinct values (the usual
case for quantised sensor readings) then uses ``percentile`` with the counts
as frequencies, so its state is bounded by ``max_distinct``. Larger groups:

1. each distinct value gets a monotone bucket key (sign and binary exponent,
   then the top 20 mantissa bits), and bucket counts get two-level prefix
   sums (per group over exponents, per exponent over mantissa buckets);
2. the target ranks (two per probability and group: a tiny table, broadcast)
   find their bucket with a broadcast join on the group plus a range check;
3. only the few target buckets are ranked value by value.

The result equals ``percentile`` / ``quantile_cont``: value at rank
``p * (n - 1)`` interpolated linearly between its neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MANTISSA_BITS = 20
MAX_DISTINCT = 1 << 20


def _bucket_keys(v: Column) -> tuple[Column, Column]:
    """(k1, k2), lexicographically non-decreasing in ``v``."""
    a = F.abs(v)
    finite = ~F.isnan(a) & (a != F.lit(float("inf")))
    e = F.floor(F.log2(a))
    k1 = (
        F.when(v == 0, F.lit(0))
        .when(~finite & (v > 0), F.lit(5000))
        .when(~finite, F.lit(-5000))
        .when(v > 0, 2000 + e)
        .otherwise(-(2000 + e))
    ).cast("long")
    m = F.floor(a / F.pow(F.lit(2.0), e) * (1 << MANTISSA_BITS))
    k2 = F.when((v == 0) | ~finite, F.lit(0)).when(v > 0, m).otherwise(-m).cast("long")
    return k1, k2


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    max_distinct: int = MAX_DISTINCT,
) -> DataFrame:
    """One row per group: ``group_cols`` + ``q_<i>`` for each probability
    (NULL values ignored; a group with no value gives no row)."""
    g = list(group_cols)
    probs = [float(p) for p in probs]
    if any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must be in [0, 1]")
    vals = df.select(*g, F.col(value_col).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    counts = vals.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    distinct = counts.groupBy(*g).agg(F.count(F.lit(1)).alias("_d")) if g else counts.agg(
        F.count(F.lit(1)).alias("_d")
    )
    big = distinct.where(F.col("_d") > max_distinct).select(*g)
    if big.limit(1).count() == 0:  # one small job over the per-group counts
        return _weighted_percentile(counts, g, probs)
    if not g:
        return _bucketed(counts, g, probs)
    # At most distinct values / max_distinct groups are large: a bounded list.
    big_b = F.broadcast(big)
    small = _weighted_percentile(counts.join(big_b, g, "left_anti"), g, probs)
    return small.unionByName(_bucketed(counts.join(big_b, g, "left_semi"), g, probs))


def _weighted_percentile(counts: DataFrame, g: list[str], probs: list[float]) -> DataFrame:
    q = F.percentile(F.col("_v"), probs, F.col("_c")).alias("_q")
    agg = counts.groupBy(*g).agg(q) if g else counts.agg(q)
    return agg.select(*g, *[F.col("_q")[i].alias(f"q_{i}") for i in range(len(probs))])


def _bucketed(counts: DataFrame, g: list[str], probs: list[float]) -> DataFrame:
    k1, k2 = _bucket_keys(F.col("_v"))
    keyed = counts.select(*g, "_v", "_c", k1.alias("_k1"), k2.alias("_k2"))
    buckets = keyed.groupBy(*g, "_k1", "_k2").agg(F.sum("_c").alias("_bn"))
    coarse = buckets.groupBy(*g, "_k1").agg(F.sum("_bn").alias("_cn"))
    before1 = Window.partitionBy(*g).orderBy("_k1").rowsBetween(Window.unboundedPreceding, -1)
    coarse_off = coarse.select(*g, "_k1", F.coalesce(F.sum("_cn").over(before1), F.lit(0)).alias("_o1"))
    before2 = Window.partitionBy(*g, "_k1").orderBy("_k2").rowsBetween(Window.unboundedPreceding, -1)
    fine = buckets.select(*g, "_k1", "_k2", "_bn", F.coalesce(F.sum("_bn").over(before2), F.lit(0)).alias("_o2"))
    spans = fine.join(coarse_off, [*g, "_k1"]).select(
        *g, "_k1", "_k2", (F.col("_o1") + F.col("_o2")).alias("_start"), "_bn"
    )
    totals = coarse.groupBy(*g).agg(F.sum("_cn").alias("_n"))
    # Two target ranks per probability (0-based, floor and ceil of p*(n-1)).
    targets = totals.select(
        *g,
        "_n",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("pi"), F.lit(p).alias("p"), F.lit(side).alias("side"))
                    for i, p in enumerate(probs)
                    for side in (0, 1)
                ]
            )
        ).alias("_t"),
    ).select(
        *g,
        F.col("_t.pi").alias("_pi"),
        F.col("_t.side").alias("_side"),
        (F.col("_t.p") * (F.col("_n") - 1)).alias("_pos"),
    ).withColumn(
        "_rank", F.when(F.col("_side") == 0, F.floor("_pos")).otherwise(F.ceil("_pos")).cast("long")
    )
    # Only groups with more than max_distinct distinct values get here, so
    # the target table has at most 2 * len(probs) * distinct / max_distinct rows.
    tb = F.broadcast(targets)
    cond = [spans[c] == tb[c] for c in g] + [
        tb["_rank"] >= spans["_start"],
        tb["_rank"] < spans["_start"] + spans["_bn"],
    ]
    hit = spans.join(tb, cond).select(
        *[spans[c] for c in g], "_k1", "_k2", "_start", "_pi", "_side", "_pos", "_rank"
    )
    in_bucket = keyed.join(F.broadcast(hit.select(*g, "_k1", "_k2").distinct()), [*g, "_k1", "_k2"])
    w = Window.partitionBy(*g, "_k1", "_k2").orderBy("_v")
    ranked = in_bucket.select(
        *g,
        "_k1",
        "_k2",
        "_v",
        (F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_below"),
        "_c",
    )
    picked = ranked.join(hit, [*g, "_k1", "_k2"]).where(
        (F.col("_rank") - F.col("_start") >= F.col("_below"))
        & (F.col("_rank") - F.col("_start") < F.col("_below") + F.col("_c"))
    )
    per_p = picked.groupBy(*g, "_pi").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_hi"),
        F.first("_pos").alias("_pos"),
    )
    q = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))
    wide = per_p.groupBy(*g).pivot("_pi", list(range(len(probs)))).agg(F.first(q))
    return wide.select(*g, *[F.col(str(i)).alias(f"q_{i}") for i in range(len(probs))])
