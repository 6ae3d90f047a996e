"""Exact top-k inner products over norm-sorted integer vectors.

Vectors are cut into bands by falling length (sampled quantiles, at most 256)
and each band into blocks of about 4,096 by a hash of the id. One pass gives the
right singular vectors (from the d x d Gram matrix, the only thing gathered).
Each query first meets the block of the longest vectors: its k-th score there is
a floor, and by Cauchy-Schwarz only bands whose longest vector times the query's
length reaches the floor can matter. Those blocks it meets in blocks of queries:
vectors by falling length, partial inner products over the leading rotated
dimensions, plus the product of the residual lengths as the bound for the rest;
only what the bound leaves is scored, exactly, in integers. Floors rise on the
way and a query stops where lengths alone fall below its floor.

Vectors null, or holding null or non-finite components, take no part, nor do
rows with a null id. Of rows that repeat an id the greatest vector (as an array)
counts. Shorter vectors are filled up with zeros. Ties go to the smaller id. A
query with fewer others than k gets them all. Components and scores must fit in
a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlog.session import materialize

BLOCK = 4096
BANDS = 256
QUERIES = 1024
STEP = 512
ENERGY = 0.8


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vec: Column, scale: int = 256) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _gram(batches, dim: int):
    total = np.zeros((dim, dim))
    for batch in batches:
        total += _gram_of(_matrix(batch.column(0), dim))
    yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["g"])


def _gram_of(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    return m.T @ m


def _matrix(col, dim: int) -> np.ndarray:
    rows = col.to_numpy(zero_copy_only=False) if isinstance(col, pa.Array) else col
    out = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def best_in_block(ids, mat, norms, qids, qmat, qnorms, floors, basis, lead: int, k: int):
    """(query index, id, score) of each query's best k in the block that reach its floor."""
    order = np.argsort(-norms, kind="stable")
    ids, mat, norms = ids[order], mat[order], norms[order]
    floors = floors.copy()
    head, qhead = mat.astype(float) @ basis[:, :lead], qmat.astype(float) @ basis[:, :lead]
    rest = np.sqrt(np.maximum(norms**2 - (head**2).sum(1), 0))
    qrest = np.sqrt(np.maximum(qnorms**2 - (qhead**2).sum(1), 0))
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qids)
    for a in range(0, len(ids), STEP):
        b = min(a + STEP, len(ids))
        slack = 1e-9 * qnorms * norms[a] + 1e-6
        live = np.flatnonzero(qnorms * norms[a] + slack >= floors)
        if not len(live):
            break
        bound = qhead[live] @ head[a:b].T + qrest[live, None] * rest[None, a:b] + slack[live, None]
        qi, pi = np.nonzero((bound >= floors[live, None]) & (ids[None, a:b] != qids[live, None]))
        if not len(qi):
            continue
        cuts = np.flatnonzero(np.diff(qi)) + 1
        for q, part in zip(live[qi[np.concatenate([[0], cuts])]], np.split(pi, cuts), strict=True):
            got = mat[a + part] @ qmat[q]
            s, v = np.concatenate([best[q][1], got]), np.concatenate([best[q][0], ids[a + part]])
            top = np.lexsort((v, -s))[:k]
            best[q] = (v[top], s[top])
            if len(top) == k:
                floors[q] = max(floors[q], float(s[top[-1]]))
    return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """vectors: (vec_id long, v array<long>); queries: ids to search for (query_id). Returns query_id, rank, vec_id, score."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    items = vectors.where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id").agg(F.max("v").alias("v")).withColumn("norm", length)
    items = materialize(items, "top-items")
    n, dim = items.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    dim = max(1, dim)
    bands = max(1, min(BANDS, -(-n // BLOCK)))
    blocks = max(1, -(-n // (bands * BLOCK)))
    marks = [1 - i / bands for i in range(bands)]
    edges = items.agg(F.percentile_approx("norm", F.array(*map(F.lit, marks)), 10000)).first()[0] or [0.0] * bands
    flat = items.select("v").mapInArrow(lambda it: _gram(it, dim), "g array<double>")
    sums = flat.select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(dim * dim)
    for r in sums:
        gram[r.i] = r.x
    power, basis = np.linalg.eigh(gram.reshape(dim, dim))
    power, basis = power[::-1], np.ascontiguousarray(basis[:, ::-1])
    lead = min(dim, 1 + int(np.searchsorted(np.cumsum(power), ENERGY * power.sum())))

    tops = F.array(*map(F.lit, edges[1:])) if bands > 1 else F.array().cast("array<double>")
    items = items.withColumn("band", F.size(F.filter(tops, lambda e: e > F.col("norm")))).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    wanted = queries.select(F.col("query_id").alias("vec_id")).where("vec_id IS NOT NULL").distinct()
    asked = items.join(wanted, "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("norm").alias("qnorm"))
    groups = max(1, -(-wanted.count() // QUERIES))
    asked = materialize(asked.withColumn("qblock", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(groups)).cast("int")), "top-queries")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            found = best_in_block(
                left.vec_id.to_numpy(), _matrix(left.v.to_numpy(), dim), left.norm.to_numpy(),
                right.query_id.to_numpy(), _matrix(right.q.to_numpy(), dim), right.qnorm.to_numpy(), right.floor.fillna(-np.inf).to_numpy(),
                basis, lead, k,
            )
            for q, (ids, scores) in zip(right.query_id.tolist(), found, strict=True):
                out["query_id"] += [q] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pd.DataFrame(out).astype("int64")

    def meet(asks: DataFrame) -> DataFrame:
        """asks: queries with band, block and floor. Vectors go to the query blocks that ask for their block."""
        keys = ["band", "block", "qblock"]
        rows = items.join(asks.select(*keys).distinct(), ["band", "block"])
        rows, asks = rows.toDF(*rows.columns), asks.toDF(*asks.columns)
        return rows.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")

    seeds = asked.withColumns({"band": F.lit(0), "block": F.lit(0), "floor": F.lit(None).cast("double")})
    first = materialize(meet(seeds), "top-first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).select("query_id", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("floor"))
    uppers = F.array(*map(F.lit, [float("inf"), *edges[1:]]))
    reach = F.size(F.filter(uppers, lambda e: F.col("floor").isNull() | (e * F.col("qnorm") * (1 + 1e-9) + 1e-6 >= F.col("floor"))))
    rest = (
        asked.join(kth, "query_id", "left").withColumn("reach", reach)
        .withColumn("band", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .where("band > 0 OR block > 0").drop("reach")
    )
    found = first.unionByName(meet(rest))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
