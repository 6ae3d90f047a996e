"""Connected components of a link table: few links in one Arrow task, more as joins and minima."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.session import discard, materialize

TURNS = 64
#: Rows (of two ids, so 16 MB) up to which links are one task, not some five jobs a turn: the driver keeps a thread for each exchange and broadcast of the last minute, and the plans.
TOGETHER = 1 << 20


def together(df: DataFrame, few: bool) -> DataFrame:
    """``df`` as one partition if it has ``few`` rows: what follows needs no exchange."""
    return df.coalesce(1) if few else df


COMPONENT_ROWS = "id long, component long"


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (u, v), ascending, and the least node reachable from each."""
    ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    least = np.arange(len(ids))
    while True:
        ra, rb = least[a], least[b]
        low = np.minimum(ra, rb)
        if (ra == rb).all():
            return ids, ids[least]
        # each root that sees a lesser one goes below it, then every node below its root
        np.minimum.at(least, ra, low)
        np.minimum.at(least, rb, low)
        while (least != (up := least[least])).any():
            least = up


def _one_task(links: DataFrame) -> DataFrame:
    """The components of at most ``TOGETHER`` links (u, v) without nulls, in one task: one job, nothing sent to the driver."""

    def found(batches):
        cols = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if cols:
            out = least_reachable(*(np.concatenate(c) for c in zip(*cols, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["id", "component"])

    return links.select(F.col("u").cast("long"), F.col("v").cast("long")).coalesce(1).mapInArrow(found, COMPONENT_ROWS)


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one least neighbour, which has none itself (stars: the end of the turns)."""
    up, down = F.lit(1).alias("up"), F.lit(0).alias("up")
    ends = edges.select(F.col("u").alias("x"), up).unionByName(edges.select(F.col("v").alias("x"), down))
    ups = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ups.where("ups > 1 OR ups = 1 AND least = 0").count() == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in a link; component is the smallest id reachable. Ids are longs.

    At most ``TOGETHER`` links go through one task. More: large and small stars in turn
    (each node points its larger neighbours, then its smaller ones, at the least id it
    sees) until there are only stars: a number of turns about the logarithm of a
    component's size. Each turn is written to the shared folder, and the one before it
    deleted, as is all but the result. Null ends and links of an id with itself count
    for nothing.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = materialize(links.where(f"`{a}` <> `{b}`").select(high, low).distinct(), "links")
    if edges.count() <= TOGETHER:
        out = materialize(_one_task(edges), "components")
        discard(edges)
        return out
    for _ in range(TURNS):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, materialize(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    ends = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    out = materialize(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(ends), "components")
    discard(edges)
    return out


def joined_further(known: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``known``, a table of :func:`components`, after further links; without one that
    joins two of its components or has a node that is new, ``known`` itself. At most
    ``TOGETHER`` rows of both are one task; of more, only the known components that a
    link joins, each as one node, go through the turns."""
    label = lambda x: known.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
    own = links.select(F.col(a).alias("a"), F.col(b).alias("b")).join(label("a"), "a", "left").join(label("b"), "b", "left")
    own = own.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    own = materialize(own.distinct(), "links")
    n = own.count()
    if not n:
        discard(own)
        return known
    if n + known.count() <= TOGETHER:
        rows = known.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(own.select(F.col("a").alias("u"), F.col("b").alias("v")))
        out = materialize(_one_task(rows), "components")
        discard(own)
        return out
    roots = components(own)
    to = roots.select(F.col("id").alias("component"), F.col("component").alias("root"))
    moved = known.join(to, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
    fresh = roots.join(known, "id", "left_anti")
    out = materialize(moved.unionByName(fresh.select("id", "component")), "components")
    discard(own, roots)
    return out
