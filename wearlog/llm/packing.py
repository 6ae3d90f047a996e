"""Packing token sequences by bounded-space online best fit.

Each task tokenizes its whole texts, cuts documents over the capacity into
pieces, and puts each piece into the open bin with the least free space that
holds it. The open bins are keyed by free space in a bitset (an int whose bit f
says that a bin with f free places is open). A task has at most ``OPEN`` open
bins: to open one more, the fullest closes. What a task still has open at its
end, at most ``OPEN`` bins, is packed once more in a few tasks, longest first,
so many small input partitions waste no space.

Tasks read splits of the input as they come: no shuffle, and a task that is run
again gives the same rows. Null text is empty: its document is the end id alone.
Null or repeated ids are documents of their own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.tokens import encode_column
from wearlog.session import materialize, small_batches

CAPACITY = 4096
OPEN = 1024
SECOND = 1 << 62
ROWS = 4096

FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
PLACE = [("sequence_id", pa.int64()), ("offset", pa.int64()), ("closed", pa.bool_())]


class Bins:
    """Open bins in a bitset keyed by free space; ``put`` and ``rest`` yield the bins that close."""

    def __init__(self, capacity: int, most: int, first_id: int):
        self.capacity, self.most, self.next = capacity, most, first_id
        self.bits, self.open, self.by_free = 0, 0, defaultdict(list)

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        got = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return got

    def put(self, length: int, row: tuple) -> Iterator[list]:
        above = self.bits >> length
        if above:
            free = length + (above & -above).bit_length() - 1
            got = self._take(free)
        else:
            if self.open >= self.most:
                yield self._take((self.bits & -self.bits).bit_length() - 1)
            free, got = self.capacity, [self.next]
            self.next += 1
        got.append((row, self.capacity - free))
        free -= length
        if not free:
            yield got
            return
        self.by_free[free].append(got)
        self.bits |= 1 << free
        self.open += 1

    def rest(self) -> Iterator[list]:
        while self.bits:
            yield self._take((self.bits & -self.bits).bit_length() - 1)


def _batches(bins: Iterator[tuple[list, bool]], fields: list) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(fields + PLACE)
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for got, closed in bins:
        rows += [(*row, got[0], at, closed) for row, at in got[1:]]
        if len(rows) >= ROWS:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def _packed(pieces: Iterator[tuple], capacity: int, most: int, first_id: int, last: bool) -> Iterator[tuple[list, bool]]:
    bins = Bins(capacity, most, first_id)
    for row in pieces:
        for got in bins.put(row[3], row):
            yield got, True
    for got in bins.rest():
        yield got, last


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, most: int = OPEN, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the piece's ids if asked for."""
    fields = FIELDS + ([("ids", pa.list_(pa.int32()))] if with_ids else [])

    def pieces(batches):
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, end, ids, at in encode_column(batch.column(1), path, end_id):
                wide = ids.astype("<u4")
                for i, a, b in zip(doc_ids[first:end], at[:-1].tolist(), at[1:].tolist(), strict=True):
                    for k, s in enumerate(range(a, b, capacity)):
                        part = wide[s : min(s + capacity, b)]
                        yield (i, k, s - a, len(part), zlib.crc32(part), *([part.astype(np.int32)] if with_ids else []))

    def first_pass(batches):
        yield from _batches(_packed(pieces(batches), capacity, most, TaskContext.get().partitionId() << 32, False), fields)

    def second_pass(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches(_packed(rows, capacity, most, SECOND | TaskContext.get().partitionId() << 32, True), fields)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    place = ", sequence_id long, `offset` long, closed boolean"
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = materialize(slim.mapInArrow(first_pass, ddl + place), "packed")
    left = done.where("NOT closed").select(*[n for n, _ in fields])
    parts = max(1, -(-left.count() // 200_000))
    again = left.coalesce(parts).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").mapInArrow(second_pass, ddl + place)
    return done.where("closed").unionByName(again).drop("closed")
