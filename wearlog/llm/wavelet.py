"""Token ids as wavelet matrices, one compressed file per shard.

A shard is a run of whole documents in ascending id order. Its ids are stored
as bit-planes from the highest bit down; below each plane the ids are parted
stably, zeros first. A plane is cut into blocks of 65,536 bits, each compressed
on its own, and a directory has the ones before each block. So one file answers
token access, counts and occurrences (rank and select) by reading a few blocks
a plane, and gives all its ids by undoing the partings plane by plane.

File: b"WMX1", header length (uint32), JSON header, then the sections that the
header names by position: document ids, document bounds, and per plane the
directory, the block positions and the blocks (all little-endian).

Null text is encoded as the empty text (the end id alone). Null ids come first
and are stored with a flag; repeated ids are documents of their own, ordered by
a hash of their texts.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlog.llm.files import new_name, open_file, own_folder, write_file
from wearlog.llm.tokens import encode_column
from wearlog.session import materialize

MAGIC = b"WMX1"
BLOCK = 1 << 16
SHARD_TOKENS = 1 << 22
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def write_shard(ids: np.ndarray, doc_ids: list[int | None], bounds: np.ndarray) -> bytes:
    """The file's bytes for the ids of documents bounded by ``bounds`` (n + 1 positions)."""
    out, pack = io.BytesIO(), zstandard.ZstdCompressor(level=1)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    head: dict = {"n": len(ids), "docs": len(doc_ids), "bits": bits, "block": BLOCK, "planes": []}

    def put(data: bytes) -> list[int]:
        at = out.tell()
        out.write(data)
        return [at, len(data)]

    head["null_ids"] = sum(d is None for d in doc_ids)
    head["doc_ids"] = put(pack.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes()))
    head["bounds"] = put(pack.compress(np.asarray(bounds, "<i8").tobytes()))
    seq = ids
    for b in range(bits - 1, -1, -1):
        one = (seq >> np.array(b, seq.dtype)) & np.array(1, seq.dtype) != 0
        packed = np.packbits(one, bitorder="little")
        step = BLOCK // 8
        ones = np.add.reduceat(_ONES[packed].astype(np.int64), np.arange(0, len(packed), step)) if len(packed) else np.zeros(0, np.int64)
        blocks = [pack.compress(packed[i : i + step].tobytes()) for i in range(0, len(packed), step)]
        ends = np.cumsum([0] + [len(x) for x in blocks], dtype=np.int64)
        head["planes"].append({
            "zeros": int(len(seq) - ones.sum()),
            "ranks": put(np.concatenate([[0], np.cumsum(ones)]).astype("<i8").tobytes()),
            "ends": put(ends.astype("<i8").tobytes()),
            "blocks": put(b"".join(blocks)),
        })
        seq = np.concatenate([seq[~one], seq[one]])
    text = json.dumps(head).encode()
    return MAGIC + struct.pack("<I", len(text)) + text + out.getvalue()


class Shard:
    """Queries on one file; ``source`` is an open file (``seek`` and ``read``)."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        start = source.read(8)
        if start[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack("<I", start[4:])
        self.head = json.loads(source.read(size))
        self.base = 8 + size
        self.n, self.bits = self.head["n"], self.head["bits"]
        self._ranks = [np.frombuffer(self._read(p["ranks"]), "<i8") for p in self.head["planes"]]
        self._ends = [np.frombuffer(self._read(p["ends"]), "<i8") for p in self.head["planes"]]
        self._block = lru_cache(maxsize=64)(self._load)

    def _read(self, section: list[int], at: int = 0, size: int | None = None) -> bytes:
        self.source.seek(self.base + section[0] + at)
        return self.source.read(section[1] if size is None else size)

    def _load(self, plane: int, block: int) -> np.ndarray:
        a, b = self._ends[plane][block : block + 2].tolist()
        raw = self._read(self.head["planes"][plane]["blocks"], a, b - a)
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=BLOCK // 8), np.uint8)

    def doc_ids(self) -> list[int | None]:
        raw = zstandard.ZstdDecompressor().decompress(self._read(self.head["doc_ids"]), max_output_size=8 * self.head["docs"] + 1)
        nulls = self.head["null_ids"]
        return [None] * nulls + np.frombuffer(raw, "<i8")[nulls:].tolist()

    def bounds(self) -> np.ndarray:
        raw = zstandard.ZstdDecompressor().decompress(self._read(self.head["bounds"]), max_output_size=8 * self.head["docs"] + 9)
        return np.frombuffer(raw, "<i8")

    def _bit(self, plane: int, i: int) -> int:
        return int(self._block(plane, i // BLOCK)[i % BLOCK // 8] >> (i % 8)) & 1

    def _rank(self, plane: int, i: int) -> int:
        """Ones before position i."""
        before = int(self._ranks[plane][i // BLOCK])
        if i % BLOCK:
            bits = np.unpackbits(self._block(plane, i // BLOCK), count=i % BLOCK, bitorder="little")
            before += int(bits.sum())
        return before

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) zero or one."""
        ranks = self._ranks[plane]
        seen = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = min(int(np.searchsorted(seen, k, side="right")) - 1, len(ranks) - 2)
        bits = np.unpackbits(self._block(plane, block), bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(seen[block])])

    def _down(self, plane: int, bit: int, i: int) -> int:
        ones = self._rank(plane, i)
        return self.head["planes"][plane]["zeros"] + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for plane in range(self.bits):
            bit = self._bit(plane, i)
            value, i = value << 1 | bit, self._down(plane, bit, i)
        return value

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            bit = token >> (self.bits - 1 - plane) & 1
            a, b = self._down(plane, bit, a), self._down(plane, bit, b)
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """How often the token occurs in positions a to b - 1."""
        low, high = self._range(token, a, self.n if b is None else b)
        return high - low

    def occurrences(self, token: int, a: int = 0, b: int | None = None) -> Iterator[int]:
        """The token's positions from a to b - 1, ascending."""
        low, high = self._range(token, a, self.n if b is None else b)
        for i in range(low, high):
            for plane in range(self.bits - 1, -1, -1):
                bit = token >> (self.bits - 1 - plane) & 1
                i = self._select(plane, bit, i - self.head["planes"][plane]["zeros"] if bit else i)
            yield i

    def ids(self) -> np.ndarray:
        """All ids in order."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for plane in range(self.bits - 1, -1, -1):
            blocks = len(self._ranks[plane]) - 1
            packed = np.concatenate([self._load(plane, b) for b in range(blocks)]) if blocks else np.zeros(0, np.uint8)
            one = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            zeros = self.head["planes"][plane]["zeros"]
            above = np.empty_like(seq)
            above[~one] = seq[:zeros]
            above[one] = seq[zeros:] | kind(1 << (self.bits - 1 - plane))
            seq = above
        return seq


def write_shards(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes all documents' ids; returns one row per file, in order: path, base (ids in earlier files), n, docs."""
    spark = docs.sparkSession
    folder = folder or own_folder(spark, "wavelet")

    def shards(batches):
        part, k = TaskContext.get().partitionId(), 0
        held, sizes, names, total = [], [], [], 0

        def flush():
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            name = new_name(folder, f"shard-{part:06d}-{k:06d}", "wmx")
            write_file(name, write_shard(np.concatenate(held), names, bounds))
            return pa.RecordBatch.from_pydict({"part": [part], "k": [k], "path": [name], "n": [int(bounds[-1])], "docs": [len(names)]})

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, end, ids, at in encode_column(batch.column(1), path, end_id):
                held.append(ids)
                sizes.append(np.diff(at))
                names += doc_ids[first:end]
                total += len(ids)
                if total >= shard_tokens:
                    yield flush()
                    held, sizes, names, total, k = [], [], [], 0, k + 1
        if names:
            yield flush()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    made = materialize(ordered.mapInArrow(shards, "part long, k long, path string, n long, docs long"), "wavelet-files")
    before = Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    return made.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), "n", "docs")


def read_shards(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, read back from the bit-planes."""
    spark: SparkSession = files.sparkSession
    files = materialize(files, "wavelet-order")

    def documents(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_file(path) as source:
                    shard = Shard(source)
                    ids, at, names = shard.ids().astype("<u4"), shard.bounds(), shard.doc_ids()
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(at[:-1] + base, pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = max(1, min(files.count(), 8 * spark.sparkContext.defaultParallelism))
    return files.select("path", "base").repartition(spread).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
