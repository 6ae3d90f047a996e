"""Ranked lexical search: short lists term at a time, long lists document at a time.

``build_index`` cuts the documents into shards of whole texts and writes one file
of inverted lists a shard to the shared folder; no text is shuffled. ``search``
adds up the documents with terms, all terms and each query term's documents over
all shards, then gives every shard to a task with a block of items. There an
item's short lists are summed into accumulators first, which from then on act as
one list with its own bounds; the long lists are followed in document order, by
blocks of ``BLOCK`` documents with their greatest impacts. A block, and then a
document in it, is skipped when the accumulators' and the lists' bounds cannot
reach the item's k-th score so far, which the accumulators' sums raise from the
start and a task keeps from shard to shard. Nothing that could tie is skipped, so
results are exact. Each task returns k rows an item.

Terms are runs of ASCII digits and letters (A-Z lower-cased) and of all characters
beyond ASCII. Weights and impacts are integers: w = floor(1000 ln((2N + 2) /
(2df + 1))), impact = 10^9 tf div (1000 tf + 8m), m = 25 + 75nN div L. Terms are
64-bit hashes: with 10^4 query terms and 10^9 terms in the corpus one would be
mistaken with a chance of about 10^-6.

Null and empty texts have no terms. Rows are documents: rows that repeat an id
count, and rank, each on its own; rows without id count but are not returned. Of
items that repeat an id the least text is taken, items without id are left out.
An item without a scoring document has no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlog.llm.files import locate, new_name, open_file, own_folder, write_file
from wearlog.llm.words import LOWER, chunks, hash_spans, spans
from wearlog.session import materialize

MAGIC = b"LEX1"
#: A shard ends at so many bytes of text or documents.
SHARD_BYTES, SHARD_DOCS = 16 << 20, 1 << 16
#: Documents to a block of bounds.
BLOCK = 64
#: A list with a document in every so many, or more, is long.
LONG = 16
#: (item, term) rows to a block of items: about 8 MB in a task.
ITEM_ROWS = 1 << 18
GAPS = np.ones(256, bool)
GAPS[48:58] = GAPS[65:91] = GAPS[97:123] = GAPS[128:] = False

_SECTIONS = {"ids": "<i8", "no_id": "u1", "sizes": "<i8", "terms": "<u8", "ends": "<i8", "docs": "<u4", "tfs": "<u4"}


def counted_terms(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, documents and frequencies, ascending by term, then document; and each document's number of terms."""
    data = LOWER[raw]
    starts, lens = spans(data, bounds, GAPS)
    terms = hash_spans(data, starts, lens)
    sizes = np.diff(np.searchsorted(starts, bounds))
    docs = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(terms, kind="stable")
    terms, docs = terms[order], docs[order]
    fresh = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])])) if len(terms) else np.zeros(0, np.int64)
    return terms[fresh], docs[fresh], np.diff(np.append(fresh, len(terms))), sizes


class _Builder:
    def __init__(self):
        self.parts, self.ids, self.sizes, self.docs, self.bytes = [], [], [], 0, 0

    def add(self, ids: list, raw: np.ndarray, bounds: np.ndarray) -> None:
        terms, docs, tfs, sizes = counted_terms(raw, bounds)
        self.parts.append((terms, docs + self.docs, tfs))
        self.ids += ids
        self.sizes.append(sizes)
        self.docs += len(sizes)
        self.bytes += len(raw)

    def file(self) -> bytes:
        terms, docs, tfs = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
        cols = {
            "ids": np.array([i or 0 for i in self.ids]), "no_id": np.array([i is None for i in self.ids]), "sizes": np.concatenate(self.sizes),
            "terms": terms[first], "ends": np.append(first, len(terms)), "docs": docs[order], "tfs": tfs[order],
        }
        pack = zstandard.ZstdCompressor(level=1)
        sections = {k: pack.compress(np.asarray(v, _SECTIONS[k]).tobytes()) for k, v in cols.items()}
        head, at = {}, 0
        for k, v in sections.items():
            head[k] = [at, len(v), len(cols[k])]
            at += len(v)
        text = json.dumps(head).encode()
        return b"".join([MAGIC, struct.pack("<I", len(text)), text, *sections.values()])


class ShardIndex:
    """The inverted lists of one file; sections are read when asked for."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        start = source.read(8)
        if start[:4] != MAGIC:
            raise ValueError("not a file of inverted lists")
        (size,) = struct.unpack("<I", start[4:])
        self.head, self.base = json.loads(source.read(size)), 8 + size
        self._kept: dict = {}

    def __getattr__(self, name: str) -> np.ndarray:
        if name not in _SECTIONS:
            raise AttributeError(name)
        if name not in self._kept:
            at, size, n = self.head[name]
            self.source.seek(self.base + at)
            kind = np.dtype(_SECTIONS[name])
            raw = zstandard.ZstdDecompressor().decompress(self.source.read(size), max_output_size=n * kind.itemsize + 1)
            self._kept[name] = np.frombuffer(raw, kind)
        return self._kept[name]

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Position of each term's list, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Writes the lists of all documents; one row per file: path, docs, with_terms (documents with a term), total (terms with repeats)."""
    folder = folder or own_folder(docs.sparkSession, "lexical")

    def shards(batches):
        part, k, now = TaskContext.get().partitionId(), 0, _Builder()

        def flush():
            path = new_name(folder, f"lists-{part:06d}-{k:06d}", "lex")
            write_file(path, now.file())
            sizes = np.concatenate(now.sizes)
            return pa.RecordBatch.from_pydict({"path": [path], "docs": [now.docs], "with_terms": [int((sizes > 0).sum())], "total": [int(sizes.sum())]})

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, end, raw, bounds in chunks(batch.column(1)):
                for a in range(0, end - first, shard_docs):
                    b = min(a + shard_docs, end - first)
                    if now.docs and now.docs + b - a > shard_docs:
                        yield flush()
                        k, now = k + 1, _Builder()
                    now.add(ids[first + a : first + b], raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                if now.bytes >= SHARD_BYTES:
                    yield flush()
                    k, now = k + 1, _Builder()
        if now.docs:
            yield flush()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return materialize(slim.mapInArrow(shards, "path string, docs long, with_terms long, total long"), "lexical-files")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per item and term: item_id, term (hash), reps."""

    def terms(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, end, raw, bounds in chunks(batch.column(1)):
                found, at, reps, _ = counted_terms(raw, bounds)
                yield pa.RecordBatch.from_arrays([ids.slice(first, end - first).take(pa.array(at)), pa.array(found.view(np.int64)), pa.array(reps, pa.int64())], names=["item_id", "term", "reps"])

    one = items.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("item_id")).agg(F.min(F.col(text_col).cast("string")).alias("text"))
    return one.mapInArrow(terms, "item_id long, term long, reps long")


class _List:
    """One list's documents and impacts, and for long ones each block's start and greatest impact."""

    def __init__(self, shard: ShardIndex, at: int, norms: np.ndarray, block: int = BLOCK, long: int = LONG):
        a, b = shard.ends[at : at + 2].tolist()
        self.docs = shard.docs[a:b].astype(np.int64)
        tf = shard.tfs[a:b].astype(np.int64)
        self.impacts = (10**9 * tf) // (1000 * tf + 8 * norms[self.docs])
        self.long = (b - a) * long >= len(norms)
        if self.long:
            self.starts = np.searchsorted(self.docs, np.arange(0, len(norms) + block, block))
            self.tops = np.zeros(len(self.starts) - 1, np.int64)
            some = np.flatnonzero(np.diff(self.starts))
            self.tops[some] = np.maximum.reduceat(self.impacts, self.starts[some])


class Best:
    """The k best (score, doc id) of an item so far, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[top], ids[top]

    @property
    def least(self) -> int:
        """A score below this one is out."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1


def search_shard(shard: ShardIndex, lists: list[tuple[int, _List]], best: Best, block: int = BLOCK, counts: dict | None = None) -> None:
    """Adds the shard's best documents for one item, given its lists with their weights."""
    n = len(shard.ids)
    blocks = -(-n // block)
    # term at a time: the short lists' sums, with bounds by block
    sums = np.zeros(blocks * block, np.int64)
    for weight, x in lists:
        if not x.long:
            sums[x.docs] += weight * x.impacts
    bounds = sums.reshape(blocks, block).max(axis=1)
    named = shard.no_id[:n] == 0
    partial = sums[:n][named]
    least = best.least
    if (partial > 0).sum() >= best.k:  # whole scores are these sums or more
        least = max(least, int(np.partition(partial, len(partial) - best.k)[len(partial) - best.k]))
    # document at a time: the sums as one list beside the long ones, those that can add most first
    long = sorted(((w, x) for w, x in lists if x.long), key=lambda y: -y[0] * int(y[1].tops.max(initial=0)))
    tops = [w * x.tops for w, x in long]
    reach = bounds + sum(tops) if tops else bounds
    seen = 0
    todo = np.flatnonzero(reach >= least)
    for a in range(0, len(todo), 64):
        some = todo[a : a + 64]
        some = some[reach[some] >= least]
        if not len(some):
            continue
        docs = (some[:, None] * block + np.arange(block)).ravel()
        left = np.repeat(reach[some] - bounds[some], block)
        keep = (docs < n) & (sums[docs] + left >= least)
        docs, left = docs[keep], left[keep]
        keep = named[docs]
        docs, left = docs[keep], left[keep]
        seen += len(docs)
        score = sums[docs]
        for (w, x), top in zip(long, tops, strict=True):
            if not len(docs):
                break
            left = left - top[docs // block]
            low, high = int(x.starts[docs[0] // block]), int(x.starts[docs[-1] // block + 1])
            if low < high:
                near = x.docs[low:high]
                at = np.minimum(np.searchsorted(near, docs), len(near) - 1)
                score = score + np.where(near[at] == docs, w * x.impacts[low:high][at], 0)
            keep = score + left >= least
            docs, left, score = docs[keep], left[keep], score[keep]
        if len(docs):
            best.add(score, shard.ids[docs])
            least = max(least, best.least)
    if counts is not None:
        counts["docs"] = counts.get("docs", 0) + n
        counts["scored"] = counts.get("scored", 0) + seen


def _read_block(path: str) -> dict:
    system, place = locate(path)
    with system.open_input_file(place) as source:
        table = pq.read_table(source)
    return {c: table.column(c).to_numpy() for c in table.column_names}


def _spread(index: DataFrame, files: list[str]) -> DataFrame:
    """A row for each shard and block of items, dealt out to tasks; a task has one block after another."""
    pairs = index.select("path", F.explode(F.array(*(F.lit(f) for f in files))).alias("block"))
    tasks = max(1, min(index.count() * len(files), 8 * index.sparkSession.sparkContext.defaultParallelism))
    return pairs.repartition(tasks).sortWithinPartitions("block", "path")


def _document_counts(index: DataFrame, files: list[str]) -> DataFrame:
    """How many documents have each query term: term, df."""

    def count(batches):
        block, terms = None, None
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != block:
                    block, terms = name, np.unique(_read_block(name)["term"]).view(np.uint64)
                    terms = np.sort(terms)
                with open_file(path) as source:
                    shard = ShardIndex(source)
                    at = shard.find(terms)
                    ends = shard.ends
                hit = at >= 0
                df = ends[at[hit] + 1] - ends[at[hit]]
                yield pa.RecordBatch.from_arrays([pa.array([name] * int(hit.sum()), pa.string()), pa.array(terms[hit].view(np.int64)), pa.array(df, pa.int64())], names=["block", "term", "df"])

    found = _spread(index, files).mapInArrow(count, "block string, term long, df long")
    return found.groupBy("block", "term").agg(F.sum("df").alias("df")).groupBy("term").agg(F.max("df").alias("df"))


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search(
    index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", block_docs: int = BLOCK, long: int = LONG, item_rows: int = ITEM_ROWS
) -> DataFrame:
    """One row per item and hit: item_id, rank (from 1), doc_id, score."""
    totals = index.agg(F.sum("with_terms"), F.sum("total")).first()
    documents, total = totals[0] or 0, totals[1] or 0
    out = "item_id long, doc_id long, score long"
    terms = materialize(item_terms(items, id_col, text_col), "lexical-items")
    rows = terms.count()
    if not documents or not rows:
        empty = index.sparkSession.createDataFrame([], out)
        return empty.select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    blocks = -(-rows // item_rows)
    plain = materialize(terms.repartition(blocks, "item_id"), "lexical-blocks")
    counts = _document_counts(index, plain.inputFiles())
    weighed = materialize(plain.join(counts, "term").repartition(blocks, "item_id").sortWithinPartitions("item_id", "term"), "lexical-weights")
    files = weighed.inputFiles()

    def hits(found: dict[int, Best]) -> pa.RecordBatch:
        ids = np.concatenate([np.full(len(b.ids), i, np.int64) for i, b in found.items()])
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([b.ids for b in found.values()])), pa.array(np.concatenate([b.scores for b in found.values()]))], names=["item_id", "doc_id", "score"])

    def find(batches):
        block, found = None, {}
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != block:
                    if found:
                        yield hits(found)
                    block, rows = name, _read_block(name)
                    vocabulary, which = np.unique(rows["term"].view(np.uint64), return_inverse=True)
                    known = {t: weight(documents, d) for t, d in zip(which.tolist(), rows["df"].tolist(), strict=True)}
                    cuts = np.flatnonzero(np.concatenate([[True], rows["item_id"][1:] != rows["item_id"][:-1], [True]])) if len(which) else []
                    wants = [
                        (int(rows["item_id"][a]), [(t, known[t] * r) for t, r in zip(which[a:b].tolist(), rows["reps"][a:b].tolist(), strict=True)])
                        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
                    ]
                    found = {i: Best(k) for i, _ in wants}
                with open_file(path) as source:
                    shard = ShardIndex(source)
                    at = shard.find(vocabulary)
                    norms = 25 + (75 * shard.sizes * documents) // total
                    lists: dict[int, _List] = {}
                    for item, coefficients in wants:
                        mine = []
                        for t, w in coefficients:
                            if at[t] >= 0 and w > 0:
                                if t not in lists:
                                    lists[t] = _List(shard, int(at[t]), norms, block_docs, long)
                                mine.append((w, lists[t]))
                        if mine:
                            search_shard(shard, mine, found[item], block_docs)
        if found:
            yield hits(found)

    best = _spread(index, files).mapInArrow(find, out)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
