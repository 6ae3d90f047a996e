"""Conversation prefix trie: double-array tries per prefix shard, shared upper nodes merged globally.

A node is a distinct sequence of first turns; its members are the conversations
that start with it. ``ordered_turns`` gives every turn its place in its
conversation, ``prefix_trie`` the nodes with their aggregates.

* Places: turns are range-partitioned by conversation, turn and content, each
  partition numbers its own rows, and the few counts before each partition are
  added; a conversation of any length may span partitions.
* Segments: a conversation is cut into segments of ``SEGMENT`` turns, so a long one
  is no long array. A segment belongs to the node it starts at (an identifier of
  all turns before it). Equal segments at one node are counted first, so any
  number of copies is one row.
* Shards: distinct segments in order of their start node and turns, cut into runs
  of at most ``SHARD`` nodes. In a shard turns get dense ids, and BASE and CHECK
  arrays are packed: state s goes by turn t to BASE[s] + t if CHECK there is s.
  All segments walk the arrays together, a turn at a time, adding up members at the
  states; child counts, leaves and savings go up from CHECK to CHECK.
* Merge: only the first and last path of a shard, and the paths of segments that go
  on in a further one, can belong to nodes that another shard has too. Their
  aggregates are added up by node, and sums over their subtrees come from pointer
  doubling: as many joins as the logarithm of the depth. All other nodes are final
  in their shard.

Turns are ordered by turn (null first), then role, then the SHA-256 of role and
text; null role or text counts as empty. Rows that repeat a turn are successive
turns. Rows without conversation id are left out. A turn is known by 128 bits of
that hash. Extra columns are ignored. An empty table gives no nodes, not even the
root; a conversation without turns is a member of the root alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlog.session import materialize

SEGMENT = 64
SHARD = 1 << 16
WIDTH = 16
ROOT = bytes(WIDTH)
#: Repeats of a turn that are unfolded from one array.
UNFOLD = 4096
#: Bytes of joined ids in one row on their way to a node's hash.
TEXT = 1 << 16


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", unfold: int = UNFOLD) -> DataFrame:
    """One row per turn: conv_id, place (from 0), key (16 bytes of role and text), chars (code points of the text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    content = F.sha2(F.concat(F.octet_length(text(role_col)).cast("string"), F.lit(":"), text(role_col), text(text_col)), 256)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), F.unhex(content).alias("hash"), F.char_length(text(text_col)).cast("long").alias("chars")
    )
    order = ["conv_id", "turn", "role", "hash"]
    runs = rows.groupBy(*order, "chars").agg(F.count("*").alias("times"))
    dealt = runs.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches):
        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids, times = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            if not len(ids):
                continue
            before = np.concatenate([[0], np.cumsum(times)])
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            start = before[first]
            if ids[0] == last:
                start[0] = -at
            local = before[:-1] - np.repeat(start, np.diff(np.append(first, len(ids))))
            at, last = int(local[-1] + times[-1]), ids[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), part)), *batch.columns, pa.array(local)], names=["part", "conv_id", "hash", "chars", "times", "place"])

    numbered = materialize(dealt.select("conv_id", "hash", "chars", "times").mapInArrow(number, "part long, conv_id long, hash binary, chars long, times long, place long"), "trie-places")
    # a conversation that spans partitions: what its earlier ones hold
    edges = numbered.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    cut = edges.select("part", F.explode(F.array("low", "high")).alias("conv_id")).distinct()
    held = numbered.join(cut, ["part", "conv_id"], "left_semi").groupBy("conv_id", "part").agg(F.sum("times").alias("held"))
    before = F.sum("held").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    moved = held.select("conv_id", "part", before.alias("before")).where("before IS NOT NULL")
    placed = numbered.join(moved, ["conv_id", "part"], "left").withColumn("place", F.col("place") + F.coalesce("before", F.lit(0)))
    # a turn repeated very often is unfolded in two steps, so no long array is made
    steps = placed.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / unfold))).alias("step"))
    again = steps.select("*", F.explode(F.sequence(F.col("step") * unfold, F.least(F.col("times"), (F.col("step") + 1) * unfold) - 1)).alias("time"))
    return again.select("conv_id", (F.col("place") + F.col("time")).alias("place"), F.substring("hash", 1, WIDTH).alias("key"), "chars")


def shared_heads(turns: DataFrame, ids: DataFrame, own: Column, donor: Column, most: int) -> DataFrame:
    """The turns with each conversation's first ``own`` ones exchanged for those of conversation ``donor`` (all if fewer).

    ids: conv_id of all conversations; ``own`` (at most ``most``) and ``donor`` are expressions of it.
    """
    heads = turns.where(F.col("place") < most).select(F.col("conv_id").alias("donor"), F.col("place").alias("at"), "key", "chars")
    plan = ids.select("conv_id", own.cast("long").alias("own"), donor.alias("donor"))
    given = plan.join(heads, "donor").where("at < own")
    taken = given.groupBy("conv_id").agg(F.count("*").alias("got"))
    shift = plan.join(taken, "conv_id", "left").select("conv_id", "own", F.coalesce("got", F.lit(0)).alias("got"))
    rest = turns.join(shift, "conv_id").where("place >= own").select("conv_id", (F.col("place") - F.col("own") + F.col("got")).alias("place"), "key", "chars")
    return given.select("conv_id", F.col("at").alias("place"), "key", "chars").unionByName(rest)


def _id(*parts) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, WIDTH)


def _segments(turns: DataFrame, ids: DataFrame, segment: int) -> DataFrame:
    """One row per conversation and segment: conv_id, k, start and stop (node ids), keys, chars, full, last."""
    cut = turns.groupBy("conv_id", F.floor(F.col("place") / segment).alias("k")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "chars"))).alias("t"))
    cut = cut.select("conv_id", "k", F.col("t.key").alias("keys"), F.col("t.chars").alias("chars"))
    rows = ids.join(cut, "conv_id", "left").select(
        "conv_id", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("keys", F.array().cast("array<binary>")).alias("keys"), F.coalesce("chars", F.array().cast("array<bigint>")).alias("chars")
    )
    joined = F.expr("aggregate(keys, X'', (a, b) -> concat(a, b))")
    rows = rows.withColumn("path", joined).withColumn("full", F.size("keys") == segment)
    # a node at a segment's start: the exclusive or, in two halves, of hashes of all segments before
    halves = F.sha2(F.concat(F.col("k").cast("string"), F.lit(":"), F.hex("path")), 256)
    half = lambda at: F.when(F.col("full"), F.conv(F.substring(halves, at, 15), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))
    until = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"h": half(1), "g": half(16)})
    rows = rows.withColumns({"hb": F.coalesce(F.bit_xor("h").over(until), F.lit(0)), "gb": F.coalesce(F.bit_xor("g").over(until), F.lit(0)), "last": F.lead("k").over(Window.partitionBy("conv_id").orderBy("k")).isNull()})
    node = lambda a, b: F.unhex(F.concat(F.lpad(F.hex(a), WIDTH, "0"), F.lpad(F.hex(b), WIDTH, "0")))
    start, further = node(F.col("hb"), F.col("gb")), node(F.col("hb").bitwiseXOR(F.col("h")), F.col("gb").bitwiseXOR(F.col("g")))
    stop = F.when(F.size("keys") == 0, start).when(F.col("full"), further).otherwise(_id(start, F.col("path")))
    return rows.select("conv_id", "k", start.alias("start"), stop.alias("stop"), "path", "chars", "full", "last")


def pack_arrays(first: np.ndarray, parent: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BASE and CHECK for nodes given in breadth-first order, and each node's state.

    ``parent`` is a node's parent (the root, node 0, has -1) and ``code`` the turn id
    that leads to it; a parent's children are ``first[parent]`` up to ``first[parent + 1]``.
    States of children are the first places, from a pointer that never goes back
    far, where all of a parent's codes fit.
    """
    n = len(parent)
    room = n + int(code.max(initial=0)) + 2
    base, check, state = np.zeros(2 * room, np.int64), np.full(2 * room, -1, np.int64), np.zeros(n, np.int64)
    check[0], low = 0, 1
    check_free = bytearray(b"\1") * (2 * room)
    check_free[0] = 0
    for p in range(n):
        a, b = int(first[p]), int(first[p + 1])
        if a == b:
            continue
        codes = code[a:b]
        least, spread = int(codes[0]), (codes - codes[0])
        at = check_free.find(1, low)
        low = at
        tries = 0
        while True:
            if at + int(spread[-1]) >= len(check_free):
                more = len(check_free) + int(spread[-1])
                base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1, np.int64))
                check_free += bytearray(b"\1") * more
            if b - a == 1:
                if check_free[at]:
                    break
            elif (check[at + spread] < 0).all():
                break
            tries += 1
            at = check_free.find(1, at + (1 if tries < 64 else 1 + b - a))
            if at < 0:
                at = len(check_free)
        base[state[p]] = at - least
        places = at + spread
        check[places] = state[p]
        state[a:b] = places
        for x in places.tolist():
            check_free[x] = 0
    used = int(state.max(initial=0)) + 1
    return base[:used], check[:used], state


class Shard:
    """The double-array trie of some distinct segments in order: start node, path of turn keys, characters, members."""

    def __init__(self, starts: list[bytes], paths: list[bytes], chars: list[list[int]], counts: np.ndarray, least: np.ndarray, depth: np.ndarray):
        self.counts, self.least = counts, least
        lens = np.array([len(p) // WIDTH for p in paths]) + 1
        symbols = np.frombuffer(b"".join(s + p for s, p in zip(starts, paths, strict=True)), f"V{WIDTH}")
        # dense ids in byte order; a start node and a turn are symbols alike, at different depths
        words = np.ascontiguousarray(symbols).view(">u8").reshape(-1, 2)
        order = np.lexsort((words[:, 1], words[:, 0]))
        fresh = np.concatenate([[True], (words[order[1:]] != words[order[:-1]]).any(axis=1)])
        dense = np.empty(len(order), np.int64)
        dense[order] = np.cumsum(fresh)
        self.symbols = np.ascontiguousarray(symbols[order[fresh]])
        rows, deep = len(paths), int(lens.max())
        offs = np.cumsum(lens) - lens
        self.lens, self.offs, self.dense, self.paths, self.starts = lens, offs, dense, paths, starts
        # nodes in breadth-first order: of rows with equal ids so far, one node
        here, level_first = np.zeros(rows, np.int64), 1
        parent, code, begin = [np.array([-1])], [np.array([0])], [np.array([0])]
        for d in range(deep):
            live = np.flatnonzero(lens > d)
            pair = np.stack([here[live], dense[offs[live] + d]], axis=1)
            new = np.concatenate([[True], (pair[1:] != pair[:-1]).any(axis=1)])
            number = level_first + np.cumsum(new) - 1
            here[live] = number
            parent.append(pair[new, 0])
            code.append(pair[new, 1])
            begin.append(live[new])
            level_first += int(new.sum())
        self.parent, self.code, self.begin = (np.concatenate(x) for x in (parent, code, begin))
        self.depths = np.repeat(np.arange(deep + 1), [len(x) for x in parent]) - 1  # the start node has 0
        edges = np.searchsorted(self.parent, np.arange(len(self.parent) + 1))
        self.base, self.check, self.state = pack_arrays(edges, self.parent, self.code)
        self._walk(chars, depth)

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Where the states go by the turn ids; -1 for nowhere."""
        to = self.base[states] + ids
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states) & (to > 0), to, -1)

    def _walk(self, chars: list[list[int]], depth: np.ndarray) -> None:
        size = len(self.check)
        self.n, self.low, self.chars, self.depth, self.children = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        lengths = np.concatenate([np.asarray([0, *c], np.int64) for c in chars])
        states = np.zeros(len(self.lens), np.int64)
        for d in range(int(self.lens.max())):
            live = np.flatnonzero(self.lens > d)
            at = self.offs[live] + d
            states[live] = to = self.step(states[live], self.dense[at])
            assert (to > 0).all()
            np.add.at(self.n, to, self.counts[live])
            np.minimum.at(self.low, to, self.least[live])
            self.chars[to] = lengths[at]
            self.depth[to] = depth[live] + d

    def shared(self, goes_on: np.ndarray) -> np.ndarray:
        """Marks of states that another shard may have too: start nodes, the first and last path, paths that go on."""
        out = np.zeros(len(self.check), bool)
        out[self.state[self.depths == 0]] = True
        rows = np.unique(np.concatenate([[0, len(self.lens) - 1], np.flatnonzero(goes_on)]))
        states, d = np.zeros(len(rows), np.int64), 0
        while len(rows):
            states = self.step(states, self.dense[self.offs[rows] + d])
            out[states] = True
            d += 1
            more = self.lens[rows] > d
            rows, states = rows[more], states[more]
        return out

    def roll_up(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves and savings of final subtrees, at their tops and, added up, at the shared states above."""
        leaves, saved = np.zeros(len(self.check), np.int64), np.zeros(len(self.check), np.int64)
        for d in range(int(self.depths.max()), -1, -1):
            s = self.state[self.depths == d]
            s = s[~shared[s]]
            if not len(s):
                continue
            leaves[s] += self.children[s] == 0
            saved[s] += (self.n[s] - 1) * self.chars[s]
            up = self.check[s]
            np.add.at(leaves, up, leaves[s])
            np.add.at(saved, up, saved[s])
            np.add.at(self.children, up, 1)
        return leaves, saved

    def node_ids(self, stops: list[bytes]) -> list[bytes]:
        """Node id of each node in breadth-first order, the virtual top excluded."""
        out: list[bytes] = [b""] * len(self.parent)
        whole = {(i, int(self.lens[i]) - 1): s for i, s in enumerate(stops)}
        for v in range(1, len(self.parent)):
            row, d = int(self.begin[v]), int(self.depths[v])
            if d == 0:
                out[v] = self.starts[row]
            else:
                out[v] = whole.get((row, d)) or hashlib.sha256(self.starts[row] + self.paths[row][: d * WIDTH]).digest()[:WIDTH]
        return out


_NODES = "shard string, slot long, up long, node_id binary, up_id binary, depth long, shared boolean, conv_id long, up_conv_id long, n long, chars long, children long, leaves long, saved long"


def _shard_rows(held: list[tuple], name: str, segment: int) -> pa.RecordBatch:
    starts, paths, stops, chars, counts, least, ks, goes_on = zip(*held, strict=True)
    t = Shard(list(starts), list(paths), list(chars), np.array(counts, np.int64), np.array(least, np.int64), np.array(ks, np.int64) * segment)
    shared = t.shared(np.array(goes_on))
    leaves, saved = t.roll_up(shared)
    ids = t.node_ids(list(stops))
    v = np.arange(1, len(t.parent))
    s, up = t.state[v], t.parent[v]
    top = t.depths[v] == 0
    # a start node beyond the root is counted by the segments that end at it; here it only gains children
    ghost = top & np.array([ids[i] != ROOT for i in v])
    known = ~top & ~shared[t.state[up]]
    cols = {
        "shard": pa.array([name] * len(v)), "slot": pa.array(v), "up": pa.array(up, mask=top), "node_id": pa.array([ids[i] for i in v], pa.binary()),
        "up_id": pa.array([None if z else ids[p] for p, z in zip(up.tolist(), top.tolist(), strict=True)], pa.binary()), "depth": pa.array(t.depth[s]), "shared": pa.array(shared[s]),
        "conv_id": pa.array(t.low[s], mask=ghost), "up_conv_id": pa.array(t.low[t.state[up]], mask=~known), "n": pa.array(np.where(ghost, 0, t.n[s])),
        "chars": pa.array(np.where(ghost, 0, t.chars[s])), "children": pa.array(t.children[s]), "leaves": pa.array(leaves[s]), "saved": pa.array(saved[s]),
    }
    return pa.RecordBatch.from_pydict(cols)


def _shards(batches: Iterator[pa.RecordBatch], segment: int, shard: int) -> Iterator[pa.RecordBatch]:
    part, k, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and size + len(row[3]) + 1 > shard:
                yield _shard_rows(held, f"{part}-{k}", segment)
                held, size, k = [], 0, k + 1
            held.append(row)
            size += len(row[3]) + 1
    if held:
        yield _shard_rows(held, f"{part}-{k}", segment)


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """node_id, leaves, saved: summed over each node's subtree by pointer doubling."""
    deep = (nodes.agg(F.max("depth")).first()[0] or 0) + 1
    now = nodes.select("node_id", F.col("up_id").alias("ptr"), "leaves", "saved")
    reach = 1
    while reach < deep:
        below = now.where("ptr IS NOT NULL").groupBy("ptr").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).withColumnRenamed("ptr", "node_id")
        far = now.select(F.col("node_id").alias("ptr"), F.col("ptr").alias("next"))
        now = now.join(below, "node_id", "left").join(far, "ptr", "left").select(
            "node_id", F.col("next").alias("ptr"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")
        )
        now, reach = materialize(now, "trie-doubling"), 2 * reach
    return now.select("node_id", "leaves", "saved")


def prefix_trie(turns: DataFrame, ids: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """The nodes, and where conversations end.

    turns: conv_id, place, key, chars; ids: conv_id of all conversations, those without turns too.
    nodes: node_id, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.
    ends: node_id, conv_id.
    """
    segments = materialize(_segments(turns, ids, segment), "trie-segments")
    distinct = segments.groupBy("stop", "start", "k").agg(
        F.first("path").alias("path"), F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.max(~F.col("last")).alias("goes_on")
    )
    dealt = distinct.select("start", "path", "stop", "chars", "n", "conv_id", "k", "goes_on").repartitionByRange("start", "path").sortWithinPartitions("start", "path")
    made = materialize(dealt.mapInArrow(lambda b: _shards(b, segment, shard), _NODES), "trie-shards")
    parts = made.where("shared")
    merged = parts.groupBy("node_id").agg(
        F.max("up_id").alias("up_id"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.max("chars").alias("chars"),
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
    )
    merged = materialize(merged, "trie-shared")
    inner = merged.where("up_id IS NOT NULL").groupBy(F.col("up_id").alias("node_id")).agg(F.count("*").alias("also"))
    merged = merged.join(inner, "node_id", "left").withColumn("children", F.col("children") + F.coalesce("also", F.lit(0)))
    merged = merged.withColumn("leaves", F.col("leaves") + (F.col("children") == 0).cast("long")).withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("chars"))
    merged = materialize(merged.drop("also"), "trie-shared")
    sums = _subtree_sums(merged)
    above = merged.select(F.col("node_id").alias("up_id"), F.col("conv_id").alias("parent_conv_id"))
    upper = merged.drop("leaves", "saved").join(sums, "node_id").join(above, "up_id", "left")
    out = lambda d: d.select("node_id", "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    # final nodes know their parent's member, or find it by the shard and slot of the shared parent
    slots = parts.select("shard", F.col("slot").alias("up"), "node_id").join(merged.select("node_id", F.col("conv_id").alias("parent")), "node_id").select("shard", "up", "parent")
    lower = made.where("NOT shared").join(slots, ["shard", "up"], "left").withColumn("parent_conv_id", F.coalesce("up_conv_id", "parent"))
    return out(upper).unionByName(out(lower)), segments.where("last").select(F.col("stop").alias("node_id"), "conv_id")


def _id_texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """From rows (node_id, conv_id) in order: a hash for a node whose ids are all here, blocks of text for the first and last node and long ones."""
    part, first, now, text, block = TaskContext.get().partitionId(), None, None, [], 0
    rows: list[tuple] = []

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["node_id", "part", "block", "ids", "ends_sha256"])
        rows.clear()
        return out

    def close(last: bool) -> None:
        if block and not text:
            return
        joined = ",".join(map(str, text))
        if last or block or now == first:
            rows.append((now, part, block, joined, None))
        else:
            rows.append((now, part, block, None, hashlib.sha256(joined.encode()).hexdigest()))

    for batch in batches:
        for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    close(False)
                else:
                    first = node
                now, text, block = node, [], 0
            text.append(conv)
            if len(text) * 8 >= size:
                rows.append((now, part, block, ",".join(map(str, text)), None))
                text, block = [], block + 1
        if len(rows) >= 4096:
            yield flush()
    if now is not None:
        close(True)
        if rows:
            yield flush()


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, sha = None, None
    for batch in batches:
        done: list[tuple] = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pydict({"node_id": [d[0] for d in done], "ends_sha256": [d[1] for d in done]})
    if now is not None:
        yield pa.RecordBatch.from_pydict({"node_id": [now], "ends_sha256": [sha.hexdigest()]})


def end_digests(ends: DataFrame, size: int = TEXT) -> DataFrame:
    """node_id, ends_sha256: of the node's ending conversations' ids, ascending, joined by commas.

    Ids are joined to blocks of text where they lie after a range partition, so the
    task that hashes a node where very many end reads a row per block, not per id.
    """
    dealt = ends.select("node_id", "conv_id").repartitionByRange("node_id", "conv_id").sortWithinPartitions("node_id", "conv_id")
    made = materialize(dealt.mapInArrow(lambda b: _id_texts(b, size), "node_id binary, part long, block long, ids string, ends_sha256 string"), "trie-ends")
    split = made.where("ids IS NOT NULL").select("node_id", "ids", "part", "block").repartition("node_id").sortWithinPartitions("node_id", "part", "block")
    whole = split.select("node_id", "ids").mapInArrow(_hash_blocks, "node_id binary, ends_sha256 string")
    return made.where("ids IS NULL").select("node_id", "ends_sha256").unionByName(whole)
