"""Lexical search and the prefix trie against brute force: nulls, empty and very long texts, ties, repeats, empty tables, clashing names."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import wearlog.llm.lexical as lexical
import wearlog.llm.prefix_trie as trie
from wearlog.llm.registry import rebuilt_conversations

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, term long, tf string, score string"
ITEMS = "item_id long, text string, rank int, df string"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=10):
    found = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    N, L = sum(n > 0 for _, _, n in found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    least = {}
    for i, t in items:
        if i is not None:
            least[i] = min(x for x in (least.get(i), t) if x is not None) if (least.get(i), t) != (None, None) else None
    out = []
    for item, text in least.items():
        scores = []
        for i, c, n in found:
            if i is None:
                continue
            m = 25 + (75 * n * N) // L if L else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def corpus():
    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}é" for i in range(300)]
    docs = [(i, " ".join(rng.choice(common if rng.random() < 0.8 else rare) for _ in range(rng.randrange(1, 60)))) for i in range(700)]
    docs += [(1000, None), (1001, ""), (1002, " ,;\x00 "), (1003, "C1 c1-C1_c1'r1É"), (1004, " ".join(rare * 200)), (1005, "日本語 c1"), (None, "r1é r2é r3é"), (7, docs[7][1]), (7, docs[7][1]), (1006, "x" * 100000)]
    docs += [(2000 + i, "r5é c1 c2") for i in range(40)]
    items = [(i, " ".join(rng.choice(common + rare) for _ in range(rng.randrange(1, 30)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "r5é r5é C1"), (103, "absent words"), (104, " ".join(common)), (None, "c1"), (0, "c1"), (105, "x" * 100000), (106, " ".join(rare * 30)), (107, "日本語")]
    return docs, items


def test_search_equals_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, 1, "a", "b") for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, 1, "a") for i, t in items], ITEMS)
    want = brute_search(docs, items)
    assert rows(lexical.search(lexical.build_index(d), q)) == want
    for block, long, shard, item_rows in ((1, 1, 50, 7), (4, 100, 9, 100), (64, 3, 400, 1 << 18)):
        index = lexical.build_index(d.coalesce(1), shard_docs=shard)
        assert index.agg({"docs": "sum"}).first()[0] == len(docs)
        assert rows(lexical.search(index, q, block_docs=block, long=long, item_rows=item_rows)) == want


def test_skipping_scores_few_documents():
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(rng.choice(words, 30)) + (" needle" if i % 500 == 0 else "") for i in range(3000)]
    built = lexical._Builder()
    raw = "".join(texts).encode()
    built.add(list(range(3000)), np.frombuffer(raw, np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    shard = lexical.ShardIndex(io.BytesIO(built.file()))
    query = lexical.counted_terms(np.frombuffer(b"needle w1 w2", np.uint8), np.array([0, 12]))[0]
    norms = 25 + 75 * shard.sizes * 3000 // int(shard.sizes.sum())
    lists = [(lexical.weight(3000, int(shard.ends[a + 1] - shard.ends[a])), lexical._List(shard, int(a), norms)) for a in shard.find(query)]
    assert sorted(x.long for _, x in lists) == [False, True, True]
    best, counts = lexical.Best(3), {}
    lexical.search_shard(shard, lists, best, counts=counts)
    assert len(best.ids) == 3 and all(i % 500 == 0 for i in best.ids) and counts["scored"] < 1500


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a b", 1, "", "")], DOCS)
    item, no_item = spark.createDataFrame([(1, "a", 1, "")], ITEMS), spark.createDataFrame([], ITEMS)
    assert rows(lexical.search(lexical.build_index(none), item)) == []
    assert rows(lexical.search(lexical.build_index(some), no_item)) == []
    assert lexical.search(lexical.build_index(none), item).dtypes == lexical.search(lexical.build_index(some), item).dtypes
    # weight 0: a term of every document of a table of one scores nothing unless the logarithm is a thousandth
    assert rows(lexical.search(lexical.build_index(some.union(some)), item)) == brute_search([(1, "a b")] * 2, [(1, "a")])


TURNS = "conv_id long, turn long, role string, text string, key string, place string, node_id string, n int"


def brute_trie(turns, rebuild=True):
    by = {}
    for c, t, r, x in turns:
        if c is not None:
            r, x = r or "", x or ""
            sha = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()
            by.setdefault(c, []).append(((t is not None, t or 0), r.encode(), sha, x))
    own = {c: [(r, s, x) for _, r, s, x in sorted(v)] for c, v in by.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        seqs[c] = own.get(base, [])[:h] + v[h:] if rebuild else v
    nodes = {}
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    children, ends = Counter(p[:-1] for p in nodes if p), {}
    for c, v in seqs.items():
        ends.setdefault(tuple(v), []).append(c)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        gain = (len(members) - 1) * (len(p[-1][2]) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += gain
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in nodes.items()
    )


def trie_rows(table, rebuild=True, segment=64, shard=1 << 16, text=1 << 16, unfold=2):
    if rebuild:
        turns, ids = rebuilt_conversations(table)
    else:
        turns, ids = trie.ordered_turns(table, unfold=unfold), table.where("conv_id IS NOT NULL").select("conv_id").distinct()
    nodes, ends = trie.prefix_trie(turns, ids, segment, shard)
    out = nodes.join(trie.end_digests(ends, text), "node_id", "left").fillna(hashlib.sha256(b"").hexdigest(), "ends_sha256")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.select(cols).collect())


def conversations():
    rng = random.Random(11)
    turns = []
    for c in list(range(0, 330, 1)) + [-5, -100, -250, 100000, 7700]:
        if c == 200:
            continue
        for t in range(rng.randrange(1, 9)):
            turns.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hello there", "ok", "é" * rng.randrange(3)])))
    turns += [(400, None, "user", None), (400, 1, None, "x"), (400, 1, None, "x"), (400, 1, None, "x"), (400, 1, "a", None), (None, 0, "user", "lost"), (401, 0, "u", "y" * 100000)]
    for c in range(500, 560):
        turns += [(c, t, "user", "same") for t in range(7)]
    for c, n in ((600, 150), (601, 151), (602, 64), (603, 128), (604, 65), (605, 300)):
        turns += [(c, t, "user", f"step {t}" if c != 605 else "again") for t in range(n)]
    return turns


@pytest.mark.parametrize("rebuild, segment, shard, text", [(True, 64, 1 << 16, 1 << 16), (True, 4, 40, 64), (False, 3, 7, 16)])
def test_trie_equals_brute_force(spark, rebuild, segment, shard, text):
    turns = conversations()
    table = spark.createDataFrame([(*t, "k", "p", "n", 1) for t in turns], TURNS).repartition(3)
    assert trie_rows(table, rebuild, segment, shard, text) == brute_trie(turns, rebuild)


def test_trie_of_nothing(spark):
    assert trie_rows(spark.createDataFrame([], TURNS)) == []


def test_double_array_answers_every_step():
    rng = np.random.default_rng(2)
    paths = sorted({tuple(rng.integers(0, 30, rng.integers(0, 6)).tolist()) for _ in range(400)})
    key = lambda t: hashlib.sha256(str(t).encode()).digest()[:16]
    rows = sorted((b"".join(map(key, p)), p) for p in paths)
    n = len(rows)
    made = trie.Shard([trie.ROOT] * n, [b for b, _ in rows], [[1] * len(p) for _, p in rows], np.ones(n, np.int64), np.arange(n), np.zeros(n, np.int64))
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
    assert (made.check >= 0).sum() == len(prefixes) + 1  # and the virtual top
    codes = {bytes(s): i + 1 for i, s in enumerate(made.symbols)}
    top = made.step(np.array([0]), np.array([codes[trie.ROOT]]))
    for p in prefixes:
        s = top
        for t in p:
            s = made.step(s, np.array([codes[key(t)]]))
        assert s[0] > 0 and made.n[s[0]] == sum(q[: len(p)] == p for q in paths)
        for t in range(30):
            gone = made.step(s, np.array([codes.get(key(t), 10**6)]))[0]
            assert (gone > 0) == ((*p, t) in prefixes)
