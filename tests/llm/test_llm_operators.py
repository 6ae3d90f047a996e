"""Training-data operators against brute force on small tables: nulls, empty and long texts, ties, repeats, extra columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wearlog.llm import content_dedup, exact_topk, language_id, mixing, near_dups, packing, quotes, warc, wavelet, weak_labels
from wearlog.llm import links as links_module
from wearlog.llm.files import open_file
from wearlog.llm.links import components, joined_further
from wearlog.llm.tokens import TextEncoder, encode_column, vocabulary

PATH = vocabulary("word_bpe_49k.json")
SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, g string, keep string"
LONG = " ".join(f"word{i}" for i in range(30000))
BASE = " ".join(f"t{i}" for i in range(60))
TEXTS = [
    (0, BASE), (1, BASE.replace(" t7 ", " x7 ")), (2, BASE.upper()), (3, None), (4, ""), (5, " \t\n"), (6, "one two"), (7, "One  TWO"),
    (8, LONG), (9, LONG + " tail"), (10, "a" * 50000), (11, "a b c d e f g"), (12, "a b c d e f"), (13, BASE.replace(" ", "  ")), (None, "lost id"), (14, "1 2 3"), (6, "one two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None, "de"][k % 3], ["b", "a", None, "ä"][k % 4], 1, 7, "clash", "clash") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def library():
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(PATH)
    return lambda t: tool.encode(t or "", add_special_tokens=False).ids


def test_cached_tokens_equal_the_library():
    encode = library()
    texts = ["", None, "a<|endoftext|>b <|StartOfText|>", "it's don't 'tis ..'s “hi”. Σας İx ½ \x00a", "A.B,c'd(e)'ll 12ab3", LONG, "é é ñ"]
    got = [ids[a:b].tolist() for _, _, ids, at in encode_column(pa.array(texts, pa.string()), PATH, 2) for a, b in zip(at[:-1], at[1:])]
    assert got == [[*encode(t), 2] for t in texts]


def test_token_cache_survives_a_reset():
    tool, words = TextEncoder(PATH), "alpha beta gamma alpha"
    raw = np.frombuffer(words.encode(), np.uint8)
    first = tool.encode(raw, np.array([0, len(raw)]))[0].tolist()
    tool.clear()
    assert tool.encode(raw, np.array([0, len(raw)]))[0].tolist() == first == library()(words)


def test_content_groups(docs, none):
    rows = content_dedup.content_groups(docs).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    members = {}
    for i, t in TEXTS:
        members.setdefault(norm(t), []).append(i)
    want = Counter()
    for i, t in TEXTS:
        own = members[norm(t)]
        want[i, min((x for x in own if x is not None), default=None), len(own), hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == len(members)
    stay = content_dedup.drop_copies(docs)
    assert stay.columns == docs.columns and stay.count() == len(members)
    assert content_dedup.content_groups(none).count() == 0 and content_dedup.drop_copies(none).count() == 0


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    top = {i: i for i, _ in texts if i is not None}
    for _ in texts:
        for (i, _), s in zip(texts, sets):
            for (j, _), u in zip(texts, sets):
                if None not in (i, j) and s and u and 100 * len(s & u) >= 85 * len(s | u):
                    top[i] = min(top[i], top[j])
    return Counter((i, len(s), top.get(i)) for (i, _), s in zip(texts, sets))


def test_near_duplicates(docs, none):
    rows = near_dups.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute_components(TEXTS)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    stay = near_dups.drop_near_duplicates(docs)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {r.doc_id for r in rows if r.kept}
    assert near_dups.near_duplicates(none).count() == 0


def test_near_duplicates_in_long_lists(spark, monkeypatch):
    """Lists over the limit: a large group of edits of one text, and texts that only share a passage."""
    monkeypatch.setattr(near_dups, "LIST", 6)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(120)]
    texts = [(0, " ".join(words))]
    for i in range(1, 40):
        own = list(words)
        own[int(rng.integers(0, 120))] = f"edit{i}"
        texts.append((i, " ".join(own)))
    for i in range(40, 70):
        texts.append((i, " ".join(words[:50] + [f"z{i}_{k}" for k in range(60)])))
    rows = near_dups.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute_components(texts)


def jaccard_groups(texts, least):
    """Brute force: the least id of each text's component, links where Jaccard on word shingles reaches ``least`` (a fraction of ints)."""
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in texts}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared * least[1] >= (len(sets[a]) + len(sets[b]) - shared) * least[0]:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def test_near_duplicates_of_nested_families(spark, monkeypatch):
    """Lists too long for pairs whose typical members are all of a larger family, and a chain in which only neighbours are near."""
    monkeypatch.setattr(near_dups, "LIST", 6)
    monkeypatch.setattr(near_dups, "ROUND", 2)
    monkeypatch.setattr(near_dups, "GROWTH", 2)
    shared, rng = [f"s{i}" for i in range(900)], np.random.default_rng(5)
    texts = []
    for family, size in enumerate((60, 20, 9)):
        own = [f"f{family}x{i}" for i in range(100)]
        for _ in range(size):
            words = shared + own
            words[int(rng.integers(1000))] = f"edit{len(texts)}"
            texts.append((len(texts), " ".join(words)))
    for step in range(12):
        texts.append((len(texts), " ".join(shared[60 * step :] + [f"c{i}" for i in range(60 * step)])))
    texts = [(int(i), t) for i, (_, t) in zip(rng.permutation(len(texts)), texts, strict=True)]
    rows = near_dups.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == jaccard_groups(texts, (85, 100))


@pytest.mark.parametrize("rounds, similarity", [(8, (85, 100)), (1, (85, 100)), (3, (80, 100))])
def test_near_duplicates_by_pivots_and_differences(spark, monkeypatch, rounds, similarity):
    """Families edited lightly to heavily, families within them, mixtures of passages, repeated ids: no link is lost by any number of rounds."""
    monkeypatch.setattr(near_dups, "LIST", 4)
    monkeypatch.setattr(near_dups, "ROUNDS", rounds)
    monkeypatch.setattr(near_dups, "FEW", 1)
    monkeypatch.setattr(near_dups, "ROUND", 2)
    rng, texts = np.random.default_rng(rounds), []
    for family in range(2):
        base = [f"b{family}w{i}" for i in range(100)]
        sub = list(base)
        sub[10:18] = [f"sub{family}x{i}" for i in range(8)]
        for _ in range(45):
            words = list(base if rng.random() < 0.6 else sub)
            for _ in range(int(rng.integers(0, 9))):
                words[int(rng.integers(100))] = f"e{int(rng.integers(0, 60))}" if rng.random() < 0.5 else f"u{len(texts)}_{int(rng.integers(1000))}"
            if rng.random() < 0.2:
                words = words[: int(rng.integers(60, 100))]
            texts.append((len(texts), " ".join(words)))
    passages = [" ".join(f"p{k}w{i}" for i in range(25)) for k in range(5)]
    for _ in range(40):
        pick = rng.permutation(5)[: int(rng.integers(2, 5))]
        texts.append((len(texts), " ".join([passages[k] for k in pick] + [f"o{len(texts)}_{i}" for i in range(int(rng.integers(0, 12)))])))
    rows = near_dups.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), similarity=similarity).collect()
    assert {r.doc_id: r.component_id for r in rows} == jaccard_groups(texts, similarity)


def test_near_duplicates_at_a_given_similarity(spark):
    """One word of sixty changed in the middle: 51 of 61 shingles, linked at 0.8 and not at 0.85; 4 of 5 shingles are just enough."""
    words = [f"p{i}" for i in range(60)]
    texts = [(1, " ".join(words)), (2, " ".join([*words[:30], "other", *words[31:]])), (3, "a b c d e f g h"), (4, "a b c d e f g h i"), (5, "a b c d e f g"), (6, "k l m n o p q"), (7, "k l m n o p q r s")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for similarity in ((80, 100), (85, 100)):
        rows = near_dups.near_duplicates(docs, similarity=similarity).collect()
        assert {r.doc_id: r.component_id for r in rows} == jaccard_groups(texts, similarity)
    stay = near_dups.drop_near_duplicates(docs, (80, 100))
    expect = jaccard_groups(texts, (80, 100))
    assert sorted(r.doc_id for r in stay.collect()) == sorted(i for i, c in expect.items() if i == c) and expect[2] == 1


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(40, 30), (41, 40), (5, 5), (None, 3), (50, 51), (50, 51)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 40: 30, 41: 30, 50: 50, 51: 50}


def test_components_after_further_links(spark):
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    rows = lambda df: sorted((r.id, r.component) for r in df.collect())
    old = [(5, 6), (6, 7), (1, 2), (20, 21), (None, 4)]
    known = components(frame(old))
    # known components joined by others' members, by a new node that is less or more than all; new nodes among themselves
    new = [(7, 2), (0, 21), (30, 31), (31, 32), (40, 6), (8, 8), (9, None)]
    assert rows(joined_further(known, frame(new))) == rows(components(frame(old + new)))
    assert joined_further(known, frame([(5, 7), (2, 1), (3, 3), (None, 5)])) is known


def test_near_duplicates_join_known_components_only_by_new_links(spark, monkeypatch):
    """One family of edits and many texts that share a passage: rounds without a new link start no turns over all links, and few lists are left to them."""
    monkeypatch.setattr(near_dups, "LIST", 6)
    monkeypatch.setattr(near_dups, "FEW", 1)
    rng, words = np.random.default_rng(11), [f"w{i}" for i in range(120)]
    texts = [(i, " ".join([*words[: (k := int(rng.integers(0, 120)))], f"edit{i}", *words[k + 1 :]])) for i in range(30)]
    texts += [(i, " ".join(words[:60] + [f"p{j}" for j in rng.permutation(60)])) for i in range(30, 60)]
    written, write = [], near_dups.materialize
    record = lambda df, name, *rest: written.append(name) or write(df, name, *rest)
    monkeypatch.setattr(near_dups, "materialize", record)
    monkeypatch.setattr(links_module, "materialize", record)
    rows = near_dups.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute_components(texts)
    assert written.count("near-links") == 1 and written.count("components") <= 5 and len(written) <= 45, written


def test_near_duplicates_deal_out_only_differences_that_others_share(spark, monkeypatch):
    """Edits of one text, each with words of its own, and a family too far from it to link: unique words and sets that nothing outside is near to make no rows."""
    monkeypatch.setattr(near_dups, "LIST", 6)
    monkeypatch.setattr(near_dups, "FEW", 1)
    rng, words = np.random.default_rng(13), [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        own = list(words) if i < 40 else [*words[:90], *(f"o{k}" for k in range(30))]
        for k in range(i % 3 + 1):
            own[int(rng.integers(90))] = f"edit{i}_{k}"
        texts.append((i, " ".join(own)))
    dealt, prefixes = [], near_dups._prefixes

    def record(sets, most):
        dealt.append(sets.where("g <> 0").selectExpr("sum(size(vals))").first()[0] or 0)
        return prefixes(sets, most)

    monkeypatch.setattr(near_dups, "_prefixes", record)
    rows = near_dups.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == jaccard_groups(texts, (85, 100))
    assert dealt and sum(dealt) <= 3000, dealt


def test_few_links_are_one_partition(spark, monkeypatch):
    """A step over few links is a task, not one for each shuffle partition; many are dealt out, with the same result."""
    links = [(i, i + 1) for i in range(30)] + [(50, 51), (60, 51)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long").repartition(3)
    found, files = [], []
    with_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "5"}
    before = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        for rows in (links_module.TOGETHER, 3):
            monkeypatch.setattr(links_module, "TOGETHER", rows)
            known = components(frame(links))
            further = joined_further(known, frame([(31, 30), (70, 60)]))
            found.append([sorted((r.id, r.component) for r in df.collect()) for df in (known, further)])
            files.append([len(df.inputFiles()) for df in (known, further)])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] and files[0] == [1, 1] and min(files[1]) > 1
    assert dict(found[0][1])[31] == 0 and dict(found[0][1])[70] == 50


def test_few_links_are_one_job(spark, monkeypatch):
    """A chain, whose stars take several turns: the links and the components are all that is written."""
    written, write = [], links_module.materialize
    monkeypatch.setattr(links_module, "materialize", lambda df, name, *rest: written.append(name) or write(df, name, *rest))
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long").repartition(3)
    known = components(frame([(i, i + 1) for i in range(40)] + [(-5, None)]))
    assert {(r.id, r.component) for r in known.collect()} == {(i, 0) for i in range(41)} and written == ["links", "components"]
    further = joined_further(known, frame([(40, -9), (90, 91)]))
    want = {(i, -9) for i in [-9, *range(41)]} | {(90, 90), (91, 90)}
    assert {(r.id, r.component) for r in further.collect()} == want and written == ["links", "components"] * 2
    assert components(frame([(3, 3), (None, 4)])).count() == 0


def test_sets_are_not_sent_through_the_driver(spark):
    """Joins of tables that hold arrays: Spark's estimate of their size is far too low."""
    sets = spark.range(4).selectExpr("id", "id AS sid", "id + 2 AS n", "array(1L, 2L, id) AS vals")
    lists = sets.selectExpr("id % 2 AS v", "sid", "id", "n", "id AS own", "0L AS home")
    pairs = spark.createDataFrame([(0, 1), (2, 3)], "a long, b long")
    for df in (near_dups._with_sets(pairs, sets), near_dups._all_across(lists, near_dups.Rule())):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_packing(docs, none):
    encode = library()
    rows = packing.pack(docs, PATH, end_id=1, with_ids=True).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows)
    want = Counter()
    for i, t in TEXTS:
        ids = [*encode(t), 1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            want[i, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert got == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()] and sum(n for _, n in places) <= 4096
    assert len(by) <= -(-sum(r.length for r in rows) // 4096) + 1
    assert packing.pack(none, PATH).count() == 0


def test_bins_close_the_fullest_first():
    bins = packing.Bins(10, 2, 0)
    assert [list(bins.put(n, (n,))) for n in (6, 7)] == [[], []]
    (closed,) = bins.put(8, (8,))
    assert closed == [1, ((7,), 0)]
    (full,) = bins.put(2, (2,))
    assert full == [2, ((8,), 0), ((2,), 8)]


def test_wavelet_shards(docs, none, spark):
    encode = library()
    files = wavelet.write_shards(docs, PATH, end_id=2, shard_tokens=5000)
    rows = wavelet.read_shards(files).collect()
    want = Counter((i, len(encode(t)) + 1, zlib.crc32(np.array([*encode(t), 2], "<u4").tobytes())) for i, t in TEXTS)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    assert wavelet.read_shards(wavelet.write_shards(none, PATH)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 65536, 70001])
def test_wavelet_queries(n, tmp_path):
    ids = np.random.default_rng(n).integers(0, 300, n).astype(np.uint16)
    path = tmp_path / "s.wmx"
    path.write_bytes(wavelet.write_shard(ids, [3] if n else [], np.array([0, n]) if n else np.array([0])))
    with open_file(str(path)) as source:
        shard = wavelet.Shard(source)
        assert (shard.ids() == ids).all()
        for i in range(0, n, 7001):
            assert shard.access(i) == ids[i]
        for token in (0, 5, 299, 400, 70000):
            assert shard.count(token, n // 3, n) == int((ids[n // 3 :] == token).sum())
            assert list(shard.occurrences(token, 0, n // 4)) == np.flatnonzero(ids[: n // 4] == token).tolist()


def test_mix_targets_and_copies(docs, none, spark):
    rows = mixing.mix(docs).collect()
    sizes = Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in TEXTS)
    assert Counter((r.doc_id, r.size) for r in rows) == sizes
    total = sum(r.size for r in rows)
    source = {r.source: (r.source_size, r.target) for r in rows}
    weight = {s: k % 3 + 1.0 for k, s in enumerate(sorted(source, key=lambda s: (s is None, s or "")))}
    open_, left, goal = set(source), float(total), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * source[s][0]}
        if not over:
            break
        goal |= {s: 3.0 * source[s][0] for s in over}
        left -= sum(goal[s] for s in over)
        open_ -= over
    goal |= share
    for s, (_, target) in source.items():
        assert target == pytest.approx(goal[s])
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rows)
    assert mixing.mix(none).count() == 0
    again = {(r.doc_id, r.size): r.taken for r in mixing.mix(docs.repartition(2)).collect()}
    assert again == {(r.doc_id, r.size): r.taken for r in rows}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


def test_mix_meets_targets(spark):
    rows = [(i, " ".join("w" * (1 + i % 40)), f"s{i % 7}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("goal")).collect()
    assert all(abs(r.t - r.goal) <= 0.005 * r.goal for r in got)


def test_exact_topk(spark):
    rng = np.random.default_rng(1)
    vecs = [(i, [float(x) for x in rng.normal(size=8) * (1 + i % 5)]) for i in range(300)]
    vecs += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (304, []), (305, vecs[0][1]), (None, vecs[1][1]), (7, vecs[7][1])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    rows = df.where(exact_topk.usable(F.col("embedding"))).select("vec_id", exact_topk.quantised(F.col("embedding")).alias("v"))
    old, exact_topk.BLOCK = exact_topk.BLOCK, 50
    try:
        got = exact_topk.top_k(rows, rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"))).collect()
        assert exact_topk.top_k(rows.where("false"), rows.where("false").select(F.col("vec_id").alias("query_id"))).count() == 0
    finally:
        exact_topk.BLOCK = old
    full = {i: [int(np.floor(256 * x)) for x in v] + [0] * (8 - len(v)) for i, v in vecs if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in full if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(full[q], full[i])), i) for i in full if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200 + "</p>\r\n\r\nWARC/1.1\r\n"
    pages = [(5, "http://a/é", big), (3, None, big), (9, "u\r\nv", None), (8, "u", ""), (7, "w", "short"), (6, "w", "short"), (None, "n", big), (11, "h", "ä" * 300000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, type int").repartition(3)
    got = warc.page_captures(df).collect()
    want = set()
    for i, _, h in pages:
        data = (h or "").encode()
        revisit = h == big and i != 3
        want.add((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_page) for r in got} == want and len(got) == len(pages)
    assert all(len(r.requests) == 1 and len(r.metadata) == 1 for r in got)
    read = warc.read_archives(warc.write_archives(df)).where("type = 'response'").collect()
    assert {bytes(r.payload).decode() for r in read} == {h or "" for _, _, h in pages}
    assert warc.page_captures(df.where("false")).count() == 0


def test_transactions_linked_either_way(spark):
    rows = [("r", "response", ["q"]), ("q", "request", []), ("m", "metadata", ["q"]), ("x", "metadata", ["nowhere"]), ("s", "response", [])]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], "record_id string, type string, concurrent_to array<string>, url string, date string, about string")
    got = {r.record_id: ([x.record_id for x in r.requests or []], [x.record_id for x in r.metadata or []]) for r in warc.captures(df).collect()}
    assert got == {"r": (["q"], ["m"]), "s": ([], [])}


def test_quotation_linking(spark):
    rows = [
        (1, 0, "u", "Hello there.\nHow are you?"), (1, 1, "a", "On Monday Bob wrote:\n\n> hello   THERE.\n> How are you?\n\nFine, thanks."),
        (1, 2, "u", ">> Hello there.\n> Fine, thanks.\nGood to hear."), (1, 3, "u", "Unrelated"), (1, 4, "x", "> Good to hear.\nyes"),
        (2, 0, "u", None), (2, 1, "u", "> Hello there."), (None, 1, "u", "> a"), (2, 1, "u", "> Hello there."), (2, 2, "u", ""),
    ]
    df = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, level string")
    got = quotes.conversations(df)
    by = {(r.conv_id, r.turn): (r.reply_to, r.root, r.depth, r.own_text) for r in got.collect()}
    assert got.count() == len(rows) and got.columns[:5] == df.columns
    assert by[1, 1] == (0, 0, 1, "Fine, thanks.") and by[1, 2] == (1, 0, 2, "Good to hear.") and by[1, 4] == (2, 0, 3, "yes")
    assert by[1, 3] == (None, 3, 0, "Unrelated") and by[2, 0] == (None, 0, 0, None) and by[2, 1] == (None, 1, 0, "") and by[None, 1][:3] == (None, 1, 0)
    assert quotes.conversations(df.where("false")).count() == 0
    # columns named as the operator's own, and a struct with odd field names
    clash = df.withColumns({c: F.lit(c) for c in ("root", "Depth", "reply_to", "own_text")}).withColumn("odd", F.struct(F.lit(1).alias("a b"), F.lit(2).alias("x:y")))
    more = quotes.conversations(clash)
    assert more.columns == [*df.columns, "in_root", "in_Depth", "in_reply_to", "in_own_text", "odd", *quotes.OWN]
    assert {(r.conv_id, r.turn): (r.reply_to, r.root, r.depth, r.own_text) for r in more.collect()} == by
    assert {(r.in_root, r.in_Depth, r.in_reply_to, r.in_own_text, r.odd["x:y"]) for r in more.collect()} == {("root", "Depth", "reply_to", "own_text", 2)}


def test_language_id_held_out(spark, none):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "12 !?", "en"), (10**6 + 2, "", None), (None, "the and of", "en")], "doc_id long, text string, lang string")
    rows = language_id.identify(docs.unionByName(odd)).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    held = [r for r in rows if r.held_out and r.lang]
    assert len(rows) == docs.count() + 4 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in rows if r.doc_id in range(10**6, 10**6 + 3))
    assert all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify(none).count() == 0 and language_id.known_language(none).count() == 0


def test_calibration():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 900)
    logits = rng.normal(0, 0.3, (900, 3)) + 2.5 * np.eye(3)[labels]
    t, least = language_id.calibrate(logits, labels)
    prob = language_id._softmax(logits / t)
    right = prob.argmax(axis=1) == labels
    # a floor above 0 that costs next to none of the right answers
    assert 0.3 < least and (prob.max(axis=1)[right] < least).mean() <= 0.002
    # wrong answers, few or none held back: the floor goes down, never up to everything
    mixed = language_id.calibrate(logits, rng.permutation(labels))[1]
    assert mixed <= 1 and language_id.calibrate(logits[:9], labels[:9])[1] < 0.1
    assert language_id.calibrate(logits[:0], labels[:0])[1] == 0.0
    assert language_id.calibrate(np.array([[9.0, 0.0]]), np.array([1]))[1] == 0.0


def test_weak_labels(spark, none):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (None, "x")], "doc_id long, text string")
    got = weak_labels.quality(docs.unionByName(odd))
    truth = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = got.join(truth, "doc_id").collect()
    assert got.count() == docs.count() + 3 and sum(r.kept == bool(r.quality) for r in rows) >= 0.9 * len(rows)
    assert weak_labels.quality(none).count() == 0


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.7
    acc = [0.95, 0.9, 0.8, 0.7, 0.6, 0.85, 0.75, 0.65]
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int) for a in acc], axis=1)
    votes[rng.random(votes.shape) < 0.3] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, rates, _ = weak_labels.estimate(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.03
    assert np.abs(np.array(list(weak_labels.accuracies(share, rates).values())) - acc).max() < 0.04
