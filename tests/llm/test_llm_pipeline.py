"""The pipeline's stages, one after another, against plain Python over a small corpus with planted copies."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from wearlog.llm import mixing
from wearlog.llm.tokens import vocabulary
from wearlog.session import materialize

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    long = max((r for r in rows if len((r[1] or "").split()) >= 60), key=lambda r: -r[0])
    words = long[1].split()[:60]
    planted = [
        (9000, " ".join(words)), (9001, " ".join([*words[:30], "otherword", *words[31:]])),  # 51 of 61 shingles
        (9002, long[1]), (9003, long[1].replace(" ", "\t ")), (9004, None), (9005, " \n"), (9006, "12 34 !"), (9007, "12 34 !"), (9006, "12 34 !"), (None, "a row without id"),
    ]
    rows += [(i, t, "en", "src1", None) for i, t in planted]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def by_row(df):
    return Counter(tuple(r) for r in df.collect())


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_kept(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    top = {i: i for i, _ in sets if i is not None}
    changed = True
    links = [(i, j) for i, s in sets for j, u in sets if None not in (i, j) and i < j and s and u and 100 * len(s & u) >= 80 * len(s | u)]
    while changed:
        changed = False
        for i, j in links:
            low = min(top[i], top[j])
            changed |= top[i] != low or top[j] != low
            top[i] = top[j] = low
    return Counter(r for r in rows if r[0] is None or top[r[0]] == r[0])


def test_stages_against_plain_python(spark, corpus):
    from tokenizers import Tokenizer

    columns, docs = corpus.columns, corpus
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF001), f"test-{name}")
        assert out.columns == columns
        before, after = by_row(docs), by_row(out)
        if name == "language_id":
            # letterless texts go, clean prose stays
            gone = before - after
            assert not after - before
            assert all(not re.search(r"[^\W\d_]", r[1] or "") for r in gone) or sum(gone.values()) < 0.05 * sum(before.values())
            assert not any(not re.search(r"[^\W\d_]", r[1] or "") for r in after)
        elif name == "exact_dedup":
            least = {}
            for r in before:
                key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
                least[key] = min(least.get(key, (True, 0)), (r[0] is None, r[0] or 0))
            want = Counter({(r[0], hashlib.md5((r[1] or "").encode()).hexdigest()): 1 for r in before if least[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")] == (r[0] is None, r[0] or 0)})
            assert len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in after}) == sum(after.values()) == len(least)
            assert {(r[0], hashlib.md5((r[1] or "").encode()).hexdigest()) for r in after} <= set(want)
        elif name == "near_dedup":
            assert after == near_kept(list(before.elements()))
            assert 9001 not in {r[0] for r in after}
        else:
            assert set(after) <= set(before)
            size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
            targets = {r.source: r.target for r in mixing.mix(docs).select("source", "target").distinct().collect()} if "source" in mixing.mix(docs).columns else None
            taken, held = defaultdict(int), defaultdict(int)
            for r, n in after.items():
                taken[r[3]] += n * size(r)
                assert n <= 3 * before[r]
            for r, n in before.items():
                held[r[3]] += n * size(r)
            order = sorted(held, key=lambda s: (s is None, s or ""))
            weights = {s: k % 3 + 1 for k, s in enumerate(order)}
            total, full = sum(held.values()), {}
            while True:
                rest = [s for s in order if s not in full]
                share = (total - sum(full.values())) / sum(weights[s] for s in rest) if rest else 0
                over = [s for s in rest if share * weights[s] > 3 * held[s]]
                if not over:
                    break
                full |= {s: 3 * held[s] for s in over}
            want = {s: full.get(s, share * weights[s]) for s in order}
            if targets:
                assert all(abs(targets[s] - want[s]) < 1e-6 * max(1, want[s]) for s in order)
            assert all(abs(taken[s] - want[s]) <= 0.1 * want[s] + 400 for s in order)
        docs = out
    tool = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter()
    for r, n in by_row(docs).items():
        ids = [*tool.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(r[0], k // 4096, k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))] += n
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    rooms = defaultdict(list)
    for r in packed:
        rooms[r.sequence_id].append((r.offset, r.length))
    for parts in rooms.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 4096


def test_no_documents(spark, corpus):
    docs = corpus.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF001), f"none-{name}")
        assert out.count() == 0
        docs = out if name != corpus_pipeline.STAGES[-1][0] else docs
