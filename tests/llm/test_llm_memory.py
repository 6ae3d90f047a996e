"""Memory of the Python workers of the pipeline's steps: small Arrow batches, small tables, small arrays."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from wearlog.llm import language_id, near_dups, packing, tokens
from wearlog.session import small_batches

PATH = tokens.vocabulary("word_bpe_49k.json")
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
MB = 1 << 20


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(1)
    return pa.array([" ".join(f"word{i}" for i in rng.integers(0, 3000, 1000)) for _ in range(1000)], pa.string())


def peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def test_a_worker_tokenizes_in_little_memory(texts):
    tokens.encoder.cache_clear()
    assert peak(lambda: [None for _ in tokens.encode_column(texts, PATH, 1)]) < 70


def test_a_worker_answers_and_shingles_in_little_memory(texts):
    model = language_id.Model(["a", "b"], np.zeros((2, 1 << language_id.BITS), np.float32), np.zeros(2), 1.0, 0.0)
    assert peak(lambda: language_id._answers(model, texts)) < 30
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
    assert peak(lambda: [None for _ in near_dups._sets([batch], 64)]) < 30


@pytest.fixture
def unset(spark):
    old = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    yield spark
    spark.conf.unset(LIMIT) if old is None else spark.conf.set(LIMIT, old)


def widest(df):
    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    return max(r.n for r in df.mapInArrow(size, "n long").collect())


def test_steps_get_small_batches(unset):
    docs = unset.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 500) AS text", "'en' AS lang")
    assert widest(docs) > 8 * MB
    for step in (lambda: packing.pack(docs.limit(3), PATH), lambda: near_dups.near_duplicates(docs.limit(3)), lambda: language_id.train(docs.limit(3))):
        unset.conf.unset(LIMIT)
        step()
        assert widest(docs) < 5 * MB


def test_the_sessions_own_limit_stays(unset):
    unset.conf.set(LIMIT, "1m")
    small_batches(unset)
    assert unset.conf.get(LIMIT) == "1m"


def test_sampled_grams_are_bytes_in_the_order_of_the_numbers():
    words = [b"abcd efgh", b"abc", b"", b"zyxw vuts rqpo"]
    raw, bounds = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0] + [len(w) for w in words])
    got = language_id._sample_grams(raw, bounds)
    lists = [np.frombuffer(g, ">u4").tolist() for g in got]
    assert [len(x) for x in lists] == [13, 1, 0, 23]
    assert all(0 <= v < 1 << language_id.BITS for x in lists for v in x)
    assert sorted(range(4), key=lambda i: got[i]) == sorted(range(4), key=lambda i: lists[i])
