"""Quality from weak labels: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Labellers vote good, bad or nothing on a whole text. All documents' votes are
counted by vote pattern (at most 3 ** labellers patterns, so the counts fit
anywhere); expectation-maximisation over the patterns estimates each labeller's
confusion rates and the share of good texts without any true label. A pattern's
posterior is then the label of its documents, and a linear scorer over hashed
4-byte grams and vote features learns from a bounded sample of them (``SAMPLE``
documents of least id hash in each of good and bad, ``GRAMS`` grams of each).

Null, empty and blank texts get no votes but ``few words``; their score comes
from that. Documents alike in text score alike, repeated or not. Rows with a null
id are scored and not trained on. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlog.llm.words import bucket_sums, chunks, gram_buckets
from wearlog.session import materialize

SAMPLE = 4000
GRAMS = 512
BITS = 18
EPOCHS = 6
RATE = 0.5
# Below or above which a value speaks for a bad or a good text: (bad if under, bad if over, good from, good to).
LABELLERS = {
    "capitals": (None, 0.2, 0.002, 0.08),
    "marks": (None, 0.08, 0.008, 0.06),
    "variety": (0.35, None, 0.45, 1.0),
    "endings": (0.5, None, 0.9, 1.0),
    "word_length": (3.0, 9.5, 4.0, 8.0),
    "commonest": (None, 0.25, 0.0, 0.12),
    "repeated_lines": (None, 0.3, 0.0, 0.1),
    "few_words": (3.0, None, 20.0, float("inf")),
}
NAMES = list(LABELLERS)
END = (".", "!", "?", '"', "”", "»", ":", ";", "…")


def measures(text: str | None) -> list[float | None]:
    """The labellers' values of a text; None where there is nothing to measure."""
    words = (text or "").split()
    if not words:
        return [None] * (len(NAMES) - 1) + [0.0]
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    n, chars = len(words), sum(map(len, words))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    upper = sum(map(str.isupper, text)) if chars < 64 else len(text) - len(_without_capitals(text))
    marks = chars - sum(len(w) for w in _WORDS.findall(text))
    # long texts repeat words anyway: variety is of the expected share, by the square root beyond 1,000 words
    variety = min(1.0, len(counts) / n * max(1.0, (n / 1000) ** 0.5))
    return [
        upper / chars, marks / chars, variety, sum(x.endswith(END) for x in lines) / len(lines), chars / n,
        max(counts.values()) / n if n >= 20 else None, 1 - len(set(lines)) / len(lines) if len(lines) > 1 else None, float(n),
    ]


_WORDS = re.compile(r"\w+")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def _without_capitals(text: str) -> str:
    return _CAPITALS.sub("", text)


def vote(name: str, value: float | None) -> int:
    """1 good, 0 bad, -1 nothing."""
    under, over, low, high = LABELLERS[name]
    if value is None:
        return -1
    if under is not None and value < under or over is not None and value > over:
        return 0
    return 1 if low <= value <= high else -1


def estimate(patterns: np.ndarray, counts: np.ndarray, turns: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1): share of good texts, rates[labeller, class, vote + 1], posteriors of good.

    Starts from the majority; every labeller starts better than chance, which fixes which class is good.
    """
    n, m = patterns.shape
    total = max(float(counts.sum()), 1.0)
    good, bad = (patterns == 1).sum(1), (patterns == 0).sum(1)
    post = np.clip((good + 1) / (good + bad + 2), 0.05, 0.95)
    post = np.where(bad * 2 >= good + bad, np.minimum(post, 0.3), post) if n else post
    share, rates = 0.5, np.full((m, 2, 3), 1 / 3)
    for _ in range(turns):
        share = float(np.clip((counts * post).sum() / total, 1e-3, 1 - 1e-3))
        for j in range(m):
            for v in (-1, 0, 1):
                is_v = (patterns[:, j] == v) * counts
                rates[j, 1, v + 1] = ((is_v * post).sum() + 0.5) / ((counts * post).sum() + 1.5)
                rates[j, 0, v + 1] = ((is_v * (1 - post)).sum() + 0.5) / ((counts * (1 - post)).sum() + 1.5)
        score = np.full(n, np.log(share / (1 - share)))
        for j in range(m):
            score += np.log(rates[j, 1, patterns[:, j] + 1] / rates[j, 0, patterns[:, j] + 1])
        new = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        if n == 0 or np.abs(new - post).max() < 1e-9:
            return share, rates, new
        post = new
    return share, rates, post


def accuracies(share: float, rates: np.ndarray) -> dict[str, float]:
    """Each labeller's share of right votes among its votes."""
    right = share * rates[:, 1, 2] + (1 - share) * rates[:, 0, 1]
    cast = right + share * rates[:, 1, 1] + (1 - share) * rates[:, 0, 2]
    return dict(zip(NAMES, (right / cast).tolist(), strict=True))


def _votes(batches):
    for batch in batches:
        rows = [[vote(n, v) for n, v in zip(NAMES, measures(t), strict=True)] for t in batch.column(1).to_pylist()]
        key = ["".join("-01"[v + 1] for v in r) for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.string())], names=["doc_id", "votes"])


def _features(votes: str) -> list[int]:
    """Buckets of the votes, past those of the grams."""
    return [(1 << BITS) + 3 * j + "-01".index(v) for j, v in enumerate(votes)]


def fit(rows: list[tuple[str, np.ndarray, float]], seed: int = 5) -> tuple[np.ndarray, float]:
    """Logistic regression by SGD on (votes, grams, posterior): weights of the buckets, bias."""
    rng = np.random.default_rng(seed)
    w, bias, seen = np.zeros((1 << BITS) + 3 * len(NAMES)), 0.0, 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            votes, grams, target = rows[i]
            own = _features(votes)
            x = bias + w[own].sum() + (w[grams].mean() if len(grams) else 0.0)
            gap = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - target
            rate = RATE / (1 + seen / 20000)
            bias -= rate * 0.1 * gap
            w[own] -= rate * 0.1 * gap
            if len(grams):
                np.subtract.at(w, grams, rate * 20 * gap / len(grams))
            seen += 1
    return w, bias


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, votes, posterior (of the label model), score (of the linear scorer), kept."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cast = materialize(slim.mapInArrow(_votes, "doc_id long, votes string"), "weak-votes")
    counted = sorted((r.votes, r["count"]) for r in cast.groupBy("votes").count().collect())
    patterns = np.array([["-01".index(c) - 1 for c in p] for p, _ in counted], int).reshape(len(counted), len(NAMES))
    _, _, post = estimate(patterns, np.array([c for _, c in counted], float))
    posterior = dict(zip([p for p, _ in counted], post.tolist(), strict=True))
    sure = [p for p, x in posterior.items() if x >= 0.5]
    side = F.col("votes").isin(sure)
    place = F.row_number().over(Window.partitionBy("good").orderBy(F.xxhash64("doc_id"), "doc_id"))
    pool = cast.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "votes"]).withColumn("good", side).withColumn("place", place).where(F.col("place") <= SAMPLE)

    def sample(batches):
        for batch in batches:
            for first, end, raw, bounds in chunks(batch.column(1)):
                grams, sizes = gram_buckets(raw, bounds, 4, BITS)
                at = np.cumsum(sizes) - sizes
                took = [grams[a + (np.arange(min(k, GRAMS)) * k) // max(1, min(k, GRAMS))].astype(np.int32) for a, k in zip(at.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(took, pa.list_(pa.int32()))], names=["doc_id", "grams"])

    # at most 2 * SAMPLE short rows: bounded, so the texts need not be shuffled to meet them
    pool = F.broadcast(materialize(pool.select("doc_id", "votes"), "weak-sample"))
    texts = slim.join(pool.select("doc_id"), "doc_id", "left_semi").mapInArrow(sample, "doc_id long, grams array<int>")
    rows = sorted((r.doc_id, r.votes, r.grams) for r in texts.join(pool.select("doc_id", "votes"), "doc_id").collect())
    w, bias = fit([(v, np.array(g, np.int64), posterior[v]) for _, v, g in rows])
    weights, extra = w[: 1 << BITS].astype(np.float32)[None, :], w

    def score(batches):
        for batch in batches:
            for first, end, raw, bounds in chunks(batch.column(1)):
                grams, sizes = gram_buckets(raw, bounds, 4, BITS)
                x = bucket_sums(weights, grams, sizes)[:, 0] / np.maximum(sizes, 1)
                texts = batch.column(1).slice(first, end - first).to_pylist()
                votes = ["".join("-01"[vote(n, v) + 1] for n, v in zip(NAMES, measures(t), strict=True)) for t in texts]
                x += [bias + extra[_features(v)].sum() for v in votes]
                prob = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(votes, pa.string()), pa.array([posterior[v] for v in votes], pa.float64()), pa.array(prob, pa.float64()), pa.array(prob >= 0.5, pa.bool_())],
                    names=["doc_id", "votes", "posterior", "score", "kept"],
                )

    return slim.mapInArrow(score, "doc_id long, votes string, posterior double, score double, kept boolean")
