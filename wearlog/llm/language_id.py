"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean embedding of its hashed 3- and 4-byte grams (letters in lower
case, other ASCII as blanks), and a linear softmax names the language. Both are
trained by stochastic gradient descent in numpy on a bounded sample: at most
``PER_LANG`` labelled texts of a language (least hashes of the id), at most
``GRAMS`` evenly spread grams of each. A fifth of the sample is held back: it
sets the softmax's temperature and the rejection threshold: the score that nearly
all right answers to held-back texts reach (see ``calibrate``).

Prediction uses whole texts, and the text only. As a text's logits are linear in
its grams, a task keeps one weight per bucket and language.

Null text and text without a letter get ``und`` and score 0, and are rejected.
Without any labelled text everything is ``und``. Rows without id are never
trained on (held_out is false for them); repeated rows get equal answers. Extra
columns are ignored, or carried along by ``known_language``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlog.llm.words import LOWER, SMALL_CHUNK, bucket_sums, chunks, gram_buckets
from wearlog.session import small_batches

PER_LANG = 1500
GRAMS = 512
BITS = 16
DIM = 16
EPOCHS = 6
#: Small samples are gone over more often, until so many updates are made.
UPDATES = 1200
BATCH = 32
RATE = 2.0
#: Share of right answers that the least score may cost, and the number of held-back texts that halves it.
LOST, CAUTION = 0.002, 100
ORDERS = (3, 4)
UND = "und"
LETTER = re.compile(r"[^\W\d_]")

FOLD = LOWER.copy()
FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # languages x buckets
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Calibrated probabilities, texts x languages."""
        data = FOLD[raw]
        total, count = np.zeros((len(bounds) - 1, len(self.langs))), np.zeros(len(bounds) - 1)
        for n in ORDERS:
            grams, sizes = gram_buckets(data, bounds, n, BITS)
            total += bucket_sums(self.weights, grams, sizes)
            count += sizes
        return _softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sample_grams(raw: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Each text's grams as big-endian 32-bit integers, whose bytes sort as the numbers do."""
    data, out = FOLD[raw], [b""] * (len(bounds) - 1)
    for n in ORDERS:
        grams, sizes = gram_buckets(data, bounds, n, BITS)
        at = np.cumsum(sizes) - sizes
        for i, (a, k) in enumerate(zip(at.tolist(), sizes.tolist(), strict=True)):
            take = min(k, GRAMS // len(ORDERS))
            out[i] += grams[a + (np.arange(take) * k) // max(take, 1)].astype(">u4").tobytes()
    return out


def fit(grams: list[np.ndarray], labels: np.ndarray, n_langs: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent; returns embeddings, softmax weights, bias."""
    rng = np.random.default_rng(seed)
    emb, soft, bias = rng.normal(0, 0.1, (1 << BITS, DIM)), rng.normal(0, 0.1, (DIM, n_langs)), np.zeros(n_langs)
    turn = -(-len(grams) // BATCH)
    epochs = max(EPOCHS, -(-UPDATES // turn))
    steps, step = epochs * turn, 0
    for _ in range(epochs):
        order = rng.permutation(len(grams))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            sizes = np.array([len(grams[i]) for i in pick])
            ids, rows = np.concatenate([grams[i] for i in pick]), np.repeat(np.arange(len(pick)), sizes)
            mean = np.zeros((len(pick), DIM))
            starts = np.cumsum(sizes) - sizes
            mean[sizes > 0] = np.add.reduceat(emb[ids], starts[sizes > 0]) / sizes[sizes > 0, None]
            err = _softmax(mean @ soft + bias)
            err[np.arange(len(pick)), labels[pick]] -= 1
            rate = RATE * (1 - step / steps)
            back = (err @ soft.T) / np.maximum(sizes, 1)[:, None]
            soft -= rate * mean.T @ err / len(pick)
            bias -= rate * err.mean(axis=0)
            used, inv = np.unique(ids, return_inverse=True)
            for k in range(DIM):
                emb[used, k] -= rate * np.bincount(inv, weights=back[rows, k], minlength=len(used))
            step += 1
    return emb, soft, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, lost: float = LOST) -> tuple[float, float]:
    """The temperature of least log loss, and the least score of an answer.

    That is the score that all but ``lost`` of the right answers to held-back texts
    reach, so it costs clean texts little; with few such texts (n) it is shrunk by
    n / (n + ``CAUTION``), and without any nothing is rejected for its score.
    """
    if not len(labels):
        return 1.0, 0.0
    grid = np.geomspace(1, 50, 121)  # softer only: texts that are all right would call for none at all
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    prob = _softmax(logits / t)
    right = np.sort(prob.max(axis=1)[prob.argmax(axis=1) == labels])
    if not len(right):
        return t, 0.0
    return t, float(right[int(lost * len(right))]) * len(right) / (len(right) + CAUTION)


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """A model from the documents whose crc32(id) mod 3 is not 1 and that have a language."""
    small_batches(docs.sparkSession)
    pool = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").where("lang IS NOT NULL AND doc_id IS NOT NULL AND crc32(cast(doc_id AS string)) % 3 <> 1")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = pool.dropDuplicates(["doc_id", "lang"]).withColumn("place", place).where(F.col("place") <= per_lang).select("doc_id", "lang")

    def featurise(batches):
        for batch in batches:
            for first, end, raw, bounds in chunks(batch.column(2), SMALL_CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first), pa.array(_sample_grams(raw, bounds), pa.binary())],
                    names=["doc_id", "lang", "grams"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.join(chosen, ["doc_id", "lang"], "left_semi").mapInArrow(featurise, "doc_id long, lang string, grams binary").collect()
    rows.sort(key=lambda r: (r.lang, r.doc_id, r.grams))
    langs = sorted({r.lang for r in rows})
    if not langs:
        return Model([UND], np.zeros((1, 1 << BITS), np.float32), np.zeros(1), 1.0, 1.0)
    grams = [np.frombuffer(r.grams, ">u4").astype(np.int32) for r in rows]
    labels = np.array([langs.index(r.lang) for r in rows])
    held = np.random.default_rng(11).random(len(rows)) < 0.2
    train_on = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    emb, soft, bias = fit([grams[i] for i in train_on], labels[train_on], len(langs))
    weights = emb @ soft
    check = np.flatnonzero(held)
    logits = np.array([(weights[grams[i]].mean(axis=0) if len(grams[i]) else 0) + bias for i in check]).reshape(len(check), len(langs))
    temperature, threshold = calibrate(logits, labels[check])
    return Model(langs, np.ascontiguousarray(weights.T.astype(np.float32)), bias, temperature, threshold)


def _answers(model: Model, col: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    langs, scores = [], np.zeros(len(col))
    for first, end, raw, bounds in chunks(col, SMALL_CHUNK):
        prob = model.scores(raw, bounds)
        best = prob.argmax(axis=1)
        for i, text in enumerate(col.slice(first, end - first).to_pylist()):
            if text is None or not LETTER.search(text):
                langs.append(UND)
            else:
                langs.append(model.langs[best[i]])
                scores[first + i] = prob[i, best[i]]
    rejected = (scores < model.threshold) | np.array([x == UND for x in langs], bool)
    return langs, np.clip(scores, 0, 1), rejected


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    model = model or train(docs)
    small_batches(docs.sparkSession)

    def predict(batches):
        for batch in batches:
            langs, scores, rejected = _answers(model, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def known_language(docs: DataFrame) -> DataFrame:
    """The documents whose language is not rejected, all columns."""
    model, at = train(docs), docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            rejected = _answers(model, batch.column(at).cast(pa.string()))[2]
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)
