"""Quality rules: base limits, then robust multivariate outliers per language and source.

Every whole text gives counts (below). A text fails the base limits with fewer
than ten words, or when over a fifth of its words lie in five-word windows that
the text has twice or more. The others become vectors: the logarithm of the mean
word length, and the square roots of three shares (symbols of word characters,
repeated lines per word, repeated words of words), all but the first within 0 to 1.

Each cell (language and source; the whole language, or all documents, where fewer
than ``LEAST`` rows are left) gets a minimum-covariance-determinant estimate: from
three deterministic starts, concentration steps take the ``SUPPORT`` share of the
cell with the least Mahalanobis distances and estimate centre and scatter from it,
until the determinant settles; the least determinant wins, and one reweighting
follows. A text is rejected when its distance from its cell's centre is beyond the
chi-square quantile ``LEVEL``. ``NOISE`` is added to the variances, so that a cell
whose texts have no symbols at all rejects nobody for a single one.

All rows take part. Vectors are counted on a grid of ``STEP`` first, so steps run
over distinct grid points with counts, not over documents, and a cell with a third
of all rows is no larger a task than another. Steps are aggregates by distance
bucket (a bucket is taken whole, so the support may exceed its share a little).

Null text counts as empty. Null languages and sources are values of their own.
Rows that repeat an id are judged each by its text. A table with fewer than
``LEAST`` rows within the limits has no estimate: the base limits alone decide.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlog.llm.words import WHITE, chunks, hash_spans, mix, spans
from wearlog.session import materialize

WINDOW = 5
LEAST_WORDS = 10
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Columns of the vector with the standard deviation that counts as noise in each.
NOISE = {"x_word_length": 0.05, "x_symbols": 0.05, "x_dup_lines": 0.1, "x_repeats": 0.1}
STEP = 0.01
LEAST = 100
SUPPORT = 0.75
WEIGHTED = 0.975
LEVEL = 1 - 1e-6
STEPS = 30
#: Less than this off every logarithm of a determinant ends the steps.
SETTLED = 1e-4
#: Distance buckets to an octave.
OCTAVE = 16

_X = list(NOISE)
_P = len(_X)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_TURN = np.array([2 * j + 3 for j in range(WINDOW)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a window of five found twice or more in the text."""
    covered = np.zeros(len(words), bool)
    n = len(words) - WINDOW + 1
    if n > 0:
        text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        grams = mix(text[:n].astype(np.uint64) + np.uint64(1))
        for j in range(WINDOW):
            grams += words[j : j + n] * _TURN[j]
        at = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
        at = at[np.argsort(mix(grams[at]), kind="stable")]
        same = (grams[at[1:]] == grams[at[:-1]]) & (text[at[1:]] == text[at[:-1]])
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        for j in range(WINDOW):
            covered[at[twice] + j] = True
    return _per_text(covered, cuts)


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, raw, bounds in chunks(batch.column(0)):
            starts, lens = spans(raw, bounds)
            cuts = np.searchsorted(starts, bounds)
            ink = ~WHITE[raw]
            whole = raw.tobytes()
            cols = [
                np.diff(cuts),
                _per_text(ink & ((raw & 0xC0) != 0x80), bounds),
                _per_text(SYMBOLS[raw], bounds),
                np.array([repeated_lines(whole[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], np.int64),
                repeated_words(hash_spans(raw, starts, lens), cuts),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(first, end - first) for k in (1, 2, 3)), *(pa.array(c, pa.int64()) for c in cols)],
                names=["doc_id", "lang", "source", *_COUNTS],
            )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, lang, source, the five counts, base_failed and the vector."""
    slim = docs.select(
        F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source")
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    rows = slim.mapInArrow(_counted, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS))
    words = F.col("n_words")
    share = lambda c, of: F.sqrt(F.col(c) / F.col(of))
    vector = [F.log(F.col("word_chars") / words), share("n_symbols", "word_chars"), share("n_dup_lines", "n_words"), share("n_repeat_words", "n_words")]
    failed = (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * words)
    rows = rows.withColumn("base_failed", failed)
    return rows.select("*", *(F.when(~F.col("base_failed"), x).alias(c) for c, x in zip(_X, vector, strict=True)))


# chi-square with 4 and 6 degrees of freedom in closed form (four is the vector's length, six corrects its variances)
def _chi4(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def _chi6(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def quantile(share: float) -> float:
    """Of chi-square with four degrees of freedom."""
    low, high = 0.0, 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi4(mid) < share else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the scatter of the nearest ``share`` of normal vectors is multiplied by."""
    return share / _chi6(quantile(share)) if share < 1 else 1.0


def _d2() -> Column:
    """Mahalanobis distance squared of x from the centre ``mu`` by the inverse scatter ``inv`` (upper triangle)."""
    off = [F.col(c) - F.col("mu")[i] for i, c in enumerate(_X)]
    return F.greatest(sum((1 if i == j else 2) * off[i] * off[j] * F.col("inv")[k] for k, (i, j) in enumerate(_PAIRS)), F.lit(0.0))


_PARAMS = "cell string, start int, mu array<double>, inv array<double>, logdet double"


def _frame(cell, start, mu: np.ndarray, scatter: np.ndarray) -> pd.DataFrame:
    scatter = scatter + np.diag(np.array(list(NOISE.values())) ** 2)
    inv, det = np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1]
    upper = np.stack([inv[:, i, j] for i, j in _PAIRS], axis=1) if len(inv) else np.zeros((0, len(_PAIRS)))
    return pd.DataFrame({"cell": cell, "start": start, "mu": list(mu), "inv": list(upper), "logdet": det})


def _full(upper: np.ndarray) -> np.ndarray:
    out = np.zeros((len(upper), _P, _P))
    for k, (i, j) in enumerate(_PAIRS):
        out[:, i, j] = out[:, j, i] = upper[:, k]
    return out


def _sums(n: str = "n") -> list[Column]:
    first = [F.sum(F.col(n) * F.col(c)).alias(f"s{i}") for i, c in enumerate(_X)]
    return [F.sum(n).alias("n"), *first, *(F.sum(F.col(n) * F.col(_X[i]) * F.col(_X[j])).alias(f"s{i}{j}") for i, j in _PAIRS)]


def _resum() -> list[Column]:
    return [F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(_P)), *(F.sum(f"s{i}{j}").alias(f"s{i}{j}") for i, j in _PAIRS)]


def _estimates(sums: DataFrame, factor: float) -> DataFrame:
    """Centre and scatter (times ``factor``) from each row's sums."""

    def solve(frames):
        for f in frames:
            n = f["n"].to_numpy(float)[:, None]
            mu = f[[f"s{i}" for i in range(_P)]].to_numpy(float) / n
            second = f[[f"s{i}{j}" for i, j in _PAIRS]].to_numpy(float) / n
            centred = second - np.stack([mu[:, i] * mu[:, j] for i, j in _PAIRS], axis=1)
            yield _frame(f["cell"], f["start"], mu, _full(centred) * factor)

    return sums.mapInPandas(solve, _PARAMS)


def _starts(points: DataFrame) -> DataFrame:
    """Three estimates a cell to start from: scales alone, with hyperbolic tangents' correlations, with spatial signs'."""
    middle = points.groupBy("cell").agg(*(F.percentile(c, F.lit(0.5), F.col("n")).alias(f"m{i}") for i, c in enumerate(_X)))
    gaps = points.join(middle, "cell")
    spread = gaps.groupBy("cell").agg(
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(_P)),
        *((F.percentile(F.abs(F.col(c) - F.col(f"m{i}")), F.lit(0.5), F.col("n")) * 1.4826).alias(f"d{i}") for i, c in enumerate(_X)),
    )
    scales = [F.greatest(F.col(f"d{i}"), F.lit(noise)) for i, noise in enumerate(NOISE.values())]
    z = points.join(spread, "cell").select("*", *(((F.col(c) - F.col(f"m{i}")) / scales[i]).alias(f"z{i}") for i, c in enumerate(_X)))
    norm = sum(F.col(f"z{i}") * F.col(f"z{i}") for i in range(_P))
    bent = lambda i, j: F.sum(F.col("n") * F.tanh(f"z{i}") * F.tanh(f"z{j}"))
    sign = lambda i, j: F.sum(F.col("n") * F.when(F.col("norm") > 0, F.col(f"z{i}") * F.col(f"z{j}") / F.col("norm")).otherwise(0.0))
    sums = z.withColumn("norm", norm).groupBy("cell").agg(
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(_P)), *(F.first(scales[i]).alias(f"d{i}") for i in range(_P)),
        *(bent(i, j).alias(f"b{i}{j}") for i, j in _PAIRS), *(sign(i, j).alias(f"g{i}{j}") for i, j in _PAIRS),
    )

    def solve(frames):
        for f in frames:
            mu, scale = f[[f"m{i}" for i in range(_P)]].to_numpy(float), f[[f"d{i}" for i in range(_P)]].to_numpy(float)
            both = scale[:, :, None] * scale[:, None, :]
            for start, name in enumerate(("", "b", "g")):
                alike = np.broadcast_to(np.eye(_P), both.shape)
                if name:
                    rough = _full(f[[f"{name}{i}{j}" for i, j in _PAIRS]].to_numpy(float))
                    own = np.sqrt(np.maximum(np.diagonal(rough, axis1=1, axis2=2), 1e-12))
                    alike = np.where(np.eye(_P, dtype=bool), 1.0, rough / (own[:, :, None] * own[:, None, :]))
                yield _frame(f["cell"], start, mu, both * alike)

    return sums.mapInPandas(solve, _PARAMS)


def _concentrate(points: DataFrame, params: DataFrame) -> DataFrame:
    """One step of all cells and starts: estimates from the nearest ``SUPPORT`` of each cell."""
    keys = Window.partitionBy("cell", "start")
    bucket = F.floor(OCTAVE * F.log2(F.col("d2") + 1e-9))
    near = points.join(params.select("cell", "start", "mu", "inv"), "cell").withColumn("d2", _d2())
    by = near.withColumn("bucket", bucket).groupBy("cell", "start", "bucket").agg(*_sums())
    before = F.coalesce(F.sum("n").over(keys.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = by.withColumn("before", before).withColumn("all", F.sum("n").over(keys)).where(F.col("before") < SUPPORT * F.col("all"))
    return _estimates(inside.groupBy("cell", "start").agg(*_resum()), 1.0)


def robust_estimates(points: DataFrame) -> DataFrame:
    """Centre ``mu`` and inverse scatter ``inv`` of each cell of points (cell, vector, n)."""
    params = materialize(_starts(points), "mcd-starts")
    for _ in range(STEPS):
        last, params = params, materialize(_concentrate(points, params), "mcd-step")
        moved = params.join(last.select("cell", "start", F.col("logdet").alias("was")), ["cell", "start"]).agg(F.max(F.col("was") - F.col("logdet"))).first()[0]
        if moved is None or moved < SETTLED:
            break
    best = params.groupBy("cell").agg(F.min(F.struct("logdet", "start")).alias("b")).select("cell", F.col("b.start").alias("start"))
    best = params.join(best, ["cell", "start"])
    # the support's scatter is too small by a known factor: distances shrink by it
    near = points.join(best.select("cell", "start", "mu", "inv"), "cell").where(_d2() <= quantile(WEIGHTED) * consistency(SUPPORT))
    return materialize(_estimates(near.groupBy("cell", "start").agg(*_sums()), consistency(WEIGHTED)), "mcd-final")


def _cell(*parts) -> Column:
    return F.to_json(F.array(*(p if isinstance(p, Column) else F.lit(p) for p in parts)))


def outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``text_statistics`` with the cell whose estimate judged the text, its distance squared and kept."""
    rows = materialize(text_statistics(docs, id_col, text_col, lang_col, source_col), "mcd-statistics")
    own, wide, all_ = _cell("own", F.col("lang"), F.col("source")), _cell("lang", F.col("lang")), _cell("all")
    grid = [(F.round(F.col(c) / STEP) * STEP).alias(c) for c in _X]
    fine = rows.where("NOT base_failed").select(own.alias("own"), wide.alias("wide"), *grid).groupBy("own", "wide", *_X).agg(F.count("*").alias("n"))
    fine = materialize(fine, "mcd-points")
    level = lambda c: fine.groupBy(c).agg(F.sum("n").alias(f"n_{c}"))
    sizes = fine.groupBy("own", "wide").agg(F.sum("n").alias("n_own")).join(level("wide"), "wide")
    total = fine.agg(F.sum("n")).first()[0] or 0
    use = F.when(F.col("n_own") >= LEAST, F.col("own")).when(F.col("n_wide") >= LEAST, F.col("wide")).when(F.lit(total >= LEAST), all_)
    cells = materialize(sizes.select("own", use.alias("cell")), "mcd-cells")
    used = cells.select("cell").distinct()
    points = fine.select(F.explode(F.array("own", "wide", all_)).alias("cell"), *_X, "n").join(used, "cell", "left_semi")
    points = materialize(points.groupBy("cell", *_X).agg(F.sum("n").alias("n")), "mcd-points")
    params = cells.join(robust_estimates(points).select("cell", "mu", "inv"), "cell").select("own", "cell", "mu", "inv")
    judged = rows.withColumn("own", own).join(params, "own", "left").withColumn("distance2", F.when(~F.col("base_failed"), _d2()))
    kept = ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= quantile(LEVEL))
    return judged.select("doc_id", "lang", "source", *_COUNTS, "base_failed", *_X, "cell", "distance2", kept.alias("kept"))
