"""Quality rules: counts against regular expressions, estimates against plain numpy, planted outliers, nasty rows."""

import re

import numpy as np
import pandas as pd
import pytest

from wearlog.llm import outliers

DOCS = "doc_id long, text string, lang string, source string, n_words int, cell string, own string, kept string"
WORDS = r"[^\x20\x09-\x0D]+"
PHRASE = "one two three four five"
TEXTS = [
    None, "", " \t\n", "word", "a b c d e f g h i j", "a b c d e f g h i", f"{PHRASE} x {PHRASE} y z", f"{PHRASE} {PHRASE} {PHRASE}", "é ü # *$% 日本 & | < > 12345 a b c d e f",
    "line one\nline two\nline one\n\n \n\nline one\rx\nline one", "a a a a a a", "a a a a a a a a a a a a", "x" * 70000, " ".join(f"w{i}" for i in range(40000)), "x\n" * 500, "A a\nA a \nA a",
]


def expected(text):
    words = re.findall(WORDS, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORDS, x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    n = len(words)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed


def test_counts_equal_plain_python(spark):
    docs = spark.createDataFrame([(i if i != 4 else None, t, None, "s", 1, "c", "o", "k") for i, t in enumerate(TEXTS * 2)], DOCS).repartition(3)
    got = outliers.outliers(docs).toPandas()
    assert len(got) == 2 * len(TEXTS)
    want = sorted([((-1 if i == 4 else i), *expected(t)) for i, t in enumerate(TEXTS * 2)])
    have = sorted((-1 if pd.isna(r.doc_id) else int(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, bool(r.base_failed)) for r in got.itertuples())
    assert have == want
    assert not (got.kept & got.base_failed).any()
    # too few rows for an estimate: the base limits decide alone
    assert (got.kept == ~got.base_failed).all() and got.cell.isna().all()


def test_empty_table(spark):
    assert outliers.outliers(spark.createDataFrame([], DOCS)).count() == 0


def plain_mcd(x, n):
    """The method on one cell's distinct points x with counts n, in numpy."""
    noise = np.diag(np.array(list(outliers.NOISE.values())) ** 2)

    def median(v):
        return np.array([np.median(np.repeat(v[:, k], n)) for k in range(v.shape[1])])

    def distance(mu, cov):
        off = x - mu
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)

    def estimate(sel):
        w = n[sel] / n[sel].sum()
        mu = w @ x[sel]
        off = x[sel] - mu
        return mu, (w[:, None] * off).T @ off

    mu = median(x)
    scale = np.maximum(1.4826 * median(np.abs(x - mu)), np.sqrt(np.diag(noise)))
    z = (x - mu) / scale
    size = np.maximum((z**2).sum(1), 1e-300)[:, None]
    best = None
    for rough in (None, np.tanh(z), z / np.sqrt(size)):
        cov = np.eye(len(mu))
        if rough is not None:
            r = (n[:, None] * rough).T @ rough
            own = np.sqrt(np.maximum(np.diag(r), 1e-12))
            cov = r / np.outer(own, own)
            np.fill_diagonal(cov, 1.0)
        cov, centre, det = cov * np.outer(scale, scale) + noise, mu, None
        for _ in range(outliers.STEPS):
            d = np.maximum(distance(centre, cov), 0)
            bucket = np.floor(outliers.OCTAVE * np.log2(d + 1e-9))
            order = np.unique(bucket)
            before = np.array([n[bucket < b].sum() for b in order])
            last = order[before < outliers.SUPPORT * n.sum()].max()
            centre, cov = estimate(bucket <= last)
            cov = cov + noise
            was, det = det, np.linalg.slogdet(cov)[1]
            if was is not None and was - det < 1e-12:
                break
        if best is None or det < best[0] - 1e-9:
            best = det, centre, cov
    near = distance(best[1], best[2]) <= outliers.quantile(outliers.WEIGHTED) * outliers.consistency(outliers.SUPPORT)
    mu, cov = estimate(near)
    return mu, np.linalg.inv(cov * outliers.consistency(outliers.WEIGHTED) + noise)


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return outliers.outliers(docs).toPandas()


def test_estimates_equal_plain_numpy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for cell, size in (("a", 900), ("b", 150)):
        x = rng.normal(0, 0.3, (size, 4)) @ np.diag([1, 0.4, 0.2, 1]) + rng.normal(0, 0.2, (size, 1))
        x[: size // 8] += [2, 1, 0, 1]
        x = np.round(x / outliers.STEP) * outliers.STEP
        x[:, 2] = 0
        rows += [(cell, *map(float, v), int(k)) for v, k in zip(x, rng.integers(1, 4, size), strict=True)]
    points = spark.createDataFrame(rows, "cell string, " + ", ".join(f"{c} double" for c in outliers.NOISE) + ", n long")
    got = {r.cell: r for r in outliers.robust_estimates(points).collect()}
    for cell in "ab":
        own = [r for r in rows if r[0] == cell]
        mu, inv = plain_mcd(np.array([r[1:5] for r in own]), np.array([r[5] for r in own]))
        assert np.allclose(got[cell].mu, mu, atol=0.02)
        assert np.allclose(got[cell].inv, [inv[i, j] for i in range(4) for j in range(i, 4)], rtol=0.1, atol=0.5)
        assert np.abs(np.array(got[cell].mu)).max() < 0.3  # the planted eighth does not pull the centre


def test_junk_goes_and_clean_stays(spark, judged):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    rows = judged.merge(labels, on="doc_id")
    good = rows[(rows.quality == 1) & ~rows.base_failed]
    bad = rows[rows.quality == 0]
    assert good.kept.mean() > 0.98 and bad.kept.mean() < 0.02
    assert set(judged.cell.dropna().str.slice(2, 5)) <= {"own", "lan", "all"}


def test_chi_square():
    assert outliers.quantile(0.95) == pytest.approx(9.487729, abs=1e-5)
    assert outliers.consistency(1.0) == 1.0 and outliers.consistency(0.75) > 1
