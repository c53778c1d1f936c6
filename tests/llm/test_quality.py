from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from making import LARGE, make  # noqa: F401

from voidage.llm import quality as Q
from voidage.llm.queries import QUERIES

WORDS = "la tion greeble mor ine est foo bar the of and".split()


def texts(n, seed, good):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "a", "en"]) for _ in range(rng.randrange(20, 300))]
        if not good:
            mark = rng.choice(["%%%", "!!", " |"])
            words = [w.upper() + mark if mark == "!!" else w + mark for w in words]
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def model():
    known = texts(200, 1, True) + texts(120, 2, False)
    return Q.fit(Q.statistics(known), np.array([1] * 200 + [0] * 120))


def plain(text):
    """The statistics that plain counting gives, by name."""
    odds = lambda part, whole: np.log((part + 0.5) / (whole - part + 0.5))
    words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
    ascii_letter = lambda c: c.isascii() and c.isalpha()
    letters = [sum(ascii_letter(c) or not c.isascii() for c in w) for w in words]
    capitals = [sum(ascii_letter(c) and c.isupper() for c in w) for w in words]
    rare = lambda w: sum(c.isascii() and not c.isalnum() and c not in " \t\n\r\v\f.,;:!?'\"()-" for c in w)
    n = len(words)
    blocks = max(n // Q.BLOCK, 1)
    of = [words[k * Q.BLOCK : (k + 1) * Q.BLOCK if k < blocks - 1 else n] for k in range(blocks)]
    return {
        "words": np.log1p(n),
        "capitals": odds(sum(capitals), sum(letters)),
        "rare marks": odds(rare(text), len(text)),
        "lines": np.log((text.count("\n") + 1) / (n + 10)),
        "word length": np.log1p(np.mean([len(w) for w in words]) if words else 0),
        "short words": odds(sum(len(w) <= 3 and k == len(w) for w, k in zip(words, letters)), n),
        "words all marks": odds(sum(not any(c.isalnum() or not c.isascii() for c in w) for w in words), n),
        "distinct words": np.log((len(set(words)) + 1) / np.sqrt(n + 1)),
        "worst rare marks": max(odds(sum(map(rare, b)), len(b) + sum(map(len, b))) for b in of),
    }


def test_statistics_are_plain_counts():
    rows = ["", " ", "x", "Ünï çödé ßß", "A|B || c&&&\n\nD.", " lead", "trail ", "a" * 10_000, *texts(20, 5, True), *texts(20, 6, False), ""]
    found = Q.statistics(rows)
    assert np.isfinite(found).all()
    for k, text in enumerate(rows):
        alone = Q.statistics([text])[0]
        assert np.allclose(alone, found[k])
        for name, value in plain(text).items():
            assert found[k][Q.NAMES.index(name)] == pytest.approx(value, abs=1e-9), (name, text[:40])
    assert Q.statistics([]).shape == (0, len(Q.NAMES))


def test_densities_are_those_of_the_gaussian():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 4)) @ rng.standard_normal((4, 4)) + 3
    gaussian = Q.Gaussian.of(x, 0.2, np.ones(4))
    covariance = 0.8 * np.cov(x.T, bias=True) + 0.1 * np.diag(np.var(x, axis=0)) + 0.1 * np.eye(4) + 1e-3 * np.eye(4)
    off = x - x.mean(0)
    expected = -0.5 * np.einsum("ni,ij,nj->n", off, np.linalg.inv(covariance), off) - 0.5 * np.linalg.slogdet(covariance)[1]
    assert np.allclose(gaussian.log_density(x), expected)


def test_unseen_texts(model):
    good, bad = (model.score(Q.statistics(texts(150, seed, kind))) for seed, kind in ((3, True), (4, False)))
    assert (good >= 0.7).mean() > 0.97 and (bad < 0.7).mean() > 0.97
    half = [a + "\n" + b for a, b in zip(texts(100, 7, True), texts(100, 8, False))]
    assert np.median(model.score(Q.statistics(half))) < 0.5


def test_scores_are_calibrated():
    """Among texts that nothing tells apart the score is the share of label 1."""
    known = texts(400, 9, True)
    labels = np.array([int(k % 4 != 0) for k in range(400)])
    scores = Q.fit(Q.statistics(known), labels).score(Q.statistics(texts(200, 10, True)))
    assert 0.6 < scores.mean() < 0.9


def test_order_batching_and_repeats_do_not_matter(spark, make, model):
    rows = ["", None, " \n ", "x" * 100_000, *texts(30, 5, True), *texts(30, 6, False)]
    rows += rows[4:10]
    got = {r.doc_id: r.score for r in Q.score(make(rows, "score").repartition(3), model, block_chars=500).collect()}
    alone = [model.score(Q.statistics([text or ""]))[0] for text in rows]
    assert [got[i] for i in range(len(rows))] == pytest.approx(alone)
    assert got[0] == got[1]
    kept = Q.keep_good(make(rows, "score"), model)
    assert kept.columns == make(rows, "score").columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i] >= 0.7}


def test_without_labels_and_without_rows(spark, make, model):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.train(make(["a"]), empty) is None
    one_class = spark.createDataFrame([(0, 1, None), (None, 0, 1), (1, None, 1)], "doc_id long, quality int, toxic int")
    assert Q.train(make(["a"]), one_class) is None
    assert [r.score for r in Q.score(make(["a", None]), None).collect()] == [0.5, 0.5]
    assert Q.keep_good(make(["a"]), None).count() == 1 and Q.score(make([]), model).count() == 0
    two = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert Q.train(make(["good words", "BAD!!"]), two) is not None


def test_labels_of_held_out_rows_are_not_learned(spark, make):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    assert Q.train(make(["a"] * 400), labels) is None


def test_sample_takes_one_row_of_an_id(spark, make):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids] + [(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    rows = [(i, t) for i in ids for t in (["fine words here"] if i % 2 else ["BAD!! WORDS!!", "WORSE%%%"])]
    once = Q.train(make(rows), labels, sample=20)
    again = Q.train(make(rows[::-1] + rows), labels, sample=20)
    assert np.allclose(once.high.mean, again.high.mean) and once.offset == pytest.approx(again.offset)


def test_query(spark):
    rows = QUERIES["op13_quality"](spark, LARGE).collect()
    assert len(rows) == spark.read.parquet(f"{LARGE}/documents.parquet").count()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.985
