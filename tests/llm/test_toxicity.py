from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from making import LARGE, make  # noqa: F401

from voidage.llm import toxicity as T
from voidage.llm.queries import QUERIES

BAD = ["vilesome", "grotten", "snarkle"]


def texts(n, seed, toxic):
    rng = random.Random(seed)
    words = ["la", "tion", "greeble", "mor", "ine", "est", "Foo,", "bar."]
    out = []
    for _ in range(n):
        text = [rng.choice(words) + rng.choice(["", "a", "en"]) for _ in range(rng.randrange(5, 300))]
        if toxic:
            for _ in range(1 + len(text) // 60):
                text[rng.randrange(len(text))] = rng.choice(BAD)
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def model():
    known = texts(150, 1, True) + texts(300, 2, False)
    return T.fit(known, np.array([1] * 150 + [0] * 300))


def test_unseen_texts(model):
    scorer = T.Scorer(model, most_words=40)
    high, low = scorer.score(texts(80, 3, True))[0], scorer.score(texts(80, 4, False))[0]
    assert (high >= 0.5).mean() > 0.95 and (low >= 0.5).mean() < 0.03


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in T.initial(3).items()}
    projected = rng.standard_normal((5, 3, 6 * T.HIDDEN))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], float)
    loss = lambda: float((T.forward(weights, projected.astype(np.float32), mask.astype(np.float32))[0] ** 2).sum() / 2)
    logits, cache = T.forward(weights, projected.astype(np.float32), mask.astype(np.float32), keep=True)
    grad, d_projected = T.backward(weights, cache, logits)
    for name in ("turn", "attend", "out", "out_bias"):
        flat = weights[name].reshape(-1)
        for at in range(0, flat.size, max(1, flat.size // 5)):
            eps, before = 1e-2, flat[at]
            flat[at] = before + eps
            up = loss()
            flat[at] = before - eps
            down = loss()
            flat[at] = before
            assert (up - down) / (2 * eps) == pytest.approx(np.asarray(grad[name]).reshape(-1)[at], rel=0.05, abs=2e-3), name
    assert (d_projected * (1 - mask[..., None])).any() == False  # noqa: E712


def test_every_word_is_in_a_window():
    for n in range(0, 700):
        seen = set()
        for start in T.window_starts(n):
            seen |= set(range(start, min(n, start + T.WINDOW)))
            assert start < n
        assert seen == set(range(n))


def test_order_batching_and_repeats_do_not_matter(spark, make, model):
    rows = ["", None, " \n ", "x" * 100_000, *texts(30, 5, True), *texts(30, 6, False)]
    rows += rows[4:10]
    got = {r.doc_id: r for r in T.score(make(rows, "score").repartition(3), model).collect()}
    for i, text in enumerate(rows):
        one = T.Scorer(model).score([text or ""])
        assert got[i].score == pytest.approx(one[0][0], abs=1e-4) and got[i].n_windows == one[1][0]
        assert got[i].top_window == one[2][0]
    assert [got[i].score for i in range(3)] == [0, 0, 0]
    kept = T.keep_clean(make(rows, "score"), model)
    assert kept.columns == make(rows, "score").columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].score < 0.5}


def test_without_labels_and_without_rows(spark, make, model):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.train(make(["a"]), empty) is None
    only_null = spark.createDataFrame([(0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert T.train(make(["a"]), only_null) is None
    assert [r.score for r in T.score(make(["a", None]), None).collect()] == [0.0, 0.0]
    assert T.score(make([]), model).count() == 0 and T.keep_clean(make([]), None).count() == 0


def test_labels_of_held_out_rows_are_not_learned(spark, make):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    assert T.train(make(["a"] * 400), labels) is None


def test_query(spark):
    rows = QUERIES["op9_toxicity"](spark, LARGE).collect()
    assert len(rows) == spark.read.parquet(f"{LARGE}/documents.parquet").count()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97


def test_training_does_not_hold_the_words_of_all_texts():
    rng = random.Random(2)
    words = [f"word{k}" for k in range(50)]
    many = [" ".join(rng.choices(words, k=2_000)) for _ in range(200)]
    tracemalloc.start()
    try:
        assert T.fit(many, np.arange(200) % 2, rounds=0) is not None
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12e6  # 400,000 words as strings of their own are more than twice that
