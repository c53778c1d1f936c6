from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import parity
import pytest
from making import MEDIUM

from pyspark.sql import functions as F
from voidage.llm import codes as C
from voidage.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], SCHEMA)


def brute(rows, parts, entries, rounds):
    usable = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if usable(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda piece, book: min((far(piece, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        groups = [[[] for _ in book] for book in books]
        for _, v, _ in kept:
            for p, piece in enumerate(cut(v)):
                groups[p][near(piece, books[p])[1]].append(piece)
        books = [
            [[sum(x) // len(g) for x in zip(*g)] if g else old for g, old in zip(groups[p], books[p])] for p in range(parts)
        ]
    out = []
    for i, v, label in kept:
        found = [near(piece, books[p]) for p, piece in enumerate(cut(v))]
        out.append((i, label, bytes(k for _, k in found).hex(), sum(d for d, _ in found)))
    return [(*r, sum(q[3] for q in out if q[1] == r[1])) for r in out], books


@pytest.mark.parametrize("entries,parts,spread", [(64, 4, 1.0), (64, 8, 0.01), (5, 4, 0.3), (1, 2, 1.0)])
def test_like_brute_force(spark, table, entries, parts, spread):
    rng = random.Random(entries * parts)
    vector = lambda: [rng.gauss(0, spread) for _ in range(16)]
    rows = [(i, vector(), rng.choice([None, 1, 2])) for i in rng.sample(range(-500, 500), 150)]
    rows += [(None, vector(), 1), *rows[:4], (9000, rows[0][1], 7), (9001, rows[0][1], None)]
    rows += [(9002, None, 1), (9003, [0.5] * 15 + [None], 1), (9004, [float("nan")] * 16, 1), (9005, [float("-inf")] * 16, 1), (9006, [], 1)]
    got, books = C.compress(table(rows).repartition(4), parts=parts, entries=entries)
    expected, expected_books = brute(rows, parts, entries, 2)
    assert books.tolist() == expected_books
    found = [(r.vec_id, r.label, bytes(r.code).hex(), r.error, r.label_error) for r in got.collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    text = ",".join(str(x) for book in expected_books for e in book for x in e)
    assert C.books_sha256(books) == hashlib.sha256(text.encode()).hexdigest()


def test_nearest_is_exact_with_ties_to_the_lower_index():
    rng = np.random.default_rng(2)
    for width, count in ((1, 1), (1, 64), (4, 64), (4, 7), (9, 64)):
        entries = rng.integers(-5, 6, (count, width)) * rng.integers(1, 30)
        points = np.concatenate([rng.integers(-200, 200, (400, width)), entries])
        distances = ((points[:, None] - entries[None]) ** 2).sum(2)
        slices = C.Slices(entries)
        nearest, least = slices.nearest(points)
        assert (nearest == distances.argmin(1)).all() and (least == distances.min(1)).all()
        radius = np.ceil(np.sqrt(distances.min(1))).astype(int)
        inside = (np.abs(points[:, None] - entries[None]) <= radius[:, None, None]).all(2)
        masks = slices.candidates(points, radius)
        assert [[m >> k & 1 for k in range(count)] for m in masks.tolist()] == inside.astype(int).tolist()
    assert C.Slices(np.zeros((3, 2))).nearest(np.zeros((0, 2)))[0].tolist() == []


def test_codes_decode_to_the_entries(spark, table):
    rows = [(i, [math.sin(i * 16 + k) for k in range(16)], i % 2) for i in range(100)]
    got, books = C.compress(table(rows), parts=4, entries=8)
    scaled = {r.vec_id: r["values"] for r in C.scaled(table(rows)).collect()}
    for r in got.withColumn("d", C.decoded(F.col("code"), books)).collect():
        assert sum((a - b) ** 2 for a, b in zip(r.d, scaled[r.vec_id])) == r.error


def test_nothing_to_code_and_what_is_refused(spark, table):
    for rows in ([], [(1, None, 1)]):
        got, books = C.compress(table(rows))
        assert books is None and got.count() == 0 and "label_error" in got.columns
    with pytest.raises(ValueError):
        C.compress(table([(1, [1.0] * 15, 1)]))
    with pytest.raises(Exception, match="does not have 16 components"):
        C.compress(table([(i, [1.0] * 16, 1) for i in range(64)] + [(99, [1.0] * 32, 1)]))[0].collect()


def test_query(spark):
    con = parity.connect(MEDIUM)
    assert parity.compare(QUERIES["op12_codes"](spark, MEDIUM), con, ORACLES["op12_codes"]) == []
