from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from making import MEDIUM, make  # noqa: F401

from voidage.llm import fingerprints as P
from voidage.llm.common import documents
from voidage.llm.queries import QUERIES


def brute_pairs(text):
    return [sum(c * (c - 1) // 2 for c in Counter(text[i : i + P.WINDOW]).values()) for i in range(len(text) - P.WINDOW + 1)]


def brute_places(text, rank):
    keys = [(rank[p], i) if rank[p] >= 0 else (1 << 60, i) for i, p in enumerate(brute_pairs(text))]
    runs = max(1, len(keys) - P.RUN + 1) if keys else 0
    points = Counter(min(keys[r : r + P.RUN]) for r in range(runs))
    return sorted(i for (r, i), n in points.items() if r < 1 << 60 and n >= min(P.POINTS, runs))


def samples(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 9)))
    out = [" ".join(word() for _ in range(rng.randrange(0, 120))).encode() for _ in range(60)]
    return out + [b"", b"x", b"a" * 500, b"ab" * 200, b"q" * 63, bytes(range(64)), bytes(range(65)), "é日".encode() * 90, " ".join(word() for _ in range(3000)).encode()]


def test_windows_and_features():
    texts = samples()
    counts = np.zeros(P.PAIRS + 1, np.int64)
    for text in texts:
        own = brute_pairs(text)
        assert P.equal_pairs(np.frombuffer(text, np.uint8)).tolist() == own
        counts += np.bincount(own, minlength=P.PAIRS + 1).astype(np.int64)
    rank = P.ranks(counts)
    data, place, of = P.feature_places(texts, rank)
    ends = np.cumsum([len(t) for t in texts])
    for k, text in enumerate(texts):
        assert (place[of == k] - (ends[k] - len(text))).tolist() == brute_places(text, rank)
    together = P.fingerprints(texts, rank)
    assert [P.fingerprints([t], rank)[0] for t in texts] == together


def test_counts_cover_all_texts(spark, make):
    texts = [t.decode("utf-8", "ignore") for t in samples()] + [None]
    want = sum(np.bincount(brute_pairs((t or "").encode()), minlength=P.PAIRS + 1) for t in texts)
    assert (P.window_counts(make(texts).repartition(4)) == want).all()


def test_likeness():
    texts = samples(5)
    rank = P.ranks(sum(np.bincount(brute_pairs(t), minlength=P.PAIRS + 1) for t in texts))
    long, other = texts[-1], samples(6)[-1]
    one = lambda t: P.fingerprints([t], rank)[0]
    assert P.likeness(one(long), one(long)) == 1 and P.likeness(one(b""), one(b"")) == 1
    assert P.likeness(one(long), one(b"")) == 0 == P.likeness(one(b""), one(long))
    assert P.likeness(one(long), one(other)) < 0.1
    half = long[: len(long) // 2] + other[: len(long) // 2]
    assert 0.3 < P.likeness(one(long), one(half)) < 0.8
    assert P.likeness(one(long), one(b"moved " + long)) > 0.7
    assert P.likeness(one(long), one(half)) == P.likeness(one(half), one(long))


def brute(rows):
    rows = sorted(rows, key=lambda r: r[0])
    texts = [t or "" for _, t in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        after = texts[(k + 1) % len(rows)]
        half = len(texts[k]) // 2
        changed = texts[k][: len(texts[k]) - half] + after[:half]
        out.append((i, texts[k], changed, after))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_documents(spark, parts):
    docs = documents(spark, MEDIUM).repartition(parts)
    rank = P.ranks(P.window_counts(docs))
    got = {r.doc_id: r for r in P.with_edits(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    one = lambda t: P.fingerprints([t.encode()], rank)[0]
    for i, text, changed, after in brute(rows):
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = one(text), one(changed), one(after)
        assert bytes(r.fingerprint) == a and bytes(r.edited_fingerprint) == b
        assert r.near_edited == P.likeness(a, b) and r.near_next == P.likeness(a, c)


def test_edges(spark, make):
    assert P.with_edits(make([])).count() == 0
    (one,) = P.with_edits(make([(3, "only é text")], "fingerprint")).collect()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256("only éonly ".encode()).hexdigest()
    rows = [(None, "n" * 10), (1, None), (1, "a b"), (1, "a b"), (2, "x" * 300_000), (5, "z" * 99)]
    got = P.with_edits(make(rows)).collect()
    assert len(got) == 6
    same = [bytes(r.fingerprint) for r in got if r.n_chars == 3]
    assert len(same) == 2 and same[0] == same[1]


def test_query_compares_more_alike_texts_higher(spark):
    rows = QUERIES["op5_fingerprints"](spark, MEDIUM).collect()
    long = [r for r in rows if r.n_chars > 1000]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.9
    assert np.median([r.near_edited for r in long]) > 0.25 and np.median([r.near_next for r in long]) < 0.1
