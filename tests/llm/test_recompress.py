from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from making import MEDIUM, make  # noqa: F401

from voidage.llm import hashing
from voidage.llm import recompress as R
from voidage.llm.common import documents
from voidage.llm.hashing import Words
from voidage.llm.queries import QUERIES


def brute(rows, window=13):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            low = -1 if i is None else i
            least[key] = min(low, least.get(key, low))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < (-1 if i is None else i):
                gone |= set(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def test_documents(spark):
    docs = documents(spark, MEDIUM)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert result(R.without_repeats(docs)) == want
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op6_substring_dedup"](spark, MEDIUM).collect()}
    assert got == {i: (n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in want}


@pytest.mark.parametrize("seed", range(3))
def test_passages_of_any_length(spark, make, seed):
    """Few distinct words, so that runs, periods and chance repeats abound."""
    rng = random.Random(seed)
    alphabet = "ab" if seed == 0 else "abcdefghij" if seed == 1 else [f"w{k}" for k in range(300)]
    passages = [[rng.choice(alphabet) for _ in range(rng.randrange(10, 60))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += [rng.choice(alphabet) for _ in range(rng.randrange(0, 30))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a : a + rng.randrange(8, 60)]
        rows.append((rng.randrange(200), " ".join(words)))
    rows += [(500, "a " * 400), (501, "a " * 90), (502, "a b " * 200), (503, "b a " * 50), (504, None), (505, " \n"), (None, "a " * 30)]
    assert result(R.without_repeats(make(rows, "ranges").repartition(4))) == brute(rows)


def test_hot_copies(spark, make):
    rng = random.Random(9)
    text = " ".join(str(rng.random()) for _ in range(60))
    rows = [(i, text if i % 3 == 0 else f"{i} own words " + " ".join(str(rng.random()) for _ in range(20))) for i in range(600)]
    assert result(R.without_repeats(make(rows))) == brute(rows)


def test_begins_depend_on_near_words_only():
    rng = np.random.default_rng(0)
    for letters in (2, 3, 6, 1000):
        words = rng.integers(1, letters + 1, 6000).astype(np.uint64)
        fresh = np.zeros(len(words), bool)
        fresh[0] = True
        whole = R.symbol_begins(words, fresh)
        at = np.flatnonzero(whole[R.SIDE : -R.SIDE]) + R.SIDE
        assert np.diff(np.flatnonzero(whole)).max() <= R.LONGEST
        for a in rng.integers(0, 5900, 300):
            part = words[a : a + 20]
            own = R.symbol_begins(part, np.arange(20) == 0)
            inner = slice(R.SIDE, 20 - R.SIDE + 1)
            assert (own[inner] == whole[a + R.SIDE : a + 20 - R.SIDE + 1]).all()
        assert len(at)


def test_every_window_has_one_group():
    texts = ["a b c d e f g h i j k l m n o p q r s t", "", "x " * 50, "one two", "a a b b " * 9]
    words, ends = Words()(texts)
    first, last, keys, of = R.anchors(words, ends, 13)
    covered = sorted(k for a, b in zip(first, last) for k in range(a, b + 1))
    starts = np.concatenate([[0], ends[:-1]])
    assert covered == [int(s) + k for s, e in zip(starts, ends) for k in range(int(e) - int(s) - 12)]


def test_empty_table(make):
    assert R.without_repeats(make([])).count() == 0


def test_words_hashed_by_whole_arrays(monkeypatch):
    texts = ["", "a b c\x1cd\x00 e", " \t\n\x0b\x0c\r", " x y", "ab ba " * 3 + "x" * 900 + " end", "no_space", " e "]
    words = [w for t in texts for w in t.encode().split()]
    (one, two), ends = hashing.word_hashes(texts, 2)
    assert list(ends) == list(np.cumsum([len(t.encode().split()) for t in texts]))
    for found in (one, two):
        assert len(set(zip(words, found))) == len(set(words)) == len(set(found))
    assert not set(one) & set(two)
    # Words are cut out in pieces; where a piece ends does not matter.
    monkeypatch.setattr(hashing, "PIECE", 16)
    again = hashing.word_hashes(texts, 2)[0]
    assert all((x == y).all() for x, y in zip((one, two), again))
    assert [len(x) for x in hashing.word_hashes([], 2)[0]] == [0, 0]


def test_no_object_for_each_word():
    """Blocks of texts take arrays of their words, not an object and a table entry for each of them."""
    text = " ".join(f"{k:x}" for k in range(150_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([text])], ["doc", "tie", "text"])
    list(R._blocks(iter([batch]), 2, 2))
    tracemalloc.start()
    list(R._blocks(iter([batch]), 2, 2))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 25 * len(text)
