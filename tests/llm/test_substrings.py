from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from making import SMALL, make  # noqa: F401

from voidage.llm import substrings as S
from voidage.llm.common import documents
from voidage.llm.queries import QUERIES


def brute(rows, window=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(d[k : k + window]) for _, d in data for k in range(len(d) - window + 1))
    out = []
    for i, d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for k in range(len(d) - window + 1):
            if seen[hash(d[k : k + window])] > 1:
                gone[k] += 1
                gone[k + window] -= 1
        mask = gone.cumsum()[:-1] > 0
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((i, len(d), int(mask.sum()), runs, kept))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect()), key=str)


def test_documents(spark):
    docs = documents(spark, SMALL)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert result(S.without_repeats(docs)) == want
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op3_suffix_dedup"](spark, SMALL).collect()}
    assert got == {i: (n, m, s, hashlib.sha256(k).hexdigest()) for i, n, m, s, k in want}


@pytest.mark.parametrize("seed", range(3))
def test_passages_of_any_length(spark, make, seed):
    rng = random.Random(seed)
    signs = "ab" if seed == 0 else "abcdefgh é" if seed == 1 else [f"{k} " for k in range(500)]
    passages = ["".join(rng.choice(signs) for _ in range(rng.randrange(100, 900))) for _ in range(8)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randrange(0, 4)):
            text += "".join(rng.choice(signs) for _ in range(rng.randrange(0, 300)))
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randrange(200, 900)]
        rows.append((i, text))
    rows += [(90, "x" * 3000), (91, "xy" * 700), (92, "x" * 399), (93, "x" * 400), (94, None), (95, ""), (None, passages[0]), (96, "q" * 401)]
    rows += [(97, "once " * 10 + str(rng.random()) * 30), (98, "same row " * 50 + "!"), (98, "same row " * 50 + "!")]
    assert result(S.without_repeats(make(rows, "kept").repartition(4))) == brute(rows)


def test_one_passage_in_a_third_of_all(spark, make):
    rng = random.Random(8)
    own = lambda n: "".join(rng.choice("abcdefgh ijklmn") for _ in range(n))
    passage = own(450)
    rows = [(i, own(300) + passage + own(200) if i % 3 == 0 else own(700)) for i in range(240)]
    assert result(S.without_repeats(make(rows))) == brute(rows)


def test_empty_table(make):
    assert S.without_repeats(make([])).count() == 0
