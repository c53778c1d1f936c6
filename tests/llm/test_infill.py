from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import parity
import pytest
from making import MEDIUM, make  # noqa: F401

from pyspark.sql import functions as F
from voidage.llm import infill as I
from voidage.llm.queries import ORACLES, QUERIES
from voidage.llm.wavelet import WaveletMatrix

TEXTS = [
    "", None, " ", "a", "Hello, World!\n", "don't   stop", "ünïcödé ßtraße 中文字 abc", "x" * 5000, "1234567890", "a <P> b", "<S>", "c<M>",
    "<", "<P", "a<", "<<<S", "S>P>M>", "\x00\x01tab\tend", "😀 emoji😀text 😀", "ab" * 3000 + " " + "cd\r\n" * 2000,
]


def brute(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    prefix, middle, suffix = ("".join(tokens[a:b]) for a, b in ((0, i), (i, j), (j, len(tokens))))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, "plain", len(tokens), None, None, text
    front, back = "<P>" + prefix, "<S>" + suffix
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, form, len(tokens), len(prefix), len(middle), (back + front if form == "spm" else front + back) + "<M>" + middle


@pytest.mark.parametrize("block", [1, 50, 10_000_000])
def test_like_brute_force_and_back(spark, make, block):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("abC .,<>PSMé1\n") for _ in range(rng.randrange(80))) for _ in range(300)]
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts)] + [(3, "same id"), (3, "same id"), (3, "other text")]
    out = I.fill_in_middle(make(rows, "form").repartition(3), block_chars=block)
    found = out.withColumn("back", I.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(str, (tuple(r)[:6] for r in found))) == sorted(str(brute(*row)) for row in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert sorted((r.doc_id, r.back) for r in found) == sorted((i, t or "") for i, t in rows)


def test_null_id_and_no_rows(spark, make):
    (row,) = I.fill_in_middle(make([(None, "some text")])).collect()
    assert (row.form, row.n, row.output) == ("plain", 3, "some text")
    assert I.fill_in_middle(make([])).count() == 0
    assert {r.form for r in I.fill_in_middle(make(["a b c"] * 40), transformed=100, suffix_first=100).collect()} == {"spm"}


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for symbol in range(8):
            ranks = np.concatenate([[0], np.cumsum(symbols == symbol)])
            assert (matrix.rank(symbol, at) == ranks).all()
        both = np.concatenate([[0], np.cumsum((symbols == 1) | (symbols == 6))])
        wanted = np.arange(both[-1] + 2)
        expected = [int(np.argmax(both >= k)) if k <= both[-1] else size for k in wanted]
        found = matrix.select((1, 6), wanted, np.zeros(len(wanted)), np.full(len(wanted), size))
        assert found.tolist() == expected


def test_query(spark):
    con = parity.connect(MEDIUM)
    df = QUERIES["op11_infill"](spark, MEDIUM)
    assert parity.compare(df, con, ORACLES["op11_infill"]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
