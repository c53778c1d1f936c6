"""Signs behind the fortieth of a word are read."""

from __future__ import annotations

import numpy as np
import pytest
from test_toxicity import model, texts  # noqa: F401

from voidage.llm import toxicity as T

CLEAN = texts(20, 6, False)


@pytest.mark.parametrize("mark", ["_", ".", "-", "/"])
def test_a_toxic_word_in_a_joined_text_is_seen(model, mark):  # noqa: F811
    clean = [mark.join(text.replace(",", "").replace(".", "").split()[:60]) for text in CLEAN]
    toxic = [f"{text}{mark}vilesome{mark}grotten" for text in clean]
    assert min(map(len, clean)) > T.LONGEST
    scorer = T.Scorer(model)
    low, high = scorer.score(clean)[0], scorer.score(toxic)[0]
    assert np.mean(high >= 0.5) > 0.9 and np.mean(low >= 0.5) < 0.1


def test_a_text_without_any_mark_is_read_to_its_end(model):  # noqa: F811
    clean = "".join(CLEAN[0].split())[:400].replace(",", "").replace(".", "")
    scorer = T.Scorer(model)
    scores = scorer.score([clean, clean + "vilesome" * 5, clean + "grottensnarkle" * 5])[0]
    assert len(set(scores)) == 3 and scores[1] > scores[0] and scores[2] > scores[0]


def test_parts_cover_a_word():
    for n in range(1, 300):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        parts = T.parts_of(word)
        assert all(len(p) <= T.LONGEST for p in parts)
        for size in (1, 20):
            for at in range(0, n - size + 1):
                assert any(word[at : at + size] in p for p in parts)
    assert T.parts_of("-" * 90) and T.split_words("A b-C " + "=" * 50 + "x") == ["a", "b-c", "=" * 50 + "x"]


def test_top_window_counts_whole_words(model):  # noqa: F811
    text = "x" * 2000 + " " + " ".join(["la"] * 100) + " vilesome grotten snarkle vilesome"
    score, count, top = T.Scorer(model).score([text])
    assert score[0] >= 0.5 and count[0] > 3 and 40 < top[0] < 105
