"""Which signs of a text are a phone number, written out by hand."""

from __future__ import annotations

import re

import pytest
from making import make  # noqa: F401

from voidage.llm import pseudonyms as P

# Text with each number that has to go in brackets of its own, <...>.
MARKED = [
    "<+49 30 1234567>", "<+44 7911 123456>", "<+49 151 12345678>", "a <+33 1 23 45 67 89>, b", "<+4930123456>.",
    "<+1 (017) 555-7713> 12345", "<+1 (017) 555-7713> 2024", "<+1 (017) 555-7713>", "<+1 017 555 7713> 2024 and",
    "<+33 1 23 45 67 89> 2024", "<+44 20 7946 0958> 12", "<+49 30 1234567> 2024", "<+49 30 1234567> 12345",
    "<+49 30-1234-5678> 2024", "<+49 (0)30 1234567>", "<+12 (345) 678-9012>", "<+17 (345) 678-9012>",
    "<+49 30 1234567> <+44 7911 123456> <+1 (017) 555-7713>", "<+43 1 58858 0>", "<+123456789012345>",
    "+1234567890123456", "+49 30 123", "+12", "x+49 30 1234567", "+49 30 1234567x", "2 + 3 = 5",
]


def plain(text: str) -> str:
    return re.sub("[<>]", "", text)


def test_whole_numbers_and_nothing_else(make):
    got = {r.doc_id: r.text for r in P.pseudonymise(make([plain(t) for t in MARKED]), "k").collect()}
    for i, text in enumerate(MARKED):
        spans, at = [], 0
        for part in re.split("(<[^>]*>)", text):
            size = len(plain(part))
            spans.append((part.startswith("<"), plain(part), got[i][at : at + size]))
            at += size
        assert at == len(got[i]), text
        for number, before, after in spans:
            assert re.sub("[0-9]", "0", before) == re.sub("[0-9]", "0", after), text
            assert (before != after) == number, (text, got[i])


@pytest.mark.parametrize("number", ["+1 (017) 555-7713", "+49 30 1234567", "+33 1 23 45 67 89"])
def test_same_number_same_pseudonym_whatever_follows(make, number):
    after = ["", ".", " 2024", " 12345", " x", ", 7"]
    got = {r.doc_id: r.text for r in P.pseudonymise(make([number + a for a in after]), "k").collect()}
    assert got[0] != number
    assert [got[i] for i in range(len(after))] == [got[0] + a for a in after]
