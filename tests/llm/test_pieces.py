from __future__ import annotations

import random

import numpy as np
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor

from making import make  # noqa: F401

from voidage.llm import pieces

TEXTS = ["", None, " ", "  ", "\n", "\n\n a", "a", "a  b\n c\tö  ", "▁a b▁", "▁", "\x00a\r\n", "<s> hi </s> <unk> <0x41>", "日本 x퟿\U0001F600",
         "​ é", "ab" * 5000, " " * 300 + "x" + " " * 40, "word " * 3000, "a\nb\n\nc", "\u0085  x", "�"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))


def want(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return np.array(ids, "<u4").tobytes(), library.decode(ids)


def test_as_the_library_does(make, library):
    docs = make(TEXTS + ["a", "a"], "ids")
    got = {r.doc_id: (bytes(r.ids), r.decoded) for r in pieces.decode(pieces.encode(docs)).collect()}
    assert got == {i: want(library, t) for i, t in enumerate(TEXTS + ["a", "a"])}


def test_any_mix_of_signs(library):
    rng = random.Random(3)
    signs = " \n\t▁ab eéß日'.\U0001F600́"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    # A table that is emptied again and again gives the same.
    encoder, decoder = pieces.Encoder(path("piece_bpe_32k.model"), most_chunks=50), pieces.Decoder(path("piece_bpe_32k.model"))
    for a in range(0, len(texts), 40):
        for text, ids in zip(texts[a : a + 40], encoder.encode(texts[a : a + 40])):
            assert (ids, decoder.decode(ids)) == want(library, text), repr(text)


def test_empty_table(make):
    assert pieces.decode(pieces.encode(make([]))).count() == 0


def test_pieces_across_marks_are_refused():
    assert pieces.chunk_pattern(["a", "▁b", "▁▁"]) is not None
    assert pieces.chunk_pattern(["a▁b"]) is None
    assert pieces.chunk_pattern(["a\nb"]).findall("▁a\nb▁c") == ["▁a\nb", "▁c"]
