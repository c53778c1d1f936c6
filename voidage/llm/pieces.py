"""SentencePiece encoding through a table of distinct marked words, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import ChunkTable, slices
from voidage.llm.common import id_and_text

#: The sign that stands for a space, fixed by the model format.
MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def chunk_pattern(pieces: list[str]) -> re.Pattern | None:
    """Where a text may be cut so that no piece crosses a cut; None if some piece has a mark after other signs.

    Cuts are in front of a run of marks and, if no piece has a line end in it,
    around line ends. Merges stay inside pieces, so they never cross a cut.
    """
    if any(MARK in piece.lstrip(MARK) for piece in pieces):
        return None
    if any("\n" in piece for piece in pieces):
        return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
    return re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


class Encoder:
    """Encodes texts as the library does, by way of the chunk table."""

    def __init__(self, path: str, most_chunks: int = 400_000):
        self.model = _load(path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pattern = chunk_pattern(pieces)
        if self.pattern is None:
            raise ValueError("a piece crosses a whitespace mark: chunks of this model are not independent")
        self.table = ChunkTable(self._segment, most_chunks)
        self.start = np.array([self.model.bos_id()], "<u4").tobytes()
        self.end = np.array([self.model.eos_id()], "<u4").tobytes()
        self.mark = [self.model.piece_to_id(MARK)]
        self.line = self.model.encode("\n")  # the mark that the library puts in front, then the line end

    def _segment(self, chunks: list[str]) -> list[bytes]:
        # The library puts one mark in front of a text. A chunk that begins with a
        # mark is given without it; any other one follows a line end, which no
        # piece contains, and both are taken off again.
        marked = [chunk.startswith(MARK) for chunk in chunks]
        found = self.model.encode(
            [chunk[1:] if m else "\n" + chunk for chunk, m in zip(chunks, marked)], num_threads=1
        )
        return [
            np.array((self.mark if chunk == MARK else ids) if m else ids[len(self.line) :], "<u4").tobytes()
            for chunk, m, ids in zip(chunks, marked, found)
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids with begin and end ids."""
        blocks = [self.pattern.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        self.table.learn(blocks)
        get = self.table.__getitem__
        return [b"".join([self.start, *map(get, block), self.end]) for block in blocks]


class Decoder:
    """Decodes ids as the library does: pieces and bytes in line, the first mark taken off."""

    def __init__(self, path: str):
        model = _load(path)
        self.table = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_control(i):
                self.table.append(b"")
            elif model.is_byte(i):
                self.table.append(bytes([int(piece[3:5], 16)]))
            elif model.is_unknown(i):
                self.table.append(" ⁇ ".encode())
            else:
                self.table.append(piece.replace(MARK, " ").encode())

    def decode(self, ids: bytes) -> str:
        whole = b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return whole.decode("utf-8", "replace")[whole.startswith(b" ") :]


def encode(docs: DataFrame, model_path: str | None = None, most_chunks: int = 400_000) -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit) of every whole text of ``docs``.

    A null text is empty; an empty text has only the begin and end ids. Rows that
    repeat are encoded each; ``doc_id`` may be null. Other columns are not read.
    ``model_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path or default_model(), most_chunks)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(encoder.encode(texts[a:b]), pa.binary())],
                    ["doc_id", "ids"],
                )

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and the text ``decoded`` from ``ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model_path or default_model())
        for batch in batches:
            ids = batch.column(1).to_pylist()
            step = 500
            for a in range(0, len(ids), step):
                part = batch.slice(a, step)
                texts = [decoder.decode(x or b"") for x in ids[a : a + step]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", F.col("ids")).mapInArrow(run, "doc_id long, ids binary, decoded string")
