"""Byte strings of a fixed length that occur more than once in the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import slices
from voidage.llm.common import stored
from voidage.llm.hashing import U64, VALUES, Sums, mixed
from voidage.llm.recompress import LOWEST, _rows, _signed

#: Bytes of the gram that makes an anchor.
GRAM = 64
#: Windows of a block.
BLOCK = 32


class Hashes(Sums):
    """Hashes of any substrings of ``data``."""

    def __init__(self, data: np.ndarray, which: int):
        super().__init__(VALUES[which][data], which)


def anchors(hashes: Hashes, ends: np.ndarray, window: int):
    """Groups of windows with the same anchor: first and last window, key, text, anchor of each group.

    The anchor of a window is the gram with the least hash in it, the leftmost of
    equals. Equal windows have it at the same place, wherever they stand.
    """
    lengths = np.diff(ends, prepend=0)
    n_windows = np.maximum(0, lengths - window + 1)
    total = int(n_windows.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64), none, none
    keys = hashes.grams(GRAM)
    span = window - GRAM + 1
    place_bits = 31
    least = np.full(len(keys) + span, np.iinfo(np.int64).max, np.int64)
    least[: len(keys)] = (keys >> U64(32)).astype(np.int64) << place_bits | np.arange(len(keys))
    width = 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    owner = np.repeat(np.arange(len(ends)), n_windows)
    first = np.arange(total) + np.repeat(ends - lengths - (n_windows.cumsum() - n_windows), n_windows)
    chosen = least[first] & ((1 << place_bits) - 1)
    cut = np.ones(total, bool)
    cut[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(cut)
    return first[at], first[np.append(at[1:], total) - 1], keys[chosen[at]], owner[at], chosen[at]


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Of each slice of texts: its rows, their bytes in line and where each text's bytes end."""
    for batch in batches:
        texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        for a, b in slices(texts, 1_000_000):
            yield batch.slice(a, b - a), np.frombuffer(b"".join(texts[a:b]), np.uint8), np.cumsum([len(t) for t in texts[a:b]])


def repeated(docs: DataFrame, window: int = 400) -> DataFrame:
    """Byte ranges to remove: ``doc``, ``tie``, ``low``, ``high`` (exclusive); ranges of a text may overlap.

    Every window of ``window`` bytes that also starts somewhere else. Exact up to
    128-bit hashes. Steps, each stored: keys of anchors that occur more than once;
    groups of windows with such an anchor, counted by their whole span; of the spans
    whose key has several different ones, one copy each, cut to the blocks of windows
    whose common bytes occur in another one; these window by window.
    """
    rows = _rows(docs)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, ends in _blocks(batches):
            yield pa.RecordBatch.from_arrays([_signed(anchors(Hashes(data, 0), ends, window)[2])], ["key"])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, ends in _blocks(batches):
            one, two = Hashes(data, 0), Hashes(data, 1)
            first, last, keys, of, anchor = anchors(one, ends, window)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            spans = [h.of(first, last + window) for h in (one, two)]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(keys),
                    part.column(0).take(pa.array(of)),
                    part.column(1).take(pa.array(of)),
                    pa.array((first - starts[of]).astype(np.int32)),
                    pa.array((last - starts[of]).astype(np.int32)),
                    pa.array((anchor - starts[of]).astype(np.int32)),
                    *map(_signed, spans),
                ],
                ["key", "doc", "tie", "first", "last", "anchor", "one", "two"],
            )

    keys = rows.mapInArrow(keyed, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(keys.filter("n > 1").select("key"))
    groups = rows.mapInArrow(grouped, "key long, doc long, tie long, first int, last int, anchor int, one long, two long")
    groups = stored(groups.join(shared, "key", "left_semi"))
    spans = stored(
        groups.groupBy("key", "one", "two").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "tie", "first", "last", "anchor")).alias("copy")
        )
    )
    whole = groups.join(spans.filter("n > 1").select("one", "two"), ["one", "two"], "left_semi")
    whole = whole.select("doc", "tie", "first", "last")
    several = spans.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    open_ = spans.join(several, "key", "left_semi").select("copy.*", (F.col("n") == 1).alias("single"))
    of_text = lambda spans, *more: spans.groupBy("doc", "tie").agg(
        F.collect_list(F.struct("first", "last", "single", *more)).alias("ranges")
    )

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of windows that stand alike to their anchor, by what all windows of a block have in common."""
        for part, data, ends in _blocks(batches):
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            rows_ = []
            for k, ranges in enumerate(part.column(3).to_pylist()):
                for r in ranges:
                    for j in range((r["anchor"] - r["last"]) // BLOCK, (r["anchor"] - r["first"]) // BLOCK + 1):
                        top = r["anchor"] - BLOCK * j
                        rows_.append((k, j, top, max(r["first"], top - BLOCK + 1), min(r["last"], top), r["single"]))
            of, j, top, first, last, alone = (np.array(c) for c in zip(*rows_))
            at = top + starts[of]
            common = [Hashes(data, w).of(at, at - BLOCK + 1 + window) for w in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(mixed(common[0] + j.astype(U64))),
                    _signed(common[1]),
                    part.column(0).take(pa.array(of)),
                    part.column(1).take(pa.array(of)),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                    pa.array(alone),
                ],
                ["one", "two", "doc", "tie", "first", "last", "single"],
            )

    spread = rows.join(of_text(open_, "anchor"), ["doc", "tie"]).select("doc", "tie", "text", "ranges")
    core = "one long, two long, doc long, tie long, first int, last int, single boolean"
    blocks = stored(spread.mapInArrow(cores, core))
    met = blocks.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = stored(blocks.join(met, ["one", "two"], "left_semi").drop("one", "two"))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, ends in _blocks(batches):
            one, two = Hashes(data, 0), Hashes(data, 1)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            at, of, alone = [], [], []
            for k, ranges in enumerate(part.column(3).to_pylist()):
                for r in ranges:
                    at.append(np.arange(r["first"], r["last"] + 1) + starts[k])
                    of.append(np.full(len(at[-1]), k))
                    alone.append(np.full(len(at[-1]), r["single"]))
            at, of, alone = np.concatenate(at), np.concatenate(of), np.concatenate(alone)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(one.of(at, at + window)),
                    _signed(two.of(at, at + window)),
                    part.column(0).take(pa.array(of)),
                    part.column(1).take(pa.array(of)),
                    pa.array((at - starts[of]).astype(np.int32)),
                    pa.array(alone),
                ],
                ["one", "two", "doc", "tie", "first", "single"],
            )

    windows = rows.join(of_text(blocks), ["doc", "tie"]).select("doc", "tie", "text", "ranges")
    windows = stored(windows.mapInArrow(single, "one long, two long, doc long, tie long, first int, single boolean"))
    often = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lone = windows.filter("single").join(often, ["one", "two"], "left_semi")
    both = whole.union(lone.select("doc", "tie", "first", F.col("first").alias("last")))
    return both.select("doc", "tie", F.col("first").alias("low"), (F.col("last") + window).alias("high"))


def without_repeats(docs: DataFrame, window: int = 400) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` and ``kept`` (the remaining bytes in line, binary).

    A byte goes if a string of ``window`` bytes that covers it also starts somewhere
    else in the input, in the same text or another; no string crosses texts. ``spans``
    are the maximal removed ranges (low, high). Null texts are empty; a row that
    repeats another is another occurrence; ids may be null. Other columns are not
    read.
    """
    found = stored(
        repeated(docs, window).groupBy("doc", "tie").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, ranges = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in slices(texts):
                sizes, spans, kept = [], [], []
                for text, own in zip(texts[a:b], ranges[a:b]):
                    data = text.encode("utf-8", "surrogatepass")
                    merged: list[list[int]] = []
                    for low, high in sorted((r["low"], r["high"]) for r in own or ()):
                        if merged and low <= merged[-1][1]:
                            merged[-1][1] = max(high, merged[-1][1])
                        else:
                            merged.append([low, high])
                    left, at = [], 0
                    for low, high in merged:
                        left.append(data[at:low])
                        at = high
                    left.append(data[at:])
                    sizes.append(len(data))
                    spans.append([{"low": low, "high": high} for low, high in merged])
                    kept.append(b"".join(left))
                removed = [n - len(k) for n, k in zip(sizes, kept)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
                )

    rows = _rows(docs).join(found, ["doc", "tie"], "left").select(
        F.when(F.col("doc") != LOWEST, F.col("doc")).alias("doc_id"), "text", "ranges"
    )
    return rows.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<low: int, high: int>>, kept binary"
    )
