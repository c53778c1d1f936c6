"""Repeated word windows across documents, found through locally consistent symbols.

Words are recompressed: runs of a symbol, then pairs, get names that are functions
of what they stand for, so that all tasks give equal content equal names without a
common table. Where a symbol begins depends only on the words next to it, so equal
windows have equal symbols inside, wherever they stand. A few of these symbols, with
their surroundings, are the anchors by which equal windows find each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import slices
from voidage.llm.common import id_and_text, stored
from voidage.llm.hashing import PLACES, U64, Sums, mixed, word_hashes

#: Words on each side of a symbol's begin that decide whether it begins there: three
#: in front (the symbol before it, of at most two, and the word before that), three
#: behind. A symbol has at most four words, so that four places in line have a begin.
SIDE = 3
LONGEST = 4
#: Words of a gram around a begin, its key.
KEY = 2 * SIDE


def symbol_begins(words: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Whether a symbol begins at each word, after naming runs of two and then pairs.

    ``fresh`` marks the first word of a text. A run of exactly two equal words is one
    symbol; the words of longer runs stay apart, as the end of a long run is out of
    sight. Then every symbol of the left class followed by one of the right class is
    named with it; classes are a bit of the name.
    """
    n = len(words)
    if not n:
        return np.zeros(0, bool)
    equal = np.zeros(n + 3, bool)  # equal[k]: word k is as word k - 1 of the same text
    equal[1:n] = (words[1:] == words[:-1]) & ~fresh[1:]
    second = equal[:n] & ~np.concatenate([[False], equal[: n - 1]]) & ~equal[1 : n + 1]
    begin = ~second
    at = np.flatnonzero(begin)
    double = np.append(second, False)[at + 1]
    names = mixed(words[at] + np.where(double, PLACES[40], PLACES[41]))
    left = (names >> U64(17) & U64(1)) == 0
    paired = np.zeros(len(at), bool)
    paired[1:] = left[:-1] & ~left[1:] & ~fresh[at[1:]]
    begin[at[paired]] = False
    return begin


def anchors(words: np.ndarray, ends: np.ndarray, window: int, sums: Sums | None = None):
    """Groups of windows by anchor: first window, last window, key, text of each group.

    The anchor of a window is the begin with the least key of those whose ``SIDE``
    words on both sides lie in the window (the leftmost of equals). Windows in line
    with the same anchor are one group. ``sums`` are those of ``words``, if known.
    """
    none = np.zeros(0, np.int64)
    lengths = np.diff(ends, prepend=0)
    starts = ends - lengths
    n_windows = np.maximum(0, lengths - window + 1)
    total = int(n_windows.sum())
    if not total:
        return none, none, np.zeros(0, U64), none
    fresh = np.zeros(len(words), bool)
    fresh[starts[lengths > 0]] = True
    begin = symbol_begins(words, fresh)
    keys = (Sums(words, 0) if sums is None else sums).grams(KEY)  # of the words from a place on
    span = window - 2 * SIDE + 1  # places of a begin inside a window
    if span < LONGEST:
        raise ValueError(f"a window must have {2 * SIDE + LONGEST - 1} words at least")
    place_bits = 31
    least = np.full(len(words) + span, np.iinfo(np.int64).max, np.int64)
    centre = np.flatnonzero(begin[SIDE : len(keys) + SIDE])  # begin minus SIDE
    least[centre] = (keys[centre] >> U64(32)).astype(np.int64) << place_bits | centre
    before = n_windows.cumsum() - n_windows
    owner = np.repeat(np.arange(len(ends)), n_windows)
    first = np.arange(total) - np.repeat(before, n_windows) + np.repeat(starts, n_windows)
    # Sliding minimum, leftmost of equals, by doubling.
    width = 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    chosen = least[first] & ((1 << place_bits) - 1)
    cut = np.ones(total, bool)
    cut[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(cut)
    last = first[np.append(at[1:], total) - 1]
    return first[at], last, keys[chosen[at]], owner[at]


def _blocks(batches: Iterator[pa.RecordBatch], column: int, hashes: int):
    """Of each slice of texts: its rows, one or two hashes of its words, their sums and where each text's words end."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        for a, b in slices(texts, 1_000_000):
            words, ends = word_hashes(texts[a:b], hashes)
            yield batch.slice(a, b - a), words, [Sums(w, k) for k, w in enumerate(words)], ends


LOWEST = -(1 << 63)


def _rows(docs: DataFrame) -> DataFrame:
    """``doc`` (null id lowest), ``tie`` (hash of the text) and ``text``; rows alike in all are one."""
    found = id_and_text(docs)
    return found.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"), F.xxhash64("text").alias("tie"), "text")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeated(docs: DataFrame, window: int = 13) -> DataFrame:
    """Removed word ranges: ``doc``, ``tie``, ``low``, ``high`` (exclusive); ranges of a text may overlap.

    Every window of ``window`` words that also starts in a document with a smaller
    id. Exact up to 128-bit hashes of word sequences. Four steps, each stored:

    1. keys that anchors in two or more documents have;
    2. groups of windows with such an anchor, and the smallest document that has the
       same group: the whole group is removed elsewhere;
    3. windows, one by one, of the groups that are first of their kind, which every
       repeated window has a copy in, and the smallest document with each;
    4. ranges of both.
    """
    rows = _rows(docs)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, sums, ends in _blocks(batches, 2, 1):
            _, _, keys, of = anchors(words[0], ends, window, sums[0])
            yield pa.RecordBatch.from_arrays([_signed(keys), part.column(0).take(pa.array(of))], ["key", "doc"])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, sums, ends in _blocks(batches, 2, 2):
            first, last, keys, of = anchors(words[0], ends, window, sums[0])
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            one, two = (h.of(first, last + window) for h in sums)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(keys),
                    part.column(0).take(pa.array(of)),
                    part.column(1).take(pa.array(of)),
                    pa.array((first - starts[of]).astype(np.int32)),
                    pa.array((last - starts[of]).astype(np.int32)),
                    _signed(one),
                    _signed(two),
                ],
                ["key", "doc", "tie", "first", "last", "one", "two"],
            )

    keys = rows.mapInArrow(keyed, "key long, doc long").groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    shared = stored(keys.filter("a < b").select("key"))
    groups = rows.mapInArrow(grouped, "key long, doc long, tie long, first int, last int, one long, two long")
    groups = stored(groups.join(shared, "key", "left_semi").drop("key"))
    least = groups.groupBy("one", "two").agg(F.min("doc").alias("least"))
    groups = stored(groups.join(least, ["one", "two"]).drop("one", "two"))
    whole = groups.filter("least < doc").select("doc", "tie", "first", "last")

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, sums, ends in _blocks(batches, 2, 2):
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            at, of = [], []
            for k, ranges in enumerate(part.column(3).to_pylist()):
                for r in ranges:
                    at.append(np.arange(r["first"], r["last"] + 1) + starts[k])
                    of.append(np.full(len(at[-1]), k))
            at, of = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, of))
            one, two = (h.of(at, at + window) for h in sums)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(of)),
                    part.column(1).take(pa.array(of)),
                    pa.array((at - starts[of]).astype(np.int32)),
                    _signed(one),
                    _signed(two),
                ],
                ["doc", "tie", "first", "one", "two"],
            )

    firsts = groups.filter("least = doc").groupBy("doc", "tie").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    windows = rows.join(firsts, ["doc", "tie"]).select("doc", "tie", "text", "ranges")
    windows = stored(windows.mapInArrow(single, "doc long, tie long, first int, one long, two long"))
    smallest = windows.groupBy("one", "two").agg(F.min("doc").alias("least"))
    later = windows.join(smallest, ["one", "two"]).filter("least < doc")
    both = whole.union(later.select("doc", "tie", "first", F.col("first").alias("last")))
    return both.select("doc", "tie", F.col("first").alias("low"), (F.col("last") + window).alias("high"))


def without_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``n_removed``, ``spans`` and ``kept`` (the kept words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller ``doc_id``; windows are those of the input. ``spans`` are
    the removed word ranges (low, high). Null texts have no words. A null ``doc_id``
    is smaller than all others; rows with the same id do not remove each other's
    words. Texts shorter than a window stay whole. Other columns are not read.
    """
    ranges = repeated(docs, window)
    of_text = stored(
        ranges.groupBy("doc", "tie").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, texts, found = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in slices(texts):
                n_words, n_removed, spans, kept = [], [], [], []
                for text, own in zip(texts[a:b], found[a:b]):
                    words = text.encode("utf-8", "surrogatepass").split()
                    merged: list[list[int]] = []
                    for low, high in sorted((r["low"], r["high"]) for r in own or ()):
                        if merged and low <= merged[-1][1]:
                            merged[-1][1] = max(high, merged[-1][1])
                        else:
                            merged.append([low, high])
                    left, at = [], 0
                    for low, high in merged:
                        left += words[at:low]
                        at = high
                    left += words[at:]
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    spans.append([{"low": low, "high": high} for low, high in merged])
                    kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [
                        docs_.slice(a, b - a),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
                        pa.array(kept, pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"],
                )

    rows = _rows(docs).join(of_text, ["doc", "tie"], "left").select(
        F.when(F.col("doc") != LOWEST, F.col("doc")).alias("doc_id"), "text", "ranges"
    )
    return rows.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, spans array<struct<low: int, high: int>>, kept string"
    )
