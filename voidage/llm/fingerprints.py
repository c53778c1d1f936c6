"""Similarity digests of improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import slices
from voidage.llm.common import id_and_text, stored
from voidage.llm.hashing import PLACES, U64, mixed

#: Bytes of a window, and windows of a run in which the rarest one gets a point.
WINDOW = RUN = 64
#: Points that make a window a feature.
POINTS = 16
#: Bits of a filter, bits a feature sets, features until the next filter is begun.
BITS, HASHES, FEATURES = 2048, 5, 160
#: Equal pairs among the bytes of a window: 0 to 2016. The entropy of order two
#: of a window with p equal pairs is log2(4096 / (64 + 2 p)).
PAIRS = WINDOW * (WINDOW - 1) // 2
#: Windows of less than 2.2 bits are fillings and never features.
MOST_PAIRS = int((4096 / 2**2.2 - 64) / 2)


def equal_pairs(data: np.ndarray) -> np.ndarray:
    """For each window its number of pairs of equal bytes, from which its entropy follows."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    enters, leaves = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        enters[d:] += same  # with the bytes before it that lie in its window
        leaves[:-d] += same
    first = sum(int((data[d:WINDOW] == data[: WINDOW - d]).sum()) for d in range(1, WINDOW))
    step = enters[WINDOW:].astype(np.int64) - leaves[: n - 1]
    return first + np.concatenate([[0], np.cumsum(step)])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in line and where each ends."""
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _spread(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


def window_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each number of equal pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS + 1, np.int64)
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for a, b in slices(texts, 150_000):
                data, ends = joined(texts[a:b])
                lengths = np.diff(ends, prepend=0)
                pairs = equal_pairs(data)
                valid = _spread(np.maximum(0, lengths - WINDOW + 1), ends - lengths)
                total += np.bincount(pairs[valid], minlength=PAIRS + 1)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["pairs", "n"])

    counts = id_and_text(docs).mapInArrow(run, "pairs long, n long").groupBy("pairs").agg(F.sum("n").alias("n"))
    out = np.zeros(PAIRS + 1, np.int64)
    for row in counts.collect():  # at most one row per possible number of pairs
        out[row["pairs"]] = row["n"]
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each number of pairs, the rarest entropy first; -1 for windows that are no features."""
    out = np.empty(PAIRS + 1, np.int64)
    out[np.argsort(counts, kind="stable")] = np.arange(PAIRS + 1)
    out[MOST_PAIRS + 1 :] = -1
    return out


def feature_places(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in line, the places of their features in it, and which text each is of."""
    data, ends = joined(texts)
    lengths = np.diff(ends, prepend=0)
    starts = ends - lengths
    n = len(data) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return data, none, none
    worst = 1 << 60
    key = np.full(len(data) + RUN, worst, np.int64)
    found = rank[equal_pairs(data)]
    key[:n] = np.where(found < 0, worst, found << 40 | np.arange(n))
    windows = np.maximum(0, lengths - WINDOW + 1)
    # A window that begins in one text and ends in the next is none.
    key[_spread(lengths - windows, starts + windows)] = worst
    least, span = key, 1
    while span < RUN:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    runs = np.where(windows > 0, np.maximum(1, windows - RUN + 1), 0)
    tops = least[_spread(runs, starts)]
    # A text of fewer windows than a run is one run; what follows its last window is not its own.
    owner = np.repeat(np.arange(len(texts)), runs)
    places = tops & ((1 << 40) - 1)
    good = (tops < worst) & (places < (starts + windows)[owner])
    short = (runs == 1) & (windows < RUN)
    points = np.bincount(places[good], minlength=1)
    place = np.flatnonzero(points)
    of = np.searchsorted(ends, place, "right")
    keep = points[place] >= np.minimum(POINTS, runs[of])
    place, of = place[keep], of[keep]
    if short.any():
        # Their one run may have been won by a window of the next text.
        extra = []
        for k in np.flatnonzero(short):
            own = key[starts[k] : starts[k] + windows[k]]
            if own.min() < worst:
                extra.append((starts[k] + int(own.argmin()), k))
        regular = ~short[of]
        place = np.concatenate([place[regular], np.array([p for p, _ in extra], np.int64)])
        of = np.concatenate([of[regular], np.array([k for _, k in extra], np.int64)])
        order = np.argsort(place)
        place, of = place[order], of[order]
    return data, place, of


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view(U64)
    out = np.zeros(len(words), U64)
    for k in range(words.shape[1]):
        out += mixed(words[:, k] + PLACES[k]) * PLACES[k]
    return mixed(out)


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[bytes]:
    """Chained filters of each text: 2 bytes, the features in the last filter, then the filters.

    A text without any feature, too short or too regular, has itself as the only
    one; an empty text has no filter.
    """
    data, place, of = feature_places(texts, rank)
    if len(place):
        hashes = _hash_rows(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[place])
    else:
        hashes = np.zeros(0, U64)
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for k, text in enumerate(texts):
        own = hashes[bounds[k] : bounds[k + 1]]
        if not len(own):
            if not text:
                out.append(b"\0\0")
                continue
            padded = np.frombuffer(text + bytes(-len(text) % WINDOW), np.uint8).reshape(-1, WINDOW)
            total = np.array([len(text)], U64) + _hash_rows(padded).cumsum()[-1:]
            own = mixed(total)
        _, first = np.unique(own, return_index=True)
        own = own[np.sort(first)]
        chain = np.zeros((-(-len(own) // FEATURES), BITS), np.uint8)
        filters = np.arange(len(own)) // FEATURES
        for j in range(HASHES):
            chain[filters, (own >> U64(11 * j) & U64(BITS - 1)).astype(np.int64)] = 1
        last = len(own) - FEATURES * (len(chain) - 1)
        out.append(last.to_bytes(2, "little") + np.packbits(chain, axis=1).tobytes())
    return out


def likeness(x: bytes, y: bytes) -> float:
    """0 to 1: bit overlap beyond chance, of the most it could be, of each filter of the shorter chain with its best match.

    Equal fingerprints give 1; two empty ones too; an empty and another one 0.
    """
    if x == y:
        return 1.0
    if len(x) > len(y):
        x, y = y, x
    if len(x) <= 2:
        return 0.0
    chains = [np.frombuffer(z[2:], np.uint64).reshape(-1, BITS // 64) for z in (x, y)]
    features = [np.full(len(c), float(FEATURES)) for c in chains]
    for z, f in zip((x, y), features):
        f[-1] = int.from_bytes(z[:2], "little")
    a, b = chains
    set_a, set_b = (np.bitwise_count(c).sum(1).astype(float) for c in chains)
    unset = 1 - 1 / BITS
    total = 0.0
    for k in range(len(a)):
        overlap = np.bitwise_count(a[k] & b).sum(1)
        most = np.minimum(set_a[k], set_b)
        na, nb = features[0][k] * HASHES, features[1] * HASHES
        chance = BITS * (1 - unset**na - unset**nb + unset ** (na + nb))
        chance = chance + 0.1 * (most - chance)
        room = most - chance
        score = np.where(room > 0, (overlap - chance) / np.where(room > 0, room, 1), overlap >= most)
        total += float(np.clip(score, 0, 1).max())
    return total / len(a)


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double"
)
_KIND = "place int, text string, tie long, row long"


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first signs of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple[int, str]], following: str, rank: np.ndarray) -> list[list]:
    """Result columns of ``rows`` (id, text); ``following`` comes after the last one."""
    import hashlib

    texts = [text for _, text in rows]
    after = texts[1:] + [following]
    changed = [edited(a, b).encode("utf-8", "surrogatepass") for a, b in zip(texts, after)]
    own = fingerprints([t.encode("utf-8", "surrogatepass") for t in [*texts, following]], rank)
    other = fingerprints(changed, rank)
    return [
        [i for i, _ in rows],
        [len(t) for t in texts],
        [hashlib.sha256(t).hexdigest() for t in changed],
        own[:-1],
        other,
        [likeness(a, b) for a, b in zip(own, other)],
        [likeness(a, b) for a, b in zip(own, own[1:])],
    ]


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def with_edits(docs: DataFrame, most_chars: int = 150_000) -> DataFrame:
    """Every whole text's fingerprint, that of its edited text, and how like they and the next document's are.

    Documents follow each other by ascending ``doc_id`` (null first; rows that
    repeat an id by a hash of their text); after the last comes the first. A null
    text is empty. Other columns are not read.

    Rows are dealt by ranges of their order, once. A task goes through its run with
    one row in hand; only its last row needs the first of the next run, and these
    few rows are brought together afterwards.
    """
    rank = ranks(window_counts(docs))
    ordered = id_and_text(docs).withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    by = ["doc_id", "tie", "row"]
    # Texts travel compressed.
    dealt = ordered.mapInArrow(_compressed, "doc_id long, data binary, tie long, row long")
    dealt = dealt.repartitionByRange(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain = zstandard.ZstdDecompressor().decompress
        empty = [pa.nulls(0, t) for t in (pa.int32(), pa.string(), pa.int64(), pa.int64())]

        def finished(rows: list[tuple[int, str]], following: str) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(_compared(rows, following, rank), _TYPES)]
            none = [pa.nulls(len(rows), t.type) for t in empty]
            return pa.RecordBatch.from_arrays([*columns, *none], names)

        def end(place: int, key, text: str, tie: int, row: int) -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in _TYPES[1:]]
            mark = [pa.array([x], t.type) for x, t in zip((place, text, tie, row), empty)]
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), *none, *mark], names)

        names = [*_NAMES, "place", "text", "tie", "row"]
        held: list[tuple[int, str]] = []
        size, last = 0, None
        for batch in batches:
            for key, data, tie, row in zip(*(c.to_pylist() for c in batch.columns)):
                text = plain(data).decode("utf-8", "surrogatepass")
                if last is None:
                    yield end(1, key, text, tie, row)
                if held and size + len(text) > most_chars:
                    yield finished(held, text)
                    held, size = [], 0
                held.append((key, text))
                size += len(text)
                last = (key, text, tie, row)
        if last is not None:
            if len(held) > 1:
                yield finished(held[:-1], held[-1][1])
            yield end(2, *last)

    result = stored(dealt.mapInArrow(run, f"{COLUMNS}, {_KIND}"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ends in order: a run's first row (1) stands behind the last row (2) of the run before."""
        first = waiting = None

        def one(row, following):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(_compared([row], following, rank), _TYPES)], _NAMES
            )

        for batch in batches:
            for key, place, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 1:
                    first = text if first is None else first
                    if waiting is not None:
                        yield one(waiting, text)
                        waiting = None
                else:
                    waiting = (key, text)
        if waiting is not None:
            yield one(waiting, first)

    ends = result.filter("place IS NOT NULL").select("doc_id", "place", "text", "tie", "row")
    # Two rows of each task: few enough for one. Many tasks look for them.
    closed = ends.repartition(1).sortWithinPartitions("doc_id", "tie", "row", "place").select("doc_id", "place", "text")
    return result.filter("place IS NULL").select(*_NAMES).union(closed.mapInArrow(close, COLUMNS))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        data = [pack(t.encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(data, pa.binary()), batch.column(2), batch.column(3)], ["doc_id", "data", "tie", "row"]
        )


def as_text(fingerprint: bytes) -> str:
    return base64.b64encode(fingerprint).decode()
