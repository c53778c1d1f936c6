"""Pack token pieces into sequences of fixed length by fitted length patterns."""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voidage.llm.chunks import ChunkTable, slices
from voidage.llm.common import id_and_text, stored

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit; for a few ids much faster than an array of numpy."""
    return struct.pack(f"<{len(ids)}I", *ids)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Words that the tokenizer's model can be given directly: letters that are one sign
#: each in lower case and in every normal form, then signs that are neither letters,
#: numbers, an apostrophe nor part of a special token.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=?@\[\]^_`{}~]*)")
#: What a tokenizer must be made of for that.
STEPS = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])


class WordEncoder:
    """Ids of whole texts, words between spaces and line ends encoded once each.

    The tokenizer drops white space before it merges, so words are independent; so
    are the letters and the signs behind them of a simple word. Its letters go to the
    merging model without the steps before it, which cost far more and change only
    their case.
    """

    def __init__(self, path: str, most_words: int = 400_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        kinds = lambda step, parts: [p["type"] for p in (config[step] or {}).get(parts, [])]
        self.direct = (kinds("normalizer", "normalizers"), kinds("pre_tokenizer", "pretokenizers")) == STEPS
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(256) if SIMPLE.fullmatch(chr(c))]
        self.as_bytes = str.maketrans({c: byte_level.pre_tokenize_str(c)[0][0] for c in letters})
        self.table = ChunkTable(self._segment, most_words)

    def _whole(self, words: list[str]) -> list[bytes]:
        return [pack_ids(x.ids) for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _segment(self, words: list[str]) -> list[bytes]:
        parts = [SIMPLE.fullmatch(word) if self.direct else None for word in words]
        others = [word for word, part in zip(words, parts) if part is None]
        tails = list({part[2] for part in parts if part})
        found = iter(self._whole(others))
        tail = dict(zip(tails, self._whole(tails)))
        tokenize, stems = self.tokenizer.model.tokenize, {}
        out = []
        for part in parts:
            if part is None:
                out.append(next(found))
                continue
            letters = part[1].lower()
            stem = stems.get(letters)
            if stem is None:
                stem = stems[letters] = pack_ids([t.id for t in tokenize(letters.translate(self.as_bytes))])
            out.append(stem + tail[part[2]])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        blocks = [text.replace("\n", " ").split(" ") for text in texts]
        self.table.learn(blocks)
        get = self.table.__getitem__
        return [b"".join(map(get, block)) for block in blocks]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every whole text: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    Only texts longer than ``capacity`` are cut. A null or empty text has the end
    id alone. ``with_ids`` adds ``ids`` (binary, little-endian unsigned 32-bit).
    Other columns are not read; rows that repeat give pieces each.
    """
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = WordEncoder(tokenizer_path or default_tokenizer())
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                rows = []
                for key, ids in zip(keys[a:b], encoder.encode(texts[a:b])):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((key, number, at // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*rows))[: 5 + with_ids]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids],
                )

    return id_and_text(docs).mapInArrow(run, schema)


def patterns(lengths: np.ndarray, capacity: int, most: int = 1_500_000) -> np.ndarray:
    """Patterns of two and three lengths that fill a sequence exactly; rows of lengths, 0 for none.

    All pairs first; then, within the bound ``most`` on the driver's work, triples by
    a rising step between the largest lengths. Lengths that no pattern has are
    packed as residuals.
    """
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    pair = lengths[(lengths * 2 >= capacity) & (lengths < capacity)]
    pair = pair[there[capacity - pair]]
    out = [np.stack([pair, capacity - pair, 0 * pair], 1)]
    small = lengths[lengths < capacity]
    step = max(1, int(np.ceil(len(small) ** 2 / 12 / most)))
    for a in small[::-1][::step]:
        b = small[(small <= a) & (2 * small >= capacity - a) & (small < capacity - a)]
        b = b[there[capacity - a - b]]
        out.append(np.stack([np.full_like(b, a), b, capacity - a - b], 1))
    return np.concatenate(out).astype(np.int64)


def non_negative_fit(found: np.ndarray, counts: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring the sum of their lengths nearest to the histogram.

    Least squares of (A x - counts), A's columns the patterns, by accelerated
    projected gradient; residuals are weighed by length, as long pieces are the
    hardest to place later.
    """
    size = len(counts)
    weight = np.zeros(size)
    weight[1:] = np.sqrt(np.arange(1, size) / size)
    flat = found.ravel()

    def forward(x):
        return weight * np.bincount(flat, np.repeat(x, 3), size)

    def back(r):
        return (weight * r)[found].sum(1)

    target = weight * counts
    probe = np.ones(len(found))
    for _ in range(12):  # the largest eigenvalue bounds the step
        probe = back(forward(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        after = np.maximum(0, y - back(forward(y) - target) / (1.05 * norm))
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences for a histogram of lengths: ([(length, how many)], number of such sequences).

    Patterns are fitted, rounded down and taken as far as pieces are left; what
    remains is packed best-fit decreasing, equal lengths and equal sequences
    together. Work depends on the capacity, not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        out.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    found = patterns(lengths, capacity)
    if len(found):
        fit = non_negative_fit(found, left.astype(float))
        order = np.argsort(-fit, kind="stable")
        for k in order[: int((fit >= 1).sum())]:
            items: dict[int, int] = {}
            for length in found[k]:
                if length:
                    items[int(length)] = items.get(int(length), 0) + 1
            times = min(int(fit[k]), *(int(left[x]) // n for x, n in items.items()))
            if times > 0:
                out.append((list(items.items()), times))
                for x, n in items.items():
                    left[x] -= times * n
    # Residuals: open sequences by free room, each entry a list of (items, how many).
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []

    def put(room: int, items, times: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((items, times))

    for length in np.flatnonzero(left)[::-1]:
        length, rest = int(length), int(left[length])
        while rest:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if rest >= each:
                    put(capacity - each * length, [(length, each)], rest // each)
                if rest % each:
                    put(capacity - (rest % each) * length, [(length, rest % each)], 1)
                break
            room = rooms[at]
            items, times = open_[room].pop()
            each = min(room // length, rest)
            taken = min(times, rest // each)
            if taken < times:
                open_[room].append((items, times - taken))
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            put(room - each * length, [*items, (length, each)], taken)
            rest -= taken * each
    out += [entry for entries in open_.values() for entry in entries]
    return out


def places(planned: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """The plan as ranges of ranks within each length, sorted by (length, first rank)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for items, times in planned:
        offset = 0
        for length, each in items:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset, each))
            used[length] = first + times * each
            offset += length * each
        sequence += times
    rows.sort()
    names = ("length", "first", "sequence", "offset", "each")
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(names)}


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... among the pieces of equal length.

    Pieces of one length are dealt to ``buckets`` by their document, numbered within
    each, and moved on by what the earlier buckets hold: a length that very many
    documents share is never sorted in one task.
    """
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sums = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(sums, ["length", "bucket"]).withColumn("rank", F.col("ahead") + F.col("own")).drop(
        "bucket", "own", "ahead"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (see ``token_pieces``) with ``sequence_id`` and ``offset``, in few sequences without gaps.

    Only the histogram of lengths, of at most ``capacity`` entries, reaches the
    driver. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces)
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    table = places(plan(counts, capacity))
    key = table["length"] << 44 | table["first"]
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            nth = rank - table["first"][at]
            sequence = table["sequence"][at] + nth // table["each"][at]
            offset = table["offset"][at] + nth % table["each"][at] * length
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked(pieces, buckets).mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (binary), each of at most ``capacity`` ids."""
    pieces = token_pieces(docs, tokenizer_path, capacity, with_ids=True)
    keys = ["doc_id", "piece", "ids_crc32"]
    joined = pieces.dropDuplicates(keys).join(packed.select(*keys, "sequence_id", "offset"), keys)
    parts = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select(
        "sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"])).alias("ids")
    )
