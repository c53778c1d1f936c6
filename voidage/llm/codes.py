"""Vectors as codes: each part of a vector is named by the nearest entry of a codebook.

The nearest of at most 64 entries is found by slicing and intersecting.  In every
dimension the entries' coordinates are sorted, and each place in that order carries a
64-bit mask of the entries before it; two places then give the entries within a range.
The ranges of all dimensions, as wide as the distance to a first guess, are combined
by AND.  What is left has the nearest entry in it, and is gone through exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voidage.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components beyond this are refused: sums of their squares would leave 64 bits.
LARGEST = 1 << 27

_ONE = np.uint64(1)


class Slices:
    """One part's codebook, prepared for exact nearest-entry searches."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        count, width = self.entries.shape
        if not 0 < count <= 64:
            raise ValueError("a codebook has 1 to 64 entries")
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, 0).T.copy()
        bits = _ONE << order.T.astype(np.uint64)
        self.before = np.zeros((width, count + 1), np.uint64)
        np.bitwise_or.accumulate(bits, axis=1, out=self.before[:, 1:])

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that are within ``radius`` of each point in every dimension."""
        found = np.full(len(points), ~np.uint64(0))
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[d], points[:, d] + radius, "right")
            found &= self.before[d][high] ^ self.before[d][low]
        return found

    def _distance(self, points: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((points - self.entries[entry]) ** 2).sum(1)

    def guess(self, points: np.ndarray) -> np.ndarray:
        """An entry near each point along the dimension in which the entries lie farthest apart."""
        d = int(np.argmax(self.entries.max(0) - self.entries.min(0)))
        order = np.argsort(self.entries[:, d], kind="stable")
        at = np.searchsorted(self.sorted[d], points[:, d]).clip(1, max(1, len(order) - 1))
        left, right = self.sorted[d][at - 1], self.sorted[d][np.minimum(at, len(order) - 1)]
        nearer = points[:, d] - left <= right - points[:, d]
        return order[np.where(nearer, at - 1, np.minimum(at, len(order) - 1))]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point; of equal distances the lowest index."""
        points = np.asarray(points, np.int64)
        best = np.full(len(points), 64, np.int64)
        least = self._distance(points, self.guess(points)) if len(points) else np.zeros(0, np.int64)
        radius = np.ceil(np.sqrt(least.astype(float))).astype(np.int64) + 1
        masks = self.candidates(points, radius)
        rows = np.flatnonzero(masks)
        left = masks[rows]
        while len(rows):
            # The lowest candidate of each row; later ones have to be nearer than it.
            entry = np.bitwise_count((left & (~left + _ONE)) - _ONE).astype(np.int64)
            distance = self._distance(points[rows], entry)
            better = (distance < least[rows]) | ((distance == least[rows]) & (entry < best[rows]))
            best[rows[better]], least[rows[better]] = entry[better], distance[better]
            left = left & (left - _ONE)
            some = left != 0
            rows, left = rows[some], left[some]
        return best, least


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``label`` and ``parts`` of the kept rows: components times 256, all floors going down.

    Rows go whose vector is null or empty, or holds a null or non-finite component.
    """
    vector = vectors[vector_col]
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    floors = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return vectors.filter(vector.isNotNull() & (F.size(vector) > 0) & usable).select(
        vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), floors.alias("values")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"a vector does not have {width} components")
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component of a vector is beyond {LARGEST // SCALE}")
    return values


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The parts of the ``entries`` smallest ids, of equal ids the smaller values first: parts x entries x width.

    None without rows. Fewer rows give as many entries.
    """
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "values").select("values").limit(entries).collect()
    if not chosen:
        return None
    lengths = {len(row[0]) for row in chosen}
    if len(lengths) > 1 or min(lengths) % parts:
        raise ValueError(f"vectors cannot be cut into {parts} equal parts: {sorted(lengths)} components")
    values = np.array([row[0] for row in chosen], np.int64)
    return values.reshape(len(values), parts, -1).transpose(1, 0, 2).copy()


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose used entries are the floors of the means of the parts assigned to them.

    Each task sums its parts per entry, Spark adds the sums up; no more than the
    codebooks' own size reaches the driver. Sums are of integers, so their order
    does not matter, nor how often a task was run.
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(book) for book in books]
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            values = _matrix(batch.column(0), parts * width).reshape(-1, parts, width)
            for p in range(parts):
                nearest, _ = slices[p].nearest(values[:, p])
                counts[p] += np.bincount(nearest, minlength=entries)
                np.add.at(sums[p], nearest, values[:, p])
        at, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(counts[at, entry]),
                pa.FixedSizeListArray.from_arrays(pa.array(sums[at, entry].ravel()), width).cast(pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "sums"],
        )

    partial = rows.select("values").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[k]) for k in range(width))).alias("sums")
    )
    after = books.copy()
    for row in total.collect():  # at most one row for each entry of each codebook
        after[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return after


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (bytes, one index per part) and ``error`` (squared distances summed over parts)."""
    parts, _, width = books.shape
    label_type = rows.schema["label"].dataType.simpleString()
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(book) for book in books]
        for batch in batches:
            values = _matrix(batch.column(2), parts * width).reshape(-1, parts, width)
            found = [slices[p].nearest(values[:, p]) for p in range(parts)]
            codes = np.stack([nearest for nearest, _ in found], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    pa.array(sum(least for _, least in found)),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return rows.select("vec_id", "label", "values").mapInArrow(
        run, f"vec_id {id_type}, label {label_type}, code binary, error long"
    )


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``, the error summed over equal labels, nulls together. ``codes`` is read twice.

    Sums are combined before the shuffle, one row per label goes back to the rows by
    an equi-join that adaptive execution can split where a label is frequent.
    """
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return codes.join(totals, codes["label"].eqNullSafe(totals["__label"])).drop("__label")


def decoded(code: Column, books: np.ndarray) -> Column:
    """The scaled components that a code stands for, as an array."""
    table = F.array(*(F.array(*(F.array(*map(F.lit, map(int, entry))) for entry in book)) for book in books))
    at = lambda p: F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int")
    return F.flatten(F.array(*(table[p][at(p)] for p in range(len(books)))))


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all kept vectors with ``label_error``, and the codebooks they refer to.

    Codebooks start as the parts of the ``entries`` smallest ids; each of ``rounds``
    rounds assigns every part and moves the entries; then parts are assigned again.
    Rows that repeat are coded and counted as often; a null id comes after all others.
    Without a kept row there are no codes and no codebooks. Vectors of unequal length,
    of a length that cannot be cut into ``parts``, or with components beyond
    ``LARGEST / 256`` raise ValueError. Other columns are not read.
    """
    rows = scaled(vectors, id_col, vector_col, label_col)
    books = first_codebooks(rows, parts, entries)
    if books is None:
        empty = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.withColumn("label_error", F.col("error")).limit(0), None
    for _ in range(rounds):
        books = moved(rows, books)
    return with_label_error(stored(coded(rows, books))), books
