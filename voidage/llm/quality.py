"""Quality by a regularised quadratic discriminant over transformed statistics of whole texts.

Each class of documents is a Gaussian over the statistics, with a covariance shrunk
towards its own diagonal and towards that of both classes.  A text's score comes from
the difference of the two log densities, which needs its Mahalanobis distances; these
come from triangular solves with Cholesky factors that are worked out once per model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import slices
from voidage.llm.common import id_and_text

#: Rows of each class that the model is fitted on at most, chosen by a hash of their id.
SAMPLE = 6_000
#: Words per block; the worst block of a text is a statistic beside its mean.
BLOCK = 48
FOLDS = 5

LETTER, UPPER, DIGIT, SPACE, LINE, MARK, RARE = 1, 2, 4, 8, 16, 32, 64
# Signs of ordinary punctuation; other ASCII signs are rare ones.
_ORDINARY = b".,;:!?'\"()-"

NAMES = (
    "words", "letters", "capitals", "digits", "marks", "rare marks", "lines", "word length", "word length spread",
    "short words", "words with marks", "words all capitals", "words all marks", "words ending in a stop",
    "capitalised words", "repeated signs", "distinct words", "worst rare marks", "worst capitals", "worst short words",
)


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    for byte in range(256):
        sign = chr(byte)
        if byte >= 128 or sign.isalpha():
            kind[byte] = LETTER | (UPPER if sign.isascii() and sign.isupper() else 0)
        elif sign.isdigit():
            kind[byte] = DIGIT
        elif byte == 32 or 9 <= byte <= 13:
            kind[byte] = SPACE | (LINE if byte == 10 else 0)
        else:
            kind[byte] = MARK | (0 if byte in _ORDINARY else RARE)
    return kind


_KIND = _kinds()
_STOP = np.isin(np.arange(256), list(b".!?"))
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256).astype(np.uint64)


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values between starts and ends."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share; moderate for small numbers, defined for none."""
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(texts: list[str]) -> np.ndarray:
    """The transformed statistics of each text, texts x ``NAMES``. All are defined for empty texts."""
    raw = [text.encode("utf-8", "surrogatepass") for text in texts]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    starts = ends - np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    kind = _KIND[data]
    # UTF-8 bytes after the first belong to their sign.
    first = (data & 0xC0) != 0x80
    space = (kind & SPACE) > 0
    begins = ~space
    begins[1:] &= space[:-1]
    stops = ~space
    stops[:-1] &= space[1:]
    inner = starts[(starts > 0) & (starts < len(data))]
    begins[inner] = ~space[inner]
    before = ends[(ends > 0) & (ends < len(data))] - 1
    stops[before] = ~space[before]
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    word_of = np.searchsorted(at, np.stack([starts, ends]), "left")
    low, high = word_of
    n = high - low

    per = lambda mask: _sums(mask, at, to)
    size, letters, capitals = per(first), per((kind & LETTER > 0) & first), per((kind & UPPER) > 0)
    marks, rare = per((kind & MARK) > 0), per((kind & RARE) > 0)
    all_marks, all_capitals = letters + per((kind & DIGIT) > 0) == 0, (capitals == letters) & (letters > 1)
    short = (size <= 3) & (letters == size)
    with_marks = (rare > 0) & ~all_marks
    last = data[to - 1] if len(to) else data[:0]
    stop = _STOP[last]
    lead = (kind[at] & UPPER > 0) & ~all_capitals if len(at) else np.zeros(0, bool)
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~space[1:]
    same[inner] = False

    text = lambda values: _sums(values, low, high)
    whole = lambda mask: _sums(mask, starts, ends)
    signs, of_letters = whole(first), text(letters)
    mean = text(size) / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(text(size * size) / np.maximum(n, 1) - mean * mean, 0))
    hashes = _word_hashes(data, at, to)
    owner = np.repeat(np.arange(len(texts)), n)
    marked = hashes ^ (owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    distinct = np.bincount(owner[np.unique(marked, return_index=True)[1]], minlength=len(texts))

    # Blocks of words; the last one of a text takes the words that are left.
    blocks = np.maximum(n // BLOCK, 1)
    of_block = np.repeat(np.arange(len(texts)), blocks)
    number = np.arange(len(of_block)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    b_low = low[of_block] + number * BLOCK
    b_high = np.where(number == blocks[of_block] - 1, high[of_block], b_low + BLOCK)
    begin = np.cumsum(blocks) - blocks
    b_words, b_letters = b_high - b_low, _sums(letters, b_low, b_high)

    def worst(part, of, take):
        return take.reduceat(_odds(part, of), begin) if len(begin) else np.zeros(0)

    columns = (
        np.log1p(n),
        _odds(of_letters, signs),
        _odds(text(capitals), of_letters),
        _odds(whole((kind & DIGIT) > 0), signs),
        _odds(text(marks), signs),
        _odds(text(rare), signs),
        np.log((whole((kind & LINE) > 0) + 1) / (n + 10)),
        np.log1p(mean),
        np.log1p(spread),
        _odds(text(short), n),
        _odds(text(with_marks), n),
        _odds(text(all_capitals), n),
        _odds(text(all_marks), n),
        _odds(text(stop), n),
        _odds(text(lead), n),
        _odds(whole(same), signs),
        np.log((distinct + 1) / np.sqrt(n + 1)),
        worst(_sums(rare, b_low, b_high), b_words + _sums(size, b_low, b_high), np.maximum),
        worst(_sums(capitals, b_low, b_high), b_letters, np.maximum),
        worst(_sums(short, b_low, b_high), b_words, np.minimum),
    )
    return np.stack(columns, 1).astype(float) if len(texts) else np.zeros((0, len(NAMES)))


def _word_hashes(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """A number for each word, from its bytes and their places; a statistic may bear a rare collision."""
    if not len(at):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data), dtype=np.uint32)
    # Gaps count on from the word before; nothing is summed over them.
    offset = place - np.repeat(place[at], np.diff(np.append(at, len(data)))) if not at[0] else place - np.concatenate(
        [np.zeros(at[0], np.uint32), np.repeat(place[at], np.diff(np.append(at, len(data))))]
    )
    mixed = _BYTE[data] * ((offset.astype(np.uint64) << np.uint64(1)) | np.uint64(1))
    mixed ^= mixed >> np.uint64(31)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return total[to] - total[at]


@dataclass
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray  # lower Cholesky factor of the covariance
    log_scale: float

    @classmethod
    def of(cls, x: np.ndarray, shrink: float, common: np.ndarray) -> Gaussian:
        """Of the rows ``x``; ``shrink`` goes to their own diagonal and, half as much, to the ``common`` one."""
        mean = x.mean(0)
        covariance = np.cov(x, rowvar=False, bias=True).reshape(x.shape[1], -1)
        covariance = (1 - shrink) * covariance + shrink * (np.diag(np.diag(covariance)) + np.diag(common)) / 2
        covariance += 1e-3 * np.eye(len(mean))
        factor = np.linalg.cholesky(covariance)
        return cls(mean, factor, float(np.log(np.diag(factor)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        """Without the constant that all classes share."""
        solved = forward_solve(self.factor, (x - self.mean).T)
        return -0.5 * (solved * solved).sum(0) - self.log_scale


def forward_solve(factor: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The solution of ``factor @ y = right`` for a lower triangular factor."""
    out = np.empty_like(right)
    for k in range(len(factor)):
        out[k] = (right[k] - factor[k, :k] @ out[:k]) / factor[k, k]
    return out


@dataclass
class Model:
    """Scaling of the statistics, both classes, and how log-density differences become scores."""

    centre: np.ndarray
    scale: np.ndarray
    low: Gaussian
    high: Gaussian
    slope: float
    offset: float

    def difference(self, stats: np.ndarray) -> np.ndarray:
        x = within(stats, self.centre, self.scale)
        return self.high.log_density(x) - self.low.log_density(x)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * squeezed(self.difference(stats)) + self.offset)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def squeezed(difference: np.ndarray) -> np.ndarray:
    """Log-density differences with long tails drawn in, in the same order."""
    return np.arcsinh(difference / 2)


def within(stats: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Centred and scaled, with outliers drawn in."""
    return 4 * np.tanh((stats - centre) / scale / 4)


def _discriminant(stats: np.ndarray, labels: np.ndarray, shrink: float) -> Model:
    centre = np.median(stats, axis=0)
    scale = np.maximum(np.std(stats, axis=0), 1e-2)
    x = within(stats, centre, scale)
    classes = [x[labels == k] for k in (0, 1)]
    common = sum(np.var(c, axis=0) for c in classes) / 2
    return Model(centre, scale, *(Gaussian.of(c, shrink, common) for c in classes), 1.0, 0.0)


def calibrated(difference: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits the labels best, a slope above 0; by Newton steps."""
    x = np.stack([squeezed(difference), np.ones(len(difference))], 1)
    weights = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - labels) + 1e-3 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        weights = weights - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return max(float(weights[0]), 1e-3), float(weights[1])


def fit(stats: np.ndarray, labels: np.ndarray, shrinks: tuple[float, ...] = (0.02, 0.1, 0.3, 0.6)) -> Model | None:
    """The discriminant whose shrinkage predicts rows left out best; None unless both classes have rows.

    Folds are the rows in turn. Differences of the rows left out also set the curve
    that turns differences into scores, so scores are shares of label 1 among
    texts like these.
    """
    labels = np.asarray(labels, int)
    if len(labels) < 2 or len(set(labels.tolist())) < 2:
        return None
    fold = np.zeros(len(labels), int)
    for kind in (0, 1):
        rows = np.flatnonzero(labels == kind)
        fold[rows] = np.arange(len(rows)) % FOLDS
    best = None
    for shrink in shrinks:
        left_out = np.zeros(len(labels))
        for k in range(FOLDS):
            kept = fold != k
            if len(set(labels[kept].tolist())) < 2:
                kept = np.ones(len(labels), bool)
            left_out[fold == k] = _discriminant(stats[kept], labels[kept], shrink).difference(stats[fold == k])
        slope, offset = calibrated(left_out, labels)
        p = sigmoid(slope * squeezed(left_out) + offset)
        loss = -np.log(np.where(labels == 1, p, 1 - p)).mean()
        if best is None or loss < best[0]:
            best = loss, shrink, slope, offset
    model = _discriminant(stats, labels, best[1])
    model.slope, model.offset = best[2], best[3]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _with_statistics(rows: DataFrame, keep: str, block_chars: int = 1_000_000) -> DataFrame:
    """Statistics of each text; ``rows`` have the columns of ``keep`` and then ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in slices(texts, block_chars):
                part = batch.slice(a, b - a)
                found = pa.array(list(statistics(texts[a:b])), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], [*part.schema.names[:-1], "stats"])

    return rows.mapInArrow(run, f"{keep}, stats array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` rows of each quality, chosen by a hash of ``doc_id`` and never held out.

    None (all scores 0.5) where a class has no labelled row. Null labels and ids are
    passed over, an id with both labels is of low quality, and of rows that share an
    id the one of the least text hash counts. Statistics are worked out in Spark's
    tasks; ``2 * sample`` rows of them are all that reaches the driver.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    parts = [
        known.filter(F.col("quality") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for kind in (0, 1)
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))  # at most 2 * sample rows of two numbers
    of_hash = F.struct(F.xxhash64("text").alias("hash"), "text")
    rows = id_and_text(docs).join(chosen, "doc_id").groupBy("doc_id", "quality").agg(F.min(of_hash)["text"].alias("text"))
    found = sorted(_with_statistics(rows, "doc_id long, quality int").collect(), key=lambda r: r["doc_id"])
    if not found:
        return None
    return fit(np.array([r["stats"] for r in found]), np.array([r["quality"] for r in found]))


def score(docs: DataFrame, model: Model | None, block_chars: int = 1_000_000) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, higher: better) and ``difference`` of log densities of every whole text.

    A null text is an empty one, whose statistics are those of no words. Rows that repeat
    are scored alike. Only id and text are read, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, block_chars):
                if model is None:
                    scores, difference = np.full(b - a, 0.5), np.zeros(b - a)
                else:
                    difference = model.difference(statistics(texts[a:b]))
                    scores = sigmoid(model.slope * squeezed(difference) + model.offset)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(scores), pa.array(difference)],
                    ["doc_id", "score", "difference"],
                )

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double, difference double")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows that score below ``threshold``; all rows without a model."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(at).to_pylist()]
            for a, b in slices(texts, 1_000_000):
                part = batch.slice(a, b - a)
                yield part if model is None else part.filter(pa.array(model.score(statistics(texts[a:b])) >= threshold))

    return docs.mapInArrow(run, docs.schema)
