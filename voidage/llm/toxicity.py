"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import ChunkTable, slices
from voidage.llm.common import id_and_text

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, GRAM_DIM = 8, 12, 12
GRAMS = 1 << 13
MOST_WORDS = 20_000
#: Toxic rows, and half the clean rows, that the model is fitted on, chosen by a hash of their id.
SAMPLE = 1_500
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Signs of the longest input; longer words are read in parts, each half over the one before.
LONGEST = 40
_LONG = re.compile(rf"\S{{{LONGEST + 1}}}")
_MARKS = re.compile(f"[{re.escape(PUNCTUATION)}]+")


@dataclass
class Model:
    """Weights; ``vocabulary`` numbers the words that have a vector of their own, 0 is for all others."""

    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]


def parts_of(word: str) -> list[str]:
    """The word; one longer than an input without the punctuation around it is cut there, then into overlapping parts."""
    if len(word) <= LONGEST or len(word.strip(PUNCTUATION) or word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    pieces = [piece for piece in _MARKS.split(word) if piece] or [word]
    return [p[i : i + LONGEST] for p in pieces for i in range(0, max(1, len(p) - step), step)]


def split_words(text: str) -> list[str]:
    """Words of the whole text, long ones in parts."""
    words = text.lower().split()
    return [part for word in words for part in parts_of(word)] if _LONG.search(text) else words


def word_inputs(words: list[str], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary number of each word; buckets of its character triples, flat, and where each word's begin."""
    numbers = np.zeros(len(words), np.int64)
    flat: list[int] = []
    starts = np.zeros(len(words), np.int64)
    for k, word in enumerate(words):
        core = word.strip(PUNCTUATION) or word
        numbers[k] = vocabulary.get(core, 0)
        starts[k] = len(flat)
        marked = f"^{core}$".encode("utf-8", "replace")
        flat += [zlib.crc32(marked[i : i + 4]) % GRAMS for i in range(max(1, len(marked) - 3))]
    return numbers, np.array(flat, np.int64), starts


def word_vectors(weights, numbers, flat, starts) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of words (word and mean character part) and how many triples each has."""
    if not len(numbers):
        return np.zeros((0, WORD_DIM + GRAM_DIM), np.float32), np.zeros((0, 1), np.float32)
    lengths = np.diff(np.append(starts, len(flat))).astype(np.float32)[:, None]
    grams = np.add.reduceat(weights["grams"][flat], starts, axis=0) / lengths
    return np.concatenate([weights["words"][numbers], grams], axis=1), lengths


def gathered(indices: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` that have the same index."""
    order = np.argsort(indices, kind="stable")
    there, begin = np.unique(indices[order], return_index=True)
    out = np.zeros((size, values.shape[1]), np.float32)
    out[there] = np.add.reduceat(values[order], begin, axis=0)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def initial(n_words: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    dim = WORD_DIM + GRAM_DIM

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "words": np.zeros((n_words + 1, WORD_DIM), np.float32),
        "grams": normal(GRAMS, GRAM_DIM, scale=0.2),
        "input": normal(dim, 6 * HIDDEN, scale=0.4 / np.sqrt(dim) * 2),
        "bias": np.zeros(6 * HIDDEN, np.float32),
        "turn": normal(2, HIDDEN, 3 * HIDDEN, scale=0.5 / np.sqrt(HIDDEN)),
        "attend": normal(2 * HIDDEN, scale=0.1),
        "out": normal(2 * HIDDEN, scale=0.3),
        "out_bias": np.full(1, -1.0, np.float32),
    }


def forward(weights, projected: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows. ``projected``: (steps, windows, 6 * HIDDEN); ``mask``: (steps, windows).

    The second direction runs over the steps reversed; both go side by side.
    """
    steps, n = mask.shape
    both = np.empty((steps, 2, n, 3 * HIDDEN), np.float32)
    both[:, 0] = projected[..., : 3 * HIDDEN]
    both[:, 1] = projected[::-1, :, 3 * HIDDEN :]
    masks = np.stack([mask, mask[::-1]], 1)[..., None]
    state = np.zeros((2, n, HIDDEN), np.float32)
    states = np.empty((steps, 2, n, HIDDEN), np.float32)
    kept = []
    for t in range(steps):
        turned = state @ weights["turn"]
        gates = sigmoid(both[t, ..., : 2 * HIDDEN] + turned[..., : 2 * HIDDEN])
        update, reset = gates[..., :HIDDEN], gates[..., HIDDEN:]
        new = np.tanh(both[t, ..., 2 * HIDDEN :] + reset * turned[..., 2 * HIDDEN :])
        after = state + masks[t] * (1 - update) * (new - state)
        if keep:
            kept.append((state, update, reset, new, turned[..., 2 * HIDDEN :]))
        state = states[t] = after
    joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1)
    rating = joined @ weights["attend"]
    rating = np.where(mask > 0, rating, -1e9)
    share = np.exp(rating - rating.max(0))
    share /= share.sum(0)
    pooled = np.einsum("tn,tnh->nh", share, joined)
    logits = pooled @ weights["out"] + weights["out_bias"][0]
    return logits, (joined, share, pooled, kept, masks)


def backward(weights, cache, d_logits: np.ndarray):
    """Gradients of all weights but the embeddings, and of the projected inputs."""
    joined, share, pooled, kept, masks = cache
    steps, n = share.shape
    grad = {"out": pooled.T @ d_logits, "out_bias": d_logits.sum(keepdims=True), "turn": np.zeros_like(weights["turn"])}
    d_pooled = d_logits[:, None] * weights["out"]
    d_share = np.einsum("nh,tnh->tn", d_pooled, joined)
    d_rating = share * (d_share - (share * d_share).sum(0))
    grad["attend"] = np.einsum("tn,tnh->h", d_rating, joined)
    d_joined = share[..., None] * d_pooled + d_rating[..., None] * weights["attend"]
    d_states = np.stack([d_joined[..., :HIDDEN], d_joined[::-1, :, HIDDEN:]], 1)
    d_both = np.empty((steps, 2, n, 3 * HIDDEN), np.float32)
    carry = np.zeros((2, n, HIDDEN), np.float32)
    turn_back = weights["turn"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        state, update, reset, new, turned_new = kept[t]
        d_after = d_states[t] + carry
        scaled = masks[t] * d_after
        d_new = scaled * (1 - update) * (1 - new * new)
        d_update = -scaled * (new - state) * update * (1 - update)
        d_reset = d_new * turned_new * reset * (1 - reset)
        d_both[t] = np.concatenate([d_update, d_reset, d_new], -1)
        d_turned = np.concatenate([d_update, d_reset, d_new * reset], -1)
        grad["turn"] += state.transpose(0, 2, 1) @ d_turned
        carry = d_after - scaled * (1 - update) + d_turned @ turn_back
    return grad, np.concatenate([d_both[:, 0], d_both[::-1, 1]], -1)


class Windows:
    """Windows of texts as rows of a table of distinct words."""

    def __init__(self, texts: Sequence[Sequence[int]]):
        self.ids = np.fromiter(chain.from_iterable(texts), np.int64)
        ends = np.cumsum([len(text) for text in texts])
        starts, stops, owner = [], [], []
        at = 0
        for k, end in enumerate(ends):
            for start in window_starts(int(end) - at):
                starts.append(at + start)
                stops.append(min(at + start + WINDOW, int(end)))
                owner.append(k)
            at = int(end)
        self.starts, self.stops, self.owner = (np.array(x, np.int64) for x in (starts, stops, owner))

    def block(self, chosen) -> tuple[np.ndarray, np.ndarray]:
        """Word rows (steps, windows) and mask of the chosen windows."""
        starts, stops = self.starts[chosen], self.stops[chosen]
        steps = int((stops - starts).max())
        at = starts + np.arange(steps)[:, None]
        mask = at < stops
        return self.ids[np.where(mask, at, starts)], mask.astype(np.float32)


def window_starts(length: int) -> range:
    """Overlapping windows over ``length`` words; none of them lies within another."""
    return range(0, max(1, length - WINDOW + STRIDE), STRIDE) if length else range(0)


def logits_of(weights, projected: np.ndarray, windows: Windows, block: int = 1024) -> np.ndarray:
    # Windows of like length run together; short ones then have few empty steps.
    order = np.argsort(windows.starts - windows.stops, kind="stable")
    out = np.empty(len(order), np.float32)
    for a in range(0, len(order), block):
        rows, mask = windows.block(order[a : a + block])
        out[order[a : a + block]] = forward(weights, projected[rows], mask)[0]
    return out


def fit(texts: list[str], labels: np.ndarray, rounds: int = 7, seed: int = 11, doubted: float = 0.08) -> Model | None:
    """Train on whole texts; None unless both classes are there.

    A text counts as toxic if any window is. So after two rounds over random windows
    the loss is taken at each text's highest window, which for clean texts is the
    hardest one, and at a few others of the clean texts. Labels have errors: the
    share ``doubted`` of toxic texts that score lowest is then left out.
    """
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        return None
    # Words become numbers text by text: the driver never holds the words of all texts.
    seen: Counter[str] = Counter()
    distinct: dict[str, int] = {}
    numbered = []
    for text in texts:
        words = split_words(text)
        seen.update({w.strip(PUNCTUATION) or w for w in words})
        numbered.append(np.array([distinct.setdefault(w, len(distinct)) for w in words], np.int64))
    least = max(2, len(texts) // 300)  # a word of few texts would only tell those texts apart
    common = sorted((w for w, n in seen.items() if n >= least), key=lambda w: (-seen[w], w))[:MOST_WORDS]
    vocabulary = {word: k + 1 for k, word in enumerate(common)}
    numbers, flat, starts = word_inputs(list(distinct), vocabulary)
    ends = np.append(starts, len(flat))
    windows = Windows(numbered)
    owner, rng = windows.owner, np.random.default_rng(seed)
    weights = initial(len(vocabulary))
    if not len(owner):
        return Model(vocabulary, weights)
    negative = np.flatnonzero(labels == 0)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.items()}
    steps_done, decay = 0, 3e-5

    def step(chosen: np.ndarray, rate: float) -> None:
        nonlocal steps_done
        rows, mask = windows.block(chosen)
        unique, inverse = np.unique(rows, return_inverse=True)
        inverse = inverse.reshape(rows.shape)
        number = numbers[unique].copy()
        number[rng.random(len(number)) < 0.3] = 0  # so that characters alone tell, too
        parts = [flat[ends[u] : ends[u + 1]] for u in unique]
        begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
        grams = np.concatenate(parts)
        vectors, lengths = word_vectors(weights, number, grams, begin)
        logits, cache = forward(weights, (vectors @ weights["input"] + weights["bias"])[inverse], mask, keep=True)
        y = labels[owner[chosen]]
        scale = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
        grad, d_projected = backward(weights, cache, (sigmoid(logits) - y) * scale)
        d_rows = gathered(inverse.ravel(), (d_projected * mask[..., None]).reshape(-1, 6 * HIDDEN), len(unique))
        grad["input"], grad["bias"] = vectors.T @ d_rows, d_rows.sum(0)
        d_vectors = d_rows @ weights["input"].T
        grad["words"] = gathered(number, d_vectors[:, :WORD_DIM], len(weights["words"])) + decay * weights["words"]
        spread = np.repeat(d_vectors[:, WORD_DIM:] / lengths, lengths[:, 0].astype(np.int64), axis=0)
        grad["grams"] = gathered(grams, spread, GRAMS) + decay * weights["grams"]
        steps_done += 1
        for k, g in grad.items():  # Adam
            first, second = moments[k]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            corrected = rate * np.sqrt(1 - 0.999**steps_done) / (1 - 0.9**steps_done)
            weights[k] -= (corrected * first / (np.sqrt(second) + 1e-8)).astype(np.float32)

    def project() -> np.ndarray:
        vectors, _ = word_vectors(weights, numbers, flat, starts)
        return vectors @ weights["input"] + weights["bias"]

    toxic_window = labels[owner] == 1
    clean = np.flatnonzero(~toxic_window)
    for turn in range(rounds):
        if turn < 2:
            pool = [rng.permutation(np.flatnonzero(toxic_window)), rng.permutation(clean)]
            n = min(6_000, max(map(len, pool)))
            pos, neg, passes = np.resize(pool[0], n), np.resize(pool[1], n), max(1, 2_000 // n)
        else:
            found = logits_of(weights, project(), windows)
            order = np.lexsort((-found, owner))
            top = order[np.unique(owner[order], return_index=True)[1]]
            best = top[labels[owner[top]] == 1]
            best = best[np.argsort(-found[best], kind="stable")[: len(best) - int(doubted * len(best))]]
            hard = clean[np.argsort(-found[clean], kind="stable")[: 2 * len(negative)]]
            neg = np.concatenate([top[labels[owner[top]] == 0], hard, rng.permutation(clean)[: 2 * len(negative)]])
            pos, passes = np.resize(best, max(len(best), len(neg) // 2)), max(1, 8_000 // len(neg))
        rate = 0.015 if turn < 2 else 0.01 if turn < rounds - 2 else 0.003
        for _ in range(passes):
            batches = max(1, len(neg) // 64)
            for p, q in zip(np.array_split(rng.permutation(pos), batches), np.array_split(rng.permutation(neg), batches)):
                step(np.concatenate([p, q]), rate)
    return Model(vocabulary, weights)


class Scorer:
    """Scores texts; inputs of each distinct word are worked out once."""

    def __init__(self, model: Model, most_words: int = 150_000):
        self.model = model
        self.table = ChunkTable(self._rows, most_words, renew=True)
        self.projected = np.zeros((0, 6 * HIDDEN), np.float32)

    def _rows(self, words: list[str]) -> range:
        weights = self.model.weights
        vectors, _ = word_vectors(weights, *word_inputs(words, self.model.vocabulary))
        new = vectors @ weights["input"] + weights["bias"]
        at = len(self.projected) if self.table else 0
        self.projected = np.concatenate([self.projected[:at], new])
        return range(at, at + len(words))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: score, number of windows, first word of the highest window. 0 for a text without words."""
        split = [split_words(text) for text in texts]
        self.table.learn(split)
        get = self.table.__getitem__
        windows = Windows([list(map(get, words)) for words in split])
        scores, counts, tops = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        if len(windows.owner):
            found = sigmoid(logits_of(self.model.weights, self.projected, windows).astype(float))
            np.maximum.at(scores, windows.owner, found)
            counts = np.bincount(windows.owner, minlength=len(texts))
            order = np.lexsort((-found, windows.owner))
            owners, first = np.unique(windows.owner[order], return_index=True)
            begin = np.concatenate([[0], np.cumsum([len(words) for words in split])])
            tops[owners] = windows.starts[order[first]] - begin[owners]
            for k in owners:
                if _LONG.search(texts[k]):
                    ends = np.cumsum([len(parts_of(word)) for word in texts[k].lower().split()])
                    tops[k] = np.searchsorted(ends, tops[k], side="right")
        return scores, counts, tops


def held_out(doc_id):
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` toxic and twice as many clean rows, chosen by a hash of ``doc_id`` and never held out.

    None (all scores 0) where a class has no labelled row. Null labels and null ids
    are passed over; an id with both labels is toxic. Of rows that share an id the one
    of the least text hash is learned from, so no more than the sample reaches the driver.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [
        known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for kind, most in ((0, 2 * sample), (1, sample))
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))  # at most 3 * sample rows of two numbers
    of_hash = F.struct(F.xxhash64("text").alias("hash"), "text")
    sampled = id_and_text(docs).join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min(of_hash)["text"].alias("text"))
    rows = sampled.collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows]))


def _scores(model: Model | None, batches: Iterator[pa.RecordBatch], texts_at: int):
    scorer = model and Scorer(model)
    for batch in batches:
        texts = [text or "" for text in batch.column(texts_at).to_pylist()]
        for a, b in slices(texts, 1_000_000):
            if scorer is None:
                zero = np.zeros(b - a)
                yield batch.slice(a, b - a), (zero, zero.astype(np.int64), zero.astype(np.int64))
            else:
                yield batch.slice(a, b - a), scorer.score(texts[a:b])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``n_windows`` and ``top_window`` (its first word) of every whole text.

    The score is that of the highest of all overlapping windows. A null text or one
    without words has score 0 and no window. Rows that repeat are scored alike.
    Only id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (scores, counts, tops) in _scores(model, batches, 1):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(scores), pa.array(counts), pa.array(tops)],
                ["doc_id", "score", "n_windows", "top_window"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double, n_windows long, top_window long")


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows that score ``threshold`` or more. No shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (scores, _, _) in _scores(model, batches, at):
            yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
