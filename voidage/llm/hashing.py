"""Words and word sequences as 64-bit hashes, whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

from voidage.llm.chunks import ChunkTable

U64 = np.uint64
#: Odd multipliers for the places of a sequence.
PLACES = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) + 2 * k & 0xFFFFFFFFFFFFFFFF | 1 for k in range(64)], U64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers (in place): equal inputs and only those give equal outputs."""
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_RNG = np.random.default_rng(77)
#: Two random values of each byte, and odd bases with their inverses modulo 2^64.
VALUES = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASES = [int(x) * 4 + 5 & 0xFFFFFFFFFFFFFFFF for x in _RNG.integers(1 << 40, 1 << 61, 2)]
#: Bytes of text that are hashed at a time.
PIECE = 1 << 16
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Sums:
    """Hashes of any stretches of ``values`` in line, from prefix sums of values times powers of a base."""

    def __init__(self, values: np.ndarray, which: int):
        n = len(values)
        steps = np.ones(n + 1, U64)
        steps[1:] = BASES[which]
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * np.multiply.accumulate(steps)[:n], out=self.sums[1:])
        steps[1:] = pow(BASES[which], -1, 1 << 64)
        self.back = np.multiply.accumulate(steps)

    def of(self, starts, stops) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.back[starts])

    def grams(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.back[:n]) if n > 0 else np.zeros(0, U64)


def word_hashes(texts: list[str], hashes: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """One or two independent hashes of all words in line, and where each text's words end.

    Words are runs of bytes but 0x20 and 0x09 to 0x0D. They are found and hashed by
    whole arrays, without an object for each word, ``PIECE`` bytes or a longer word at
    a time; two hashes are of different bases and byte values.
    """
    raw = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    solid = ~_SPACE[data]
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in raw], dtype=np.int64))
    found = [np.empty(len(starts), U64) for _ in range(hashes)]
    a = 0
    while a < len(starts):
        low = starts[a]
        b = max(a + 1, int(np.searchsorted(stops, low + PIECE, "left")))
        part = data[low : stops[b - 1]]
        for which, out in enumerate(found):
            out[a:b] = Sums(VALUES[which][part], which).of(starts[a:b] - low, stops[a:b] - low)
        a = b
    return found, ends


class Words:
    """Hashes of words, runs of signs but space, tab and line ends, each distinct word hashed once."""

    def __init__(self, lower: bool = False, seed: int = 0, most: int = 300_000):
        import xxhash

        self.lower = lower
        digest = xxhash.xxh3_64_intdigest
        self.table = ChunkTable(lambda words: [digest(word, seed) for word in words], most)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in line, and where each text's words end."""
        raw = [text.encode("utf-8", "surrogatepass") for text in texts]
        # On bytes, lower() turns A-Z alone and split() cuts at 0x20 and 0x09 to 0x0D alone.
        blocks = [(text.lower() if self.lower else text).split() for text in raw]
        self.table.learn(blocks)
        ends = np.cumsum([len(block) for block in blocks]) if blocks else np.zeros(0, np.int64)
        get = self.table.__getitem__
        total = int(ends[-1]) if len(ends) else 0
        return np.fromiter((h for block in blocks for h in map(get, block)), U64, total), ends


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on; the last ``width - 1`` places have none."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for k in range(width):
        out += mixed(words[k : k + n] + PLACES[k]) * PLACES[k]
    return mixed(out)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word sequences; a shorter text is one sequence as a whole."""
    if not len(words):
        return np.zeros(0, U64)
    return np.unique(grams(words, min(width, len(words))))
