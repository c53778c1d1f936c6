"""Segment distinct chunks of text once and put their ids back in place."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator


class ChunkTable(dict):
    """Chunk -> value, filled by ``segment`` with all unseen chunks of a block at once.

    Its size is bounded, so a worker's memory does not grow with the vocabulary of
    the corpus: beyond ``most`` chunks only those that the block at hand uses stay,
    or none with ``renew``.
    """

    def __init__(self, segment: Callable[[list[str]], Iterable], most: int = 400_000, renew: bool = False):
        super().__init__()
        self.segment, self.most, self.renew = segment, most, renew

    def learn(self, blocks: Iterable[list[str]]) -> None:
        used = set().union(*blocks)
        # Not set.difference, which goes through the whole table unless it is a plain dict.
        unseen = [chunk for chunk in used if chunk not in self]
        if not unseen:
            return
        if len(self) + len(unseen) > self.most:
            kept = {} if self.renew else {chunk: self[chunk] for chunk in used if chunk in self}
            if self.renew:
                unseen = list(used)
            self.clear()
            self.update(kept)
        self.update(zip(unseen, self.segment(unseen)))


def slices(values: list[str], most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of consecutive texts of about ``most_chars`` together; a longer text is a run of its own."""
    start = size = 0
    for at, value in enumerate(values):
        if size and size + len(value) > most_chars:
            yield start, at
            start, size = at, 0
        size += len(value)
    if start < len(values):
        yield start, len(values)
