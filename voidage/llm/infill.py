"""Fill-in-the-middle: texts cut at token boundaries and put together again in another order.

Tokens are runs of letters A-Z and a-z, and every other sign alone.  Signs fall into
three classes: letters that begin a run, letters that go on with one, and others.
A wavelet matrix over the classes of a whole block of texts tells how many boundaries
lie before any place (the ranks of two classes together), and bisection on those
ranks finds the places of all cuts of the block at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voidage.llm.chunks import slices
from voidage.llm.common import id_and_text
from voidage.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OTHER, BEGINS, GOES_ON = 0, 1, 2
#: Of 100: draws that transform a text, and transformed ones with the suffix in front.
TRANSFORMED, SUFFIX_FIRST = 90, 20

_SCHEMA = "doc_id long, form string, n long, prefix_chars long, middle_chars long, output string"


def classes(signs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each code point; ``starts`` are where texts begin in the block."""
    letter = ((signs | 32) >= 97) & ((signs | 32) <= 122)
    after = np.zeros(len(signs), bool)
    after[1:] = letter[:-1]
    after[starts[starts < len(signs)]] = False
    return np.where(letter, np.where(after, GOES_ON, BEGINS), OTHER).astype(np.uint8)


def cut_places(texts: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text, and its two cuts in code points, from two draws per text (texts x 2, unsigned)."""
    lengths = np.array([len(text) for text in texts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    signs = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    matrix = WaveletMatrix(classes(signs, starts), 2)
    boundaries = (OTHER, BEGINS)  # a token begins at each of these
    first = matrix.ranks(boundaries, starts)
    tokens = matrix.ranks(boundaries, ends) - first
    units = np.sort(draws.astype(np.int64) % (tokens + 1)[:, None], axis=1)
    # The cut after k units is where unit k + 1 begins, one sign before k + 1 boundaries have passed.
    low, high = (np.repeat(x, 2) for x in (starts, ends))
    wanted = (first[:, None] + units).ravel() + 1
    after = matrix.select(boundaries, wanted, low, high)
    whole = (units == tokens[:, None]).ravel()
    places = np.where(whole, high, after - 1).reshape(-1, 2) - starts[:, None]
    return tokens, places


def draws_of(doc_id: Column) -> list[Column]:
    """Four unsigned draws from a document's id."""
    digest = F.sha2(F.concat(F.lit("1:"), doc_id.cast("string")).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST, block_chars: int = 1_000_000
) -> DataFrame:
    """``doc_id``, ``form``, ``n`` (tokens), ``prefix_chars``, ``middle_chars`` and ``output`` of every whole text.

    Forms: ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle, each behind
    its mark; a text stays ``plain``, with null parts, if it is empty (null counts as
    empty), contains one of the marks, or its draw says so.  ``transformed`` and
    ``suffix_first`` are shares in 100.

    Two draws of the document's id modulo tokens + 1 give the cuts, so rows that repeat
    an id and text come out alike; a null id has null draws and stays plain.  Whole
    texts are cut in blocks of about ``block_chars`` signs, a longer text is a block of
    its own.  Only id and text are read, nothing is shuffled.  A table without rows
    gives none.
    """
    rows = id_and_text(docs)
    drawn = rows.select("doc_id", "text", *(h.alias(f"h{k}") for k, h in enumerate(draws_of(F.col("doc_id")), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            draws = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns[2:]], 1)
            without = np.asarray(batch.column(0).is_null())
            for a, b in slices(texts, block_chars):
                part = texts[a:b]
                tokens, places = cut_places(part, draws[a:b, :2])
                plain = (draws[a:b, 2] % 100 >= transformed) | without[a:b]
                back = draws[a:b, 3] % 100 < suffix_first
                forms, prefixes, middles, outputs = [], [], [], []
                for k, text in enumerate(part):
                    if plain[k] or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
                        forms.append("plain")
                        prefixes.append(None)
                        middles.append(None)
                        outputs.append(text)
                        continue
                    i, j = map(int, places[k])
                    first, second = PREFIX + text[:i], SUFFIX + text[j:]
                    forms.append("spm" if back[k] else "psm")
                    prefixes.append(i)
                    middles.append(j - i)
                    outputs.append((second + first if back[k] else first + second) + MIDDLE + text[i:j])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(forms, pa.string()),
                        pa.array(tokens, pa.int64()),
                        pa.array(prefixes, pa.int64()),
                        pa.array(middles, pa.int64()),
                        pa.array(outputs, pa.string()),
                    ],
                    ["doc_id", "form", "n", "prefix_chars", "middle_chars", "output"],
                )

    return drawn.mapInArrow(run, _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from; a mark cannot arise where a part ends."""

    def between(mark: str, *following: str) -> Column:
        rest = F.substring(output, F.locate(mark, output) + F.lit(len(mark)), F.length(output))
        for other in following:
            at = F.locate(other, rest)
            rest = F.when(at > 0, F.substring(rest, F.lit(1), at - 1)).otherwise(rest)
        return rest

    middle = between(MIDDLE)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
