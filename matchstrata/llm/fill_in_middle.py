"""Fill-in-the-middle documents, cut at line ends through memoised content-defined chunks.

A rolling hash of the last bytes cuts a text into chunks, so equal passages give
equal chunks wherever they stand. What a cut needs to know of a chunk (how many
lines end in it, how many code points it has) is kept under the chunk's content;
a chunk met again is looked up, equality of the bytes being part of the look-up.
Added up along a document, these counts tell its number of lines, the chunk in
which the line before a cut ends, and the code points before it; only that chunk
is looked at again.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstrata.llm.tokens import slices, trim

#: Bytes of a chunk: at least, at most, and (besides the least) as a power of two on average.
LEAST_CHUNK, MOST_CHUNK, CHUNK_BITS = 256, 8_192, 10
#: Bytes of chunks that one Python worker remembers; beyond them it starts anew.
KEPT_BYTES = 32 << 20

_HASHED_AT_ONCE = 1 << 20
_WINDOW = 32  # bytes the rolling hash depends on; not more than LEAST_CHUNK
_GEAR = np.random.default_rng(1).integers(0, 1 << 32, 256, dtype=np.uint32)  # any random numbers
_ENTRY_BYTES = 160  # what a remembered chunk takes besides its bytes


@dataclass(frozen=True)
class Layout:
    """How texts are cut and put together.

    ``seed`` goes into the digest that decides; of 100 documents ``rate`` are
    transformed, and of 100 of these ``suffix_first`` lead with the suffix.
    """

    seed: int = 7
    rate: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def candidates(data: np.ndarray) -> np.ndarray:
    """Places behind which a chunk may end: those with a zero in the top bits of the rolling hash."""
    found = []
    for start in range(0, len(data), _HASHED_AT_ONCE):
        lead = min(start, _WINDOW)
        h = _GEAR[data[start - lead : start + _HASHED_AT_ONCE]]
        width = 1
        while width < _WINDOW:  # the sum over a window is that of its halves, the older one shifted
            older = h[:-width] << np.uint32(width)
            h[width:] += older
            width *= 2
        found.append(np.flatnonzero(h[lead:] >> np.uint32(32 - CHUNK_BITS) == 0) + start)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(start: int, end: int, cuts: list[int]) -> Iterator[int]:
    """Ends (exclusive) of the chunks of a text at ``start`` to ``end`` of the hashed bytes."""
    while end - start > LEAST_CHUNK:
        k = bisect_left(cuts, start + LEAST_CHUNK - 1)
        start = min(cuts[k] + 1 if k < len(cuts) else end, start + MOST_CHUNK, end)
        yield start
    if start < end:
        yield end


def _code_points(raw: bytes) -> int:
    if raw.isascii():
        return len(raw)
    return len(raw) - int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 == 0x80))


class ChunkCounts:
    """Lines that end in a chunk and its code points, remembered by the chunk's content."""

    def __init__(self, kept_bytes: int = KEPT_BYTES):
        self.kept_bytes, self.held, self.looked_at = kept_bytes, 0, 0
        self.known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, chunk: bytes) -> tuple[int, int]:
        found = self.known.get(chunk)
        if found is None:
            self.looked_at += 1
            found = chunk.count(b"\n"), _code_points(chunk)
            if self.held > self.kept_bytes:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk) + _ENTRY_BYTES
        return found


class CutText:
    """A text as chunks with running counts."""

    def __init__(self, raw: bytes, ends: list[int], counts: ChunkCounts):
        self.raw, self.starts = raw, [0, *ends][: len(ends)]
        each = [counts(raw[a:b]) for a, b in zip(self.starts, ends, strict=True)]
        self.lines_after = list(accumulate(x for x, _ in each))
        self.points_before = [0, *accumulate(x for _, x in each)]
        ended = self.lines_after[-1] if ends else 0
        self.n_lines = ended + (bool(raw) and raw[-1:] != b"\n")

    def after_line(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` lines."""
        if k == 0:
            return 0, 0
        if k == self.n_lines:
            return len(self.raw), self.points_before[-1]
        at = bisect_left(self.lines_after, k)
        start, place = self.starts[at], self.starts[at] - 1
        for _ in range(k - (self.lines_after[at - 1] if at else 0)):
            place = self.raw.index(b"\n", place + 1)
        return place + 1, self.points_before[at] + _code_points(self.raw[start : place + 1])


def drawn(doc_id: int | None, layout: Layout) -> list[int]:
    """Four 32-bit numbers of a document: the first groups of a digest of seed and id."""
    digest = hashlib.sha256(f"{layout.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def transform(doc_id: int | None, text: CutText, layout: Layout) -> tuple[str, int | None, int | None, bytes]:
    """Form, code points of prefix and middle, and the output of a text."""
    raw, n = text.raw, text.n_lines
    marks = [m.encode() for m in (layout.prefix, layout.suffix, layout.middle)]
    h1, h2, h3, h4 = drawn(doc_id, layout)
    if not raw or h3 % 100 >= layout.rate or any(m in raw for m in marks):
        return "plain", None, None, raw
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, points_a), (b, points_b) = text.after_line(first), text.after_line(last)
    p, s, m = marks
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h4 % 100 < layout.suffix_first:
        return "spm", points_a, points_b - points_a, b"".join((s, suffix, p, prefix, m, middle))
    return "psm", points_a, points_b - points_a, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts lines, each with its line end, the last perhaps without one. The
    prefix ends after the smaller and the middle after the larger of two numbers
    of lines drawn from the id; a null id is drawn for like an empty one, and rows
    with one id are cut by the same numbers. A text that is empty or null, holds a
    mark, or is not drawn, is ``plain``: the output is the text and the counts of
    characters (code points) are null. No documents give no rows; other columns
    are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        counts = ChunkCounts()
        for batch in slices(batches, 1):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            cuts = candidates(np.frombuffer(b"".join(texts), np.uint8)).tolist()
            done, start = [], 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), texts, strict=True):
                ends = [e - start for e in chunk_ends(start, start + len(raw), cuts)]
                cut = CutText(raw, ends, counts)
                done.append((cut.n_lines, *transform(doc_id, cut, layout)))
                start += len(raw)
            n, form, prefix, middle, output = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )
        trim()

    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form", layout: Layout = Layout()) -> Column:
    """The text that an output of ``fill_in_middle`` was made from."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in (layout.prefix, layout.suffix, layout.middle)), -1)
    second, third, last = (F.get(parts, F.lit(k)) for k in (1, 2, 3))  # before the first mark is nothing
    return (
        F.when(F.col(form) == "psm", F.concat(second, last, third))
        .when(F.col(form) == "spm", F.concat(third, last, second))
        .otherwise(F.col(output))
    )
