"""Byte-level BPE ids of whole texts, in bulk."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that one Python worker keeps between batches, with their ids. Beyond them it keeps the last batch's.
KEPT_WORDS = 400_000
#: New words that the library encodes in one call.
WORDS_AT_ONCE = 20_000
#: Text that is cut into words at once.
BYTES_AT_ONCE = 2 << 20

def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class _Words:
    """Words, how many ids each has, and all ids one after the other."""

    words: pa.Array
    sizes: np.ndarray
    ids: np.ndarray

    def with_more(self, other: _Words) -> _Words:
        if not len(other.words):
            return self
        return _Words(
            pa.concat_arrays([self.words, other.words]),
            np.concatenate([self.sizes, other.sizes]),
            np.concatenate([self.ids, other.ids]),
        )

    def taken(self, words: pa.Array, place: np.ndarray, usable: np.ndarray) -> _Words:
        """The entries at ``place`` under the names ``words``; those not ``usable`` without ids."""
        if not len(self.words):
            return _Words(words, np.zeros(len(words), np.int32), np.zeros(0, "<u4"))
        sizes = np.where(usable, self.sizes[place], 0)
        return _Words(words, sizes, _gathered(_Words(self.words, self.sizes, self.ids), place[usable]))

    def whole(self, usable: np.ndarray) -> _Words:
        return _Words(self.words.filter(pa.array(usable)), self.sizes[usable], self.ids)


def _gathered(of: _Words, place: np.ndarray) -> np.ndarray:
    """The ids of the words at ``place``, one word after the other."""
    starts = np.cumsum(of.sizes, dtype=np.int64) - of.sizes
    each = of.sizes[place]
    before = np.cumsum(each, dtype=np.int64) - each
    total = int(each.sum())
    return of.ids[np.repeat(starts[place] - before, each) + np.arange(total)]


class BulkEncoder:
    """Encodes texts to unsigned 32-bit ids, as the library gives them for the whole text.

    The vocabulary's splitting rule never lets a token reach over a space that
    has a non-space character on both sides, except as the token's first
    character; a line end between two such characters is a token of its own. So
    the ids of a text are those of its pieces, each led by a space or a line end,
    one after the other. The pieces of a batch are told apart by a dictionary
    encoding; only pieces not met lately go to the library, joined as one text
    and cut again by the byte length of each token; the ids of the batch are then
    gathered at once. Texts with two white-space characters in a row, or with the
    name of an added token, are encoded whole.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.kept_words = kept_words
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # most of what it gets are new pieces
        size = self.tokenizer.get_vocab_size()
        # A byte-level token shows each of its bytes as one character.
        self.n_bytes = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)], dtype=np.int64)
        self.stops = {c: self._ids(c)[0] for c in ",."}
        self.line_end = len(self._ids("\n"))
        self.known = _Words(pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, "<u4"))

    def _ids(self, text: str, plain: bool = False) -> np.ndarray:
        """``plain``: names of added tokens count as ordinary text."""
        self.tokenizer.encode_special_tokens = plain
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype="<u4")

    def _learnt(self, words: pa.Array) -> _Words:
        """Different words, each led by a space or a line end, with the ids of the library."""
        if not len(words):
            return _Words(words, np.zeros(0, np.int32), np.zeros(0, "<u4"))
        if len(words) > WORDS_AT_ONCE:
            return self._learnt(words[:WORDS_AT_ONCE]).with_more(self._learnt(words[WORDS_AT_ONCE:]))
        led = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise(" ", words, ""))
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(led)], led), "")[0].as_py()
        ids = self._ids(text, plain=True)  # a text with such a name is encoded whole
        ends = np.cumsum(np.asarray(pc.binary_length(led)), dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1
        return _Words(words, np.diff(cuts, prepend=0).astype(np.int32), ids)

    def _looked_up(self, words: pa.Array) -> tuple[_Words, np.ndarray]:
        """``words`` (all different) with their ids, and which of them are no pieces: those
        with more white space at an end, and the empty one."""
        first, second = (pc.utf8_slice_codeunits(words, k, k + 1) for k in (0, 1))
        broken = np.asarray(
            pc.or_(
                pc.or_(pc.equal(words, ""), pc.utf8_is_space(pc.utf8_slice_codeunits(words, -1))),
                pc.and_(
                    pc.utf8_is_space(first), pc.or_(pc.not_equal(first, "\n"), pc.utf8_is_space(second))
                ),
            )
        )
        at = pc.index_in(words, value_set=self.known.words)
        new = np.asarray(at.is_null()) & ~broken
        learnt = self._learnt(words.filter(pa.array(new)))
        everything = self.known.with_more(learnt)
        place = np.asarray(pc.fill_null(at, 0)).astype(np.int64)
        place[new] = len(self.known.words) + np.arange(len(learnt.words))
        found = everything.taken(words, place, ~broken)
        self.known = everything if len(everything.words) <= self.kept_words else found.whole(~broken)
        return found, broken

    def _pieces(self, words: pa.Array) -> tuple[_Words, np.ndarray]:
        """Ids of different pieces, and which are none (see ``_looked_up``)."""
        # A full stop or comma after a letter, before a space or line end, is a token of its own.
        ends = pc.utf8_slice_codeunits(words, -1)
        lettered = pc.utf8_is_alpha(pc.utf8_slice_codeunits(words, -2, -1))
        stop_id = np.full(len(words), -1, np.int64)
        for c, one in self.stops.items():
            stop_id[np.asarray(pc.and_(pc.equal(ends, c), lettered))] = one
        stopped = stop_id >= 0
        stems = pc.if_else(pa.array(stopped), pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        found, broken = self._looked_up(stems.dictionary)
        at = np.asarray(stems.indices)
        base = found.taken(words, at.astype(np.int64), ~broken[at])
        sizes = base.sizes + stopped
        ids = np.empty(int(sizes.sum()), "<u4")
        last = np.cumsum(sizes)[stopped] - 1
        room = np.ones(len(ids), bool)
        room[last] = False
        ids[last] = stop_id[stopped]
        ids[room] = base.ids
        return _Words(words, sizes, ids), broken[at]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has. Null counts as empty.

        ``end_id`` is put behind each text.
        """
        n = len(texts)
        if not n:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # A line end is put before each text, so that all pieces are led by white space.
        led = pc.binary_join_element_wise("\n", texts, "")
        lists = pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " ")
        offsets = np.asarray(lists.offsets).astype(np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        inside = np.ones(len(flat), bool)
        inside[offsets[:-1]] = False  # what lies before the line end put in front
        pieces = np.asarray(flat.indices)[inside]
        bounds = offsets - np.arange(n + 1)
        found, broken = self._pieces(flat.dictionary)
        odd = np.zeros(n, bool)
        if broken.any():
            odd |= np.add.reduceat(broken[pieces], bounds[:-1]) > 0
        for name in self.added:
            odd |= np.asarray(pc.match_substring(texts, name))
        before = np.concatenate([[0], np.cumsum(found.sizes[pieces])])
        all_ids = _gathered(found, pieces)
        edges = before[bounds]
        skip = self.line_end
        tail = np.array([] if end_id is None else [end_id], "<u4")
        if odd.any():
            whole = self._whole([texts[k].as_py() for k in np.flatnonzero(odd).tolist()])
            each_text = [
                next(whole) if odd[k] else all_ids[edges[k] + skip : edges[k + 1]] for k in range(n)
            ]
            counts = np.fromiter(map(len, each_text), np.int64, n) + len(tail)
            return np.concatenate([p for x in each_text for p in (x, tail)]), counts
        counts = edges[1:] - edges[:-1] - skip
        kept = np.ones(len(all_ids), bool)
        for k in range(skip):
            kept[edges[:-1] + k] = False
        all_ids = all_ids[kept]
        if len(tail):
            all_ids = np.insert(all_ids, np.cumsum(counts), tail[0])
        return all_ids, counts + len(tail)

    def _whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:  # one at a time: an encoding holds much more than the ids
            yield self._ids(text)


def slices(batches, text_at: int) -> Iterator[pa.RecordBatch]:
    """Record batches in short runs of about ``BYTES_AT_ONCE`` of text, so that few texts are held at once."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_at)), 0)).astype(np.int64)
        run = np.cumsum(sizes) // BYTES_AT_ONCE
        starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)


def worker_encoder(path: str | None) -> BulkEncoder:
    """The encoder of this Python worker for a vocabulary file, built once."""
    path = path or vocabulary_path()
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = BulkEncoder(path)
    return _ENCODERS[path]


def trim() -> None:
    """Give memory that was freed back to the system; the Python worker lives on, others need it."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if release is not None:
        release(0)


_ENCODERS: dict[str, BulkEncoder] = {}
