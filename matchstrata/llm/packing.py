"""Best-fit decreasing packing of token pieces into fixed windows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchstrata.llm.tokens import slices, trim, worker_encoder

WINDOW = 2048
END_ID = 1
#: Pieces that one task packs together. The windows left open at its end are the only loss of splitting.
PIECES_PER_TASK = 8_192

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"


def cut_documents(
    docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str | None = None
) -> DataFrame:
    """Pieces of at most ``window`` ids: full windows first, then what is left.

    A null text is empty: its document is the end id alone. Documents with a null
    or repeated ``doc_id`` are all kept. ``ids`` are little-endian unsigned 32-bit
    integers. Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        encoder = worker_encoder(vocabulary)
        for batch in slices(batches, 1):
            ids, counts = encoder.encode(batch.column(1), end_id)
            n_pieces = -(-counts // window)
            owner = np.repeat(np.arange(len(counts)), n_pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = number * window
            length = np.minimum(window, counts[owner] - start)
            edges = np.concatenate([[0], 4 * np.cumsum(length)])
            raw = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(counts[owner]),
                    pa.Array.from_buffers(
                        pa.binary(), len(owner), [None, pa.py_buffer(edges.astype(np.int32)), raw]
                    ),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )
        trim()

    return rows.mapInArrow(run, PIECE_SCHEMA)


class OpenWindows:
    """Segment tree over remaining capacities: which of them some open window has.

    A leaf holds the open windows with exactly that much room left, an inner node
    how many lie below it. ``tightest`` goes up from the leaf until a right
    neighbour has windows, then down its leftmost path.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.windows[room].pop()

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest room of at least ``need`` that an open window has."""
        count, node = self.count, need + self.leaves
        if count[node]:
            return need
        while node > 1 and (node & 1 or not count[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        return node - self.leaves


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece, and the number of windows. Equal lengths keep their order."""
    at = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int(np.count_nonzero(lengths == window))
    at[order[:full]] = np.arange(full)
    opened, used = OpenWindows(window), full
    for k, n in zip(order[full:].tolist(), lengths[order[full:]].tolist(), strict=True):
        room = opened.tightest(n)
        if room is None:
            w, room = used, window
            used += 1
        else:
            w = opened.take(room)
        at[k], offset[k] = w, window - room
        if room > n:
            opened.put(room - n, w)
    return at, offset, used


def pack_pieces(
    pieces: DataFrame, window: int = WINDOW, tasks: int | None = None
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; all their other columns are kept.

    Each of ``tasks`` even shares of the pieces is packed for itself, in runs of
    at most ``PIECES_PER_TASK``. Shares are dealt round robin, so equal or null
    document ids do not meet in one task. No piece may be longer than ``window``.
    An empty frame gives no rows.
    """
    if tasks is None:
        tasks = max(1, math.ceil(pieces.count() / PIECES_PER_TASK))
    columns = [f for f in pieces.columns if f not in ("sequence_id", "offset")]
    shared = pieces.select(*columns).repartition(tasks)
    length_at = columns.index("length")

    def run(batches):
        from pyspark import TaskContext

        held, rows = [], 0
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PIECES_PER_TASK:
                used = yield from pack(held, number)
                number += used
                held, rows = [], 0
        if rows:
            yield from pack(held, number)
        trim()

    def pack(held, number):
        """The batches with their pieces' places; each is handed on as it came, without a copy."""
        lengths = np.concatenate([np.asarray(batch.column(length_at)) for batch in held])
        at, offset, used = best_fit_decreasing(lengths, window)
        start = 0
        held.reverse()
        while held:
            batch = held.pop()
            end = start + batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number + at[start:end]), pa.array(offset[start:end])],
                names=[*columns, "sequence_id", "offset"],
            )
            start = end
        return used

    schema = StructType(
        [*shared.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    return shared.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """Cut, then pack. Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and, if ``keep_ids``, ``ids``."""
    pieces = cut_documents(docs, window, end_id, vocabulary).withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        pieces = pieces.drop("ids")
    columns = [c for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids") if c in pieces.columns]
    # Every document has a piece at least; counting them reads no text.
    tasks = max(1, math.ceil(docs.count() / PIECES_PER_TASK))
    return pack_pieces(pieces.select(*columns), window, tasks)
