"""Minimax contiguous partition: the smallest capacity by which ordered atomic groups fit into n shards.

Groups (rows with one key) are ordered by the digest of their key. The capacity
is found by binary search; a greedy walk checks whether it suffices. The walk
needs the prefix sums of the sizes only near its cuts, so the digest's leading
digits serve as a radix tree: the driver holds the sums of at most a fixed number
of its blocks, and from level to level only blocks in which some capacity that is
still possible would cut are opened into finer ones. All sums are Spark
aggregations with partial sums before the shuffle.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstrata.llm.common import either, numbered, text_bytes
from matchstrata.session import stage

FIRST_DIGITS = 3  # 4,096 blocks to begin with
MORE_DIGITS = 2  # an opened block gives at most 256


@dataclass(frozen=True)
class Block:
    """Groups whose digest has the prefix; ``single`` when it is one group."""

    prefix: str
    last: str
    size: int
    single: bool


def _sums(rows: DataFrame, digits: int, inside: list[str] | None) -> list[Block]:
    if inside is not None:
        by_length: dict[int, list[str]] = {}
        for p in inside:
            by_length.setdefault(len(p), []).append(p)
        rows = rows.where(
            either([F.substring("digest", 1, n).isin(ps) for n, ps in by_length.items()])
        )
    found = (
        rows.groupBy(F.substring("digest", 1, digits).alias("prefix"))
        .agg(F.sum("size").alias("size"), F.min("digest").alias("low"), F.max("digest").alias("last"))
        .collect()
    )
    return [Block(r["prefix"], r["last"], int(r["size"]), r["low"] == r["last"]) for r in found]


def _walk(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Greedy: fill each shard up to ``capacity``. Indexes of the last block of each, or None."""
    cuts, filled = [], 0
    for _ in range(shards):
        k = bisect_right(ends, filled + capacity) - 1
        cuts.append(k)
        filled = ends[k] if k >= 0 else 0
        if k == len(ends) - 1:
            return cuts
    return None


def _smallest(low: int, high: int, suffices) -> int:
    """Binary search for the smallest capacity that suffices; ``high`` does."""
    while low < high:
        middle = (low + high) // 2
        if suffices(middle):
            high = middle
        else:
            low = middle + 1
    return low


def _touched(ends: list[int], blocks: list[Block], low: int, high: int, shards: int) -> set[int]:
    """Blocks in which a cut may fall for any capacity from ``low`` to ``high``.

    A shard may begin anywhere between the earliest and the latest cut before
    it. The latest cut is bounded by ``high`` times its number; the earliest by
    walking with ``low`` and losing a whole open block at each cut.
    """
    hit: set[int] = set()
    least, most, total = 0, 0, ends[-1]
    for _ in range(shards):
        first = bisect_right(ends, least + low)  # the block that the earliest cut may fall into
        most = min(most + high, total)
        last = bisect_right(ends, most)
        hit.update(k for k in range(first, min(last + 1, len(blocks))) if not blocks[k].single)
        least = ends[first - 1] if first else 0
    return hit


def minimax_cuts(rows: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The smallest capacity, and the last digest of each shard but the last.

    ``rows`` has ``digest`` (hexadecimal text) and ``size`` (long, at least 1).
    """
    digits = FIRST_DIGITS
    blocks = sorted(_sums(rows, digits, None), key=lambda b: b.prefix)
    if not blocks:
        return 0, []
    while True:
        ends, filled = [], 0
        for b in blocks:
            filled += b.size
            ends.append(filled)
        largest = max([b.size for b in blocks if b.single], default=0)
        floor = max(largest, -(-filled // shards))
        # Open blocks taken as atoms: enough. Taken as divisible anywhere: at least this.
        high = _smallest(floor, filled, lambda c: _walk(ends, c, shards) is not None)
        open_blocks = [k for k, b in enumerate(blocks) if not b.single]
        hit = _touched(ends, blocks, floor, high, shards) if open_blocks else set()
        if not hit:
            cuts = _walk(ends, high, shards)
            return high, [blocks[k].last if k >= 0 else "" for k in cuts[:-1]]
        digits += MORE_DIGITS
        finer = _sums(rows, digits, [blocks[k].prefix for k in sorted(hit)])
        blocks = sorted([b for k, b in enumerate(blocks) if k not in hit] + finer, key=lambda b: b.prefix)


def shard_of(digest: Column, cuts: list[str]) -> Column:
    """The shard of a digest: how many cuts lie before it."""
    place = F.lit(0)
    for c in cuts:
        place = place + F.when(digest > F.lit(c), 1).otherwise(0)
    return place


def minimax_shards(docs: DataFrame, shards: int = 8, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Documents dealt into ``shards`` shards of near equal bytes; equal texts stay together.

    Per row: the id, ``size`` (UTF-8 bytes plus 1; null has no bytes),
    ``text_crc32``, ``digest``, ``shard`` and ``slot`` (its place in the shard
    by id, from 0). All null texts are one group, apart from the empty text. Rows
    with a null or repeated id are kept, null first, equal ids in the order of
    their digests. No documents give no rows. Other columns are not looked at.
    """
    raw = text_bytes(text)
    rows = stage(
        docs.select(
            F.col(row_id),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.when(F.col(text).isNull(), F.lit("0" * 64)).otherwise(F.sha2(raw, 256)).alias("digest"),
        ),
        "shard-rows",
    ).df
    _, cuts = minimax_cuts(rows, shards)
    dealt = rows.withColumn("shard", shard_of(F.col("digest"), cuts))
    order = [F.col("shard").asc(), F.col(row_id).asc_nulls_first(), F.col("digest").asc()]
    placed = numbered(dealt, order, "slot", "shard-slots")
    counts = {r["shard"]: r["n"] for r in rows.groupBy(shard_of(F.col("digest"), cuts).alias("shard")).agg(F.count("*").alias("n")).collect()}
    first, before = F.lit(0), 0
    for s in range(shards):
        first = F.when(F.col("shard") == s, before).otherwise(first)
        before += counts.get(s, 0)
    return placed.withColumn("slot", (F.col("slot") - first).cast("long"))
