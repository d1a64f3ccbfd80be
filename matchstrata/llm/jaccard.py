"""Similarity join of documents on word n-grams, by adaptive multi-match prefixes.

All shingles are put in one order, estimated rare first. If two sets have
similarity of at least t, the first ``n - ceil(t n) + l`` shingles of each (its
l-prefix) share at least l. Every document chooses its own l by estimated cost:
a longer prefix is looked up more often but admits fewer candidates. A pair is
verified only if its prefixes share as many shingles as the smaller l of the two.

The estimate has a fixed size, so in a large corpus it cannot tell a shingle of a
few dozen documents from a unique one. What turns out frequent among the prefixes
of documents that have rarer shingles besides is put last in the order, by its
exact count, and the prefixes that held it are chosen again.

Documents with equal sets are one class and go through the join once. Classes
that share a frequent prefix shingle (a group of near copies) never become pairs
of rows: they are gathered in blocks, in order of set size, and compared block
by block; each comparison hands on a spanning forest of its links.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstrata.llm.common import BROADCAST_ROWS, components, numbered, small
from matchstrata.llm.tokens import trim
from matchstrata.session import Staged, stage

SKETCH_BITS = 18
_SKETCH_PART = 4_096
MOST_MATCHES = 4
#: Prefix shingles with more classes than this are compared by blocks instead of pairs of rows.
HOT = 32
#: Times that prefixes are chosen again, and the most shingles put last each time.
ROUNDS = 3
DEMOTED = 1 << 18
BLOCK_DOCS = 512
BLOCK_SHINGLES = 1 << 19
KEPT_WORDS = 100_000
_COLUMNS_AT_ONCE = 4_096


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked when ``part * intersection >= percent-of * union``."""

    words: int = 3
    at_least: int = 90
    of: int = 100

    def overlap(self, n: int) -> int:
        """Shingles that a set of ``n`` shares at least with any set it is linked to."""
        return -(-self.at_least * n // self.of)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Sets of 64-bit shingle hashes. Words end at ASCII white space; A to Z count as a to z."""

    def __init__(self, words: int):
        self.words, self.known = words, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        width = min(self.words, len(h))
        mixed = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
        return np.unique(mixed)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (two rounds of xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _scan_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per document its class key and set size; per task, its counts of shingles by bucket."""

    def run(batches):
        from pyspark import TaskContext

        shingles = Shingler(rule.words)
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            keys, sizes, seen = [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py())
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                seen.append(_bucket(s))
            if seen:
                counts += np.bincount(np.concatenate(seen), minlength=len(counts))
            none = [None] * len(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), *_nulls(none)],
                names=_SCAN_NAMES,
            )
        parts = [p for p in range(len(counts) // _SKETCH_PART) if counts[p * _SKETCH_PART : (p + 1) * _SKETCH_PART].any()]
        none = [None] * len(parts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(none, pa.int64()),
                pa.array(none, pa.binary()),
                pa.array(none, pa.binary()),
                pa.array(none, pa.int64()),
                pa.array(parts, pa.int32()),
                pa.array([TaskContext.get().partitionId() % 64] * len(parts), pa.int32()),
                pa.array([_packed(counts[p * _SKETCH_PART : (p + 1) * _SKETCH_PART]) for p in parts], pa.binary()),
            ],
            names=_SCAN_NAMES,
        )
        trim()

    return docs.mapInArrow(run, "doc_id long, text_key binary, key binary, n long, part int, share int, counts binary")


_SCAN_NAMES = ["doc_id", "text_key", "key", "n", "part", "share", "counts"]


def _nulls(none: list) -> list[pa.Array]:
    return [pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary())]


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype("<i8").tobytes()


def _sketch(scanned: DataFrame) -> np.ndarray:
    """Counts of all shingles by bucket: a table of fixed size, summed on the executors."""

    def total(key, pdf):
        summed = np.sum([np.frombuffer(c, "<i8") for c in pdf["counts"]], axis=0)
        return pdf.head(1).assign(counts=[_packed(summed)])

    schema = "part int, share int, counts binary"
    rows = scanned.where("part IS NOT NULL").select("part", "share", "counts")
    shares = rows.groupBy("part", "share").applyInPandas(total, schema)
    table = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in shares.groupBy("part").applyInPandas(total, schema).collect():
        table[r["part"] * _SKETCH_PART :][:_SKETCH_PART] = np.frombuffer(r["counts"], "<i8")
    return table


def prefix(shingles: np.ndarray, seen: np.ndarray, rule: Rule) -> tuple[int, np.ndarray]:
    """The l that seems cheapest, and the l-prefix. ``seen`` estimates how often each shingle occurs."""
    n, overlap = len(shingles), rule.overlap(len(shingles))
    order = np.lexsort((shingles, seen))
    probes = np.cumsum(seen[order])
    best, cost = 1, None
    for matches in range(1, min(MOST_MATCHES, overlap) + 1):
        looked_up = float(probes[n - overlap + matches - 1])
        # At most this many others share that many shingles, and comparing sets takes time by their size.
        total = looked_up + looked_up / matches * (1 + n / 64)
        if cost is None or total < cost:
            best, cost = matches, total
    return best, shingles[order[: n - overlap + best]]


def _seen(shingles: np.ndarray, table: np.ndarray, late: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each shingle occurs: those in ``late`` (sorted) by their counts, after all others."""
    seen = table[_bucket(shingles)]
    if len(late):
        at = np.minimum(np.searchsorted(late, shingles), len(late) - 1)
        known = late[at] == shingles
        seen[known] = table.max() + 1 + counts[at[known]]
    return seen


def _prefixes(docs: DataFrame, sketch: np.ndarray, rule: Rule, late: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``key, n, matches, shingles`` of each class. ``late``: shingles that come last in the order, and their counts."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((sketch, *(late or none)))  # of bounded size

    def run(batches):
        shingles, order = Shingler(rule.words), shared.value
        for batch in batches:
            rows = []
            for text in batch.column(1):
                s = shingles(text.as_py())
                if len(s):
                    matches, first = prefix(s, _seen(s, *order), rule)
                    rows.append((xxhash.xxh3_128_digest(s.tobytes()), len(s), matches, first.view(np.int64)))
            if rows:
                keys, sizes, matches, firsts = zip(*rows, strict=True)
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(matches, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(firsts))),
                    ],
                    names=["key", "n", "matches", "shingles"],
                )
        trim()

    found = docs.mapInArrow(run, "key binary, n long, matches int, shingles array<long>")
    return found.dropDuplicates(["key"])


def forest(sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``, by intersections of all with all."""
    k, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(k), sizes)
    shared = times[column] > 1  # what occurs once is in no intersection
    order = np.argsort(column[shared], kind="stable")
    owner, column = owner[shared][order], column[shared][order]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((k, k), np.float32)  # exact below 2^24
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, _COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [start, start + _COLUMNS_AT_ONCE])
        part = np.zeros((k, min(_COLUMNS_AT_ONCE, width - start)), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        common += part @ part.T
    inter = common.astype(np.int64)
    linked = rule.of * inter >= rule.at_least * (sizes[:, None] + sizes[None, :] - inter)
    free, links = np.ones(k, bool), []
    for root in range(k):
        if not free[root]:
            continue
        free[root], queue = False, [root]
        while queue:
            one = queue.pop()
            for other in np.flatnonzero(linked[one] & free).tolist():
                free[other] = False
                queue.append(other)
                links.append((one, other))
    return links


def _verified(members: DataFrame, rule: Rule) -> DataFrame:
    """``a, b`` links within each unit. ``members`` has ``unit, key, shingles`` (binary)."""

    def run(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for _, group in groupby(rows, key=lambda r: r[0]):
            found = {key: np.frombuffer(raw, np.uint64) for _, key, raw in group}
            keys = list(found)
            links = forest([found[x] for x in keys], rule)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[x] for x, _ in links], pa.binary()), pa.array([keys[y] for _, y in links], pa.binary())],
                    names=["a", "b"],
                )
        trim()

    placed = members.select("unit", "key", "shingles").repartition("unit").sortWithinPartitions("unit")
    return placed.mapInArrow(run, "a binary, b binary")


def _sets_of(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """``key, shingles`` of the classes in ``wanted`` (``key, doc_id``: one document of each)."""

    def run(batches):
        shingles = Shingler(rule.words)
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                names=["key", "shingles"],
            )
        trim()

    ids = wanted.select(F.col("doc_id").alias("__id")).distinct()
    few = docs.select("doc_id", "text").join(small(ids), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    # Documents may share an id; of each class one set stays.
    found = few.mapInArrow(run, "key binary, shingles binary").join(wanted.select("key"), "key", "left_semi")
    return found.dropDuplicates(["key"])


def _blocked_units(hot: DataFrame, rule: Rule) -> DataFrame:
    """``unit, key``: every two blocks of a cluster whose set sizes allow a link.

    ``hot`` has ``key, n, cluster``. Blocks follow the order of sizes, and hold
    fewer classes the larger their sets are.
    """
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK_DOCS), F.lit(BLOCK_SHINGLES) / F.pow(F.lit(2.0), F.ceil(F.log2("n")))))
    order = [F.col("cluster").asc(), F.col("n").asc(), F.col("key").asc()]
    placed = numbered(hot, order, "__at", "cluster-order")
    blocks = stage(
        placed.select("key", "n", "cluster", F.floor(F.col("__at") / F.floor(width)).alias("at"), F.floor(width).cast("long").alias("width")),
        "cluster-blocks",
    ).df
    spans = blocks.groupBy("cluster", "width", "at").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = spans.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("width", "at", "low", "high")])
    first = (F.col("low") < F.col("low2")) | (
        (F.col("low") == F.col("low2")) & (F.struct("width", "at") <= F.struct("width2", "at2"))
    )
    close = F.col("high") * rule.of >= F.col("low2") * rule.at_least
    pairs = spans.join(other, "cluster").where(first & close)
    unit = F.concat_ws("-", F.lit("b"), F.hex("cluster"), "width", "at", "width2", "at2")
    units = pairs.select(
        "cluster",
        unit.alias("unit"),
        F.explode(F.array_distinct(F.array(F.struct("width", "at"), F.struct(F.col("width2").alias("width"), F.col("at2").alias("at"))))).alias("s"),
    ).select("cluster", "unit", "s.width", "s.at")
    return blocks.join(units, ["cluster", "width", "at"]).select("unit", "key")


def _shared(prefixes: DataFrame) -> Staged:
    """``shingle, count`` of those that occur in several prefixes."""
    return stage(prefixes.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().where("count > 1"), "shared-shingles")


def _avoidable(prefixes: DataFrame, times: DataFrame) -> tuple[np.ndarray, np.ndarray, Staged]:
    """Hot shingles that most of their classes need not have in the prefix, their counts, and the classes that have one.

    A class whose prefix is mostly hot is a copy among many: other shingles of it
    would be as frequent. Of too many such shingles the most frequent are taken.
    """
    often = times.where(F.col("count") > HOT)
    held = prefixes.select("key", F.size("shingles").alias("long"), F.explode("shingles").alias("shingle"))
    held = stage(held.join(small(often), "shingle"), "hot-shingles")
    loose = held.df.groupBy("key").agg((F.count("*") * 2 < F.max("long")).alias("loose"))
    late = (
        held.df.join(loose, "key")
        .groupBy("shingle")
        .agg(F.max("count").alias("count"), F.count_if("loose").alias("loose"))
        .where(F.col("loose") * 2 >= F.col("count"))
        .orderBy(F.desc("count"), "shingle")
        .select("shingle", "count")
        .limit(DEMOTED)
    )
    late = stage(late, "late-shingles")
    found = late.df.toArrow()
    holders = stage(held.df.join(F.broadcast(late.df), "shingle", "left_semi").select("key").distinct(), "holders")
    held.discard()
    late.discard()
    return found["shingle"].to_numpy().view(np.uint64), found["count"].to_numpy(), holders


def _chosen_again(rows: DataFrame, classes: DataFrame, prefixes: Staged, sketch: np.ndarray, rule: Rule) -> tuple[Staged, Staged]:
    """The prefixes without hot shingles that can be avoided, and their shared shingles.

    A shingle that moves to the end of the order changes only the prefixes that
    held it, so only these are made anew.
    """
    times, late, counts = _shared(prefixes.df), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        more, their, holders = _avoidable(prefixes.df, times.df)
        # Of a shingle that stays frequent although it is last already, nothing better can be said; few classes are few blocks.
        fresh = ~np.isin(more, late)
        if not fresh.any() or holders.df.count() <= 2 * BLOCK_DOCS:
            holders.discard()
            break
        late, counts = np.concatenate([late, more[fresh]]), np.concatenate([counts, their[fresh]])
        order = np.argsort(late)
        late, counts = late[order], counts[order]
        ids = stage(holders.df.join(classes, "key").select(F.col("doc_id").alias("__id")).distinct(), "holder-ids")
        few = rows
        if ids.df.count() <= BROADCAST_ROWS:  # beyond that all texts are read again, not shuffled
            few = rows.join(F.broadcast(ids.df), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
        anew = _prefixes(few, sketch, rule, (late, counts)).join(small(holders.df), "key", "left_semi")
        kept = prefixes.df.join(small(holders.df), "key", "left_anti")
        chosen = stage(kept.unionByName(anew), "prefixes")
        for old in (prefixes, times, holders, ids):
            old.discard()
        prefixes = chosen
        times = _shared(prefixes.df)
    return prefixes, times


def _units(prefixes: DataFrame, times: DataFrame, rule: Rule) -> Staged:
    """``unit, key``: groups of classes within which every link between classes occurs.

    ``times``: the shingles shared among the prefixes, with their counts.
    """
    stored = stage(
        # Both sides grow with the corpus: joined by shuffle at every size.
        prefixes.select("key", "n", "matches", F.explode("shingles").alias("shingle")).join(times, "shingle"), "postings"
    )
    postings = stored.df
    hot = postings.where(F.col("count") > HOT)
    stars = hot.join(hot.groupBy("shingle").agg(F.min("key").alias("first")), "shingle")
    clusters = stage(
        components(stars.select(F.col("key").alias("a"), F.col("first").alias("b")), "clusters").select(
            F.col("node").alias("key"), F.col("component").alias("cluster")
        ),
        "clusters",
    ).df
    sizes = hot.select("key", "n").distinct()
    blocked = _blocked_units(sizes.join(clusters, "key"), rule)

    rare = postings.where(F.col("count") <= HOT).select("shingle", "key", "n", "matches")
    rare = rare.join(small(clusters), "key", "left")
    left = rare.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("key", "n", "matches", "cluster")])
    right = rare.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("key", "n", "matches", "cluster")])
    sized = (F.col("n_a") * rule.of >= F.col("n_b") * rule.at_least) & (F.col("n_b") * rule.of >= F.col("n_a") * rule.at_least)
    apart = ~F.coalesce(F.col("cluster_a") == F.col("cluster_b"), F.lit(False))  # together: compared by blocks
    pairs = (
        left.join(right, "shingle")
        .where((F.col("key_a") < F.col("key_b")) & sized & apart)
        .groupBy("key_a", "key_b")
        .agg(F.count("*").alias("shared"), F.first(F.least("matches_a", "matches_b")).alias("needed"))
        .where("shared >= needed")
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    )
    pairs = stage(pairs, "candidates").df
    # Small groups of candidates are compared whole; in large ones each class with its own partners.
    groups = stage(components(pairs, "candidates").withColumnRenamed("node", "a"), "candidate-groups").df
    counted = groups.groupBy("component").agg(F.count("*").alias("members"))
    labelled = groups.join(small(counted), "component")
    whole = labelled.where(F.col("members") <= BLOCK_DOCS).select(
        F.concat(F.lit("c-"), F.hex("component")).alias("unit"), F.col("a").alias("key")
    )
    large = pairs.join(labelled.where(F.col("members") > BLOCK_DOCS).select("a"), "a", "left_semi")
    unit = F.concat(F.lit("p-"), F.hex("a"))
    partners = large.select(unit.alias("unit"), F.explode(F.array("a", "b")).alias("key")).distinct()
    units = stage(blocked.unionByName(whole).unionByName(partners), "units")
    stored.discard()
    return units


def _text_key(text: Column) -> Column:
    """A 128-bit digest of a text; null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def similar_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``.

    The component is the smallest ``doc_id`` that links reach; documents with
    equal sets are linked. A text that is null or has no word has no shingles and
    is linked with nothing. Rows with one id are documents of their own; a null
    id is reported only where the whole component has no other. No documents give
    no rows. Other columns are not looked at.
    """
    found = _labelled(docs, rule, with_text=False)
    smallest = found.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = found.where("n_shingles > 0").join(smallest, "component")
    empty = found.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).unionByName(empty.select(*columns))


def _labelled(docs: DataFrame, rule: Rule, with_text: bool = True) -> DataFrame:
    """Per document: ``doc_id, text_key, n_shingles, component`` (a class key)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("text_key", _text_key(F.col("text")) if with_text else F.lit(None).cast("binary"))
    scanned = stage(_scan_sets(rows, rule), "sets")
    sets = scanned.df.where("part IS NULL").select("doc_id", "text_key", "key", "n")
    full = sets.where("n > 0")
    classes = full.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    sketch = _sketch(scanned.df)
    prefixes = stage(_prefixes(rows, sketch, rule), "prefixes")
    prefixes, times = _chosen_again(rows, classes, prefixes, sketch, rule)
    units = _units(prefixes.df, times.df, rule)
    prefixes.discard()
    times.discard()
    wanted = stage(units.df.select("key").distinct().join(classes, "key"), "wanted")
    members = units.df.join(_sets_of(rows, wanted.df, rule), "key")
    links = stage(_verified(members, rule), "links")
    units.discard()
    wanted.discard()
    reached = stage(components(links.df).withColumnRenamed("node", "key"), "reached").df
    links.discard()
    found = sets.join(reached, "key", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component")
    )
    kept = stage(found, "labelled").df
    scanned.discard()
    return kept


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one document of each component: that with its smallest id.

    Documents without words are all kept. A document is told by its id and its
    set of shingles, so rows with one id and different texts go or stay each for
    itself. Of several rows that would stay for one component (equal ids, or no id
    at all) one stays, that with the smallest text key; a component without any
    id keeps one row.
    """
    found = _labelled(docs.select("doc_id", "text"), rule).where("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    ranked = found.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    told = found.join(ranked.select("component", "first"), "component").withColumn("stays", place == F.col("first"))
    told = told.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.bool_or("stays").alias("stays"), F.count("*").alias("rows")
    )
    told = stage(told.where("NOT stays OR rows > 1"), "copies").df
    gone, twice = told.where("NOT stays"), told.where("stays")
    rows = docs.select("*", F.col("doc_id").cast("long").alias(_ID), _text_key(F.col("text").cast("string")).alias(_KEY))

    def among(df: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return df.join(some, F.col(_ID).eqNullSafe(some["id"]) & (F.col(_KEY) == some["key"]), how)

    kept = among(rows, gone, "left_anti")
    if not twice.isEmpty():
        kept = among(kept, twice, "left_anti").unionByName(among(kept, twice, "left_semi").dropDuplicates([_ID, _KEY]))
    return kept.select(*[f"`{c}`" for c in docs.columns])


#: Names of helper columns, longer than any that a table is likely to have.
_ID = "__id_of_a_row_in_the_similarity_join"
_KEY = "__text_key_of_a_row_in_the_similarity_join"
