"""Benchmark decontamination by winnowed fingerprints.

Of every ``SPAN - GRAM + 1`` neighbouring word k-grams the one with the least
hash is a fingerprint. A window of ``SPAN`` words holds just that many k-grams,
so a window that an item and a document share picks the same fingerprint in
both: no shared window is missed. Fingerprints that meet are extended: the words
around them decide which windows really occur.

Everything is built-in functions; documents stay in their partitions, as only
fingerprints are exploded, against those of the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchstrata.llm.common import small
from matchstrata.session import stage

SPAN = 10
GRAM = 5
_PICKED = SPAN - GRAM + 1
#: Fingerprints with their words (up to 15 each) that are broadcast at most.
PRINTS_BROADCAST = 50_000
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words with A to Z in lower case; a null text has none."""
    return _split(F.translate(text, _UPPER, _LOWER))


def _folded(text: Column) -> Column:
    """As many words, in lower case throughout: enough to find candidates, and quicker.

    The one letter whose lower case depends on what surrounds the word goes first.
    """
    return _split(F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3"))))


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAK), "")


def _grams(words: Column, size: int) -> Column:
    """Hashes of the word ``size``-grams, by place."""
    last = F.size(words) - (size - 1)
    return F.when(
        last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, size)))
    ).otherwise(F.array().cast("array<long>"))


def _winnowed(grams: Column) -> Column:
    """The least of every ``_PICKED`` neighbours."""
    last = F.size(grams) - (_PICKED - 1)
    return F.when(
        last > 0,
        F.array_distinct(
            F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_min(F.slice(grams, i, _PICKED)))
        ),
    ).otherwise(F.array().cast("array<long>"))


def _places(grams: Column, keep) -> Column:
    """``(place from 1, hash)`` of the grams that ``keep`` accepts."""
    return F.filter(
        F.transform(grams, lambda h, i: F.struct((i + 1).alias("at"), h.alias("hash"))), lambda g: keep(g["hash"])
    )


def _prints(items: DataFrame) -> DataFrame:
    """``hash, item_id, gram, span, ctx, off``: fingerprints of items with the words around them.

    ``ctx`` are the words from which windows with the fingerprint can be made,
    ``off`` is its place in them from 0, ``span`` the length of a window. An item
    of fewer than ``SPAN`` words is its own only window and fingerprint.
    """
    split = items.select(
        F.col("item_id"), words_of(F.col("text")).alias("words"), _folded(F.col("text")).alias("folded")
    ).where(F.size("words") > 0)
    long = split.where(F.size("words") >= SPAN).withColumn("grams", _grams(F.col("folded"), GRAM))
    long = long.withColumn("picked", _winnowed(F.col("grams")))
    before = _PICKED - 1
    placed = long.select(
        "item_id", "words", F.explode(_places(F.col("grams"), lambda h: F.array_contains("picked", h))).alias("g")
    )
    first = F.greatest(F.col("g.at") - before, F.lit(1))
    long_prints = placed.select(
        F.col("g.hash").alias("hash"),
        "item_id",
        F.lit(GRAM).alias("gram"),
        F.lit(SPAN).alias("span"),
        F.slice("words", first, F.col("g.at") - first + GRAM + before).alias("ctx"),
        (F.col("g.at") - first).alias("off"),
    )
    n = F.size("words")
    short_prints = split.where(n < SPAN).select(
        F.xxhash64("folded").alias("hash"), "item_id", n.alias("gram"), n.alias("span"), F.col("words").alias("ctx"), F.lit(0).alias("off")
    )
    return long_prints.unionByName(short_prints).distinct()


def _all_prints(rows: DataFrame, short: list[int]) -> DataFrame:
    """``text_key, hash``: hashes by which a text may meet the benchmark.

    ``rows`` has ``text_key, words``. Each array is a column before the next is
    made from it: inside a lambda function it would be made again for each element.
    """
    hashes = _winnowed(F.col("grams"))
    for n in short:
        hashes = F.concat(hashes, _grams(F.col("words"), n))
    hashes = F.array_distinct(hashes) if short else hashes
    return rows.withColumn("grams", _grams(F.col("words"), GRAM)).select("text_key", F.explode(hashes).alias("hash"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``doc_id, text_key, n_words, n_hit, n_items, items, items_sha256, contaminated``.

    A word is hit if it lies in an occurrence of a window of an item; ``items``
    are the ids of the items with occurring windows, sorted as strings. Ids that
    repeat count once; an item without id makes hits but is not listed. Documents
    with equal texts are examined once; every row of ``docs`` gets its result,
    also with null or repeated ids. No text or no words: no hit. An empty
    benchmark hits nothing. Other columns are not looked at.
    """
    prints = stage(_prints(items), "benchmark-prints").df
    short = [r["gram"] for r in prints.where(F.col("span") < SPAN).select("gram").distinct().collect()]  # at most 9
    rows = docs.select(
        F.col("doc_id"), F.col("text"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_key")
    )
    # One pass over all texts: their sizes, and the keys of those that share a fingerprint.
    folded = rows.select("text_key", _folded(F.col("text")).alias("words"))
    hashes = prints.select("hash").distinct()
    met = _all_prints(folded, sorted(short))
    met = stage(met.join(small(hashes), "hash").distinct(), "met").df
    found = _occurrences(rows, met, prints, sorted(short))
    covered = _covered(found)
    listed = found.where("item_id IS NOT NULL").groupBy("text_key").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    hits = stage(covered.join(listed, "text_key", "left"), "hits").df
    none = F.array().cast("array<string>")
    return (
        rows.select("doc_id", "text_key", F.size(_folded(F.col("text"))).cast("long").alias("n_words"))
        .join(hits, "text_key", "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
        )
        .withColumns(
            {
                "n_items": F.size("items").cast("long"),
                "items_sha256": F.sha2(F.array_join("items", ",").cast("binary"), 256),
                "contaminated": F.col("n_hit") > 0,
            }
        )
    )


def _occurrences(rows: DataFrame, met: DataFrame, prints: DataFrame, short: list[int]) -> DataFrame:
    """``text_key, item_id, start, end``: occurrences of windows, as places of words."""
    wanted = met.groupBy("text_key").agg(F.collect_set("hash").alias("wanted"))  # at most a text's own fingerprints
    texts = rows.join(small(met.select("text_key").distinct()), "text_key", "left_semi").dropDuplicates(["text_key"])
    split = texts.join(wanted, "text_key").select(
        "text_key", "wanted", words_of(F.col("text")).alias("words"), _folded(F.col("text")).alias("folded")
    )
    wanted_hash = lambda h: F.array_contains("wanted", h)
    places = _places(_grams(F.col("folded"), GRAM), wanted_hash)
    for n in short:
        places = F.concat(places, _places(_grams(F.col("folded"), n), wanted_hash))
    at = split.select("text_key", "words", F.explode(F.array_distinct(places)).alias("g"))
    reach = _PICKED - 1
    first = F.greatest(F.col("g.at") - reach, F.lit(1))
    around = at.select(
        "text_key",
        F.col("g.hash").alias("hash"),
        first.alias("first"),
        (F.col("g.at") - first).alias("doc_off"),
        F.slice("words", first, F.col("g.at") - first + SPAN).alias("doc_ctx"),
    )
    # Windows of the item, by their start in ctx, and where they would begin in doc_ctx.
    hit = around.join(small(prints, PRINTS_BROADCAST), "hash")
    shift = F.col("doc_off") - F.col("off")
    same = lambda s: (
        (s + shift >= 0)
        & (s + shift + F.col("span") <= F.size("doc_ctx"))
        & (F.slice("doc_ctx", F.greatest(s + shift, F.lit(0)) + 1, F.col("span")) == F.slice("ctx", s + 1, F.col("span")))
    )
    starts = F.filter(F.sequence(F.lit(0), F.size("ctx") - F.col("span")), same)
    return stage(
        hit.select("text_key", "item_id", "span", (F.col("first") + shift).alias("base"), F.explode(starts).alias("s"))
        .select("text_key", "item_id", (F.col("base") + F.col("s")).alias("start"), "span")
        .distinct()
        .select("text_key", "item_id", "start", (F.col("start") + F.col("span")).alias("end")),
        "occurrences",
    ).df


def _covered(found: DataFrame) -> DataFrame:
    """``text_key, n_hit``: how many words the spans of a text cover together."""
    spans = found.groupBy("text_key", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("text_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    return (
        spans.select("text_key", fresh.alias("fresh")).groupBy("text_key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    )


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item."""
    found = contaminated(docs.select("doc_id", "text"), items.select("item_id", "text"))
    hit = stage(found.where("contaminated").select("text_key").distinct(), "contaminated").df
    key = F.sha2(F.coalesce("d.text", F.lit("")).cast("binary"), 256)
    kept = docs.alias("d").join(small(hit.alias("h")), key == F.col("h.text_key"), "left_anti")
    return kept.select(*[f"d.`{c}`" for c in docs.columns])
