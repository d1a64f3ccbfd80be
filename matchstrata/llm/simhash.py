"""Near duplicates by 64-bit SimHash, found through deletion-variant signatures.

Two fingerprints that differ in at most ``bits`` places are cut into so few
segments that one of these differs in at most one bit: two, for three bits. Each segment is indexed as it is, and once for each
of its bits with that bit as a wildcard; equal entries meet in an equality join,
and what meets is verified. Two segments that differ in one bit meet in exactly
one entry, equal ones in the one without a wildcard.

An entry that too many fingerprints share is not paired. Its members agree on the
segment but for the wildcard, so at most ``bits`` places of the rest differ: the
rest is cut and indexed in the same way, down to segments so short that few
different fingerprints are left in a group. No link is lost, and a pair costs no
more than the size of the groups that it meets in. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstrata.llm.common import components
from matchstrata.session import stage

WORDS = 3
BITS = 3
#: Pairs that an entry may make for each fingerprint it holds; beyond them its members are cut further.
PAIRS_EACH = 64
#: Values that one task makes entries of.
VALUES_PER_TASK = 16_384
#: Segments of this many bits are not cut further.
LEAST_SEGMENT = 8

# A to Z and the white space that ends a word, and what they become.
_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r"
_TO = "abcdefghijklmnopqrstuvwxyz" + " " * 5


def _key(text: Column) -> Column:
    """A 128-bit digest."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _shingled(docs: DataFrame, words: int) -> DataFrame:
    """``task, doc_id, text_key, at, h``: the hash of each shingle, ``at`` from 0; one NULL for no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = docs.select(
        F.spark_partition_id().alias("task"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _key(text).alias("text_key"),
        F.array_remove(F.split(F.translate(text, _FROM, _TO), " "), "").alias("w"),
    )
    names = [f"w{k}" for k in range(words)]
    following = [F.slice("w", k + 1, F.greatest(F.size("w") - k, F.lit(0))).alias(n) for k, n in enumerate(names)]
    whole = F.array(F.struct(*[(F.array_join("w", " ") if k == 0 else F.lit(None).cast("string")).alias(n) for k, n in enumerate(names)]))
    # Fewer words than a shingle takes: all of them are one.
    zipped = F.when(F.size("w") >= words, F.arrays_zip(*following)).when(F.size("w") > 0, whole)
    found = cut.select("task", "doc_id", "text_key", F.size("w").alias("n"), F.posexplode_outer(zipped).alias("at", "g"))
    last = F.col(f"g.{names[-1]}")
    complete = F.col("at").isNull() | (F.col("n") < words) | last.isNotNull()
    h = F.when(F.col("at").isNotNull(), F.xxhash64(F.concat_ws(" ", *[F.col(f"g.{n}") for n in names])))
    return found.where(complete).select("task", "doc_id", "text_key", F.coalesce("at", F.lit(0)).alias("at"), h.alias("h"))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, fingerprint`` (a 64-bit integer), a row for each row of ``docs``.

    Shingles count as often as they occur. Bits are counted by pairs, one in the
    low and one in the high half of a sum, and added up before they are shuffled.
    No words: fingerprint zero. Null text counts as empty; rows of one task with
    one id and one text are counted together and given back as often as they
    came. Other columns are not looked at.
    """
    both = (1 << 32) + 1
    counted = (
        _shingled(docs, words)
        .groupBy("task", "doc_id", "text_key")
        .agg(
            F.count("h").alias("n"),
            F.count_if(F.col("at") == 0).alias("copies"),
            *[F.coalesce(F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(both))), F.lit(0)).alias(f"b{k}") for k in range(32)],
        )
    )
    # A row that occurs k times has k times the counts and the same majority.
    bits = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"b{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"b{k}", 32)
        bits = bits.bitwiseOR(F.when(2 * low > F.col("n"), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        top = F.lit((1 << (k + 32)) - (1 << 64 if k == 31 else 0)).cast("long")
        bits = bits.bitwiseOR(F.when(2 * high > F.col("n"), top).otherwise(F.lit(0).cast("long")))
    found = counted.select("doc_id", bits.alias("fingerprint"), "copies")
    return found.select("doc_id", "fingerprint", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("c")).drop("c")


def _entries(rows: DataFrame, half: int, bits: int) -> DataFrame:
    """Each row of ``f, known, open, lead, rest`` under the entries of both halves of its rest.

    ``known`` are the bits that the members of an entry agree on, ``open`` the
    wildcards, ``lead`` the first of these, ``rest`` is the lowest of the bits that are
    still free; ``entry`` tells entries apart. Linked members differ in every
    wildcard, so those with a one (``side``) in the first need only meet those with a zero.
    """
    one = F.lit(1).cast("long")
    low, other = F.col("rest") + F.col("part") * half, F.col("rest") + (1 - F.col("part")) * half
    mask = F.call_function("shiftleft", F.lit((1 << half) - 1).cast("long"), low)
    wild = F.when(F.col("wild") < 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", one, low + F.col("wild")))
    cut = (
        rows.withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("wild", F.explode(F.sequence(F.lit(-1), F.lit(half - 1))))
        .select("f", F.col("known").alias("k"), F.col("open").alias("o"), "lead", mask.alias("mask"), wild.alias("wild"), other.alias("rest"))
        .select(
            "f",
            F.col("k").bitwiseOR(F.col("mask").bitwiseAND(F.bitwise_not("wild"))).alias("known"),
            F.col("o").bitwiseOR(F.col("wild")).alias("open"),
            F.when(F.col("lead") == 0, F.col("wild")).otherwise(F.col("lead")).alias("lead"),
            "rest",
        )
        .where(F.bit_count("open") <= bits)
    )
    return cut.select(
        "*",
        F.xxhash64("known", "open", F.col("f").bitwiseAND(F.col("known"))).alias("entry"),
        (F.col("f").bitwiseAND(F.col("lead")) != 0).alias("side"),
    )


def _near(a: str, b: str, bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def linked(values: DataFrame, bits: int = BITS, pairs_each: int = PAIRS_EACH) -> DataFrame:
    """``a, b``: all pairs of different values ``f`` (64-bit integers) at most ``bits`` (1 to 3) apart.

    Entries of two values are pairs as they are; those of more are joined with
    themselves, unless they would make more than ``pairs_each`` pairs a value:
    their values are cut further. A pair may come more than once.
    """
    if not 1 <= bits <= 3:
        raise ValueError("two segments leave one difference in one of them for 1 to 3 bits only")
    zero = F.lit(0).cast("long")
    rows = values.select("f").where("f IS NOT NULL")
    # Each value becomes some dozens of entries: few small tasks would make them all.
    rows = rows.repartition(max(1, math.ceil(rows.count() / VALUES_PER_TASK)), "f").distinct()
    rows = rows.select("f", zero.alias("known"), zero.alias("open"), zero.alias("lead"), F.lit(0).alias("rest"))
    half, found = 32, []
    while True:
        entries = _entries(rows, half, bits)
        n, ones = F.col("n"), F.col("ones")
        pairs = F.when(F.col("wild"), ones * (n - ones)).otherwise(n * (n - 1) / 2)
        groups = (
            entries.groupBy("entry")
            .agg(
                F.count("*").alias("n"),
                F.count_if("side").alias("ones"),
                F.bool_or(F.col("open") != 0).alias("wild"),
                F.min("f").alias("a"),
                F.max("f").alias("b"),
            )
            .where(n > 1)
            .withColumn("pairs", pairs)
            .where("pairs > 0")
        )
        groups = stage(groups, f"simhash-entries-{half}").df
        found.append(groups.where((n == 2) & _near("a", "b", bits)).select("a", "b"))
        last = half == LEAST_SEGMENT
        fits = F.lit(True) if last else F.col("pairs") <= pairs_each * n
        several = entries.join(groups.where((n > 2) & fits).select("entry"), "entry").select("entry", "f", "open", "side")
        zeros = several.where(~F.col("side")).select("entry", F.col("f").alias("a"))
        others = several.where(F.col("side") | (F.col("open") == 0)).select("entry", F.col("f").alias("b"), "open")
        met = zeros.join(others, "entry").where(((F.col("open") != 0) | (F.col("a") < F.col("b"))) & _near("a", "b", bits))
        found.append(met.select("a", "b"))
        hot = groups.where((n > 2) & ~fits).select("entry")
        if last or hot.isEmpty():
            break
        rows = stage(entries.join(hot, "entry").select("f", "known", "open", "lead", "rest"), f"simhash-rest-{half}").df
        half //= 2
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


def hex_of(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """Per document: ``doc_id, fingerprint`` (16 hexadecimal digits) and ``component_id``.

    The component is the smallest ``doc_id`` that links of fingerprints at most
    ``bits`` bits apart reach; documents without words have fingerprint zero and
    are linked like any other. Rows with null or repeated ids are documents of
    their own; a null id is reported only where the whole component has no other.
    Empty tables give no rows; other columns are not looked at.
    """
    prints = stage(fingerprints(docs, words), "fingerprints").df
    values = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    values = stage(values.select(F.col("fingerprint").alias("f"), "doc_id"), "fingerprint-values").df
    links = stage(linked(values, bits), "fingerprint-links").df
    reached = components(links, "fingerprint-components")
    named = (
        values.join(reached, values["f"] == reached["node"], "left")
        .select("f", "doc_id", F.coalesce("component", "f").alias("component"))
    )
    named = stage(named, "fingerprint-classes").df
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = stage(named.join(smallest, "component").select(F.col("f").alias("fingerprint"), "component_id"), "simhash-classes").df
    return prints.join(classes, "fingerprint").select("doc_id", hex_of("fingerprint").alias("fingerprint"), "component_id")
