"""Line deduplication: equal lines, and lines within a small edit distance, across all documents.

The near lines come from a segment-partition join. A line is split into
``edits + 1`` segments; a line within ``edits`` edits of it holds one of them
unchanged, not far from its place. So every line is indexed by its segments, by
length and number of the segment, and looked up by its own substrings for each
length that it may differ to. What meets is verified by edit distance: a band of
``2 * edits + 1`` diagonals held in the bits of one integer, a step for each
character. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstrata.llm.common import small
from matchstrata.session import stage

EDITS = 2
#: Shorter lines are compared for equality only: of few characters, two edits make other words.
LEAST_CHARS = 50
#: In larger groups of lines with one segment, all are first compared with the earliest.
HOT = 16
#: Tasks that the pairs of a group are dealt to which nothing tells apart.
DEALT = 16
#: Pairs a line up to which large groups are paired: their lengths and counts are compared at once.
PAIRS = 128
#: Letters of about equal use stand in one row of ``2 * edits + 1``, so that the classes of characters are about even.
_LETTERS = "etaoidhrsnlucmfbpgwyvkxqjz"
#: Of the characters beyond Latin 1, where those begin that go to one class together.
_BLOCKS = [
    *range(0x100, 0x180, 0x20), 0x180, *range(0x400, 0x460, 0x10), *range(0x460, 0x3000, 0x800), *range(0x3000, 0xE000, 0x1000), 0xE000,
]


def _lookups(edits: int) -> list[list[tuple[int, int]]]:
    """(segment, shift) by which a text is looked up, for texts shorter by 0, 1, ... characters.

    Those of no difference begin with the unshifted segments, under which the text
    is indexed itself.
    """
    out = []
    for less in range(edits + 1):
        found = [(k, 0) for k in range(edits + 1)] if less == 0 else []
        for k in range(edits + 1):
            low, high = max(-k, less - (edits - k)), min(k, less + (edits - k))
            found += [(k, shift) for shift in range(low, high + 1) if less or shift]
        out.append(found)
    return out


def _hashes(line: Column, length: Column, edits: int) -> Column:
    """Hashes of a line's segments (the first ``edits + 1``), then of what it is looked up by.

    One expression over a list of look-ups: written out for each, they would be more
    code than a method may have that the JVM compiles.
    """
    found = [(by, k, shift) for by, lookups in enumerate(_lookups(edits)) for k, shift in lookups]
    table = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("by", "segment", "shift"), row)]) for row in found])
    parts = edits + 1

    bytes_ = line.cast("binary")

    def hashed(row: Column) -> Column:
        of = length - row["by"]

        def cut(base: Column) -> Column:
            longer = row["segment"] - (parts - (of - base * parts))  # the last segments are longer by one
            start = base * row["segment"] + F.greatest(longer, F.lit(0)) + row["shift"] + 1
            size = base + F.when(longer >= 0, 1).otherwise(0)
            start = F.greatest(start, F.lit(1))
            # In a text of single bytes a place is found without counting characters; the hash is of the same bytes.
            of_bytes = F.xxhash64(of, row["segment"], F.substring(bytes_, start, size))
            return F.when(F.octet_length(line) == length, of_bytes).otherwise(F.xxhash64(of, row["segment"], F.substring(line, start, size)))

        return _let(F.floor(of / parts).cast("int"), cut)

    return F.transform(table, hashed)


def _classes(edits: int, way: int) -> list[str]:
    """Patterns of ``2 * edits + 1`` classes of characters; each character is in one.

    Characters of one class in one way are in different classes in the others, as
    far as they stand in different rows.
    """
    n = 2 * edits + 1
    latin = [c for letter in _LETTERS for c in (letter, letter.upper())] + [chr(x) for x in range(0x100) if chr(x).lower() not in _LETTERS]
    out = [""] * n
    for k, c in enumerate(latin):
        place = k // 2 if k < 2 * len(_LETTERS) else k
        out[(place + way * (place // n)) % n] += f"\\x{{{ord(c):x}}}"
    for k, (low, high) in enumerate(zip(_BLOCKS, [*_BLOCKS[1:], 0x110000])):
        out[(k + way * (k // n)) % n] += f"\\x{{{low:x}}}-\\x{{{high - 1:x}}}"
    return out


def _by_class(line: Column, edits: int, way: int) -> Column:
    """Hashes of what is left of a line when all but one class of characters is taken out.

    An edit touches two classes at most, so ``edits`` of them leave one of
    ``2 * edits + 1`` as it was.
    """
    return F.array(*[F.xxhash64(F.regexp_replace(line, f"[^{c}]+", "")) for c in _classes(edits, way)])


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` edits (insert, delete, replace one character).

    Only for lengths that differ by at most ``edits``, and of at least that. One
    integer holds the band: bit r of step i stands for character i - edits + r of
    ``a``. ``vp`` and ``vn`` tell where the distance grows and falls from one row
    of the band to the next; the score follows the lower edge of the band down to
    the end of ``a``, then runs along it.
    """
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1).cast("long")
    zero = F.lit(0).cast("long")
    flip = lambda x: full.bitwiseXOR(x)
    has = lambda x, bit: x.bitwiseAND(bit) != 0

    # The characters are bound once; inside a lambda function they would be split again at each step.
    def banded(texts: Column) -> Column:
        one, other = texts["a"], texts["b"]

        def matches(i: Column) -> Column:
            total = zero
            for r in range(width):
                same = F.get(one, i + (r - edits)) == F.get(other, i)
                total = total + F.when(same, F.lit(1 << r).cast("long")).otherwise(zero)
            return total

        def step(state: Column, i: Column) -> Column:
            vp, vn = state["vp"], state["vn"]

            def with_matches(x: Column) -> Column:
                carried = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseAND(full)
                return _let(carried.bitwiseOR(x).bitwiseOR(vn), with_diagonal)

            def with_diagonal(d0: Column) -> Column:
                hp = vn.bitwiseOR(flip(d0.bitwiseOR(vp)))
                hn = d0.bitwiseAND(vp)
                down = i < F.size(one) - edits
                # Past the end of ``a`` the last row moves up through the band.
                edge = F.call_function("shiftright", F.lit(1 << (width - 1)).cast("long"), (i - F.size(one) + edits + 1).cast("int"))
                along = F.when(has(hp, edge), 1).otherwise(0) - F.when(has(hn, edge), 1).otherwise(0)
                lower = F.when(has(d0, F.lit(1 << (width - 1)).cast("long")), 0).otherwise(1)
                half = F.shiftright(d0, 1)
                return F.struct(
                    hn.bitwiseOR(flip(half.bitwiseOR(hp))).alias("vp"),
                    half.bitwiseAND(hp).alias("vn"),
                    (state["score"] + F.when(down, lower).otherwise(along)).alias("score"),
                )

            # The score falls by one a step at most, and only along the last row.
            lost = state["score"] > 2 * edits + F.size(other) - F.size(one)
            return F.when(lost, state).otherwise(_let(matches(i), with_matches))

        start = F.struct(
            F.lit(((1 << (edits + 1)) - 1) << edits).cast("long").alias("vp"), zero.alias("vn"), F.lit(edits).alias("score")
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(other) - 1), start, step, lambda s: s["score"] <= edits)

    return _let(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), banded)


def _key(text: Column) -> Column:
    """A 128-bit digest."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


#: Characters that are counted in each line of a candidate pair, before it is verified.
_COUNTED = "acdehilnorstu "


# A line of nothing but these is blank.
_BLANK = " \t\r\f\x0b"


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, line_no, line, length`` of the lines that are not blank."""
    return (
        docs.where("text IS NOT NULL")
        .select("doc_id", "text", _key(F.col("text")).alias("text_key"))  # beside the generator it would be made for each line
        .select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .withColumn("length", F.char_length("line"))
        .where(F.ltrim("line", F.lit(_BLANK)) != "")
    )


def _counts(line: Column) -> dict[str, Column]:
    """How often each of some characters occurs. ``edits`` edits change the counts by twice that together."""
    size = F.octet_length(line)
    return {f"c{k}": size - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for k, c in enumerate(_COUNTED)}


def _alike(a: str, b: str, edits: int) -> Column:
    """Whether the counts and lengths of two lines allow ``edits`` edits."""
    apart = F.lit(0)
    for k in range(len(_COUNTED)):
        apart = apart + F.abs(F.col(f"{a}.c{k}") - F.col(f"{b}.c{k}"))
    return (apart <= 2 * edits) & (F.abs(F.col(f"{a}.length") - F.col(f"{b}.length")) <= edits)


def _near(docs: DataFrame, lines: DataFrame, least: int, edits: int) -> DataFrame:
    """``line_key``: lines with another line within ``edits`` edits that occurs earlier.

    ``lines`` are stored: ``place, line_key, id, hashes``.
    """
    # Most segments occur in one line only; of a line that repeats, one id is the least and the greatest.
    shared = (
        lines.select("id", F.explode("hashes").alias("hash"))  # no hashes: a short line
        .groupBy("hash")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low <> high")
        .select("hash")
    )
    shared = stage(shared, "shared-segments").df
    entries = lines.select("id", F.posexplode("hashes").alias("k", "hash")).join(small(shared), "hash")
    # Texts that share an id share what either is looked up by.
    entries = stage(entries.groupBy("id", "hash").agg(F.max(F.col("k") <= edits).alias("indexed")), "segments").df
    ids = stage(entries.select("id").distinct(), "segment-lines").df
    first = lines.join(small(ids), "id", "left_semi").groupBy("line_key").agg(F.min("place").alias("place"))
    long = _lines(docs).where(F.col("length") >= least).select("line", "length", F.xxhash64("line").alias("id"))
    texts = long.join(small(ids), "id", "left_semi").withColumn("line_key", _key(F.col("line"))).dropDuplicates(["line_key"])
    texts = stage(texts.withColumns(_counts(F.col("line"))).join(first, "line_key"), "segment-texts").df
    return _near_in_groups(entries.join(texts.select("id", "line_key"), "id").select("line_key", "hash", "indexed"), texts, edits)


def _near_in_groups(entries: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """``line_key``: lines within reach of an earlier one that shares a look-up with them.

    ``entries`` are ``line_key, hash, indexed``. A group of at most ``HOT`` entries
    with one hash is paired. In a larger one all are first compared with the line
    that occurs earliest. The lines of groups in which others are left are grouped
    anew, by classes of characters, in one more way each time: two lines within reach
    agree in all characters of one class. Groups of the same lines are looked at once.
    When the groups left make at most ``PAIRS`` pairs a line, or nothing tells them
    apart, they are paired whatever their size, dealt out over many tasks.
    """

    def near(pairs: DataFrame) -> DataFrame:
        """Of ``later, earlier`` the later ones of those within reach."""
        texts_a = texts.select(F.col("line_key").alias("later"), F.col("line").alias("__a"))
        texts_b = texts.select(F.col("line_key").alias("earlier"), F.col("line").alias("__b"))
        # Dealt out again: the pairs of a few large groups would else be verified by a few tasks.
        found = pairs.distinct().join(texts_a, "later").join(texts_b, "earlier").repartition("later", "earlier")
        return found.where(within(F.col("__a"), F.col("__b"), edits)).select(F.col("later").alias("line_key")).distinct()

    def met(later: DataFrame, all_: DataFrame, on: tuple[str, ...] = ("hash",)) -> DataFrame:
        """Pairs of a group that its roles, lengths and counts allow."""
        meet = (F.col("b.place") < F.col("a.place")) & (F.col("a.indexed") | F.col("b.indexed")) & _alike("a", "b", edits)
        for c in on:
            meet = (F.col(f"a.{c}") == F.col(f"b.{c}")) & meet
        pairs = later.alias("a").join(all_.alias("b"), meet)
        return pairs.select(F.col("a.line_key").alias("later"), F.col("b.line_key").alias("earlier"))

    counts = [f"c{k}" for k in range(len(_COUNTED))]
    ways = 2 * edits + 1
    level, done, found = entries, None, []
    for way in range(ways + 1):
        placed = stage(level.join(texts.drop("line", "id"), "line_key"), f"placed-segments-{way}").df
        member = F.xxhash64("line_key", "indexed")
        groups = placed.groupBy("hash").agg(
            F.count("*").alias("n"),
            F.min(F.struct("place", "line_key")).alias("head"),
            F.bit_xor(member).alias("xor"),
            F.sum(member.cast("decimal(20,0)")).alias("sum"),
        )
        hot = groups.where(F.col("n") > HOT).groupBy("n", "xor", "sum").agg(F.min("hash").alias("hash"), F.min("head").alias("head"))
        hot = stage(hot.select("hash", "n", F.col("head.line_key").alias("line_key")), f"hot-segments-{way}").df
        few = stage(groups.where((F.col("n") > 1) & (F.col("n") <= HOT)).select("hash"), f"cold-segments-{way}").df
        heads = stage(hot.select("hash", "line_key").join(texts.select("line_key", "length", *counts), "line_key"), f"hot-heads-{way}").df
        led = placed.alias("a").join(
            heads.alias("b"),
            (F.col("a.hash") == F.col("b.hash")) & (F.col("a.line_key") != F.col("b.line_key")) & _alike("a", "b", edits),
        )
        led = stage(near(led.select(F.col("a.line_key").alias("later"), F.col("b.line_key").alias("earlier"))), f"near-heads-{way}").df
        done = led if done is None else done.unionByName(led)
        open_ = placed.join(done, "line_key", "left_anti")
        cold = placed.join(small(few), "hash", "left_semi")
        found.append(near(met(cold.join(done, "line_key", "left_anti"), cold)))
        others = (F.col("h.hash") == F.col("o.hash")) & (F.col("h.line_key") != F.col("o.line_key"))  # than the earliest
        left = stage(hot.alias("h").join(open_.alias("o"), others, "left_semi").select("hash", "n"), f"open-segments-{way}").df
        if left.isEmpty():
            break
        members = placed.join(small(left.select("hash")), "hash", "left_semi")
        pairs = left.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0]
        if way == ways or pairs <= PAIRS * texts.count():
            one, all_ = F.pmod(F.xxhash64("line_key"), F.lit(DEALT)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))
            dealt = members.join(done, "line_key", "left_anti").withColumn("deal", one)
            found.append(near(met(dealt, members.withColumn("deal", all_), ("hash", "deal"))))
            break
        if way == 0:  # all classes of the line: no need to keep the segments apart
            members = members.select("line_key").distinct().select("line_key", F.lit(0).cast("long").alias("hash"))
        lines = texts.join(members.select("line_key").distinct(), "line_key", "left_semi")
        kept = stage(lines.select("line_key", _by_class(F.col("line"), edits, way).alias("kept")), f"classes-{way}").df
        level = members.select("line_key", "hash").join(kept, "line_key")
        level = level.select("line_key", "hash", F.posexplode("kept").alias("class", "kept"))
        level = level.select("line_key", F.xxhash64("hash", "class", "kept").alias("hash"), F.lit(True).alias("indexed"))
    out = done
    for one in found:
        out = out.unionByName(one)
    return out.distinct()


def dedup_lines(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines, n_equal, n_near``.

    A line that is not blank and equals an earlier one goes (``n_equal``). Of lines
    of at least ``least_chars`` characters, so does one within ``edits`` edits of a
    different line that first occurs earlier, all its occurrences (``n_near``).
    Earlier is by ``doc_id`` (null first), text digest and number of the line.
    Blank lines stay. A line that went may still be the earlier one of others.
    Rows with one id and one text count as one document and get one result. A null
    text stays null and has no lines; a document may be left with an empty text.
    Columns named like the three counts are replaced, all others are kept.
    """
    counts = ["n_lines", "n_equal", "n_near"]
    docs = docs.drop(*counts)
    read = docs.select("doc_id", "text")
    places = stage(
        _lines(read).select(
            F.struct("doc_id", "text_key", "line_no").alias("place"),
            _key(F.col("line")).alias("line_key"),
            F.xxhash64("line").alias("id"),
            F.when(F.col("length") >= least_chars, _hashes(F.col("line"), F.col("length"), edits)).alias("hashes"),
        ),
        "lines",
    ).df
    near = stage(_near(read, places, least_chars, edits).withColumn("near", F.lit(True)), "near-lines").df
    # Most lines occur once: told by their short hash first, so that few are shuffled with key and place.
    again = stage(places.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated-ids").df
    repeated = (
        places.join(small(again), "id", "left_semi").groupBy("line_key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("line_key", "first")
    )
    repeated = stage(repeated, "repeated-lines").df
    gone = (
        places.join(small(repeated), "line_key", "left")
        .join(small(near), "line_key", "left")
        .withColumn("near", F.coalesce("near", F.lit(False)))
        .where("near OR (first IS NOT NULL AND first <> place)")
        .select("place.*", "near")
        .distinct()
    )
    gone = stage(gone, "gone-lines").df
    lists = gone.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(
        F.collect_list("line_no").alias("__gone"), F.count_if("near").alias("__near")
    )  # at most the lines of one text
    lists = stage(lists, "gone-line-lists").df  # stored, so that Catalyst knows its size
    # The table's columns are told by their alias: they may have any names.
    joined = docs.alias("d").join(
        lists.alias("g"),
        F.col("d.doc_id").eqNullSafe(F.col("g.__id")) & (_key(F.col("d.text")) == F.col("g.__key")),
        "left",
    )
    text, lost = F.col("d.text"), F.col("g.__gone")
    split = F.split(text, "\n")
    left = F.array_join(F.filter(split, lambda _, i: ~F.array_contains(lost, i)), "\n")
    went, near_n = F.coalesce(F.size(lost), F.lit(0)), F.coalesce(F.col("g.__near"), F.lit(0)).cast("int")
    return joined.select(
        *[F.when(lost.isNull(), text).otherwise(left).alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns],
        F.coalesce(F.size(split), F.lit(0)).alias("n_lines"),
        (F.when(lost.isNull(), 0).otherwise(went) - near_n).alias("n_equal"),
        near_n.alias("n_near"),
    )
