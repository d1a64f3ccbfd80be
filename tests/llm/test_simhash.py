"""SimHash near duplicates against plain Python."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from matchstrata.llm import simhash

DOCS = "doc_id long, text string, f long, w string, n int, at int, task int, entry long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 5, "x", 1, 2, 3, 4) for i, t in rows], DOCS).repartition(parts)


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits=3):
    """Smallest id reachable for each row; rows are compared all with all."""
    group = list(range(len(ids)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                group[root(a)] = root(b)
    roots = [root(k) for k in range(len(ids))]
    least = {}
    for r, i in zip(roots, ids, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in roots]


def near_texts(rng, n, size=60):
    """Groups of texts that differ in few words, and some that do not."""
    out = []
    while len(out) < n:
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([size, 4 * size]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(99)}"
            out.append(" ".join(copy))
    return out[:n]


ODD = [None, "", " \t\n", "One", "two words", "ONE", "a b c", "a\x0bb\x0cc", "é x y z", "\x85 b c d", "a  b\r\nc", "x " * 9000, "İI K"]


def test_fingerprints_are_the_plain_ones(spark):
    rng = random.Random(4)
    texts = ODD + near_texts(rng, 80)
    rows = list(enumerate(texts)) + [(None, "a b c"), (3, "One"), (3, "One"), (3, "other text of four")]
    got = sorted(map(tuple, simhash.fingerprints(frame(spark, rows)).collect()), key=repr)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    assert got == sorted(((i, signed(plain_fingerprint(t))) for i, t in rows), key=repr)


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = random.Random(11)
    texts = ODD + near_texts(rng, 250)
    rows = [(k if k % 40 else None, t) for k, t in enumerate(texts)] + [(7, texts[30]), (7, texts[31]), (900, None)]
    rng.shuffle(rows)
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], prints)
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, want, strict=True)), key=repr
    )
    assert len({p for p in prints}) > len(set(want)) > 50


def dense_values(rng):
    """Values around few centres, among them many with one half in common."""
    values = {0, -1, 1 << 62}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(60):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
        for _ in range(150):  # one half in common, but for a bit
            values.add((centre & ~0xFFFFFFFF) ^ rng.getrandbits(32) ^ (rng.randrange(2) << 40))
        for _ in range(120):  # three quarters in common
            values.add((centre & ~0xFFFF) ^ rng.getrandbits(16))
        for _ in range(200):  # all but the low byte in common, but for two bits
            values.add((centre & ~0xFF) ^ rng.getrandbits(8) ^ (rng.randrange(2) << 20) ^ (rng.randrange(2) << 50))
    return sorted({x - (1 << 64) if x >= 1 << 63 else x for x in values})


@pytest.mark.parametrize("bits, pairs_each", [(3, 64), (3, 1), (3, 0), (2, 1), (1, 0)])
def test_no_link_is_lost_when_entries_are_cut_further(spark, bits, pairs_each):
    values = dense_values(random.Random(8))
    frame_ = spark.createDataFrame([(v,) for v in values] + [(values[0],), (None,)], "f long")
    got = {(r["a"], r["b"]) for r in simhash.linked(frame_, bits, pairs_each).collect()}
    mask = (1 << 64) - 1
    want = {
        (a, b) for k, a in enumerate(values) for b in values[k + 1 :] if ((a ^ b) & mask).bit_count() <= bits
    }
    assert {(min(p), max(p)) for p in got} == want


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.linked(spark.createDataFrame([(1,)], "f long"), 4)


def test_main_path_is_built_in(spark):
    plan = simhash.fingerprints(frame(spark, [(1, "a b c d")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "Arrow")
    assert simhash.fingerprints(frame(spark, [(1, "a b c d")])).select(F.count("*")).first()[0] == 1
