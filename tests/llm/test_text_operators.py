"""Similarity join, line dedup, decontamination, language and quality against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from matchstrata.llm import decontamination, jaccard, language_id, line_dedup, quality
from matchstrata.llm.common import components
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, hash long, words int, __id long, __key string, __gone int"


def frame(spark, rows, parts=3):
    full = [(i, t, lang, "s", len(t or ""), "k", 1, 2, 7, "k", 3) for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def union_find(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 260)]
    links += [(300, k) for k in range(301, 340)] + [(5, 5), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    want = union_find([x for x in links if None not in x and x[0] != x[1]])
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert got.count() == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Similarity join

def brute_join(rows):
    def shingles(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        if not w:
            return frozenset()
        return frozenset(tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2)))

    sets = [shingles(t) for _, t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                    links.append((a, b))
    roots = union_find(links)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = roots.get(k, k)
            least[r] = min(i, least.get(r, i))
    return sorted(
        ((i, len(sets[k]), least.get(roots.get(k, k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=repr
    )


def near_copies(seed, groups, copies, length, edits):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = words(rng, length)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w = w[rng.randrange(4) :]
            out.append(" ".join(w))
    return out


def check_join(spark, texts):
    rows = list(enumerate(texts))
    got = jaccard.similar_documents(frame(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted(map(tuple, got), key=repr) == brute_join(rows)


def test_join_is_the_brute_force_join(spark):
    texts = near_copies(1, 12, 6, 70, 3) + near_copies(2, 6, 4, 12, 1) + near_copies(3, 5, 5, 300, 9)
    texts += [None, "", " \t\n", "one", "One", "two words", "two  words", "a b c", "A b c", "a b c a b c a b c", "É è", "é è"]
    texts += ["same text here again"] * 5 + ["K kelvin sign", "k kelvin sign"]
    check_join(spark, texts)


def test_join_of_large_groups_goes_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT", 3)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 5)
    check_join(spark, near_copies(4, 3, 30, 90, 5) + near_copies(5, 20, 3, 40, 2))


def test_documents_with_a_common_passage_are_not_compared_for_it(spark, monkeypatch):
    """An estimate that cannot tell frequent shingles does not chain the documents that hold them."""
    monkeypatch.setattr(jaccard, "HOT", 8)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 5)
    monkeypatch.setattr(jaccard, "_sketch", lambda scanned: np.zeros(1 << jaccard.SKETCH_BITS, np.int64))
    compared, verified = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda members, rule: compared.append(members.count()) or verified(members, rule))
    rng = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(30))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " " + passage for _ in range(40)]
    check_join(spark, [*texts, texts[0] + " more", texts[1] + " more"])
    assert compared[0] < 40  # fewer members than documents; by blocks, all with all, 378


def test_join_of_long_candidate_chains(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT", 50)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 3)
    check_join(spark, near_copies(6, 4, 14, 80, 5))


def test_join_with_null_and_repeated_ids(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(None, a), (None, a), (7, b), (7, a), (7, b), (3, b), (None, "alone here now"), (9, None), (None, None)]
    got = jaccard.similar_documents(frame(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted(map(tuple, got), key=repr) == brute_join(rows)
    assert jaccard.similar_documents(frame(spark, [])).count() == 0


def test_prefixes_never_miss(spark):
    rng = np.random.default_rng(8)
    rule = jaccard.Rule()
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = rng.choice(1000, n, replace=False).astype(np.uint64)
        b = np.unique(np.where(rng.random(n) < 0.06, rng.integers(0, 1000, n), a).astype(np.uint64))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both):
            continue
        seen = rng.integers(1, 60, 1000)
        la, pa_ = jaccard.prefix(a, seen[a.astype(int)], rule)
        lb, pb = jaccard.prefix(b, seen[b.astype(int)], rule)
        assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_one_of_each_group_stays(spark):
    texts = near_copies(1, 5, 4, 70, 2) + ["", None, "", "dup dup dup dup"] + ["dup dup dup dup"]
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)] + [(0, texts[0], None)])
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = [i for i, n, c in brute_join(list(enumerate(texts))) if n == 0 or i == c]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_rows_with_one_id_go_or_stay_each_for_itself(spark):
    """Copies go by id and text: a clean text under the id of a copy is not lost."""
    a, b = "a text that two rows hold in common", "quite another text that nobody else has"
    rows = [(1, a, None), (2, a, None), (2, b, None), (None, b + " x y z", None), (None, a, None), (5, None, None), (5, "", None)]
    rows += [(None, "same words without any id", None)] * 2 + [(7, "twice under one id and text", None)] * 3
    kept = jaccard.one_of_each(frame(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(
        [(1, a), (2, b), (None, b + " x y z"), (5, None), (5, ""), (None, "same words without any id"), (7, "twice under one id and text")],
        key=repr,
    )


# Line dedup

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutated(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        k = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[k] = rng.choice("abcé☃")
        elif kind == 1:
            text.insert(k, rng.choice("abc𝄞"))
        elif len(text) > 4:
            del text[k]
    return "".join(text)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_band_in_bits_is_edit_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("ab" if rng.random() < 0.5 else "abcdé") for _ in range(rng.randrange(5, 24)))
        b = mutated(rng, a, rng.randrange(edits + 3))
        if abs(len(a) - len(b)) <= edits and min(len(a), len(b)) >= edits:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string").repartition(8)
    got = df.select("a", "b", line_dedup.within(F.col("a"), F.col("b"), edits).alias("near")).collect()
    for r in got:
        assert r["near"] == (distance(r["a"], r["b"]) <= edits), (r["a"], r["b"])


def brute_lines(rows, edits, least):
    occ = []
    for i, text in rows:
        if text is not None:
            key = hashlib.sha256(text.encode()).digest()[:16]
            occ += [((i is not None, i or 0, key, n), line) for n, line in enumerate(text.split("\n")) if line.strip(" \t\r\f\v")]
    first = {}
    for place, line in occ:
        first[line] = min(place, first.get(line, place))
    near = {
        a for a in first for b in first
        if min(len(a), len(b)) >= least and a != b and first[b] < first[a] and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits
    }
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0, 0))
            continue
        key, kept, n_equal, n_near = hashlib.sha256(text.encode()).digest()[:16], [], 0, 0
        for n, line in enumerate(text.split("\n")):
            if line in near:
                n_near += 1
            elif line in first and first[line] != (i is not None, i or 0, key, n):
                n_equal += 1
            else:
                kept.append(line)
        out.append((i, "\n".join(kept), len(text.split("\n")), n_equal, n_near))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [2, 16])
def test_lines_are_those_of_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = random.Random(hot)
    base = ["".join(rng.choice("abcdefg é") for _ in range(rng.randrange(12, 40))) for _ in range(25)]
    base += ["aaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaa", "abababababababababab", "tiny", ""]
    rows = []
    for i in range(60):
        lines = [mutated(rng, x, rng.choice([0, 0, 1, 2, 3])) if len(x) > 12 else x for x in rng.choices(base, k=rng.randrange(1, 7))]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (None, rows[0][1]), (102, "\n\n"), (103, rows[3][1]), (104, base[2] + "\n" + base[2])]
    rows.append(rows[5])
    got = line_dedup.dedup_lines(frame(spark, [(i, t, None) for i, t in rows]), least_chars=12).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_equal"], r["n_near"]) for r in got), key=repr) == brute_lines(rows, 2, 12)


def test_lines_keep_all_columns(spark):
    docs = frame(spark, [(1, "x" * 60 + "\nshort\n" + "x" * 60, "en"), (2, "x" * 60, None)])
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_equal", "n_near"]
    assert (got[1]["text"], got[2]["text"], got[1]["key"]) == ("x" * 60 + "\nshort", "", "k")
    assert (got[1]["__id"], got[1]["__key"], got[1]["__gone"]) == (7, "k", 3)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_lines_of_one_lead_are_told_apart_by_what_follows(spark, monkeypatch):
    """Groups of one segment are cut further instead of paired; no near line is lost."""
    rng = random.Random(5)
    lead = "This file is licensed under the terms that follow: "
    lines = [lead + "".join(rng.choice("abcdefgh ") for _ in range(30)) for _ in range(250)]
    lines += [mutated(rng, rng.choice(lines), rng.choice([1, 2, 2, 3])) for _ in range(60)]
    lines += [x[:40] + "Q" + x[40:] for x in lines[:20]]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i :: 40])) for i in range(40)]
    seen = []
    real = line_dedup.within
    monkeypatch.setattr(line_dedup, "within", lambda a, b, edits: seen.append(1) or real(a, b, edits))
    got = line_dedup.dedup_lines(frame(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_equal"], r["n_near"]) for r in got), key=repr) == brute_lines(rows, 2, 50)
    assert len(seen) > 3  # more than one level


def test_near_copies_of_one_line_are_told_apart_by_few_entries(spark, monkeypatch):
    """Lines with words replaced anywhere share most segments: what is stored for them grows with the lines."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(6))
    base = [word() for _ in range(24)]
    lines = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(len(words))] = word()
        lines.append(" ".join(words))
    lines += [mutated(rng, x, rng.choice([1, 2, 3])) for x in rng.sample(lines, 20)]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::15])) for i in range(15)]
    stored, real = {}, line_dedup.stage

    def counted(df, label, *more):
        out = real(df, label, *more)
        stored[label] = out.df.count()
        return out

    monkeypatch.setattr(line_dedup, "stage", counted)
    monkeypatch.setattr(line_dedup, "PAIRS", 2, raising=False)
    got = line_dedup.dedup_lines(frame(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_equal"], r["n_near"]) for r in got), key=repr) == brute_lines(rows, 2, 50)
    assert max(stored.values()) <= 12 * len(lines), stored  # 12 look-ups a line


def test_classes_of_characters_hold_each_once():
    every = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    for edits in (1, 2):
        for way in range(2 * edits + 1):
            classes = [re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", c) + "]") for c in line_dedup._classes(edits, way)]
            assert len(classes) == 2 * edits + 1
            for c in every[:0x600] + every[0x600::997]:
                assert sum(x.match(c) is not None for x in classes) == 1


def test_short_lines_that_repeat_stay_once(spark):
    rows = [(i, f"words of document {i}\nAll rights reserved.\n\n \t\n}}", None) for i in range(5)]
    got = {r["doc_id"]: (r["text"], r["n_equal"]) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[i] == (f"words of document {i}\n\n \t", 2) for i in range(1, 5))


def test_lines_with_more_of_one_character_than_a_short_holds(spark):
    line = " ".join("x" * 32_768)  # 32,767 spaces
    docs = frame(spark, [(1, line, None), (2, line + " y", None), (3, line[:-1] + "z", None)])
    got = {r["doc_id"]: (r["text"], r["n_near"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (line, 0), 2: ("", 1), 3: ("", 1)}


# Decontamination

def brute_hits(rows, items):
    def split(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)

    out = []
    for i, text in rows:
        w, hit, ids = split(text), set(), set()
        for item, body in items:
            v = split(body)
            n = min(10, len(v))
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids.add(item)
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_contamination_is_that_of_brute_force(spark):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, rng.choice([3, 5, 9, 10, 11, 14, 25, 60]), 200))) for k in range(25)]
    items += [(100, "Zürich? Straße: x"), (104, "ΟΔΟΣ x"), (101, ""), (102, None), (None, " ".join(words(rng, 12))), (7, " ".join(words(rng, 15))), (103, "a a a a a a a a a a a a a a")]
    rows = []
    for i in range(120):
        w = words(rng, rng.randrange(0, 60), 200)
        for _ in range(rng.randrange(3)):
            v = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(v) + 1)
            w[rng.randrange(len(w) + 1) : 0] = v[a : a + rng.choice([8, 9, 10, 12, 30])]
        rows.append((i, rng.choice([" ", ", ", "--", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    rows += [(500, None), (501, ""), (502, "ZÜRICH straße X zürich STRAßE x"), (504, "Zürich ΟΔΟΣ'x! Straße ΟΔΟΣ."), (None, items[3][1]), (3, items[5][1]), (503, "a " * 40), rows[7]]
    got = decontamination.contaminated(frame(spark, [(i, t, None) for i, t in rows]), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == brute_hits(rows, items)


def test_contamination_without_rows(spark):
    docs = frame(spark, [(1, "some words here", None)])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontamination.contaminated(docs, none).select(*COLUMNS).collect()] == brute_hits([(1, "some words here")], [])
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.without_benchmark(docs, items).count() == 0
    assert decontamination.without_benchmark(docs, none).columns == docs.columns


def test_contamination_is_native(spark):
    docs, items = frame(spark, [(1, "a b", None)]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for df in (decontamination.contaminated(docs, items), line_dedup.dedup_lines(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# Language

LETTERS = {"aa": "abcde ", "bb": "vwxyz ", "cc": "éèàùç "}


def language_rows(n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(LETTERS))
        rows.append((i, "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(4, 400))) + "e" * (lang == "aa"), lang))
    return rows


def test_gradients_are_those_of_differences():
    rng = np.random.default_rng(0)
    net = language_id.new_network(["a", "b", "c"], rng, hidden=3)
    runs, labels = rng.integers(0, 257, (4, 6)), np.array([0, 1, 2, 1])
    _, gradients = language_id.loss_and_gradients(net, runs, labels)
    for p, g in zip(net.parts(), gradients, strict=True):
        used = np.flatnonzero(g) if g.size > 300 else np.arange(g.size)
        for k in rng.choice(used, min(12, len(used)), replace=False):
            at = np.unravel_index(k, p.shape)
            kept = p[at]
            p[at] = kept + 1e-6
            up = language_id.loss_and_gradients(net, runs, labels)[0]
            p[at] = kept - 1e-6
            down = language_id.loss_and_gradients(net, runs, labels)[0]
            p[at] = kept
            assert abs((up - down) / 2e-6 - g[at]) < 1e-5


def test_reader_agrees_with_the_training_network():
    rng = np.random.default_rng(1)
    net = language_id.new_network(["a", "b"], rng)
    runs = rng.integers(0, 256, (5, 20))
    p = language_id.Reader(net).positions(runs)
    loss, _ = language_id.loss_and_gradients(net, runs, np.zeros(5, int))
    assert p.shape == (5, 20, 2) and abs(-np.log(p[..., 0]).mean() - loss) < 1e-4
    texts = [b"", b"x", bytes(rng.integers(0, 256, 300).astype(np.uint8))]
    pooled = language_id.Reader(net).pooled(texts)
    assert pooled[0].sum() == 0 and np.allclose(pooled[1:].sum(axis=1), 1, atol=1e-4)


def test_languages_are_told_apart_on_held_out_documents(spark):
    rows = language_rows() + [(900, None, "aa"), (901, "", None), (902, "12 %% 34", "bb"), (None, "abcd " * 20, None), (5, "vwxy " * 9, None)]
    got = language_id.identified(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    unseen = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in unseen if r["doc_id"] < 400]) > 0.97
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and by_id[None]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got)


def _plain_pooled(net, text):
    """Mean label distribution over the bytes of a text, a loop over runs, steps and units."""
    h_size, total = net.states.shape[1], np.zeros(len(net.languages))
    gate = lambda x: min(1.0, max(0.0, 0.25 * x + 0.5))

    def one_way(part, side):
        h, out = [0.0] * h_size, []
        for byte in part:
            a = net.inputs[side, byte]
            b = [sum(h[i] * net.states[side, i, j] for i in range(h_size)) for j in range(3 * h_size)]
            new = []
            for u in range(h_size):
                z, r = gate(a[u] + b[u]), gate(a[h_size + u] + b[h_size + u])
                c = np.tanh(a[2 * h_size + u] + r * b[2 * h_size + u])
                new.append(c + z * (h[u] - c))
            h = new
            out.append(h)
        return out

    for start in range(0, len(text), language_id.RUN):
        part = text[start : start + language_id.RUN]
        for f, b in zip(one_way(part, 0), one_way(part[::-1], 1)[::-1], strict=True):
            scores = np.array(f) @ net.out[0] + np.array(b) @ net.out[1] + net.bias
            e = np.exp(scores - scores.max())
            total += e / e.sum()
    return total / len(text)


def test_prediction_of_a_long_text_is_that_of_plain_loops(spark):
    net = language_id.train([(t.encode(), lang) for _, t, lang in language_rows(60)], steps=20)
    texts = ["vwxyz " * 70 + "abc", "é" * 65, "a", "abcde vwxyz éèàùç " * 17]
    got = {r["doc_id"]: r for r in language_id.languages_of(frame(spark, [(i, t, None) for i, t in enumerate(texts)]), net).collect()}
    for i, t in enumerate(texts):
        want = _plain_pooled(net, t.encode())
        assert got[i]["lang_pred"] == net.languages[int(want.argmax())]
        assert abs(got[i]["score"] - want.max()) < 1e-3


def test_more_languages_than_a_batch_holds_are_all_learnt():
    names = [f"l{k:03}" for k in range(200)]
    seen = set()
    real = language_id.loss_and_gradients

    def watched(net, runs, labels):
        seen.update(labels.tolist())
        return real(net, runs, labels)

    language_id.loss_and_gradients = watched
    try:
        net = language_id.train([(f"{n} {n}".encode(), n) for n in names], steps=2)
    finally:
        language_id.loss_and_gradients = real
    assert net.languages == names and seen == set(range(200))


def test_every_language_has_a_place_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 3)
    rows = [(i, "text", f"l{i}") for i in range(40)]
    learnt = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {lang for _, lang in language_id.sample_of(frame(spark, rows))} == learnt


def test_labels_of_held_out_documents_are_not_read(spark):
    rows = language_rows(60)
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert language_id.sample_of(frame(spark, rows, 1)) == language_id.sample_of(frame(spark, other, 1))


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(i, "text", None) for i in range(5)])
    assert {r["lang_pred"] for r in language_id.identified(docs).collect()} == {"und"}
    assert language_id.in_known_language(docs).count() == 5
    assert language_id.identified(docs.limit(0)).count() == 0


def test_rejected_documents_go(spark):
    rows = language_rows(200) + [(900, None, "aa"), (901, "12 34", "bb")]
    docs = frame(spark, rows)
    kept = language_id.in_known_language(docs)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and len(ids & set(range(200))) > 190 and not ids & {900, 901}


# Quality

def quality_rows():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < (0.9 if i % 3 else 0.3)
        text = " ".join(words(rng, 60)) + "." if good else " ".join(w + "%%%" for w in words(rng, 30))
        rows.append((i, text, "en" if i % 2 else None, f"host{i % 3}" if i % 50 else None))
        if i % 2 == 0:
            labels.append((i, int(good), 0))
    return rows, labels


def scored(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    return quality.scored(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_follows_labels(spark):
    rows, labels = quality_rows()
    got = {r["doc_id"]: r for r in scored(spark, rows, labels).collect()}
    bad = {i for i, text, _, _ in rows if "%%%" in text}
    assert len(got) == len(rows)
    assert np.mean([(i in bad) != got[i]["keep"] for i in got]) > 0.97


def test_rates_are_shrunk_sums(spark):
    rows, labels = quality_rows()
    got = scored(spark, rows, labels).collect()
    good = {i: q for i, q, _ in labels}
    weight = lambda r: (1.0, good[r["doc_id"]]) if r["doc_id"] in good else (0.25, 0.25 * r["opinion"])
    groups, paths = {}, {}
    for r in got:
        for table, key in ((groups, r["host"]), (paths, (r["host"], r["path"]))):
            n, s = table.get(key, (0, 0))
            w, x = weight(r)
            table[key] = (n + w, s + x)
    total = sum(s for _, s in groups.values()) / sum(n for n, _ in groups.values())

    def concentration(table, prior):
        n = sum(k for k, _ in table.values())
        between = sum(k * (s / k - prior(key)) ** 2 for key, (k, s) in table.items())
        chance = sum(prior(key) * (1 - prior(key)) for key in table)
        within = sum(k * prior(key) * (1 - prior(key)) for key, (k, _) in table.items()) / n
        spread = (between - chance) / (n - sum(k * k for k, _ in table.values()) / n)
        return within / spread - 1 if spread > 0 else 1e6

    k_host = concentration(groups, lambda _: total)
    means = {h: (k_host * total + s) / (k_host + n) for h, (n, s) in groups.items()}
    k_path = concentration(paths, lambda key: means[key[0]])
    for r in got[:80]:
        w, x = weight(r)
        n, s = groups[r["host"]]
        host = (k_host * total + s - x) / (k_host + n - w)
        n, s = paths[(r["host"], r["path"])]
        path = (k_path * host + s - x) / (k_path + n - w)
        assert abs(r["host_rate"] - host) < 1e-6 and abs(r["path_rate"] - path) < 1e-6
        odds = r["opinion"] / (1 - r["opinion"]) * path / (1 - path) / (total / (1 - total))
        assert abs(r["quality"] - odds / (1 + odds)) < 1e-6


def test_quality_of_odd_rows(spark):
    rows, labels = quality_rows()
    rows += [(None, None, None, None), (None, "", "en", "h"), (3, "again", None, None), (4, "x" * 100_000, "en", "h")]
    labels += [(None, 1, 1), (5, None, 0), (3, 1, 0), (3, 0, 0), (99_999, 1, 0)]
    assert scored(spark, rows, labels).count() == len(rows)
    assert {round(r["opinion"], 6) for r in scored(spark, rows[:9], [(1, 1, 0)]).collect()} == {0.5}
    assert scored(spark, [], labels).count() == 0
