"""Fill-in-the-middle documents against plain Python."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from matchstrata.llm import fill_in_middle as fim

DOCS = "doc_id long, text string, n long, form string, output string"
ODD = [
    None, "", "\n", "\n\n\n", "one line", "one line\n", "a\nb", "a\nb\n\n", "é\nüü\n\U0001f600 x", "has <P> in it\n", "<S>", "x<M>\ny",
    "ends with <\nmore <S\n<P", "<\n>\nS>\nP>", "\r\n\r\n", "\x00\n\x00",
]


def plain(doc_id, text, layout=fim.Layout()):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{layout.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    p, s, m = layout.prefix, layout.suffix, layout.middle
    if not text or any(x in text for x in (p, s, m)) or h[2] % 100 >= layout.rate:
        return doc_id, len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < layout.suffix_first:
        return doc_id, len(lines), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return doc_id, len(lines), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def some_texts(rng, n=200):
    passages = ["\n".join("".join(rng.choice("abé €") for _ in range(rng.randrange(90))) for _ in range(60)) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = [rng.choice(passages + ["\n", "x\n", "tail", "y" * rng.randrange(3000)]) for _ in range(rng.randrange(1, 9))]
        out.append("\n".join(parts) + rng.choice(["", "\n"]))
    return out


def all_rows():
    rng = random.Random(3)
    texts = ODD + some_texts(rng) + ["\n" * 70_000, "a" * 200_000, "é" * 40_000 + "\n" + "b" * 40_000]
    return list(enumerate(texts)) + [(None, "no\nid\nat all\n"), (5, "other\ntext"), (5, "other\ntext")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], DOCS).repartition(3)


def test_outputs_are_the_plain_ones_and_give_the_texts_back(spark):
    rows = all_rows()
    for layout in (fim.Layout(), fim.Layout(seed=1, rate=60, suffix_first=10, prefix="[pre]", suffix="(su|f)", middle="$")):
        made = fim.fill_in_middle(frame(spark, rows), layout)
        got = made.withColumn("back", fim.restored(layout=layout)).collect()
        assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted((plain(i, t, layout) for i, t in rows), key=repr)
        assert sorted(((r["doc_id"], r["back"]) for r in got), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
        assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_chunks_follow_content():
    rng = np.random.default_rng(2)
    body = rng.integers(0, 256, 300_000).astype(np.uint8).tobytes()

    def chunks(raw):
        ends = list(fim.chunk_ends(0, len(raw), fim.candidates(np.frombuffer(raw, np.uint8)).tolist()))
        assert b"".join(raw[a:b] for a, b in zip([0, *ends], ends, strict=False)) == raw
        assert all(b - a <= fim.MOST_CHUNK for a, b in zip([0, *ends], ends, strict=False))
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    whole, shifted = chunks(body), chunks(b"some words before" + body)
    assert len(set(whole) & set(shifted)) > 0.9 * len(whole) > 100
    # The place inside a longer run of texts does not matter.
    joined = b"q" * 1000 + body
    cuts = fim.candidates(np.frombuffer(joined, np.uint8)).tolist()
    assert [e - 1000 for e in fim.chunk_ends(1000, len(joined), cuts)] == list(np.cumsum([len(c) for c in whole]))
    assert chunks(b"") == [] and chunks(b"x") == [b"x"]


def test_hash_blocks_do_not_show(monkeypatch):
    data = np.random.default_rng(4).integers(97, 123, 50_000).astype(np.uint8)
    want = fim.candidates(data)
    monkeypatch.setattr(fim, "_HASHED_AT_ONCE", 777)
    assert (fim.candidates(data) == want).all() and len(want) > 20


def test_repeated_chunks_are_looked_at_once():
    counts = fim.ChunkCounts()
    body = np.random.default_rng(5).integers(97, 123, 40_000).astype(np.uint8).tobytes()
    for lead in (b"", b"abc", b"other"):
        raw = lead + body
        cuts = fim.candidates(np.frombuffer(raw, np.uint8)).tolist()
        ends = list(fim.chunk_ends(0, len(raw), cuts))
        fim.CutText(raw, ends, counts)
    assert counts.looked_at < 1.3 * len(ends)
    small = fim.ChunkCounts(kept_bytes=2_000)
    for k in range(500):
        assert small(b"line %d\n\xc3\xa9" % k) == (1, len(b"line %d\n" % k) + 1)
    assert small.held < 4_000


def test_empty_table(spark):
    assert fim.fill_in_middle(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert fim.fill_in_middle(frame(spark, [(1, "a")])).where(F.col("n") == 1).count() == 1
