"""Each stage of the pipeline against brute force over what the stage before kept."""

import random
import zlib
from pathlib import Path

import corpus_pipeline
import numpy as np
from matchstrata.llm import language_id
from matchstrata.llm.queries import oracle_sql, queries
from matchstrata.llm.tokens import vocabulary_path
from test_text_operators import LETTERS, brute_hits, brute_join, brute_lines, near_copies, union_find
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    word = lambda lang: "".join(rng.choice(LETTERS[lang].strip()) for _ in range(rng.randrange(2, 7)))
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(LETTERS))
        lines = [" ".join(word(lang) for _ in range(rng.randrange(9, 20))) for _ in range(rng.randrange(1, 6))]
        rows.append([i, "\n".join(lines), lang])
    for i in range(150, 180):  # near and exact copies
        text = rows[rng.randrange(150)][1].split(" ")
        if i % 2:
            text[rng.randrange(len(text))] = "ecce"
        rows.append([i, " ".join(text), "aa"])
    items = [(k, " ".join(word("bb") for _ in range(12))) for k in range(5)]
    for i in range(180, 190):
        rows.append([i, f"{word('bb')} {items[i % 5][1].upper()} " + " ".join(word("bb") for _ in range(5)), "bb"])
    rows += [[190, None, None], [191, "12 34 %%", "aa"], [192, "", "aa"]]
    docs = [(i, t, lang, f"s{i % 3}", None if t is None else len(t)) for i, t, lang in rows]
    return docs, items


def write(spark, tmp_path, docs, items):
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_are_those_of_brute_force(spark, tmp_path):
    docs, items = corpus()
    sf = write(spark, tmp_path, docs, items)
    kept = {}
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        function(spark, frame, sf).write.parquet(f"{sf}/{name}")
        after = spark.read.parquet(f"{sf}/{name}")
        assert after.columns == frame.columns and after.schema == frame.schema, name
        kept[name], frame = {r["doc_id"]: r for r in after.collect()}, after

    assert not {190, 191, 192} & set(kept["language_id"]) and len(kept["language_id"]) > 170
    rows = [(i, r["text"]) for i, r in kept["language_id"].items()]
    lines = {i: t for i, t, _, n_equal, n_near in brute_lines(rows, 2, 50) if t.strip() or not n_equal + n_near}
    assert {i: r["text"] for i, r in kept["line_dedup"].items()} == lines
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"].values())
    assert len(lines) < len(rows)
    assert set(kept["jaccard_join"]) == {i for i, n, c in brute_join(sorted(lines.items())) if n == 0 or i == c}
    rows = [(i, r["text"]) for i, r in kept["jaccard_join"].items()]
    clean = {r[0] for r in brute_hits(rows, items) if not r[-1]}
    assert set(kept["decontamination"]) == clean and len(clean) < len(rows)

    packed = corpus_pipeline.STAGES[-1][1](spark, frame, sf).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    for i in clean:
        pieces = sorted((r for r in packed if r["doc_id"] == i), key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in pieces), "<u4").tolist()
        assert ids == tokenizer.encode(kept["decontamination"][i]["text"], add_special_tokens=False).ids + [1]
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in packed)


def test_copies_of_paragraphs_parted_by_blank_lines_go_as_a_whole(spark):
    text = "\n\n".join(" ".join([w] * 12) for w in ("first", "second", "third"))
    rows = [(1, text), (2, text), (3, text.replace("\n\n", "\n \t\n\n")), (4, "\n\n"), (5, text + "\n\nan end of its own"), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.distinct_lines(spark, docs, "").collect()}
    assert set(kept) == {1, 4, 5, 6} and kept[1] == text and kept[5].strip() == "an end of its own"


def brute_similar(rows, words, percent):
    """Ids of the documents that stay: without words, or the first of those that links reach."""
    split = [(t or "").split() for _, t in rows]
    sets = [{tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set() for w in split]
    near = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    reached = union_find([(x, y) for x in range(len(rows)) for y in range(x) if near(sets[x], sets[y])])
    return {i for k, (i, _) in enumerate(rows) if reached.get(k, k) == k}


def test_similar_documents_share_four_fifths_of_five_word_shingles(spark):
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join(base), " ".join("other" if k in (30, 60) else w for k, w in enumerate(base)), "", None]
    rows = list(enumerate(texts + near_copies(9, 12, 5, 100, 4) + near_copies(10, 10, 4, 40, 2)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_similar(spark, docs, "").collect()}
    assert kept == brute_similar(rows, 5, 80) and {0, 2, 3} <= kept and 1 not in kept
    assert kept < brute_similar(rows, 3, 90)


def test_run_is_all_stages(spark, tmp_path):
    docs, items = corpus()
    sf = write(spark, tmp_path, docs[:60], items)
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
    assert 0 < len({r["doc_id"] for r in got.collect()}) <= 60


def test_empty_tables(spark, tmp_path):
    sf = write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_queries_are_one_for_each_operator():
    names = queries()
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(oracle_sql()) <= set(names)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_nothing_else_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent / "matchstrata"
    others = [p for p in root.rglob("*.py") if p.parent.name != "llm"]
    assert others and not any("matchstrata.llm" in p.read_text() or "from .llm" in p.read_text() for p in others)


def test_sample_is_bounded():
    assert language_id.SAMPLE_DOCS * language_id.SAMPLE_CHARS < 2_000_000
