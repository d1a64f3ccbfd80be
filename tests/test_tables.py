import re
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import rows
from matchstrata.operators.contracts import Contract, ContractViolation
from matchstrata.operators.dedup import keep_first
from matchstrata.session import scratch_path
from matchstrata.sources.tables import BUCKETS, LakeTable

KV = "k string, part string, v int"


@pytest.fixture
def lake(spark):
    return LakeTable(spark, scratch_path(spark, "table"))


def frame(spark, data, schema=KV):
    return spark.createDataFrame(data, schema)


def folder(lake):
    return Path(f"{lake.path}/{lake._about()['data']}".removeprefix("file:"))


def files(lake):
    """Live data files, by partition folder."""
    found = {}
    for f in folder(lake).rglob("*.parquet"):
        found.setdefault(f.parent.name if f.parent != folder(lake) else "", set()).add(f.name)
    return found


def test_absent_table(spark, lake):
    assert not lake.exists() and lake.version() is None
    with pytest.raises(FileNotFoundError):
        lake.read()
    schema = StructType([StructField("a", StringType())])
    assert lake.read_or_empty(schema).schema == schema
    summary = lake.summary("none").first()
    assert summary["version"] is None and "no table" in summary["message"]


def test_create_fixes_columns_and_constraints(spark, lake):
    schema = StructType([StructField("k", StringType()), StructField("n", LongType())])
    lake.create(schema, checks={"k_not_null": "k IS NOT NULL"})
    assert lake.create(StructType([])).schema() == schema
    assert lake.version() == 0 and lake.read().count() == 0
    lake.save(frame(spark, [("a", 1)], "k string, n bigint"), mode="append")
    with pytest.raises(ContractViolation, match="k_not_null"):
        lake.save(frame(spark, [(None, 1)], "k string, n bigint"), mode="append")
    with pytest.raises(ContractViolation, match="k_not_null"):
        lake.upsert(frame(spark, [(None, 1)], "k string, n bigint"), ["k"])
    assert lake.version() == 1 and rows(lake.read()) == [("a", 1)]


def test_modes(spark, lake):
    one, two = frame(spark, [("a", "p", 1)]), frame(spark, [("b", "p", 2)])
    lake.save(one, mode="error")
    with pytest.raises(FileExistsError):
        lake.save(two, mode="error")
    lake.save(two, mode="ignore")
    assert rows(lake.read()) == [("a", "p", 1)]
    lake.save(two, mode="append")
    assert rows(lake.read()) == [("a", "p", 1), ("b", "p", 2)]
    lake.save(two, mode="overwrite")
    assert rows(lake.read()) == [("b", "p", 2)]
    assert lake.version() == 2
    with pytest.raises(ValueError):
        lake.save(two, mode="upsert")


def test_a_table_can_be_overwritten_from_itself(spark, lake):
    lake.save(frame(spark, [("a", "p", 1), ("b", "p", 2)]))
    lake.save(lake.read().where("v = 2"))
    assert rows(lake.read()) == [("b", "p", 2)]


def test_replacing_partitions_keeps_the_others(spark, lake):
    load = {"partition_by": ["part"], "replace_partitions": True, "schema_mode": "merge"}
    lake.save(frame(spark, [("a", "d1", 1), ("b", "d2", 2), ("c", "d2", 3)]), **load)
    kept = files(lake)["part=d1"]
    again = frame(spark, [("b", "d2", 9), ("e", "d3", 4)])
    for _ in range(2):
        lake.save(again, **load)
        assert rows(lake.read(), *["k", "part", "v"]) == [("a", "d1", 1), ("b", "d2", 9), ("e", "d3", 4)]
    assert files(lake)["part=d1"] == kept


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_replacing_by_condition(spark, lake, partition_by):
    lake.save(frame(spark, [("a", "p", 1), ("b", "q", 2), ("c", "q", 3), ("d", None, 4)]),
              partition_by=partition_by)
    lake.save(frame(spark, [("x", "q", 7)]), replace_where="part = 'q'")
    expected = [("a", "p", 1), ("d", None, 4), ("x", "q", 7)]
    assert rows(lake.read(), "k", "part", "v") == expected
    with pytest.raises(ContractViolation, match="replace_where"):
        lake.save(frame(spark, [("y", "p", 8)]), replace_where="part = 'q'")
    lake.save(frame(spark, [("z", None, 0)]), replace_where="v = 0 OR k = 'a'")
    assert rows(lake.read(), "k", "part", "v") == expected[1:] + [("z", None, 0)]


def test_odd_partition_values_survive(spark, lake):
    parts = ["a b", "x/y: z=1", "100%", "", None, "ü", "[q]{r}*?", "a+b"]
    data = [(str(i), p, i) for i, p in enumerate(parts)]
    lake.save(frame(spark, data), partition_by=["part"])
    assert rows(lake.read(), "k", "part", "v") == sorted(data)
    lake.upsert(frame(spark, [(str(i), p, i + 10) for i, p in enumerate(parts)]), ["k"])
    assert rows(lake.read(), "k", "part", "v") == sorted((k, p, v + 10) for k, p, v in data)
    assert rows(lake.read().where("part = ''"), "k") == [("3",)]
    assert rows(lake.read().where("part IS NULL"), "k") == [("4",)]


def test_partition_filter_prunes_directories(spark, lake):
    lake.save(frame(spark, [("a", "p1", 1), ("b", "p2", 2)]), partition_by=["part"])
    plan = lake.read().where("part = 'p1' AND v > 0").select("k")._jdf.queryExecution().toString()
    scan = plan[plan.index("== Physical Plan =="):]
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)[1]
    assert "part#" in filters and "= p1" in filters
    assert "GreaterThan(v,0)" in scan and "ReadSchema: struct<k:string,v:int>" in scan


def test_schema_evolution(spark, lake):
    lake.save(frame(spark, [("a", 1)], "k string, v int"))
    wider = frame(spark, [("b", 2, "new")], "k string, v int, w string")
    with pytest.raises(ValueError, match="w"):
        lake.save(wider, mode="append")
    lake.save(wider, mode="append", schema_mode="merge")
    assert rows(lake.read()) == [("a", 1, None), ("b", 2, "new")]
    with pytest.raises(ValueError, match="column 'v'"):
        lake.save(frame(spark, [("c", "text")], "k string, v string"), mode="append", schema_mode="merge")
    lake.save(frame(spark, [("d", 4)], "k string, v int"), mode="overwrite", schema_mode="merge")
    assert rows(lake.read()) == [("d", 4, None)]
    lake.save(frame(spark, [("e",)], "k string"), mode="overwrite", schema_mode="overwrite")
    assert lake.read().columns == ["k"]


def test_unstorable_types_become_text(spark, lake):
    lake.save(spark.sql("SELECT 'a' AS k, NULL AS nothing, make_interval(1) AS span"))
    assert rows(lake.read()) == [("a", None, "1 years")]


def test_summary_and_preview(spark, lake):
    lake.save(frame(spark, [(str(i).zfill(2), "p", i) for i in range(25)]))
    summary = lake.summary("numbers").first()
    assert (summary["version"], summary["n_rows"], summary["n_columns"]) == (0, 25, 3)
    assert [(r["v"], r["place"]) for r in lake.preview(["k"]).collect()] == [(i, i + 1) for i in range(10)]


# -- upsert ----------------------------------------------------------------
def test_first_upsert_creates(spark, lake):
    lake.upsert(frame(spark, [("a", "p", 1)]), ["k"], partition_by=["part"])
    assert rows(lake.read(), "k", "part", "v") == [("a", "p", 1)]
    assert set(files(lake)) == {"part=p"}


def test_upsert_updates_moves_inserts_and_keeps(spark, lake):
    lake.upsert(
        frame(spark, [("a", "p1", 1), ("b", "p1", 2), ("c", "p2", 3), ("d", "p3", 4)]), ["k"],
        partition_by=["part"],
    )
    untouched = files(lake)["part=p3"]
    lake.upsert(frame(spark, [("a", "p9", 10), ("c", "p2", None), ("n", "p1", 5)]), ["k"])
    assert rows(lake.read(), "k", "part", "v") == [
        ("a", "p9", 10), ("b", "p1", 2), ("c", "p2", None), ("d", "p3", 4), ("n", "p1", 5),
    ]
    assert files(lake)["part=p3"] == untouched


def test_upsert_null_keys_are_inserted_and_copies_stay(spark, lake):
    lake.save(frame(spark, [("a", "p", 1), ("a", "p", 2), (None, "p", 3)]))
    lake.upsert(frame(spark, [("a", "q", 9), (None, "q", 8), (None, "q", 7)]), ["k"])
    assert rows(lake.read()) == sorted(
        [("a", "q", 9), ("a", "q", 9), (None, "p", 3), (None, "q", 8), (None, "q", 7)], key=repr
    )


def test_upsert_rejects_a_key_given_twice(spark, lake):
    lake.save(frame(spark, [("a", "p", 1)]))
    with pytest.raises(ContractViolation, match="unique"):
        lake.upsert(frame(spark, [("a", "p", 2), ("a", "p", 3)]), ["k"])
    assert lake.version() == 0


def test_upsert_by_two_keys_and_new_columns(spark, lake):
    lake.save(frame(spark, [("a", "p", 1), ("a", "q", 2)]))
    source = frame(spark, [("a", "q", 5, "n"), ("b", "q", 6, "m")], KV + ", w string")
    with pytest.raises(ValueError, match="w"):
        lake.upsert(source, ["k", "part"], schema_mode="overwrite")
    lake.upsert(source, ["k", "part"])
    assert rows(lake.read()) == [("a", "p", 1, None), ("a", "q", 5, "n"), ("b", "q", 6, "m")]
    lake.upsert(frame(spark, [("a", "q")], "k string, part string"), ["k", "part"])
    assert rows(lake.read()) == [("a", "p", 1, None), ("a", "q", 5, "n"), ("b", "q", 6, "m")]


def test_a_partition_load_done_again_changes_nothing(spark, lake):
    batches = [("s", 0, "a"), ("s", 1, "b"), ("s", 1, "z"), ("s", 1, "b"), ("another checkpoint", 0, "c")]
    for stream, batch, k in batches:
        loaded = frame(spark, [(k, stream, batch)], "k string, stream string, batch bigint")
        lake.save(loaded, partition_by=["stream", "batch"], replace_partitions=True)
    assert rows(lake.read(), "k", "stream", "batch") == [("a", "s", 0), ("b", "s", 1), ("c", "another checkpoint", 0)]


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_folders_stay_as_many_as_partitions(spark, lake, partition_by):
    for i in range(6):
        lake.upsert(frame(spark, [(str(i), "pq"[i % 2], i)]), ["k"], partition_by=partition_by)
    assert lake.read().count() == 6
    assert len(files(lake)) == (2 if partition_by else 1)
    assert all(len(names) <= BUCKETS for names in files(lake).values())
    # The current rows, and those before the load, for frames that were read then.
    assert len([d for d in folder(lake).parent.iterdir() if d.is_dir()]) == (1 if partition_by else 2)


def test_only_touched_partitions_are_written_anew(spark, lake):
    data = [(f"{i:03d}", "pqrs"[i % 4], i) for i in range(80)]
    lake.save(frame(spark, data), partition_by=["part"])
    before = files(lake)
    # 040 moves from p to q; r and s are neither left nor entered.
    lake.upsert(frame(spark, [("040", "q", -1)]), ["k"])
    assert {d.rpartition("=")[2] for d in before if before[d] == files(lake)[d]} == {"r", "s"}
    assert rows(lake.read(), "k", "part", "v") == sorted(
        [r for r in data if r[0] != "040"] + [("040", "q", -1)], key=repr
    )


def test_a_partition_that_all_rows_leave_goes(spark, lake):
    lake.upsert(frame(spark, [("a", "p", 1), ("b", "p", 2), ("c", "", 3), ("d", None, 4), ("e", "x/y=z", 5)]), ["k"], partition_by=["part"])
    moved = [("a", "q", 1), ("b", "q", 2), ("c", "q", 3), ("d", "q", 4), ("e", "", 5)]
    lake.upsert(frame(spark, moved), ["k"])
    assert rows(lake.read(), "k", "part", "v") == sorted(moved) and len(files(lake)) == 2
    lake.upsert(frame(spark, moved), ["k"])
    assert rows(lake.read(), "k", "part", "v") == sorted(moved)


def _keyed(spark, lake, n=40_000):
    """A table of many keys in 2 buckets, with small row groups."""
    schema = StructType([StructField("k", LongType()), StructField("part", StringType()), StructField("v", LongType())])
    lake.create(schema, partition_by=["part"], keys=["k"], buckets=2)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(1 << 14))
    try:
        lake.save(spark.range(n).select((F.col("id") * 2).alias("k"), F.lit("p").alias("part"), F.col("id").alias("v")), mode="append")
    finally:
        conf.unset("parquet.block.size")
    return lake


def _scanned(df):
    """Rows that the file scans of a frame hand on, after it ran."""
    df.collect()
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if "Adaptive" in node.nodeName():
            stack.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            stack.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            stack += [children.apply(k) for k in range(children.size())]
    return total


def test_a_merge_of_few_keys_reads_few_row_groups(spark, lake):
    table = _keyed(spark, lake)
    with table._bucketed(table._about()) as name:
        whole = _scanned(spark.table(name).select("k"))
        keys = [20 + 8_000 * i for i in range(10)]
        some = _scanned(spark.table(name).where(F.col("k").isin(keys)).select("k"))
        # Odd keys lie within the range of most row groups, but in no Bloom filter.
        none = _scanned(spark.table(name).where(F.col("k").isin([k + 1 for k in keys])).select("k"))
    assert whole == 40_000 and 10 <= some < whole / 2 and none < some / 2
    table.upsert(frame(spark, [(20, "p", -1), (21, "p", -2)], "k bigint, part string, v bigint"), ["k"])
    assert rows(table.read().where("k IN (20, 21)"), "k", "v") == [(20, -1), (21, -2)]
    assert table.read().count() == 40_001


def test_a_merge_does_not_shuffle_the_table(spark, lake):
    table = _keyed(spark, lake, 1_000)
    about = table._about()
    source = spark.range(500).select((F.col("id") * 3).alias("k"), F.lit("p").alias("part"), F.lit(0).cast("bigint").alias("v"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with table._bucketed(about) as name:
            merged = table._merged(spark.table(name), source, ["k"], table.schema())
            plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joins = plan.count("SortMergeJoin")
    assert joins == 2 and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange hashpartitioning") == 2  # the source, once for each join; never the table
    for part in plan.split("Scan parquet")[1:]:
        assert "Exchange" not in part.splitlines()[0]


def test_a_gate_keeps_rows_from_being_published(spark, lake):
    lake.save(frame(spark, [("a", "p", 1)]))
    seen = []

    def gate(written):
        seen.extend(rows(written, "k"))
        Contract("gate", rows={"small": "v < 5"}).enforce(written)

    with pytest.raises(ContractViolation):
        lake.upsert(frame(spark, [("b", "p", 7)]), ["k"], gate=gate)
    assert rows(lake.read(), "k") == [("a",)] and ("b",) in seen
    lake.upsert(frame(spark, [("b", "p", 3)]), ["k"], gate=gate)
    assert rows(lake.read(), "k") == [("a",), ("b",)]


KEYS = st.sampled_from(["a", "b", "c", None])
ROW = st.tuples(KEYS, st.sampled_from(["p", "q", ""]), st.integers(0, 9))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=8), st.lists(ROW, max_size=6, unique_by=lambda r: r[0]))
def test_upsert_equals_a_loop(spark, target, source):
    lake = LakeTable(spark, scratch_path(spark, "looped"))
    lake.save(frame(spark, target), partition_by=["part"])
    lake.upsert(frame(spark, source), ["k"])
    new = {r[0]: r for r in source if r[0] is not None}
    held = {r[0] for r in target}
    expected = [new.get(r[0], r) for r in target]
    expected += [r for r in source if r[0] is None or r[0] not in held]
    assert rows(lake.read(), "k", "part", "v") == sorted(expected, key=repr)
    if not any(r[0] is None for r in source):
        lake.upsert(frame(spark, source), ["k"])
        assert rows(lake.read(), "k", "part", "v") == sorted(expected, key=repr)


def test_buckets_grow_with_the_rows(spark, lake, monkeypatch):
    """A load takes as many buckets, and later writes as many tasks, as the rows need."""
    monkeypatch.setattr("matchstrata.sources.tables.BUCKET_ROWS", 100)
    schema = StructType([StructField("k", LongType()), StructField("part", StringType()), StructField("v", LongType())])
    lake.create(schema, partition_by=["part"], keys=["k"])
    some = lambda n, part: spark.range(n).select("id", F.lit(part).alias("p"), "id").toDF("k", "part", "v")
    load = {"replace_partitions": True, "partition_by": ["part"], "schema_mode": "merge"}
    lake.save(some(1_000, "a"), **load)
    assert lake._about()["buckets"] == 10 and len(files(lake)["part=a"]) == 10
    lake.save(some(3_000, "b"), **load)
    assert lake._about()["buckets"] == 10 and len(files(lake)["part=b"]) == 30
    lake.upsert(some(1_200, "a"), ["k"])
    assert lake.read().count() == 4_000 and len(files(lake)["part=a"]) >= 10


def exchanges(df):
    """Shuffles by hash in the plan of a frame."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_step_by_key_shares_the_shuffle_of_the_save(spark, lake, monkeypatch):
    """Rows placed as the save wants them are shuffled once for the choice of a copy and the buckets."""
    monkeypatch.setattr("matchstrata.sources.tables.BUCKET_ROWS", 20)
    lake.create(StructType([StructField("k", StringType()), StructField("part", StringType()), StructField("v", LongType())]), partition_by=["part"], keys=["k"])
    data = [(f"k{i % 100}", f"p{i % 3}", i) for i in range(150)]
    df = frame(spark, data, "k string, part string, v long")
    first = keep_first(lake.placed(df, 150), ["k", "part"], ["v"])
    assert exchanges(first) == 1
    written = []
    inner = LakeTable._write
    monkeypatch.setattr(LakeTable, "_write", lambda self, rows, *a, **more: written.append((exchanges(rows), more["placed"])) or inner(self, rows, *a, **more))
    lake.save(first, replace_partitions=True, schema_mode="merge", about_rows=150, placed=True)
    assert written == [(1, True)]
    want = rows(keep_first(df, ["k", "part"], ["v"]), "k", "part", "v")
    assert rows(lake.read(), "k", "part", "v") == want
    assert all(len({re.search(r"_(\d+)\.", f).group(1) for f in fs}) == len(fs) for fs in files(lake).values())  # a file a bucket
    with lake.read_by_keys(150) as by_keys:
        latest = keep_first(by_keys, ["k"], ["v"])
        assert exchanges(latest) == 0
        assert rows(latest, "k", "v") == rows(keep_first(df, ["k"], ["v"]), "k", "v")
    with lake.read_by_keys(10_000) as grown:  # too few buckets for so many rows
        assert exchanges(keep_first(grown, ["k"], ["v"])) == 1
