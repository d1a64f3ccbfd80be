"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from matchstrata.operators import dedup, refine, standings as table
from matchstrata.plans import reports, workload
from matchstrata.session import scratch_path, stage

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return stage(workload.silver(spark, SF_DIR), "plans").df


LAZY = ["standings", "dedup_latest", "dedup_first", "dedup_last_in_batch", "refine_pipeline",
        "enrich_left_join", "name_map", "leaders", "league_kpis", "outcome_counts", "blowouts",
        "contract_silver", "contract_gold", "cross_layer_check", "played_pending_counts", "leagues"]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products_and_no_python_in_plans(spark, name):
    plan = plan_of(workload.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in plan


def test_one_row_per_key_is_limited_before_the_shuffle(spark, silver):
    plan = plan_of(dedup.keep_latest(silver))
    limits = re.findall(r"WindowGroupLimit .*?(Partial|Final)", plan)
    assert limits == ["Final", "Partial"]
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning(event_id")


def test_standings_scan_once_hash_aggregate_first(spark, silver):
    plan = plan_of(table.standings(silver))
    assert plan.count("FileScan") == 1
    assert plan.count("HashAggregate(keys=[league") == 2
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "league", "home_team", "home_id", "home_score", "away_team", "away_id", "away_score",
        "event_date", "outcome"}


def test_reports_read_only_their_columns(spark, silver):
    plan = plan_of(reports.outcome_counts(silver))
    assert "ReadSchema: struct<league:string,outcome:string>" in plan
    plan = plan_of(reports.blowouts(silver, "ASIA"))
    assert "EqualTo(league,ASIA)" in plan and "EqualTo(is_blowout,true)" in plan


def test_finished_filter_stays_above_the_deduplication(spark, silver):
    plan = plan_of(refine.clean_matches(dedup.keep_latest(workload.matches_raw(spark, SF_DIR))))
    assert plan.index("btrim" if "btrim" in plan else "upper(") < plan.index("Window ")


def test_teams_are_broadcast_by_size_only(spark, silver):
    teams = workload.teams_raw(spark, SF_DIR)
    large = stage(
        spark.range(400_000).select(
            F.col("id").cast("string").alias("team_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("city"),
            F.col("id").alias("venue_capacity"),
        ),
        "large_teams",
    ).df
    small_plan = plan_of(refine.enrich_with_home_team(silver, stage(teams, "teams").df))
    large_plan = plan_of(refine.enrich_with_home_team(silver, large))
    assert "BroadcastHashJoin" in small_plan and "SortMergeJoin" in large_plan


def test_a_hot_team_is_split_in_the_home_team_join(spark):
    """A third and more of the matches at one home team: AQE cuts that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        teams = spark.range(1000).select(
            F.col("id").cast("string").alias("team_id"), F.lit("c").alias("city"),
            F.col("id").alias("venue_capacity"))
        matches = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, "7").otherwise((F.col("id") % 1000).cast("string")).alias("home_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
        joined = refine.enrich_with_home_team(matches, teams)
        path = scratch_path(spark, "skew")
        joined.write.parquet(path)
        assert spark.read.parquet(path).count() == 60_000
        joined.count()
        joined.toPandas()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_customers_meet_the_orders_not_the_lines(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")  # nation and region only
    try:
        plan = plan_of(workload.matches_raw(spark, "/root/testdata/sf0.01"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 3
    assert plan.index("hashpartitioning(o_custkey") > plan.index("FileScan parquet [l_")


def test_copies_of_a_match_lie_together_without_a_shuffle_of_their_own(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "4000"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            matches = workload.matches_raw(spark, "/root/testdata/sf0.01", together=True)
            plan = plan_of(matches)
            placed = matches.select("event_id", F.spark_partition_id().alias("at")).distinct()
            assert placed.groupBy("event_id").count().where("count > 1").isEmpty()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert plan.count("hashpartitioning(l_orderkey") == 1


def test_the_messages_of_a_part_are_read_once(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.DataFrame.join", None)  # a part is a filter, no join
    landed = scratch_path(spark, "part")
    for part in range(3):
        workload._land_part(spark, SF_DIR, landed, part)
    assert spark.read.json(landed).count() == spark.read.parquet(f"{SF_DIR}/events.parquet").count()
