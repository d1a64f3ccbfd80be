"""The library's operators over a star schema of orders.

The adapter reads every order line as one extract of a match: the customer is
the home team, the part the away team, the ship date the day of the extract,
and the customer's region the league. Lines repeat, so one match has several
extracts; ids of parts and customers overlap, so one team id has several names.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import (
    day_name,
    month_number,
    not_integral,
    one_decimal,
    parse_date,
    parse_dates_alike,
    signed,
    thousands,
    to_long,
    year_number,
)
from ..operators import contracts, dedup, ranking, refine, standings as table
from ..schema import (
    BRONZE_TEAMS,
    MATCH_COLUMNS,
    MATCH_FIELDS,
    MATCH_TOPIC,
    PUBLISHED_MATCHES,
    PUBLISHED_STANDINGS,
    TEAM_FIELDS,
    TEAM_TOPIC,
    with_published_names,
)
from ..session import delete, scratch_path, shuffles_removed, stage
from ..sources import envelopes, messages
from ..sources.tables import LakeTable
from ..streaming import BronzeStream
from . import jobs, reports

AS_OF = datetime(2024, 5, 1, 12, 0, 0, tzinfo=timezone.utc)
#: How landed text and messages are compressed; a file of it is read by one task.
LANDED_CODEC = "lz4"
TIE_BREAK = ("tie_price", "tie_supplier", "away_id", "home_score")


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _day(c: str) -> Column:
    return F.col(c).cast("date").cast("string")


def _tie_break() -> list[Column]:
    return [F.desc(TIE_BREAK[0]), *[F.asc(c) for c in TIE_BREAK[1:]]]


# -- adapter ---------------------------------------------------------------
def matches_raw(spark: SparkSession, sf: str, together: bool = False) -> DataFrame:
    """Bronze-shaped matches, plus the two columns that settle ties.

    The lines, the most rows, meet two tables only, the narrower one first: beyond
    the size of a broadcast each join shuffles them. Customers are joined to the orders.
    ``together``: all copies of a match lie in one partition (by its order, so that the
    join needs no further shuffle).
    """
    ordered = (
        _read(spark, sf, "orders")
        .join(_read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = _read(spark, sf, "lineitem").join(_read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if together:
        lines = lines.repartition("l_orderkey")
    return (
        lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
            F.concat_ws(" vs ", "c_name", "p_name").alias("event_name"),
            F.when(F.col("l_tax") > 0, F.year("o_orderdate").cast("string")).alias("season"),
            F.col("r_name").alias("league"),
            F.col("r_regionkey").cast("string").alias("league_id"),
            F.col("c_name").alias("home_team"),
            F.col("o_custkey").cast("string").alias("home_id"),
            (F.floor("l_quantity") % 6).cast("bigint").alias("home_score"),
            F.col("p_name").alias("away_team"),
            F.col("l_partkey").cast("string").alias("away_id"),
            (F.col("l_suppkey") % 5).cast("bigint").alias("away_score"),
            _day("o_orderdate").alias("event_date"),
            F.lit("20:00:00").alias("event_time"),
            F.when(F.col("l_discount") > 0, F.concat(F.lit("Ground "), "l_suppkey")).alias("venue"),
            F.when(F.col("l_linestatus") == "F", " ft ").otherwise("NS").alias("status"),
            F.concat(_day("l_shipdate"), F.lit("T00:00:00+00:00")).alias("extracted_at"),
            _day("l_shipdate").alias("extract_date"),
            F.col("l_extendedprice").alias("tie_price"),
            F.col("l_suppkey").alias("tie_supplier"),
        )
    )


def teams_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze-shaped teams: customers; those in debt have no city, and the
    machinery segment has no name, so the home-team join also misses."""
    return (
        _read(spark, sf, "customer")
        .join(_read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("team_id"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("name"),
            F.col("c_mktsegment").alias("alt_name"),
            F.col("r_name").alias("country"),
            F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("city"),
            F.col("r_name").alias("league"),
            F.col("r_regionkey").cast("string").alias("league_id"),
            F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("Arena "), "n_name")).alias(
                "venue"
            ),
            F.floor("c_acctbal").cast("bigint").alias("venue_capacity"),
            F.col("n_name").alias("venue_location"),
            (F.col("c_nationkey") + 1900).cast("bigint").alias("founded_year"),
            F.lit(None).cast("string").alias("description"),
            F.when(F.col("c_acctbal") > 5000, F.concat("c_name", F.lit(".example"))).alias(
                "website"
            ),
            F.lit("2024-05-01T12:00:00+00:00").alias("extracted_at"),
        )
    )


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated, finished, typed and derived matches, before the renames."""
    return (
        matches_raw(spark, sf)
        .transform(dedup.keep_latest, tie_break=_tie_break())
        .transform(refine.clean_matches)
        .transform(refine.type_matches)
        .transform(refine.derive_columns)
        .drop(*TIE_BREAK[:2])
    )


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return table.standings(silver(spark, sf))


def _stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a layer of the lake: written once, read by every use."""
    return stage(df, label).df


def _null_some_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "home_score": F.nullif("home_score", F.lit(5)),
            "away_score": F.nullif("away_score", F.lit(4)),
        }
    )


# -- refinement ------------------------------------------------------------
def dedup_latest(spark, sf):
    return dedup.keep_latest(matches_raw(spark, sf), tie_break=_tie_break()).select(*MATCH_COLUMNS)


def dedup_first(spark, sf):
    arrival = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *arrival)
    return dedup.keep_first(lines, ["l_orderkey", "l_linenumber"], arrival)


def dedup_last_in_batch(spark, sf):
    events = _read(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return dedup.keep_last(events, ["user_id"], ["event_id"])


def drop_incomplete_and_filter_finished(spark, sf):
    return _null_some_scores(matches_raw(spark, sf)).transform(refine.clean_matches).select(
        *MATCH_COLUMNS
    )


def clean_teams(spark, sf):
    return refine.clean_teams(teams_raw(spark, sf))


def _number_texts(spark, sf) -> DataFrame:
    """Event counters written in the ways numbers arrive, good and bad."""
    k = F.get_json_object("props", "$.k")
    high = F.col("value") > 10
    text = (
        F.when(F.col("event_type") == "view", k)
        .when(F.col("event_type") == "click", F.concat(F.lit("  "), k, F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(k, F.lit(".0")))
        .when((F.col("event_type") == "purchase") & high, F.concat(k, F.lit(".5")))
        .when(F.col("event_type") == "purchase", F.concat(k, F.lit("e2")))
        .when(high, F.concat(k, F.lit("d")))
        .otherwise(F.lit(""))
    )
    return _read(spark, sf, "events").select("event_id", text.alias("text"))


def coerce_numeric(spark, sf):
    return _number_texts(spark, sf).select(
        "event_id", "text", to_long("text").alias("number"),
        not_integral("text").alias("fractional"),
    )


def whole_number_gate(spark, sf):
    return contracts.whole_numbers("numbers", ["text"]).violations(_number_texts(spark, sf))


def parse_dates(spark, sf):
    day = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("to be defined"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(_day("o_orderdate"), F.lit(" 20:00")))
        .otherwise(_day("o_orderdate"))
    )
    dated = _read(spark, sf, "orders").select("o_orderkey", parse_date(day).alias("event_date"))
    return dated.withColumns(
        {
            "match_year": year_number("event_date"),
            "match_month": month_number("event_date"),
            "weekday": day_name("event_date"),
        }
    )


def column_dates(spark, sf):
    """Date texts of three columns, each read in the form of its first filled value."""
    key, day = F.col("o_orderkey"), _day("o_orderdate")
    times = (
        F.when(key % 7 == 0, "to be defined").when(key % 11 == 0, day)
        .otherwise(F.concat(day, F.lit(" "), F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":30:00")))
    )
    dayed = F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "dd/MM/yyyy"))
    mixed = (
        F.when(F.col("o_orderpriority") == "3-MEDIUM", day)
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat(day, F.lit("T20:00:00")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "soon")
    )
    texts = _read(spark, sf, "orders").select(
        "o_orderkey", times.alias("with_time"), dayed.alias("with_day"), mixed.alias("mixed")
    )
    return parse_dates_alike(texts, ["with_time", "with_day", "mixed"], ["o_orderkey"])


def derive_outcome(spark, sf):
    derived = matches_raw(spark, sf).transform(refine.type_matches).transform(refine.derive_columns)
    return derived.select(
        "event_id", "extract_date", "tie_price", "tie_supplier", "event_date", "home_score",
        "away_score", "match_year", "match_month", "weekday", "outcome", "score_difference",
        "is_blowout",
    )


def rename_columns(spark, sf):
    return refine.rename_ambiguous(matches_raw(spark, sf).select(*MATCH_COLUMNS))


def enrich_left_join(spark, sf):
    matches = matches_raw(spark, sf).select(*MATCH_COLUMNS)
    return refine.enrich_with_home_team(matches, refine.clean_teams(teams_raw(spark, sf)))


def refine_pipeline(spark, sf):
    teams = refine.clean_teams(teams_raw(spark, sf))
    return refine.refine_matches(matches_raw(spark, sf), teams, _tie_break()).drop(*TIE_BREAK[:2])


# -- standings and reports -------------------------------------------------
def name_map(spark, sf):
    return table.team_names(silver(spark, sf))


def standings(spark, sf):
    return table.in_table_order(gold(spark, sf))


def standings_published_names(spark, sf):
    return with_published_names(standings(spark, sf), PUBLISHED_STANDINGS)


def ranked_standings(spark, sf):
    return reports.ranked_standings(gold(spark, sf))


def podium(spark, sf):
    return reports.standings_display(gold(spark, sf))


def leaders(spark, sf):
    return reports.leaders(gold(spark, sf))


def league_kpis(spark, sf):
    matches = _stored(silver(spark, sf), "silver")
    return reports.league_kpis(matches, table.standings(matches))


def outcome_counts(spark, sf):
    return reports.outcome_counts(silver(spark, sf))


def blowouts(spark, sf):
    return reports.blowouts(silver(spark, sf))


def attack_defence(spark, sf):
    return reports.attack_defence(gold(spark, sf))


def leagues(spark, sf):
    return reports.leagues(gold(spark, sf))


def league_count(spark, sf):
    return reports.league_count(gold(spark, sf))


def scale_max(spark, sf):
    return reports.points_scale(gold(spark, sf))


def text_formats(spark, sf):
    formatted = gold(spark, sf).select(
        "league", "team_id",
        signed("goal_difference").alias("signed_difference"),
        one_decimal(F.col("goals_for") / F.col("played")).alias("goals_per_match"),
        thousands(F.col("goals_for") * 1000).alias("grouped_goals"),
    )
    return formatted


def played_pending_counts(spark, sf):
    return contracts.status_counts(matches_raw(spark, sf))


# -- contracts -------------------------------------------------------------
def contract_silver(spark, sf):
    """Silver with faults: no league, negative score, unknown outcome, repeated id."""
    good = _stored(silver(spark, sf), "silver")
    faulty = good.withColumns(
        {
            "league": F.nullif("league", F.lit("ASIA")),
            "home_score": F.when(F.col("away_score") == 4, F.lit(-1)).otherwise(
                F.col("home_score")
            ).cast("bigint"),
            "outcome": F.when(F.col("outcome") == "Empate", "Nulo").otherwise(F.col("outcome")),
        }
    )
    return contracts.SILVER_MATCHES.violations(faulty.unionByName(good.where("is_blowout")))


def contract_gold(spark, sf):
    """Gold with faults: broken sums, negative goals, no name, repeated team."""
    good = _stored(gold(spark, sf), "gold")
    faulty = good.withColumns(
        {
            "points": F.when(F.col("won") == 0, F.col("points") + 7).otherwise(F.col("points")).cast("bigint"),
            "lost": F.when(F.col("drawn") == 1, F.col("lost") + 1).otherwise(F.col("lost")),
            "goals_for": F.when(F.col("goals_for") == 4, F.lit(-11)).otherwise(
                F.col("goals_for")
            ).cast("bigint"),
            "team": F.nullif("team", F.lit("red widget")),
        }
    )
    return contracts.GOLD_STANDINGS.violations(
        faulty.unionByName(good.where(F.col("league") == "EUROPE"))
    )


def contract_violations(spark, sf):
    """Coercion faults: gold columns that arrive as text, one of them absent."""
    good = _stored(gold(spark, sf), "gold").withColumns(
        {
            "played": F.when(F.col("won") == 0, F.lit("none")).otherwise(
                F.col("played").cast("string")
            ),
            "team_id": F.col("team_id").cast("bigint"),
        }
    )
    return contracts.GOLD_STANDINGS.violations(good.drop("drawn"))


def contract_clean(spark, sf):
    """The contracts over sound layers: every rule, with no failing row."""
    matches = _stored(silver(spark, sf), "silver")
    standing = _stored(table.standings(matches), "gold")
    return contracts.SILVER_MATCHES.report(matches).unionByName(
        contracts.GOLD_STANDINGS.report(standing)
    )


def contract_report(spark, sf):
    """What enforcing a contract raises, once, with all broken rules."""
    faulty = _stored(gold(spark, sf), "gold").withColumns(
        {
            "goals_against": F.when(F.col("won") == 1, F.lit(None)).otherwise(F.col("goals_against")),
            "lost": F.col("lost") - 1,
        }
    )
    try:
        contracts.GOLD_STANDINGS.enforce(faulty)
    except contracts.ContractViolation as error:
        found = error.failures
    else:
        found = []
    return spark.createDataFrame([tuple(r[c] for c in ("rule", "column", "n_failed")) for r in found],
                                 "rule string, column string, n_failed long")


def contract_cases(spark, sf):
    """Five failing cases of each broken rule of a faulty table."""
    faulty = _stored(gold(spark, sf), "gold").withColumns(
        {
            "goals_against": F.when(F.col("won") == 1, F.lit(None)).otherwise(F.col("goals_against")),
            "lost": F.col("lost") - 1,
            "team_id": F.when(F.col("drawn") == 0, "0").otherwise(F.col("team_id")),
        }
    )
    return contracts.GOLD_STANDINGS.cases(faulty)


def document_paths(spark, sf):
    """Events as JSON documents of no declared shape: types and counts by path."""
    tags = F.concat(F.lit(',"tags":['), F.col("user_id").cast("string"), F.lit(',"'), F.col("event_type"), F.lit('"]'))
    text = F.concat(
        F.lit('{"type":"'), F.col("event_type"), F.lit('","props":'), F.col("props"), tags,
        F.when(F.col("value") < 10, F.lit(',"cheap":true')).otherwise(F.lit(',"cheap":null')),
        F.when(F.col("value") >= 1, F.lit("}")).otherwise(F.lit("")),  # the others are cut off
    )
    documents = _read(spark, sf, "events").select(envelopes.whole_document(text).alias("document"))
    return envelopes.document_paths(documents, "document")


def cross_layer_check(spark, sf):
    """Bronze against a sound silver, and against one the filter emptied."""
    bronze, kept = matches_raw(spark, sf), silver(spark, sf)
    emptied = matches_raw(spark, sf).transform(refine.keep_finished, statuses=("ENDED",))
    sound = contracts.layer_gap(bronze, kept).withColumn("layer", F.lit("sound"))
    return sound.unionByName(
        contracts.layer_gap(bronze, emptied).withColumn("layer", F.lit("emptied"))
    )


# -- landed JSON -----------------------------------------------------------
def _raw_record(fields: dict[str, str], **values: Column) -> Column:
    return F.struct(*[values.get(c, F.col(c)).cast("string").alias(raw) for raw, c in fields.items()])


def _response(field: str, fields: dict[str, str], **values: Column) -> Column:
    body = F.struct(F.array(_raw_record(fields, **values)).alias(field))
    return F.to_json(body, {"ignoreNullFields": "false"})


def _land(records: DataFrame, value: Column, label: str, key: str, order: list[Column]) -> str:
    """Write the value of each record as one response a line, copies of a key in order.

    The copies of a key, which lie in one partition, go to one file; the order among
    keys does not matter. The files are compressed: the keys of the records repeat in
    every line.
    """
    path = scratch_path(records.sparkSession, label)
    placed = records.sortWithinPartitions("league_id", key, *order)
    lines = placed.select(F.col("league_id").alias("source"), value.alias("value"))
    with shuffles_removed(records.sparkSession):
        lines.write.partitionBy("source").text(path, compression=LANDED_CODEC)
    return path


def _land_matches(matches: DataFrame, value: Column | None = None) -> str:
    """``matches`` with their copies together."""
    value = _response("events", MATCH_FIELDS) if value is None else value
    return _land(matches, value, "events", "event_id", [F.desc("extract_date"), *_tie_break()])


def _land_teams(teams: DataFrame, value: Column | None = None) -> str:
    value = _response("teams", TEAM_FIELDS) if value is None else value
    return _land(teams.repartition("team_id"), value, "teams", "team_id", [])


def map_raw_matches(spark, sf):
    """Matches as stored; a score that arrives as a fraction is NULL."""
    score = F.when(F.col("home_score") == 5, F.lit("5.5")).otherwise(F.col("home_score").cast("string"))
    raw = matches_raw(spark, sf, together=True)
    path = _land_matches(raw, _response("events", MATCH_FIELDS, home_score=score))
    return envelopes.read_matches(spark, path, AS_OF, on_fraction="null")


def map_raw_teams(spark, sf):
    return envelopes.read_teams(spark, _land_teams(teams_raw(spark, sf)), AS_OF)


def ingest_union_with_health(spark, sf):
    """Sources of all states: one without teams, one without matches, one with
    cut-off text, one with fractions for scores, one that is not configured, one
    configured but never landed."""
    responses = F.when(F.col("league_id") == "0", '{"teams":null}').otherwise(
        _response("teams", TEAM_FIELDS)
    )
    events = (
        F.when(F.col("league_id") == "1", '{"events":null}')
        .when(
            (F.col("league_id") == "2") & F.col("venue").isNull(),
            F.concat(F.lit('{"events":['), "event_id"),
        )
        .when(
            (F.col("league_id") == "3") & (F.col("home_score") == 2),
            _response("events", MATCH_FIELDS, home_score=F.lit("2.5")),
        )
        .otherwise(_response("events", MATCH_FIELDS))
    )
    leagues = [(f"league {i}", str(i), "2024") for i in range(6) if i != 4]
    landed = envelopes.ingest(
        spark,
        _land_teams(teams_raw(spark, sf), responses),
        _land_matches(matches_raw(spark, sf, together=True), events),
        AS_OF,
        leagues,
    )
    kept = (
        landed.teams.select("league_id", F.lit("kept_teams").alias("kind"))
        .unionByName(landed.matches.select("league_id", F.lit("kept_matches").alias("kind")))
        .groupBy(F.col("league_id").alias("source"))
        .agg(
            F.count_if(F.col("kind") == "kept_teams").alias("kept_teams"),
            F.count_if(F.col("kind") == "kept_matches").alias("kept_matches"),
        )
    )
    return landed.health.join(kept, "source", "left").fillna(0, ["kept_teams", "kept_matches"])


def set_aside(spark, sf):
    """What a load does not take: text that is no JSON, and rows that break a constraint."""
    cut = F.when(
        (F.col("league_id") == "2") & F.col("venue").isNull(), F.concat(F.lit('{"events":['), "event_id")
    ).otherwise(_response("events", MATCH_FIELDS))
    lake = jobs.Lake(spark, scratch_path(spark, "lake"))
    jobs.run_bronze(
        lake, _land_teams(teams_raw(spark, sf)), _land_matches(matches_raw(spark, sf, together=True), cut), AS_OF, keep_going=True
    )
    kept = lake.set_aside.read()
    team = F.get_json_object("text", "$.team_id")
    return kept.select("kind", "source", "reason", F.coalesce(team, "text").alias("what"))


# -- tables ----------------------------------------------------------------
def _new_table(spark, label: str) -> LakeTable:
    return LakeTable(spark, scratch_path(spark, label))


def full_overwrite(spark, sf):
    """Two full loads: only the second remains."""
    lake = _new_table(spark, "teams").create(BRONZE_TEAMS)
    teams = teams_raw(spark, sf)
    jobs.load_teams(teams, lake)
    jobs.load_teams(teams.where(F.col("name").isNotNull()), lake)
    return lake.read()


def partition_overwrite(spark, sf):
    """Two incremental loads: partitions of the second replace those of the first."""
    matches = (
        matches_raw(spark, sf)
        .withColumn("extract_month", F.substring("extract_date", 1, 7))
        .select("event_id", "league", "home_score", "away_score", "extract_month")
    )
    lake = _new_table(spark, "matches")
    load = {"partition_by": ["extract_month"], "replace_partitions": True, "schema_mode": "merge"}
    lake.save(matches, **load)
    newer = matches.where("extract_month >= '1999-01' AND league <> 'ASIA'").withColumn(
        "home_score", F.col("home_score") + 10
    )
    lake.save(newer, **load)
    return lake.read()


def replace_by_condition(spark, sf):
    """A load that replaces the rows a condition names, in whatever files they are."""
    teams = teams_raw(spark, sf).select("team_id", "name", "league", "founded_year")
    lake = _new_table(spark, "conditional")
    lake.save(teams)
    newer = teams.where("founded_year < 1910").withColumn("name", F.upper("league"))
    lake.save(newer, replace_where="founded_year < 1910")
    return lake.read()


def append_and_modes(spark, sf):
    """Append adds rows, ignore leaves the table as it is."""
    teams = teams_raw(spark, sf).select("team_id", "name", "league")
    lake = _new_table(spark, "appended")
    lake.save(teams, mode="error")
    lake.save(teams.where(F.col("league") == "ASIA"), mode="append")
    lake.save(teams, mode="ignore")
    return lake.read()


_UPSERTED = ["event_id", "season", "league", "home_score", "away_score"]


def upsert_silver(spark, sf):
    """Silver upserted by match id: changed matches (some move to another
    season), new matches, and matches the second load does not name."""
    lake = _new_table(spark, "silver")
    lake.upsert(
        silver(spark, sf).select(*_UPSERTED), ["event_id"], partition_by=["season"]
    )
    first = lake.read()
    changed = first.where("home_score = 3").withColumns(
        {"away_score": F.col("away_score") + 100, "season": F.lit("1999")}
    )
    added = first.where("home_score = 2").withColumn(
        "event_id", F.concat(F.lit("new-"), "event_id")
    )
    lake.upsert(changed.unionByName(added), ["event_id"])
    return lake.read()


def upsert_gold(spark, sf):
    """Standings upserted by team and league."""
    lake = _new_table(spark, "gold")
    lake.upsert(gold(spark, sf), ["team_id", "league"], partition_by=["league"])
    later = lake.read().where("won > 1").withColumn("points", F.col("points") + 3)
    lake.upsert(later, ["team_id", "league"])
    return lake.read()


def schema_evolution(spark, sf):
    """A load with a new column: earlier rows show NULL there."""
    teams = teams_raw(spark, sf)
    lake = _new_table(spark, "evolving")
    lake.save(teams.where(F.col("league") != "ASIA").select("team_id", "name", "league"))
    lake.save(
        teams.where(F.col("league") == "ASIA").select("team_id", "name", "league", "city"),
        mode="append",
        schema_mode="merge",
    )
    return lake.read()


def partition_edge_values(spark, sf):
    """Partition values that a path cannot hold as they are: '', NULL, and names with a meaning on disk."""
    odd = (
        F.when(F.col("founded_year") < 1905, F.lit(""))
        .when(F.col("founded_year") < 1910, F.lit("__TEXT__"))
        .when(F.col("founded_year") < 1915, F.lit("__HIVE_DEFAULT_PARTITION__"))
        .when(F.col("founded_year") < 1920, F.lit("a/b=c%2F d"))
    )
    teams = teams_raw(spark, sf).select("team_id", odd.alias("part"), "founded_year")
    lake = _new_table(spark, "edges")
    lake.save(teams, partition_by=["part"])
    lake.upsert(teams.where("founded_year = 1907").withColumn("founded_year", F.lit(0).cast("bigint")), ["team_id"])
    return lake.read()


def check_rejected(spark, sf):
    """A write that breaks a constraint is not published, and names the rule."""
    teams = teams_raw(spark, sf).select("team_id", "name", "founded_year")
    lake = _new_table(spark, "checked").create(teams.schema, checks={"old_enough": "founded_year < 1920"})
    lake.save(teams.where("founded_year < 1920"), mode="append")
    try:
        lake.save(teams, mode="append")
    except contracts.ContractViolation as error:
        rules = ", ".join(r["rule"] for r in error.failures)
    else:
        rules = None
    return lake.read().withColumn("rejected_by", F.lit(rules))


def storable_types(spark, sf):
    """Columns of a type that Parquet lacks are stored as text."""
    teams = teams_raw(spark, sf).select("team_id", F.lit(None).alias("nothing"))
    lake = _new_table(spark, "storable")
    lake.save(teams)
    return lake.read().withColumn("type", F.lit(dict(lake.read().dtypes)["nothing"]))


def read_absent(spark, sf):
    """A table that is not there reads as an empty one of the asked-for columns."""
    lake = _new_table(spark, "absent")
    absent = lake.read_or_empty(BRONZE_TEAMS)
    jobs.load_teams(teams_raw(spark, sf), lake)
    sized = [
        rows.agg(F.count("*").alias("n_rows")).select(
            F.lit(label).alias("state"), "n_rows", F.lit(len(rows.columns)).alias("n_columns")
        )
        for label, rows in (("absent", absent), ("present", lake.read_or_empty(BRONZE_TEAMS)))
    ]
    return sized[0].unionByName(sized[1])


def ignore_empty(spark, sf):
    """Responses without records are passed over where that is asked for."""
    empty = F.when(F.col("league") == "ASIA", '{"teams":[]}').otherwise(_response("teams", TEAM_FIELDS))
    path = _land_teams(teams_raw(spark, sf), empty)
    kept = envelopes.read_teams(spark, path, AS_OF, on_empty="ignore")
    return kept.groupBy("league").agg(F.count("*").alias("n_teams"))


def ranked_one_league(spark, sf):
    """Positions within the one league that is asked for."""
    return reports.ranked_standings(gold(spark, sf), "EUROPE").select("league", "team_id", "points", "position")


def table_preview(spark, sf):
    """The first ten rows of a table in a stated order."""
    lake = _new_table(spark, "previewed")
    lake.save(teams_raw(spark, sf).select("team_id", "name", "league"))
    return lake.preview(["league", "team_id"])


def table_summary(spark, sf):
    lake = _new_table(spark, "summed").create(BRONZE_TEAMS)
    jobs.load_teams(teams_raw(spark, sf), lake)
    present = lake.summary("bronze/teams")
    absent = _new_table(spark, "absent").summary("none")
    return present.unionByName(absent).select(
        "name", "version", "n_rows", "n_columns", F.col("message").isNotNull().alias("absent")
    )


# -- messages and streams --------------------------------------------------
def publish_messages(spark, sf):
    """Matches published as messages and read back from the folder."""
    rows = matches_raw(spark, sf).select(*MATCH_COLUMNS)
    path = scratch_path(spark, "topic")
    messages.publish(
        messages.to_messages(rows, MATCH_TOPIC, "event_id", PUBLISHED_MATCHES), path, compression=LANDED_CODEC
    )
    back = spark.read.schema(messages.MESSAGE).json(path)
    trees = back.withColumn("tree", messages.parsed(MATCH_COLUMNS, PUBLISHED_MATCHES))
    return trees.select(
        "topic", "key", messages.is_object("value", "tree").alias("is_object"),
        *messages.fields("tree", MATCH_COLUMNS, PUBLISHED_MATCHES),
    )


def event_messages(spark, sf) -> DataFrame:
    """Events as messages: two known topics, one unknown, some cut-off values."""
    k = F.get_json_object("props", "$.k")
    user = F.col("user_id").cast("string")
    day = _day("ts")
    match = F.struct(
        user.alias("event_id"),
        F.col("event_type").alias("event_name"),
        k.alias("home_score"),
        F.floor("value").cast("string").alias("away_score"),
        day.alias("extract_date"),
    )
    team = F.struct(
        user.alias("team_id"),
        F.concat(F.lit("user "), user, F.lit(" "), k).alias("name"),
        k.alias("venue_capacity"),
        day.alias("extracted_at"),
    )
    topic = (
        F.when(F.col("event_type").isin("view", "click"), MATCH_TOPIC)
        .when(F.col("event_type").isin("signup", "purchase"), TEAM_TOPIC)
        .otherwise("otros")
    )
    value = F.when(F.col("event_type").isin("view", "click"), F.to_json(match)).otherwise(
        F.to_json(team)
    )
    cut = F.when(F.col("value") < 1, F.expr("'{\"event_id\":'")).otherwise(value)
    # Offsets restart in each of four partitions of the topic; time tells the order.
    return _read(spark, sf, "events").select(
        topic.alias("topic"), user.alias("key"), cut.alias("value"),
        F.floor(F.col("event_id") / 4).alias("offset"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.timestamp_seconds("event_id").alias("timestamp"),
    )


_PARTS = 3


def _land_part(spark, sf, landed: str, part: int) -> None:
    """The messages of one third of the time, as further files of the folder."""
    last = _read(spark, sf, "events").agg(F.max("event_id")).first()[0] or 0
    third = F.floor(F.unix_seconds("timestamp") * _PARTS / (last + 1))  # the time of a message is its event's id
    messages_ = event_messages(spark, sf).where(third == part)
    # All messages of an id in one file: files of a part may be taken in any order.
    messages_.repartition("topic", "key").write.mode("append").json(landed)


def _new_sink(spark) -> BronzeStream:
    root = scratch_path(spark, "stream")
    return BronzeStream(spark, f"{root}/teams", f"{root}/matches", f"{root}/rejected")


def _run_stream(spark, sf) -> BronzeStream:
    """A micro-batch for each part that lands: later ones merge into what earlier ones left."""
    sink, landed, checkpoint = _new_sink(spark), scratch_path(spark, "messages"), scratch_path(spark, "checkpoint")
    for part in range(_PARTS):
        _land_part(spark, sf, landed, part)
        sink.start(messages.file_stream(spark, landed), checkpoint).awaitTermination()
    return sink


def stream_admission(spark, sf):
    """All parts landed before the stream starts, admitted by bytes in several batches."""
    sink, landed, archive = _new_sink(spark), scratch_path(spark, "messages"), scratch_path(spark, "archive")
    for part in range(_PARTS):
        _land_part(spark, sf, landed, part)
    whole = spark.read.format("binaryFile").load(landed).agg(F.sum("length")).first()[0] or 0  # opens no file
    stream = messages.file_stream(spark, landed, bytes_per_batch=max(1, whole // (2 * _PARTS)), archive=archive)
    sink.start(stream, scratch_path(spark, "checkpoint")).awaitTermination()
    batches = sink.counts.read().agg(F.count_distinct("batch_id")).first()[0]
    return _stream_tables(sink).withColumn("several_batches", F.lit(batches >= _PARTS))


def _resumed_stream(spark, sf) -> BronzeStream:
    """Half of the messages under one checkpoint, the rest under a fresh one."""
    sink = _new_sink(spark)
    for half in ("partition < 2", "partition >= 2"):
        landed = scratch_path(spark, "messages")
        event_messages(spark, sf).where(half).write.json(landed)
        sink.start(messages.file_stream(spark, landed), scratch_path(spark, "checkpoint")).awaitTermination()
    return sink


def stream_upsert(spark, sf):
    """The bronze tables after the stream has caught up: the last message per id."""
    return _stream_tables(_run_stream(spark, sf))


def stream_resumed(spark, sf):
    """The same tables filled under two checkpoints: nothing of the second is skipped."""
    sink = _resumed_stream(spark, sf)
    rejected = sink.rejected.read().select("topic", F.col("key").alias("id"), F.col("reason").alias("label"))
    kept = _stream_tables(sink).select("topic", "id", F.lit("kept").alias("label"))
    return kept.unionByName(rejected)


def stream_counts(spark, sf):
    """What the stream recorded of each batch and topic: messages, rejected ones, rows upserted."""
    counts = _run_stream(spark, sf).counts.read()
    return counts.select("batch_id", "topic", "n_messages", "n_rejected", "n_upserted")


def decoded_messages(spark, sf):
    """Binary keys and values, as a connector gives them, as text; some are cut within a character."""
    text = F.encode(F.concat(F.lit("ñ "), "value"), "UTF-8")
    cut = F.when(F.col("offset") % 5 == 0, F.substring(text, 1, 1)).otherwise(text)
    raw = event_messages(spark, sf).withColumns({"key": F.col("key").cast("binary"), "value": cut})
    return messages.decoded(raw).select("topic", "key", "value", "offset", "partition", "undecoded")


def _stream_tables(sink: BronzeStream) -> DataFrame:
    matches = sink.matches.read().select(
        F.lit(MATCH_TOPIC).alias("topic"), F.col("event_id").alias("id"),
        F.col("event_name").alias("label"), F.col("home_score").alias("number"),
        F.col("extract_date").alias("day"),
    )
    teams = sink.teams.read().select(
        F.lit(TEAM_TOPIC).alias("topic"), F.col("team_id").alias("id"),
        F.col("name").alias("label"), F.col("venue_capacity").alias("number"),
        F.col("extracted_at").alias("day"),
    )
    return matches.unionByName(teams)


def stream_rejected(spark, sf):
    return _run_stream(spark, sf).rejected.read().select("topic", "key", "value", "offset", "reason")


def feed_lines(spark, sf):
    return messages.feed_line(event_messages(spark, sf))


# -- the whole chain -------------------------------------------------------
def _landed(spark, sf) -> tuple:
    """Landed teams, with and without a name, and matches."""
    return _land_teams(teams_raw(spark, sf)), _land_matches(matches_raw(spark, sf, together=True)), AS_OF


def _landed_lake(spark, sf) -> jobs.Lake:
    lake, landed = jobs.Lake(spark, scratch_path(spark, "lake")), _landed(spark, sf)
    jobs.run_bronze(lake, *landed, keep_going=True)  # unnamed teams are set aside
    for path in landed[:2]:
        delete(spark, path)
    return lake


def run_medallion(spark, sf):
    """Landed JSON through bronze and silver to the stored standings."""
    lake = _landed_lake(spark, sf)
    jobs.run_silver(lake)
    jobs.run_gold(lake)
    return lake.gold_standings.read()


def medallion_summary(spark, sf):
    """The closing summary of a run of all layers, with what each layer holds."""
    lake = jobs.Lake(spark, scratch_path(spark, "lake"))
    summary = jobs.run_all(lake, *_landed(spark, sf), keep_going=True)
    counts = jobs.layer_counts(lake).select(F.col("layer").alias("name"), "n_finished", "n_keys")
    return summary.join(counts, "name", "left").select(
        "name", "version", "n_rows", "n_columns", "n_finished", "n_keys"
    )


def built_once(spark, sf):
    """The chain run where gold is absent, and not again."""
    lake, landed = jobs.Lake(spark, scratch_path(spark, "lake")), _landed(spark, sf)
    built = jobs.ensure_built(lake, *landed, keep_going=True)
    again = jobs.ensure_built(lake, *landed, keep_going=True)
    teams = lake.gold_standings.read().groupBy("league").agg(F.count("*").alias("n_teams"))
    return teams.withColumns({"built": F.lit(built), "built_again": F.lit(again)})


def standings_shown(spark, sf):
    """Standings with their place in the order they are shown in."""
    shown = table.in_table_order(gold(spark, sf))
    return ranking.numbered(shown).select("place", "league", "team_id", "points")


def blowouts_shown(spark, sf):
    """Wide wins with their place in the order they are shown in, newest first."""
    return ranking.numbered(reports.blowouts(silver(spark, sf))).select("place", "event_id", "event_date")


def medallion_silver(spark, sf):
    """Landed JSON to the stored silver matches."""
    lake = _landed_lake(spark, sf)
    jobs.run_silver(lake)
    return lake.silver_matches.read()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        standings, dedup_latest, dedup_first, dedup_last_in_batch,
        drop_incomplete_and_filter_finished, clean_teams, coerce_numeric, whole_number_gate,
        parse_dates, derive_outcome, rename_columns, enrich_left_join, refine_pipeline,
        name_map, standings_published_names, ranked_standings, podium, leaders, league_kpis,
        outcome_counts, blowouts, attack_defence, leagues, league_count, scale_max,
        text_formats, played_pending_counts, contract_silver, contract_gold,
        contract_violations, contract_clean, cross_layer_check, map_raw_teams,
        map_raw_matches, ingest_union_with_health, full_overwrite, partition_overwrite,
        replace_by_condition, append_and_modes, upsert_silver, upsert_gold, schema_evolution, table_summary,
        publish_messages, stream_upsert, stream_rejected, feed_lines, run_medallion,
        medallion_silver, partition_edge_values, check_rejected, storable_types, read_absent,
        ignore_empty, ranked_one_league, table_preview, stream_resumed, stream_counts,
        decoded_messages, contract_report, column_dates, contract_cases, document_paths, set_aside,
        stream_admission, medallion_summary, built_once, standings_shown, blowouts_shown,
    ]
    return {q.__name__: q for q in named}
