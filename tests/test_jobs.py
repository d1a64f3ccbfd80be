from datetime import datetime, timezone

import pytest

from conftest import rows
from matchstrata.operators.contracts import ContractViolation
from matchstrata.plans import jobs, reports
from matchstrata.schema import (
    PUBLISHED_SILVER,
    PUBLISHED_STANDINGS,
    with_canonical_names,
    with_published_names,
)
from matchstrata.session import scratch_path
from matchstrata.sources import envelopes, messages
from matchstrata.streaming import BronzeStream
from test_envelopes import AS_OF, land, match, team

LATER = datetime(2024, 5, 2, 9, 0, tzinfo=timezone.utc)


def fixtures(tmp_path):
    teams = land(tmp_path, "teams", "77", {"teams": [team(), team(idTeam="502", strTeam="United", strCity=None, strStadiumLocation=None)]})
    events = land(tmp_path, "events", "77", {"events": [
        match(), match(idEvent="9002", idHomeTeam="502", strHomeTeam="United", idAwayTeam="501",
                       strAwayTeam="Rovers", intHomeScore="0", intAwayScore="0", strSeason=None),
        match(idEvent="9003", strStatus="NS", intHomeScore=None, intAwayScore=None)]})
    return teams, events


@pytest.fixture
def lake(spark):
    return jobs.Lake(spark, scratch_path(spark, "lake"))


def test_the_chain(spark, lake, tmp_path):
    paths = fixtures(tmp_path)
    assert jobs.ensure_built(lake, *paths, AS_OF)
    assert not jobs.ensure_built(lake, *paths, AS_OF)
    assert rows(lake.source_health.read(), "source", "status") == [("77", "ok")]
    assert lake.bronze_matches.read().count() == 3
    silver = lake.silver_matches.read()
    assert rows(silver, "event_id", "season", "outcome", "home_city", "home_venue_capacity") == [
        ("9001", "2024", "Local", "Cair", 12000),
        ("9002", "Sin temporada", "Empate", "No informado", 12000)]
    assert rows(lake.gold_standings.read(), "team_id", "team", "points") == [
        ("501", "Rovers", 4), ("502", "United", 1)]
    assert rows(jobs.summaries(lake), "name", "n_rows", "n_columns") == [
        ("bronze/matches", 3, 17), ("bronze/teams", 2, 14), ("gold/standings", 2, 11),
        ("silver/matches", 2, 25)]
    published = with_published_names(silver, PUBLISHED_SILVER)
    assert {"resultado", "descripcion_partido", "ciudad_local"} <= set(published.columns)
    assert with_canonical_names(published, PUBLISHED_SILVER).columns == silver.columns


def test_reruns_are_idempotent_and_days_add_up(spark, lake, tmp_path):
    paths = fixtures(tmp_path)
    for _ in range(2):
        jobs.run_all(lake, *paths, AS_OF)
    assert lake.bronze_matches.read().count() == 3 and lake.silver_matches.read().count() == 2
    later = fixtures(tmp_path / "later")
    land(tmp_path / "later", "events", "77", {"events": [match(idEvent="9003", intHomeScore="5", intAwayScore="0")]})
    jobs.run_all(lake, *later, LATER)
    assert rows(lake.bronze_matches.read().groupBy("extract_date").count()) == [
        ("2024-05-01", 3), ("2024-05-02", 3)]
    assert lake.silver_matches.read().count() == 2  # the first copy of 9003 is not finished


def test_rows_refined_earlier_are_not_retracted(spark, lake, tmp_path):
    jobs.run_all(lake, *fixtures(tmp_path), AS_OF)
    teams, _ = fixtures(tmp_path / "later")
    events = land(tmp_path / "other", "events", "77", {"events": [match(strStatus="NS"), match(idEvent="9009")]})
    jobs.run_all(lake, teams, events, LATER)
    assert rows(lake.silver_matches.read(), "event_id") == [("9001",), ("9002",), ("9009",)]


def test_refining_recent_extracts_only_gives_the_same_silver(spark, lake, tmp_path):
    jobs.run_all(lake, *fixtures(tmp_path), AS_OF)
    teams, _ = fixtures(tmp_path / "later")
    events = land(tmp_path / "other", "events", "77", {"events": [match(intHomeScore="6"), match(idEvent="9009")]})
    jobs.run_bronze(lake, teams, events, LATER)
    jobs.run_silver(lake, since="2024-05-02")
    recent = rows(lake.silver_matches.read())
    assert [r[0] for r in rows(lake.silver_matches.read(), "event_id", "home_score")] == ["9001", "9002", "9009"]
    jobs.run_silver(lake)
    assert rows(lake.silver_matches.read()) == recent


def test_a_broken_contract_publishes_nothing_and_stops_the_chain(spark, lake, tmp_path):
    teams, events = fixtures(tmp_path)
    land(tmp_path, "events", "77", {"events": [match(idEvent="9005", intHomeScore="-1")]})
    with pytest.raises(ContractViolation, match="home_score"):
        jobs.run_all(lake, teams, events, AS_OF)
    assert lake.bronze_matches.exists()
    assert not lake.silver_matches.exists() and not lake.gold_standings.exists()


def test_silver_emptied_by_the_filter_is_noticed(spark, lake, tmp_path):
    teams, _ = fixtures(tmp_path)
    events = land(tmp_path / "x", "events", "77", {"events": [match(intHomeScore=None)]})
    with pytest.raises(ContractViolation, match="silver is empty"):
        jobs.run_all(lake, teams, events, AS_OF)


def test_teams_need_a_name(spark, lake, tmp_path):
    teams, events = fixtures(tmp_path)
    land(tmp_path, "teams", "77", {"teams": [team(idTeam="503", strTeam=None)]})
    with pytest.raises(ContractViolation, match="name_not_null"):
        jobs.run_bronze(lake, teams, events, AS_OF)


def test_stream_and_batch_give_the_same_bronze(spark, lake, tmp_path):
    paths = fixtures(tmp_path)
    jobs.run_bronze(lake, *paths, AS_OF)
    landed = envelopes.ingest(spark, *paths, AS_OF)
    folder, root = str(tmp_path / "topic"), scratch_path(spark, "streamed")
    offset = "monotonically_increasing_id() AS offset"
    messages.publish(messages.to_messages(landed.teams, "equipos", "team_id").selectExpr("*", offset), folder)
    messages.publish(messages.to_messages(landed.matches, "partidos", "event_id").selectExpr("*", offset), folder)
    sink = BronzeStream(spark, f"{root}/t", f"{root}/m", f"{root}/r")
    sink.start(messages.file_stream(spark, folder), f"{root}/c").awaitTermination()
    assert rows(sink.teams.read()) == rows(lake.bronze_teams.read())
    assert rows(sink.matches.read()) == rows(lake.bronze_matches.read())
    assert sink.rejected.read().count() == 0


GOLD = [("A", "1", "North", 2, 1, 1, 0, 3, 1, 2, 4), ("A", "2", "South", 2, 1, 1, 0, 9, 1, 8, 4),
        ("A", "3", None, 2, 0, 0, 2, 1, 11, -10, 0), ("B", "1", "North", 1, 0, 0, 1, 0, 1, -1, 0)]
SILVER = [("A", "m1", "2024-01-01", "North", 3, 0, "South", "Local", True),
          ("A", "m2", "2024-02-01", "South", 1, 1, "North", "Empate", False),
          ("A", "m3", "2024-03-01", "South", 5, 0, "North", "Local", True)]


@pytest.fixture(scope="module")
def gold(spark):
    from matchstrata.schema import STANDINGS_COLUMNS
    types = ["string"] * 3 + ["bigint"] * 8
    return spark.createDataFrame(GOLD, ", ".join(f"{c} {t}" for c, t in zip(STANDINGS_COLUMNS, types)))


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(
        SILVER, "league string, event_id string, event_date string, home_team string, home_score bigint, "
        "away_score bigint, away_team string, outcome string, is_blowout boolean")


def test_ranking_reports(spark, gold):
    assert rows(reports.ranked_standings(gold), "league", "team_id", "position") == [
        ("A", "1", 2), ("A", "2", 1), ("A", "3", 3), ("B", "1", 1)]
    assert rows(reports.ranked_standings(gold, "B"), "team_id") == [("1",)]
    shown = reports.standings_display(gold)
    assert rows(shown, "league", "place", "max_points") == [
        ("A", "🥇", 4), ("A", "🥈", 4), ("A", "🥉", 4), ("B", "🥇", 1)]
    assert rows(reports.leaders(gold), "league", "headline") == [
        ("A", "South: 4 pts · 1 PG · DG +8"), ("B", "North: 0 pts · 0 PG · DG -1")]
    assert [r["league"] for r in reports.leagues(gold).collect()] == ["A", "B"]
    assert rows(reports.league_count(gold)) == [(2,)]
    assert ("A", "3", None, 1, 11, 1, 0, 2, 0, -10) in rows(reports.attack_defence(gold))
    renamed = with_published_names(gold, PUBLISHED_STANDINGS)
    assert renamed.columns == ["liga", "id_equipo", "equipo", "PJ", "PG", "PE", "PP", "GF", "GC", "DG", "Pts"]


def test_match_reports(spark, gold, silver):
    assert rows(reports.league_kpis(silver, gold)) == [
        ("A", 3, 3, 10, 10 / 3, "3.3", 2), ("B", 1, 0, 0, 0.0, "0.0", 0)]
    assert rows(reports.outcome_counts(silver)) == [("A", 2, 1, 0)]
    assert [r["event_id"] for r in reports.blowouts(silver).collect()] == ["m3", "m1"]
    assert reports.blowouts(silver, "B").count() == 0


def test_what_a_load_does_not_take_is_set_aside(spark, lake, tmp_path):
    teams, events = fixtures(tmp_path)
    land(tmp_path, "teams", "78", {"teams": [team(idTeam="503", strTeam=None, idLeague="78"), team(idTeam="504", idLeague="78")]})
    from pathlib import Path

    (Path(str(events)) / "source=77" / "cut.json").write_text('{"events":[{\n')
    summary = jobs.run_all(lake, teams, events, AS_OF, keep_going=True)
    aside = lake.set_aside.read()
    assert rows(aside, "kind", "source", "reason") == [("matches", "77", "not_json"), ("teams", "78", "constraint")]
    assert '"team_id":"503"' in aside.where("kind = 'teams'").first()["text"]
    assert aside.where("kind = 'matches'").first()["text"] == '{"events":[{'
    assert rows(lake.bronze_teams.read(), "team_id") == [("501",), ("502",), ("504",)]
    assert {r["name"]: r["n_rows"] for r in summary.collect()} == {
        "bronze/teams": 3, "bronze/matches": 3, "silver/matches": 2, "gold/standings": 2}
    assert rows(jobs.layer_counts(lake)) == [
        ("bronze/matches", 3, 2, 3), ("gold/standings", 2, None, 2), ("silver/matches", 2, 2, 2)]


def test_rows_are_numbered_in_the_order_shown(spark):
    from matchstrata.operators.ranking import numbered

    df = spark.range(1000).selectExpr("(id * 37) % 1000 AS k").repartition(7)
    got = numbered(df.orderBy("k")).collect()
    assert sorted((r["place"], r["k"]) for r in got) == [(i + 1, i) for i in range(1000)]
    assert numbered(df.limit(0)).count() == 0
