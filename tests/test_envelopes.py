import json
from datetime import datetime, timezone
from pathlib import Path

import pytest

from conftest import rows
from matchstrata.operators.contracts import ContractViolation
from matchstrata.schema import BRONZE_MATCHES, BRONZE_TEAMS, RAW_MATCH, RAW_TEAM
from matchstrata.sources import envelopes

AS_OF = datetime(2024, 5, 1, 12, 30, tzinfo=timezone.utc)
STAMP = "2024-05-01T12:30:00+00:00"

TEAM = {
    "idTeam": "501", "strTeam": "Rovers", "strAlternate": "RVR", "strCountry": "Narnia",
    "strCity": "Cair", "strLeague": "First", "idLeague": "77", "strStadium": "Park",
    "intStadiumCapacity": "12000", "strStadiumLocation": "Cair East", "intFormedYear": "1899",
    "strDescriptionES": "desc", "strWebsite": "rovers.example",
}
MATCH = {
    "idEvent": "9001", "strEvent": "Rovers vs United", "strSeason": "2024", "strLeague": "First",
    "idLeague": "77", "strHomeTeam": "Rovers", "idHomeTeam": "501", "intHomeScore": "2",
    "strAwayTeam": "United", "idAwayTeam": "502", "intAwayScore": "1", "dateEvent": "2024-04-30",
    "strTime": "18:00:00", "strVenue": "Park", "strStatus": "FT",
}


def team(**values):
    return {**TEAM, **values}


def match(**values):
    return {**MATCH, **values}


def land(root, kind, source, *responses):
    """One response per line; text is written as it is."""
    folder = Path(root) / kind / f"source={source}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in responses]
    (folder / f"part-{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n", "utf-8")
    return str(Path(root) / kind)


def test_teams_map_to_14_columns(spark, tmp_path):
    path = land(tmp_path, "teams", "77", {"teams": [TEAM]})
    records = envelopes.explode_records(envelopes.read_responses(spark, path, "teams", RAW_TEAM))
    mapped = envelopes.map_teams(records.select("record"), AS_OF)
    assert mapped.columns == BRONZE_TEAMS.names and len(mapped.columns) == 14
    assert mapped.first().asDict() == {
        "team_id": "501", "name": "Rovers", "alt_name": "RVR", "country": "Narnia", "city": "Cair",
        "league": "First", "league_id": "77", "venue": "Park", "venue_capacity": "12000",
        "venue_location": "Cair East", "founded_year": "1899", "description": "desc",
        "website": "rovers.example", "extracted_at": STAMP,
    }


def test_matches_map_to_17_columns(spark, tmp_path):
    path = land(tmp_path, "events", "77", {"events": [MATCH]})
    records = envelopes.explode_records(envelopes.read_responses(spark, path, "events", RAW_MATCH))
    mapped = envelopes.map_matches(records.select("record"), AS_OF)
    assert mapped.columns == BRONZE_MATCHES.names and len(mapped.columns) == 17
    row = mapped.first()
    assert (row["event_id"], row["home_id"], row["home_score"]) == ("9001", "501", "2")
    assert (row["extracted_at"], row["extract_date"]) == (STAMP, "2024-05-01")


def test_city_falls_back_and_absent_keys_are_null(spark, tmp_path):
    bare = {"idTeam": "3", "strTeam": "Bare"}
    path = land(tmp_path, "teams", "77", {"teams": [
        team(idTeam="1", strCity=""), team(idTeam="2", strCity=None), bare]})
    got = envelopes.read_teams(spark, path, AS_OF)
    assert rows(got, "team_id", "city", "venue") == [
        ("1", "Cair East", "Park"), ("2", "Cair East", "Park"), ("3", None, None)]


def test_numbers_are_typed_whatever_their_json_type(spark, tmp_path):
    path = land(tmp_path, "events", "77", {"events": [
        match(idEvent="1", intHomeScore=3, intAwayScore="2.0"),
        match(idEvent="2", intHomeScore=None, intAwayScore="n/a")]})
    got = envelopes.read_matches(spark, path, AS_OF)
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in BRONZE_MATCHES]
    assert rows(got, "event_id", "home_score", "away_score") == [("1", 3, 2), ("2", None, None)]


def test_first_copy_by_place_wins(spark, tmp_path):
    land(tmp_path, "teams", "A", {"teams": [team(strTeam="first"), team(strTeam="second")]},
         {"teams": [team(strTeam="third")]})
    path = land(tmp_path, "teams", "B", {"teams": [team(strTeam="other"), team(idTeam="8", strTeam="own")]})
    assert rows(envelopes.read_teams(spark, path, AS_OF), "team_id", "name") == [
        ("501", "first"), ("8", "own")]


def test_empty_responses(spark, tmp_path):
    path = land(tmp_path, "events", "A", {"events": None}, {}, {"events": []})
    with pytest.raises(envelopes.EmptySource):
        envelopes.read_matches(spark, path, AS_OF)
    assert envelopes.read_matches(spark, path, AS_OF, on_empty="ignore").count() == 0


def test_pretty_printed_files(spark, tmp_path):
    text = json.dumps({"teams": [TEAM, team(idTeam="2")]}, indent=2)
    folder = tmp_path / "teams"
    folder.mkdir()
    (folder / "league.json").write_text(text)
    got = envelopes.read_teams(spark, str(folder), AS_OF, whole_files=True)
    assert rows(got, "team_id") == [("2",), ("501",)]
    responses = envelopes.read_responses(spark, str(folder), "teams", RAW_TEAM, whole_files=True)
    assert rows(responses, "source") == [("league.json",)]


def test_source_names_are_decoded(spark, tmp_path):
    spark.createDataFrame([("Liga A/B + c", json.dumps({"teams": [TEAM]}))], "source string, value string") \
        .write.partitionBy("source").text(str(tmp_path / "t"))
    got = envelopes.read_responses(spark, str(tmp_path / "t"), "teams", RAW_TEAM)
    assert rows(got, "source") == [("Liga A/B + c",)]


LEAGUES = [("Two", "2", "2024"), ("One", "1", "2024"), ("Three", "3", "2024"), ("Four", "4", "2024"),
           ("Five", "5", "2024")]


def landed(tmp_path):
    land(tmp_path, "teams", "1", {"teams": [team(idTeam="x", strTeam="of one")]})
    land(tmp_path, "teams", "2", {"teams": [team(idTeam="x", strTeam="of two")]})
    land(tmp_path, "teams", "3", {"teams": [team(idTeam="y")]})
    land(tmp_path, "teams", "4", {"teams": None})
    teams = land(tmp_path, "teams", "99", {"teams": [team(idTeam="foreign")]})
    land(tmp_path, "events", "1", {"events": [match(idEvent="a", strEvent="of one")]}, "{cut off")
    land(tmp_path, "events", "2", {"events": [match(idEvent="a", strEvent="of two"), match(idEvent="b", strStatus="NS")]})
    land(tmp_path, "events", "3", {"events": []})
    events = land(tmp_path, "events", "4", {"events": [match(idEvent="lost")]})
    return teams, events


def test_ingest_skips_bad_sources_and_reports_them(spark, tmp_path):
    got = envelopes.ingest(spark, *landed(tmp_path), AS_OF, LEAGUES)
    counts = ["n_teams", "n_matches", "n_finished", "n_broken"]
    assert rows(got.health, "source", *counts, "status") == [
        ("1", 1, 1, 1, 1, "ok"), ("2", 1, 2, 1, 0, "ok"), ("3", 1, 0, 0, 0, "no_matches"),
        ("4", 0, 1, 1, 0, "no_teams"), ("5", 0, 0, 0, 0, "no_teams"), ("99", 1, 0, 0, 0, "unlisted")]
    assert rows(got.teams, "team_id", "name") == [("x", "of two"), ("y", "Rovers")]
    assert rows(got.matches, "event_id", "event_name") == [("a", "of two"), ("b", MATCH["strEvent"])]
    assert rows(got.broken) == [("matches", "1", "{cut off")]
    got.discard()


def test_ingest_without_configuration_takes_sources_by_name(spark, tmp_path):
    got = envelopes.ingest(spark, *landed(tmp_path), AS_OF)
    assert rows(got.teams, "team_id", "name") == [("foreign", "Rovers"), ("x", "of one"), ("y", "Rovers")]
    assert rows(got.matches, "event_id", "event_name")[0] == ("a", "of one")


def test_ingest_fails_without_any_match(spark, tmp_path):
    teams = land(tmp_path, "teams", "1", {"teams": [TEAM]})
    events = land(tmp_path, "events", "1", {"events": None})
    with pytest.raises(envelopes.EmptySource):
        envelopes.ingest(spark, teams, events, AS_OF)


def test_a_source_with_fractions_is_left_out_alone(spark, tmp_path):
    teams, events = landed(tmp_path)
    land(tmp_path, "teams", "6", {"teams": [team(idTeam="z", intStadiumCapacity="0.5")]})
    land(tmp_path, "events", "6", {"events": [match(idEvent="f")]})
    land(tmp_path, "events", "3", {"events": [match(idEvent="c"), match(idEvent="d", intAwayScore="1.5")]})
    got = envelopes.ingest(spark, teams, events, AS_OF, [*LEAGUES, ("Six", "6", "2024")])
    state = {r["source"]: (r["n_fractional"], r["status"]) for r in got.health.collect()}
    assert state == {"1": (0, "ok"), "2": (0, "ok"), "3": (1, "bad_number"), "4": (0, "no_teams"),
                     "5": (0, "no_teams"), "6": (1, "bad_number"), "99": (0, "unlisted")}
    assert rows(got.teams, "team_id") == [("x",), ("y",)]
    assert rows(got.matches, "event_id") == [("a",), ("b",)]


def test_readers_refuse_fractions_unless_told(spark, tmp_path):
    events = land(tmp_path, "events", "1", {"events": [match(), match(intHomeScore="1.5"), match(idEvent="z", intAwayScore="1.5")]})
    with pytest.raises(ContractViolation, match="away_score_is_whole"):
        envelopes.read_matches(spark, events, AS_OF)
    got = envelopes.read_matches(spark, events, AS_OF, on_fraction="null")
    assert rows(got.where("event_id = 'z'"), "away_score") == [(None,)]


def test_configuration_has_all_leagues(spark):
    config = envelopes.league_config(spark)
    assert config.count() == 9 and config.select("source").distinct().count() == 9


def test_responses_are_read_as_whole_documents(spark, tmp_path):
    path = land(tmp_path, "any", "5", {"a": 1, "b": [{"c": "x"}, {"c": 2.5}, 3], "n": None}, {"a": "text", "b": {}}, [True])
    folder = Path(str(path)) / "source=5"
    (folder / "cut.json").write_text('{"a":\n')
    read = envelopes.read_documents(spark, str(path))
    assert rows(read.where("document IS NULL"), "source", "broken") == [("5", '{"a":')]
    assert rows(envelopes.document_paths(read, "document")) == sorted([
        ("$", "OBJECT", 2), ("$", "ARRAY", 1), ("$[*]", "BOOLEAN", 1), ("$.a", "BIGINT", 1), ("$.a", "STRING", 1),
        ("$.b", "ARRAY", 1), ("$.b", "OBJECT", 1), ("$.b[*]", "OBJECT", 2), ("$.b[*]", "BIGINT", 1),
        ("$.b[*].c", "STRING", 1), ("$.b[*].c", "DECIMAL", 1), ("$.n", "VOID", 1)], key=repr)
    assert rows(envelopes.document_paths(read, "document", depth=0)) == [("$", "ARRAY", 1), ("$", "OBJECT", 2)]


def test_matches_are_not_shuffled_by_source(spark, tmp_path):
    """Few sources hold all matches: an exchange by source would give each to one task."""
    for sources in (LEAGUES, None):
        got = envelopes.ingest(spark, *landed(tmp_path), AS_OF, sources)
        plan = got.matches._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(source" not in plan and plan.count("BroadcastHashJoin") == 2
