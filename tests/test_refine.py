from datetime import datetime

import pytest

from conftest import rows
from matchstrata.operators import dedup, refine
from matchstrata.schema import BRONZE_MATCHES, BRONZE_TEAMS


def matches(spark, *records):
    names = BRONZE_MATCHES.names
    data = [tuple(r.get(n) for n in names) for r in records]
    return spark.createDataFrame(data, BRONZE_MATCHES)


def teams(spark, *records):
    data = [tuple(r.get(n) for n in BRONZE_TEAMS.names) for r in records]
    return spark.createDataFrame(data, BRONZE_TEAMS)


def match(event_id, **values):
    return {"event_id": event_id, "home_score": 1, "away_score": 0, "status": "FT",
            "extract_date": "2023-03-01", "event_date": "2023-02-27", "league": "L", **values}


def test_latest_extract_wins(spark):
    df = matches(
        spark,
        match("7", home_score=1, extract_date="2023-03-01"),
        match("7", home_score=5, extract_date="2023-03-04"),
        match("8", home_score=0, extract_date="2023-03-01"),
    )
    assert rows(dedup.keep_latest(df), "event_id", "home_score") == [("7", 5), ("8", 0)]


def test_latest_extract_ties_null_dates_and_null_ids(spark):
    df = matches(
        spark,
        match("1", home_score=4, extracted_at="2023-03-01T10"),
        match("1", home_score=2, extracted_at="2023-03-01T12"),
        match("2", home_score=1, extract_date=None),
        match("2", home_score=3, extract_date="2020-01-01"),
        match(None, home_score=6),
        match(None, home_score=7, extract_date="2024-01-01"),
    )
    expected = [("1", 2), ("2", 3), (None, 7)]
    assert rows(dedup.keep_latest(df), "event_id", "home_score") == expected
    reverse = df.orderBy("home_score")
    assert rows(dedup.keep_latest(reverse), "event_id", "home_score") == expected


def test_first_and_last_by_arrival(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 3, 30)], "k string, at int, v int")
    assert rows(dedup.keep_first(df, ["k"], ["at"])) == [("a", 1, 10), ("b", 3, 30)]
    assert rows(dedup.keep_last(df, ["k"], ["at"])) == [("a", 2, 20), ("b", 3, 30)]


def test_clean_matches(spark):
    df = matches(
        spark,
        match("1", status="FT", venue="Ground", season="2022"),
        match("2", status=" match finished\t", venue=None, season=None),
        match("3", status="NS", home_score=None),
        match("4", status=None),
        match("5", away_score=None),
        match(None),
        match("6", venue="", season=""),
    )
    got = rows(refine.clean_matches(df), "event_id", "venue", "season")
    assert got == [
        ("1", "Ground", "2022"),
        ("2", "Estadio desconocido", "Sin temporada"),
        ("6", "", ""),
    ]


def test_clean_teams(spark):
    df = teams(
        spark,
        {"team_id": "1", "name": "One"},
        {"team_id": "2", "name": "Two", "city": "C", "venue": "", "website": "w"},
        {"team_id": None, "name": "No id"},
        {"team_id": "4", "name": None},
    )
    got = rows(refine.clean_teams(df), "team_id", "city", "venue", "website")
    assert got == [("1", "No informado", "No informado", "Sin sitio web"), ("2", "C", "", "w")]


def test_types(spark):
    df = refine.type_matches(matches(spark, match("1"), match("2", event_date="27.02.2023")))
    assert dict(df.dtypes)["event_date"] == "timestamp_ntz"
    assert dict(df.dtypes)["home_score"] == "bigint"
    assert rows(df, "event_id", "event_date") == [("1", datetime(2023, 2, 27)), ("2", None)]


@pytest.mark.parametrize(
    "scores, expected",
    [((6, 3), ("Local", 3, True)), ((5, 3), ("Local", 2, False)), ((2, 2), ("Empate", 0, False)),
     ((1, 7), ("Visitante", 6, True)), ((3, 4), ("Visitante", 1, False))],
)
def test_derived(spark, scores, expected):
    df = matches(spark, match("1", home_score=scores[0], away_score=scores[1]))
    got = refine.derive_columns(refine.type_matches(df))
    assert rows(got, "outcome", "score_difference", "is_blowout") == [expected]
    assert rows(got, "match_year", "match_month", "weekday") == [(2023, 2, "Monday")]


def test_renames_skip_absent_columns(spark):
    df = spark.createDataFrame([("e", "x")], "event_name string, other string")
    assert refine.rename_ambiguous(df).columns == ["match_label", "other"]


def test_enrich_keeps_all_matches_and_multiplies_on_repeated_ids(spark):
    info = teams(
        spark,
        {"team_id": "1", "name": "One", "city": "Rome", "venue_capacity": 9},
        {"team_id": "2", "name": "Two", "city": None, "venue_capacity": None},
        {"team_id": "3", "name": "A", "city": "X"},
        {"team_id": "3", "name": "B", "city": "Y"},
    )
    df = matches(spark, *[match(str(i), home_id=h) for i, h in enumerate(["1", "2", "3", "9", None])])
    got = rows(refine.enrich_with_home_team(df, info), "event_id", "home_city", "home_venue_capacity")
    assert got == [
        ("0", "Rome", 9), ("1", "No informado", None), ("2", "X", None), ("2", "Y", None),
        ("3", "No informado", None), ("4", "No informado", None),
    ]


def test_pipeline_lets_an_unfinished_newer_extract_hide_the_match(spark):
    df = matches(
        spark,
        match("1", extract_date="2023-01-01", status="FT"),
        match("1", extract_date="2023-01-02", status="Postponed"),
        match("2", home_id="1", season=None),
    )
    got = refine.refine_matches(df, teams(spark, {"team_id": "1", "name": "One", "city": "Rome"}))
    assert rows(got, "event_id", "season", "home_city", "match_venue", "match_status") == [
        ("2", "Sin temporada", "Rome", "Estadio desconocido", "FT")
    ]
