import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from matchstrata.operators import standings as table
from matchstrata.operators.ranking import positions, top_of_group

SCHEMA = """league string, event_id string, event_date date, home_id string, home_team string,
 home_score bigint, away_id string, away_team string, away_score bigint, outcome string"""


def game(league, home, home_score, away, away_score, n=0, date=None, outcome=""):
    if outcome == "":
        outcome = ("Local" if home_score > away_score else
                   "Visitante" if home_score < away_score else "Empate")
    return (league, str(n), date, home[0], home[1], home_score, away[0], away[1], away_score, outcome)


def frame(spark, *games):
    return spark.createDataFrame(list(games), SCHEMA)


NORTH, SOUTH, EAST = ("1", "North"), ("2", "South"), ("3", "East")
STATS = ["played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points"]


def brute_standings(games):
    """The same table with a loop per match."""
    stats, names = {}, {}
    sightings = []
    for g in games:
        league, _, date, hid, hname, hs, aid, aname, as_, out = g
        sightings.append((0, date is None, date, hname is not None, hname, hid))
        sightings.append((1, date is None, date, aname is not None, aname, aid))
        for tid, f, a, win in ((hid, hs, as_, "Local"), (aid, as_, hs, "Visitante")):
            if tid is None or league is None:
                continue
            s = stats.setdefault((league, tid), [0] * 5)
            for i, v in enumerate((1, out == win, out == "Empate", f or 0, a or 0)):
                s[i] += int(v)
    for s in sorted(sightings, key=lambda s: (s[0], s[1], str(s[2]), s[3], s[4] or "")):
        names.setdefault(s[5], s[4])
    return sorted(
        (l, t, names[t], p, w, d, p - w - d, f, a, f - a, 3 * w + d)
        for (l, t), (p, w, d, f, a) in stats.items()
    )


def test_a_round_robin_with_byes(spark):
    """Three teams, one resting in each round."""
    df = frame(spark, game("L", NORTH, 4, SOUTH, 1), game("L", SOUTH, 2, EAST, 2), game("L", EAST, 5, NORTH, 3))
    got = {r["team_id"]: tuple(r[c] for c in STATS) for r in table.standings(df).collect()}
    assert got == {
        "1": (2, 1, 0, 1, 7, 6, 1, 3), "2": (2, 0, 1, 1, 3, 6, -3, 1), "3": (2, 1, 1, 0, 7, 5, 2, 4)}


def test_a_club_that_is_renamed_twice_stays_one_row(spark):
    df = frame(
        spark,
        game("L", EAST, 0, ("7", "Athletic"), 0),
        game("L", ("7", "Union"), 2, SOUTH, 6),
        game("L", NORTH, 3, ("7", "Dynamo"), 4),
    )
    got = rows(table.standings(df).where("team_id = '7'"), "team", "played", "goals_for", "goals_against")
    assert got == [("Union", 3, 6, 9)]


def test_name_of_first_home_sighting_by_date_even_if_null(spark):
    import datetime as dt
    d = lambda n: dt.date(2024, 1, n)
    df = frame(
        spark,
        game("L", EAST, 1, ("1", "away name"), 0, date=d(1)),
        game("L", ("1", "late"), 1, EAST, 0, date=d(9)),
        game("M", ("1", "early"), 1, EAST, 0, date=d(3)),
        game("L", ("2", None), 1, EAST, 0, date=d(3)),
        game("L", ("2", "named later"), 1, EAST, 0, date=d(4)),
        game(None, ("4", "seen without league"), 1, EAST, 0, date=d(1)),
        game("L", ("4", "seen later"), 1, EAST, 0, date=d(2)),
    )
    names = [("1", "early"), ("2", None), ("3", "East"), ("4", "seen without league")]
    assert rows(table.team_names(df)) == names
    assert rows(table.standings(df).select("team_id", "team").distinct()) == names


def test_a_team_of_two_leagues_and_matches_of_none(spark):
    df = frame(
        spark,
        game("cup", EAST, 0, SOUTH, 0),
        game("first", SOUTH, 5, EAST, 2),
        game("first", EAST, 1, NORTH, 2),
        game("first", (None, "guest"), 0, SOUTH, 0),
        game(None, SOUTH, 7, EAST, 0),
    )
    assert rows(table.standings(df), "league", "team_id", "points", "played") == [
        ("cup", "2", 1, 1), ("cup", "3", 1, 1), ("first", "1", 3, 1), ("first", "2", 4, 2), ("first", "3", 0, 2)]


def test_unknown_outcome_counts_as_loss_and_null_scores_as_zero(spark):
    df = frame(spark, game("L", NORTH, None, SOUTH, None, outcome=None))
    got = rows(table.standings(df), "team_id", *STATS)
    assert got == [("1", 1, 0, 0, 1, 0, 0, 0, 0), ("2", 1, 0, 0, 1, 0, 0, 0, 0)]


def test_table_order_is_by_points_not_by_id(spark):
    df = frame(spark, game("L", EAST, 1, SOUTH, 0), game("L", EAST, 2, NORTH, 2))
    ordered = table.in_table_order(table.standings(df)).collect()
    assert [(r["team_id"], r["points"]) for r in ordered] == [("3", 4), ("1", 1), ("2", 0)]


TEAM = st.tuples(st.sampled_from("1234"), st.sampled_from(["x", "y", None]))
GAMES = st.lists(
    st.builds(
        game, st.sampled_from(["A", "B", None]), TEAM, st.integers(0, 4), TEAM, st.integers(0, 4)
    ),
    min_size=1, max_size=20,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(GAMES, st.randoms())
def test_standings_equal_a_loop_in_any_row_order(spark, games, rng):
    shuffled = games[:]
    rng.shuffle(shuffled)
    got = table.standings(frame(spark, *shuffled)).collect()
    assert sorted(tuple(r) for r in got) == brute_standings(games)
    leagued = [g for g in games if g[0] is not None]
    assert sum(r["played"] for r in got) == 2 * len(leagued)
    assert sum(r["goals_for"] for r in got) == sum(r["goals_against"] for r in got)


def test_positions_of_a_hot_group(spark):
    """One league with most teams spans several partitions and is numbered without gaps."""
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randrange(5), f"t{i}") for i in range(4000)]
    df = spark.createDataFrame(data, "league string, points int, team_id string")
    got = positions(df, ["league"], [F.desc("points"), "team_id"])
    expected = []
    for league in {d[0] for d in data}:
        ranked = sorted((d for d in data if d[0] == league), key=lambda d: (-d[1], d[2]))
        expected += [(*d, i) for i, d in enumerate(ranked, 1)]
    assert rows(got) == sorted(expected, key=repr)
    best = top_of_group(df, ["league"], [F.desc("points"), "team_id"])
    assert rows(best) == sorted((e[:3] for e in expected if e[3] == 1), key=repr)
