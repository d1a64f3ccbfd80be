import pytest

from conftest import rows
from matchstrata.operators.contracts import (
    GOLD_STANDINGS,
    SILVER_MATCHES,
    Contract,
    ContractViolation,
    Required,
    layer_gap,
    require_refined,
    status_counts,
    whole_numbers,
)
from matchstrata.schema import STANDINGS_COLUMNS

GOLD = "league string, team_id string, team string, " + ", ".join(
    f"{c} bigint" for c in STANDINGS_COLUMNS[3:]
)
SILVER = ("event_id string, league string, home_score bigint, away_score bigint, outcome string, "
          "score_difference bigint, is_blowout boolean")


def gold(spark, *lines, schema=GOLD):
    return spark.createDataFrame(list(lines), schema)


def line(league="East", team_id="40", team="Rovers", played=7, won=4, drawn=1, lost=2, f=13, a=9,
         difference=None, points=None):
    return (league, team_id, team, played, won, drawn, lost, f, a,
            f - a if difference is None else difference,
            3 * won + drawn if points is None else points)


def silver(spark, *lines):
    return spark.createDataFrame(list(lines), SILVER)


def broken(contract, df):
    return {(r["rule"], r["column"]): (r["n_failed"], r["sample"])
            for r in contract.violations(df).collect()}


HOME, AWAY, LEVEL = ("m1", "East", 5, 3, "Local", 2, False), ("m2", "East", 0, 4, "Visitante", 4, True), (
    "m3", "West", 3, 3, "Empate", 0, False)


def changed(row, **values):
    names = [c.split()[0] for c in SILVER.split(", ")]
    return tuple(values.get(n, v) for n, v in zip(names, row, strict=True))


def test_sound_rows_pass(spark):
    GOLD_STANDINGS.enforce(gold(spark, line(), line(league="West"), line(team_id="41", team=None)))
    SILVER_MATCHES.enforce(silver(spark, HOME, AWAY, LEVEL))


@pytest.mark.parametrize(
    "faulty, rule",
    [
        ([line(points=14)], ("points_are_3_won_plus_drawn", "*")),
        ([line(lost=3)], ("played_is_won_drawn_lost", "*")),
        ([line(), line(team_id="41"), line(team="Again")], ("unique", "league|team_id")),
        ([line(a=-6, difference=19)], ("at_least_0", "goals_against")),
        ([line(team_id=None)], ("not_null", "team_id")),
    ],
)
def test_each_gold_fault_is_found(spark, faulty, rule):
    df = gold(spark, *faulty)
    assert list(broken(GOLD_STANDINGS, df)) == [rule]
    with pytest.raises(ContractViolation, match=rule[0]):
        GOLD_STANDINGS.enforce(df)


@pytest.mark.parametrize(
    "faulty, rule",
    [
        ([HOME, changed(LEVEL, outcome="Draw")], ("one_of", "outcome")),
        ([HOME, AWAY, changed(LEVEL, event_id="m2")], ("unique", "event_id")),
        ([changed(AWAY, score_difference=None)], ("not_null", "score_difference")),
        ([changed(AWAY, away_score=-4)], ("at_least_0", "away_score")),
    ],
)
def test_each_silver_fault_is_found(spark, faulty, rule):
    assert list(broken(SILVER_MATCHES, silver(spark, *faulty))) == [rule]


def test_a_report_names_every_rule(spark):
    report = {(r["rule"], r["column"]): r["n_failed"] for r in SILVER_MATCHES.report(silver(spark, HOME, HOME, LEVEL)).collect()}
    assert report.pop(("unique", "event_id")) == 2
    assert len(report) == 11 and set(report.values()) == {0}


def test_all_faults_come_in_one_report(spark):
    df = gold(spark, line(points=0), line(team_id="2", f=-1, difference=-10), line(team_id="2"))
    with pytest.raises(ContractViolation) as error:
        GOLD_STANDINGS.enforce(df)
    assert {f["rule"] for f in error.value.failures} == {
        "points_are_3_won_plus_drawn", "at_least_0", "unique",
    }


def test_goal_difference_may_have_any_sign_and_extra_columns_are_allowed(spark):
    df = gold(spark, line(f=0, a=4)).selectExpr("*", "1 AS more")
    assert broken(GOLD_STANDINGS, df) == {}


def test_missing_column_and_uncastable_text(spark):
    df = gold(spark, line(), line(team_id="2")).drop("won").selectExpr(
        "* EXCEPT (played)", "CASE team_id WHEN '40' THEN 'seven' ELSE '7' END AS played"
    )
    assert broken(GOLD_STANDINGS, df) == {
        ("column_present", "won"): (None, None), ("castable", "played"): (1, "seven"),
    }


def test_null_skips_value_rules(spark):
    contract = Contract("c", (Required("n", "bigint", nullable=True, at_least=0),), {"even": "n % 2 = 0"})
    df = spark.createDataFrame([(None,), (2,), (3,), (-1,)], "n bigint")
    assert broken(contract, df) == {("at_least_0", "n"): (1, "-1"), ("even", "*"): (2, "-1")}


def test_samples_count_whole_groups_of_copies(spark):
    df = silver(spark, *[(i, "L", 1, 0, "Local", 1, False) for i in ("a", "b", "b", "c", "c", "c")])
    assert broken(SILVER_MATCHES, df) == {("unique", "event_id"): (5, "b")}


def test_whole_numbers_name_the_rows(spark):
    df = spark.createDataFrame([("1", None), ("2.5", "x"), ("2.0", "1.5")], "a string, b string")
    with pytest.raises(ContractViolation, match="b_is_whole"):
        whole_numbers("numbers", ["a", "b"]).enforce(df)
    assert set(broken(whole_numbers("numbers", ["a", "b"]), df)) == {
        ("a_is_whole", "*"), ("b_is_whole", "*"),
    }


def test_layers(spark):
    bronze = spark.createDataFrame([("AET",), (" pen ",), ("HT",), (None,), ("Postponed",), ("finished",)], "status string")
    pending = bronze.where("status IN ('HT', 'Postponed')")
    none = spark.createDataFrame([], SILVER)
    some = silver(spark, AWAY, LEVEL)
    assert rows(status_counts(bronze)) == [(3, 3)]
    assert rows(layer_gap(bronze, none)) == [(3, 0, False)]
    assert rows(layer_gap(bronze, some)) == [(3, 2, True)]
    with pytest.raises(ContractViolation, match="silver is empty"):
        require_refined(bronze, none)
    require_refined(bronze, some)
    require_refined(pending, none)


def test_cases_are_the_smallest_of_each_rule(spark):
    lines = [line(team_id=f"{i:03}", won=-1 - i % 9, points=99) for i in range(40)] + [line(team_id="7"), line(team_id="7"), line(team=None)]
    df = gold(spark, *lines).repartition(4)
    got = {}
    for r in GOLD_STANDINGS.cases(df, 3).orderBy("rule", "column", "place").collect():
        got.setdefault((r["rule"], r["column"]), []).append((r["place"], r["shown"]))
    assert got[("at_least_0", "won")] == [(1, "-1"), (2, "-2"), (3, "-3")]
    assert got[("unique", "league|team_id")] == [(1, "East|7")]
    assert got[("points_are_3_won_plus_drawn", "*")] == [(k + 1, f"East|{k:03}") for k in range(3)]
    assert {k: len(v) for k, v in got.items()}.items() <= {k: 3 for k in got if k[0] != "unique"}.items() | {(k, 1) for k in got if k[0] == "unique"}
    with pytest.raises(ContractViolation) as raised:
        GOLD_STANDINGS.enforce(df)
    assert ("at_least_0", "won", 1, "-1") in raised.value.cases and len(raised.value.cases) <= 5 * len(got)
    assert GOLD_STANDINGS.cases(gold(spark, line())).count() == 0
    assert GOLD_STANDINGS.cases(gold(spark, line()).drop("won")).count() == 0


def test_cases_are_limited_before_the_shuffle(spark):
    plan = GOLD_STANDINGS.cases(gold(spark, line()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
