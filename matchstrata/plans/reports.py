"""Read-side queries over published standings (gold) and matches (silver)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import guarded_ratio, one_decimal, podium, signed
from ..operators.ranking import positions, top_of_group
from ..schema import AWAY_WIN, DRAW, HOME_WIN, STANDINGS_STATS

BEST_FIRST = ("points", "goal_difference")


def _best_first():
    return [*[F.desc(c) for c in BEST_FIRST], F.asc("team_id")]


def _one_league(df: DataFrame, league: str | None) -> DataFrame:
    return df if league is None else df.where(F.col("league") == league)


def leagues(gold: DataFrame) -> DataFrame:
    """The leagues with standings, in order."""
    return gold.select("league").dropna().distinct().orderBy("league")


def league_count(gold: DataFrame) -> DataFrame:
    return gold.agg(F.countDistinct("league").alias("n_leagues"))


def ranked_standings(gold: DataFrame, league: str | None = None) -> DataFrame:
    """Standings with the position of each team in its league, best first."""
    return positions(_one_league(gold, league), ["league"], _best_first())


def standings_display(gold: DataFrame, league: str | None = None) -> DataFrame:
    """Ranked standings as shown: podium label and the scale of the points bar."""
    ranked = ranked_standings(gold, league)
    # The first team has the most points: one row per league, from the ranked
    # rows that are already stored.
    scale = points_scale(ranked.where("position = 1"))
    return (
        ranked.join(scale, "league", "left")
        .withColumn("place", podium("position"))
        .select("league", "position", "place", "team_id", "team", *STANDINGS_STATS, "max_points")
    )


def points_scale(gold: DataFrame) -> DataFrame:
    """Highest points per league, at least 1."""
    top = F.greatest(F.max("points"), F.lit(1)).cast("bigint")
    return gold.groupBy("league").agg(top.alias("max_points"))


def leaders(gold: DataFrame, league: str | None = None) -> DataFrame:
    """The first team of each league, with its headline."""
    best = top_of_group(_one_league(gold, league), ["league"], _best_first())
    # Wording of the headline.
    headline = F.format_string(
        "%s: %d pts · %d PG · DG %s", F.coalesce("team", F.lit("None")), "points", "won",
        signed("goal_difference"),
    )
    return best.select(
        "league", "team_id", "team", "points", "won", "goal_difference",
        headline.alias("headline"),
    )


def league_kpis(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Teams, matches, goals, goals per match and blowouts of each league in gold."""
    teams = gold.where(F.col("league").isNotNull()).groupBy("league").agg(
        F.count("*").alias("teams")
    )
    played = silver.groupBy("league").agg(
        F.count("*").alias("matches"),
        (F.sum("home_score") + F.sum("away_score")).cast("bigint").alias("goals"),
        F.count_if("is_blowout").alias("blowouts"),
    )
    per_match = guarded_ratio("goals", "matches")
    return teams.join(played, "league", "left").select(
        "league",
        "teams",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("matches", "goals")],
        per_match.alias("goals_per_match"),
        one_decimal(per_match).alias("goals_per_match_text"),
        F.coalesce("blowouts", F.lit(0)).alias("blowouts"),
    )


def outcome_counts(silver: DataFrame) -> DataFrame:
    """Home wins, draws and away wins per league; 0 where there is none."""
    wanted = {"home_wins": HOME_WIN, "draws": DRAW, "away_wins": AWAY_WIN}
    return silver.groupBy("league").agg(
        *[F.count_if(F.col("outcome") == label).alias(name) for name, label in wanted.items()]
    )


def blowouts(silver: DataFrame, league: str | None = None) -> DataFrame:
    """Matches won by a wide margin, newest first."""
    return (
        _one_league(silver, league)
        .where("is_blowout")
        .orderBy(F.desc("event_date"), "event_id")
        .select("league", "event_id", "event_date", "home_team", "home_score", "away_score",
                "away_team")
    )


def attack_defence(gold: DataFrame, league: str | None = None) -> DataFrame:
    """Goals for against goals against, sized and coloured by points."""
    return _one_league(gold, league).select(
        "league", "team_id", "team", "goals_for", "goals_against",
        (F.col("points") + 1).alias("size"),
        "points", "played", "won", "goal_difference",
    )
