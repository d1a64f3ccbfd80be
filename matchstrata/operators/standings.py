"""League standings from refined matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import AWAY_WIN, DRAW, HOME_WIN, STANDINGS_COLUMNS


def team_sides(matches: DataFrame) -> DataFrame:
    """Each match seen by its home team and by its away team, in one scan."""
    date = F.col("event_date") if "event_date" in matches.columns else F.lit(None).cast("date")

    def side(role: int, own: str, other: str, win: str) -> Column:
        return F.struct(
            F.col(f"{own}_id").alias("team_id"),
            F.col(f"{own}_team").alias("team"),
            F.lit(role).alias("role"),
            date.alias("seen"),
            F.col(f"{own}_score").alias("scored"),
            F.col(f"{other}_score").alias("conceded"),
            F.coalesce(F.col("outcome") == win, F.lit(False)).alias("win"),
            F.coalesce(F.col("outcome") == DRAW, F.lit(False)).alias("draw"),
        )

    both = F.array(side(0, "home", "away", HOME_WIN), side(1, "away", "home", AWAY_WIN))
    return matches.select("league", F.inline(both)).where(F.col("team_id").isNotNull())


def _first_name() -> Column:
    """The name of the first sighting: home before away, then the earliest date.

    Names seen on one date in one role are settled by the name itself, so that
    only fixed-width minima are kept per row; an unknown date comes last, and a
    NULL name counts as a name.
    """
    return F.min(F.struct("role", F.col("seen").isNull(), "seen", "team"))


def team_names(matches: DataFrame) -> DataFrame:
    """Display name per team id over all leagues."""
    return (
        team_sides(matches)
        .groupBy("team_id", "team", "role")
        .agg(F.min("seen").alias("seen"))
        .groupBy("team_id")
        .agg(_first_name().alias("named"))
        .select("team_id", F.col("named.team").alias("team"))
    )


def standings(matches: DataFrame, points_win: int = 3, points_draw: int = 1) -> DataFrame:
    """Played, won, drawn, lost, goals and points per league and team.

    The matches are scanned once. The first grouping, also by name and role,
    keeps fixed-width buffers only, so it runs as a hash aggregation with
    map-side partials; everything after it works on the few rows it leaves. The
    name is chosen per team id over all leagues: that window holds one row per
    league of the team. Rows without team id form no group; rows without league
    only take part in the choice of the name.
    """
    sightings = (
        team_sides(matches)
        .groupBy("league", "team_id", "team", "role")
        .agg(
            F.count("*").alias("played"),
            F.count_if("win").alias("won"),
            F.count_if("draw").alias("drawn"),
            F.sum("scored").alias("scored"),
            F.sum("conceded").alias("conceded"),
            F.min("seen").alias("seen"),
        )
    )
    stats = sightings.groupBy("league", "team_id").agg(
        *[F.sum(c).alias(c) for c in ("played", "won", "drawn")],
        F.coalesce(F.sum("scored"), F.lit(0)).cast("bigint").alias("goals_for"),
        F.coalesce(F.sum("conceded"), F.lit(0)).cast("bigint").alias("goals_against"),
        _first_name().alias("named"),
    )
    first = F.min("named").over(Window.partitionBy("team_id"))
    return (
        stats.withColumn("team", first.getField("team"))
        .where(F.col("league").isNotNull())
        .withColumn("lost", F.col("played") - F.col("won") - F.col("drawn"))
        .withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
        .withColumn("points", F.col("won") * points_win + F.col("drawn") * points_draw)
        .select(*STANDINGS_COLUMNS)
    )


def in_table_order(table: DataFrame) -> DataFrame:
    """League, then points from high to low, then team id."""
    return table.orderBy("league", F.desc("points"), "team_id")
