"""From bronze rows to refined matches: filter, type, derive, rename, enrich."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import day_name, finished, month_number, parse_date, year_number
from ..schema import (
    AWAY_WIN,
    BLOWOUT_MARGIN,
    DRAW,
    FINISHED_STATUSES,
    HOME_WIN,
    NO_WEBSITE,
    NOT_REPORTED,
    SILVER_RENAMES,
    UNKNOWN_SEASON,
    UNKNOWN_VENUE,
)
from .dedup import keep_latest


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in which every required column has a value."""
    return df.na.drop(subset=list(required))


def fill_missing(df: DataFrame, fills: Mapping[str, str]) -> DataFrame:
    """NULL replaced per column; an empty text is a value and stays."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def keep_finished(
    df: DataFrame, status: str = "status", statuses: Sequence[str] = FINISHED_STATUSES
) -> DataFrame:
    return df.where(finished(status, statuses))


def clean_matches(df: DataFrame) -> DataFrame:
    """Finished matches with an id and both scores; optional texts filled."""
    return (
        df.transform(drop_incomplete, ["event_id", "home_score", "away_score"])
        .transform(keep_finished)
        .transform(fill_missing, {"venue": UNKNOWN_VENUE, "season": UNKNOWN_SEASON})
    )


def clean_teams(df: DataFrame) -> DataFrame:
    """Teams with an id and a name; optional texts filled."""
    fills = {"city": NOT_REPORTED, "venue": NOT_REPORTED, "website": NO_WEBSITE}
    return df.transform(drop_incomplete, ["team_id", "name"]).transform(fill_missing, fills)


def type_matches(
    df: DataFrame,
    dates: Sequence[str] = ("event_date",),
    numbers: Sequence[str] = ("home_score", "away_score"),
) -> DataFrame:
    """Date texts to naive timestamps and scores to whole numbers."""
    typed = {c: parse_date(c) for c in dates}
    typed.update({c: F.col(c).cast("bigint") for c in numbers})
    return df.withColumns(typed)


def outcome(home: Column, away: Column) -> Column:
    return F.when(home > away, HOME_WIN).when(home < away, AWAY_WIN).otherwise(DRAW)


def derive_columns(
    df: DataFrame,
    date: str = "event_date",
    home_score: str = "home_score",
    away_score: str = "away_score",
    margin: int = BLOWOUT_MARGIN,
) -> DataFrame:
    """Date parts, outcome, absolute score difference and the blowout flag."""
    home, away = F.col(home_score), F.col(away_score)
    difference = F.abs(home - away)
    return df.withColumns(
        {
            "match_year": year_number(date),
            "match_month": month_number(date),
            "weekday": day_name(date),
            "outcome": outcome(home, away),
            "score_difference": difference,
            "is_blowout": difference > margin,
        }
    )


def rename_ambiguous(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Columns whose names mean different things in other tables; absent ones are skipped."""
    return df.withColumnsRenamed(dict(names or SILVER_RENAMES))


def enrich_with_home_team(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """City and venue capacity of the home team, all matches kept.

    No hint is set: Catalyst broadcasts the teams when their size is under its
    threshold and otherwise runs a sort-merge left join, whose hot left keys
    AQE splits. Several teams with one id multiply the match, as in any join.
    """
    info = teams.select(
        F.col("team_id").alias("_team_id"),
        F.col("city").alias("home_city"),
        F.col("venue_capacity").alias("home_venue_capacity"),
    )
    return (
        matches.join(info, matches.home_id == info._team_id, "left")
        .drop("_team_id")
        .transform(fill_missing, {"home_city": NOT_REPORTED})
    )


def refine_matches(
    bronze: DataFrame, teams: DataFrame, tie_break: Sequence[Column | str] | None = None
) -> DataFrame:
    """All refinement steps in order.

    Deduplication comes before the filter on purpose: a match whose newest
    extract is unfinished is left out even if an older extract was final.
    """
    return (
        bronze.transform(keep_latest, tie_break=tie_break)
        .transform(clean_matches)
        .transform(type_matches)
        .transform(derive_columns)
        .transform(rename_ambiguous)
        .transform(enrich_with_home_team, teams)
    )
