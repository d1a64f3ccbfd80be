"""Layer jobs: landed JSON to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions import finished
from ..operators.contracts import (
    GOLD_STANDINGS,
    SILVER_MATCHES,
    require_refined,
)
from ..operators.refine import clean_teams, refine_matches
from ..operators.standings import standings
from ..schema import (
    BRONZE_MATCHES,
    BRONZE_TEAMS,
    MATCH_CHECKS,
    TEAM_CHECKS,
)
from ..sources.envelopes import ingest, type_bronze_matches, type_teams
from ..sources.tables import LakeTable


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lake:
    """Where the layers live."""

    spark: SparkSession
    root: str

    def _table(self, name: str) -> LakeTable:
        return LakeTable(self.spark, f"{self.root.rstrip('/')}/{name}")

    @property
    def bronze_teams(self) -> LakeTable:
        return self._table("bronze/teams")

    @property
    def bronze_matches(self) -> LakeTable:
        return self._table("bronze/matches")

    @property
    def source_health(self) -> LakeTable:
        return self._table("bronze/source_health")

    @property
    def set_aside(self) -> LakeTable:
        return self._table("bronze/set_aside")

    @property
    def silver_matches(self) -> LakeTable:
        return self._table("silver/matches")

    @property
    def gold_standings(self) -> LakeTable:
        return self._table("gold/standings")


def create_bronze(lake: Lake) -> None:
    lake.bronze_teams.create(
        BRONZE_TEAMS, checks=TEAM_CHECKS, description="teams, full load", keys=["team_id"]
    )
    lake.bronze_matches.create(
        BRONZE_MATCHES,
        partition_by=["extract_date"],
        checks=MATCH_CHECKS,
        description="matches, daily increments",
        keys=["event_id"],
    )


def load_teams(teams: DataFrame, table: LakeTable, about_rows: int | None = None) -> int:
    """FULL load: the frame becomes the table."""
    return table.save(teams, mode="overwrite", schema_mode="merge", about_rows=about_rows)


def load_matches(matches: DataFrame, table: LakeTable, about_rows: int | None = None, placed: bool = False) -> int:
    """INCREMENTAL load: the frame's extract dates are replaced, others stay."""
    return table.save(
        matches,
        mode="overwrite",
        partition_by=["extract_date"],
        replace_partitions=True,
        schema_mode="merge",
        about_rows=about_rows,
        placed=placed,
    )


def run_bronze(
    lake: Lake,
    teams_path: str,
    matches_path: str,
    as_of: datetime,
    leagues: Sequence[tuple[str, str, str]] | None = None,
    whole_files: bool = False,
    keep_going: bool = False,
) -> DataFrame:
    """Load landed responses into bronze; returns the health of the sources.

    Text that is no JSON is stored in ``bronze/set_aside`` (kind, source, reason,
    text), which each load writes anew. A row that breaks a constraint of its table
    stops the load; with ``keep_going`` it is set aside too, and the others load.
    """
    create_bronze(lake)
    landed = ingest(lake.spark, teams_path, matches_path, as_of, leagues, whole_files, place=lake.bronze_matches.placed)
    kinds = [
        ("teams", type_teams(landed.teams), TEAM_CHECKS, load_teams, lake.bronze_teams, landed.staged_teams),
        ("matches", type_bronze_matches(landed.matches), MATCH_CHECKS, partial(load_matches, placed=True),
         lake.bronze_matches, landed.staged_matches),
    ]
    aside = [landed.broken.select("kind", "source", F.lit("not_json").alias("reason"), F.col("broken").alias("text"))]
    for kind, rows, checks, load, table, staged in kinds:
        if keep_going:
            met = F.lit(True)
            for condition in checks.values():
                met = met & F.coalesce(F.expr(condition), F.lit(False))
            text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
            source = F.col("league_id").alias("source")
            aside.append(rows.where(~met).select(F.lit(kind).alias("kind"), source, F.lit("constraint").alias("reason"), text.alias("text")))
            rows = rows.where(met)
        load(rows, table, about_rows=staged.df.count())  # first copies are fewer: the count is an upper bound
    lake.set_aside.save(reduce(DataFrame.unionByName, aside))
    # One row per source, kept after the staged parse is gone.
    health = lake.source_health
    health.save(landed.health, schema_mode="overwrite")
    landed.discard()
    for status, sources, matches, finished in (
        health.read().groupBy("status")
        .agg(F.count("*"), F.sum("n_matches"), F.sum("n_finished")).collect()
    ):
        log.info("bronze: %d sources %s, %d matches, %d finished", sources, status, matches, finished)
    return health.read()


def run_silver(lake: Lake, since: str | None = None) -> int:
    """Refine bronze into the next silver version, hold that to its contract, then publish it.

    ``since`` (an extract date) limits the run to matches extracted on that day
    or later and so to those partitions: the newest extract of such a match lies
    there. A change in the teams then reaches these matches only; without
    ``since`` all matches are refined anew.
    """
    teams = clean_teams(lake.bronze_teams.read())
    counted = Observation("silver")
    about_rows = lake.bronze_matches.read().count()
    with lake.bronze_matches.read_by_keys(about_rows) as bronze:  # the newest extract is chosen where the copies lie
        if since is not None:
            bronze = bronze.where(F.col("extract_date") >= since)
        refined = refine_matches(bronze, teams).observe(counted, F.count(F.lit(1)).alias("n"))

        def gate(written: DataFrame) -> None:
            require_refined(bronze, written)
            SILVER_MATCHES.enforce(written)

        version = lake.silver_matches.upsert(
            refined, ["event_id"], partition_by=["season"], keys_are_unique=True, gate=gate,
            about_rows=bronze.count() if since is not None else about_rows,
        )
    log.info("silver: %d matches refined", counted.get["n"])
    return version


def run_gold(lake: Lake) -> int:
    """Standings from silver, held to their contract as written, then published."""
    counted = Observation("gold")
    table = standings(lake.silver_matches.read()).observe(counted, F.count(F.lit(1)).alias("n"))
    version = lake.gold_standings.upsert(
        table, ["team_id", "league"], partition_by=["league"], keys_are_unique=True,
        gate=GOLD_STANDINGS.enforce,
    )
    log.info("gold: %d teams with standings", counted.get["n"])
    return version


def run_all(lake: Lake, teams_path: str, matches_path: str, as_of: datetime, **options) -> DataFrame:
    """The three layers in order; a failing one stops the rest.

    Returns the closing summary: a row per table, as :func:`summaries`. The health
    of the sources stays in ``bronze/source_health``.
    """
    run_bronze(lake, teams_path, matches_path, as_of, **options)
    run_silver(lake)
    run_gold(lake)
    return summaries(lake)


def ensure_built(lake: Lake, teams_path: str, matches_path: str, as_of: datetime, **options) -> bool:
    """Run the chain only where gold is absent; returns whether it ran."""
    if lake.gold_standings.exists():
        return False
    run_all(lake, teams_path, matches_path, as_of, **options)
    return True


def layer_counts(lake: Lake) -> DataFrame:
    """One row per layer: its rows, those of finished matches, its distinct keys.

    Finished matches of bronze (rows, not matches) are the most that silver can
    hold of what was refined together; gold has teams, so no finished ones.
    """
    matches = lake.bronze_matches.read().agg(
        F.lit("bronze/matches").alias("layer"), F.count("*").alias("n_rows"),
        F.count_if(finished("status")).alias("n_finished"), F.count_distinct("event_id").alias("n_keys"),
    )
    silver = lake.silver_matches.read().agg(
        F.lit("silver/matches").alias("layer"), F.count("*").alias("n_rows"),
        F.count("*").alias("n_finished"), F.count_distinct("event_id").alias("n_keys"),
    )
    gold = lake.gold_standings.read().agg(
        F.lit("gold/standings").alias("layer"), F.count("*").alias("n_rows"),
        F.lit(None).cast("bigint").alias("n_finished"), F.count_distinct("league", "team_id").alias("n_keys"),
    )
    return matches.unionByName(silver).unionByName(gold)


def summaries(lake: Lake) -> DataFrame:
    """One summary row per table of the lake."""
    tables = {
        "bronze/teams": lake.bronze_teams,
        "bronze/matches": lake.bronze_matches,
        "silver/matches": lake.silver_matches,
        "gold/standings": lake.gold_standings,
    }
    rows = [t.summary(name) for name, t in tables.items()]
    merged = rows[0]
    for r in rows[1:]:
        merged = merged.unionByName(r)
    return merged
