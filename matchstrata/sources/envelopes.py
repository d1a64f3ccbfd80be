"""Landed JSON responses: one array of records per response.

Responses are landed as text, one per line, under ``source=<id>`` folders (the
id of the league they were asked for). A line is the unit Spark splits on;
``whole_files`` takes pretty-printed files, one response each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import finished, first_filled, load_stamp, not_integral, to_long
from ..operators.contracts import whole_numbers
from ..operators.dedup import keep_first
from ..session import Staged, stage
from ..schema import (
    BRONZE_MATCHES,
    BRONZE_TEAMS,
    LEAGUES,
    MATCH_COLUMNS,
    MATCH_FIELDS,
    MATCH_NUMBERS,
    RAW_MATCH,
    RAW_TEAM,
    TEAM_COLUMNS,
    TEAM_FIELDS,
    TEAM_NUMBERS,
)

# Order in which records arrived: by file, by place in the file, by place in
# the array.
ARRIVAL = ("_file", "_block", "_line", "_position")


class EmptySource(ValueError):
    """A response without records where records are required."""


def _decoded(name: Column) -> Column:
    """A folder name as its writer meant it: file paths are URI-encoded, and
    Spark escapes special characters of partition values before that."""
    for _ in range(2):
        name = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return name


def read_responses(
    spark: SparkSession, path: str, field: str, record: StructType, whole_files: bool = False
) -> DataFrame:
    """One row per landed response: source, arrival columns, records, broken text.

    Values of any JSON type are read as text and an absent key is NULL.
    ``records`` is NULL where the array is missing or the text is no object.
    """
    envelope = StructType(
        [StructField(field, ArrayType(record)), StructField("_broken", StringType())]
    )
    lines = spark.read.text(path, wholetext=whole_files)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/source=([^/]+)/", 1)
    source = F.coalesce(F.nullif(_decoded(folder), F.lit("")), F.col("_metadata.file_name"))
    parsed = F.from_json("value", envelope, {"columnNameOfCorruptRecord": "_broken"})
    return (
        lines.where(F.length("value") > 0)
        .select(
            source.alias("source"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
            "value",
            parsed.alias("_envelope"),
        )
        .select(
            "source", "_file", "_block", "_line",
            F.col(f"_envelope.{field}").alias("records"),
            F.when(F.col("_envelope").isNull() | F.col("_envelope._broken").isNotNull(),
                   F.col("value")).alias("broken"),
        )
    )


def whole_document(text: Column | str) -> Column:
    """A JSON text as one value of any shape (VARIANT); NULL for text that is no JSON."""
    return F.try_parse_json(text)


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per landed response, read as a whole: source, document, broken text.

    For responses without a record field: nothing of their shape is assumed.
    """
    lines = spark.read.text(path, wholetext=whole_files).where(F.length("value") > 0)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/source=([^/]+)/", 1)
    source = F.coalesce(F.nullif(_decoded(folder), F.lit("")), F.col("_metadata.file_name"))
    document = whole_document("value")
    return lines.select(
        source.alias("source"), document.alias("document"), F.when(document.isNull(), F.col("value")).alias("broken")
    )


def document_paths(df: DataFrame, document: str, depth: int = 3) -> DataFrame:
    """What the documents hold: path, type, how many values.

    Objects and arrays are opened down to ``depth`` levels, elements of an array
    under ``[*]``; a path with values of several types has a row for each. Numbers
    are BIGINT or DECIMAL, whatever their size.
    """
    level = df.select(F.lit("$").alias("path"), F.col(document).alias("v")).where(F.col(document).isNotNull())
    parts = []
    for below in range(depth + 1):
        kind = F.regexp_extract(F.schema_of_variant("v"), "^([A-Z]+)", 1)
        parts.append(level.select("path", kind.alias("type")))
        if below < depth:
            opened = level.where(kind.isin("OBJECT", "ARRAY")).lateralJoin(
                df.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("pos", "key", "value")
            )
            step = F.when(F.col("key").isNull(), F.lit("[*]")).otherwise(F.concat(F.lit("."), F.col("key")))
            level = opened.select(F.concat("path", step).alias("path"), F.col("value").alias("v"))
    return reduce(DataFrame.unionByName, parts).groupBy("path", "type").agg(F.count("*").alias("n_values"))


def explode_records(responses: DataFrame, on_empty: str = "ignore") -> DataFrame:
    """One row per record, with its place in the array.

    ``on_empty='fail'`` makes a read without any record an error.
    """
    rest = [c for c in responses.columns if c not in ("records", "broken")]
    records = responses.select(*rest, F.posexplode("records").alias("_position", "record"))
    if on_empty == "fail" and records.isEmpty():
        raise EmptySource("no records in any response")
    return records


def _project(records: DataFrame, record: str, fields: dict[str, str], **special: Column):
    """The fields of a record under their column names, after the other columns."""
    keep = [c for c in records.columns if c != record]
    named = {name: F.col(f"{record}.{raw}") for raw, name in fields.items()} | special
    return records.select(*keep, *[c.alias(name) for name, c in named.items()])


def map_teams(records: DataFrame, as_of: datetime, record: str = "record") -> DataFrame:
    """Raw team records to the team columns, numbers still text.

    The city falls back to the venue's location when it is missing or empty.
    """
    instant, _ = load_stamp(as_of)
    city = first_filled(f"{record}.strCity", f"{record}.strStadiumLocation")
    return _project(records, record, TEAM_FIELDS, city=city, extracted_at=F.lit(instant))


def map_matches(records: DataFrame, as_of: datetime, record: str = "record") -> DataFrame:
    """Raw match records to the match columns, numbers still text."""
    instant, day = load_stamp(as_of)
    return _project(
        records, record, MATCH_FIELDS, extracted_at=F.lit(instant), extract_date=F.lit(day)
    )


def _typed(df: DataFrame, schema: StructType, numbers: Sequence[str]) -> DataFrame:
    return df.select(
        *[
            (to_long(f.name) if f.name in numbers else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def type_teams(df: DataFrame) -> DataFrame:
    """The stored team columns; text that is no number becomes NULL."""
    return _typed(df, BRONZE_TEAMS, TEAM_NUMBERS)


def type_bronze_matches(df: DataFrame) -> DataFrame:
    """The stored match columns; text that is no number becomes NULL."""
    return _typed(df, BRONZE_MATCHES, MATCH_NUMBERS)


def league_config(spark: SparkSession, leagues: Sequence[tuple[str, str, str]] = LEAGUES):
    """The configured leagues in load order: name, source (id), season, load_order."""
    rows = [(name, league_id, season, i) for i, (name, league_id, season) in enumerate(leagues)]
    return spark.createDataFrame(
        rows, "league string, source string, season string, load_order int"
    )


def _whole(rows: DataFrame, label: str, numbers: Sequence[str], on_fraction: str) -> DataFrame:
    if on_fraction == "fail":
        whole_numbers(label, numbers).enforce(rows)
    return rows


def read_teams(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    on_empty: str = "fail",
    on_fraction: str = "fail",
    **read,
) -> DataFrame:
    """Landed team responses as stored team rows, first one per id.

    A fraction in a number column is an error, or NULL with ``on_fraction='null'``.
    """
    records = explode_records(read_responses(spark, path, "teams", RAW_TEAM, **read), on_empty)
    first = keep_first(map_teams(records, as_of), ["team_id"], ["source", *ARRIVAL])
    return type_teams(_whole(first, "landed_teams", TEAM_NUMBERS, on_fraction))


def read_matches(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    on_empty: str = "fail",
    on_fraction: str = "fail",
    **read,
) -> DataFrame:
    """Landed match responses as stored match rows, first one per id and load date."""
    records = explode_records(read_responses(spark, path, "events", RAW_MATCH, **read), on_empty)
    first = keep_first(
        map_matches(records, as_of), ["event_id", "extract_date"], ["source", *ARRIVAL]
    )
    return type_bronze_matches(_whole(first, "landed_matches", MATCH_NUMBERS, on_fraction))


@dataclass(frozen=True)
class Ingest:
    """Mapped rows of all good sources (numbers still text) and the sources' state."""

    teams: DataFrame
    matches: DataFrame
    health: DataFrame
    broken: DataFrame
    staged_teams: Staged
    staged_matches: Staged
    staged_sources: tuple[Staged, ...] = ()

    def discard(self) -> None:
        """Delete the staged parse; no frame of this ingest can be read after it."""
        for staged in (self.staged_teams, self.staged_matches, *self.staged_sources):
            staged.discard()


def _fractional(numbers: Sequence[str]) -> Column:
    return reduce(or_, [not_integral(c) for c in numbers])


def source_health(
    teams: DataFrame, matches: DataFrame, expected: DataFrame | None = None
) -> DataFrame:
    """Per source: teams, matches, finished matches, broken responses, records
    with a fraction where a whole number belongs, a status.

    ``unlisted``: landed, but not among the configured sources; left out.
    ``no_teams``: the source is left out as a whole. ``bad_number``: its matches
    are left out, and its teams too if the fraction is in one of them.
    ``no_matches``: its teams are kept. ``ok``: both kinds are loaded. A
    configured source that landed nothing shows as ``no_teams``.
    """
    zero = F.lit(0).cast("bigint")
    record = F.col("_position").isNotNull().cast("bigint")
    broken = F.col("broken").isNotNull().cast("bigint").alias("n_broken")
    played = finished("status").cast("bigint")
    rows = teams.select(
        "source", record.alias("n_teams"), zero.alias("n_matches"), zero.alias("n_finished"), broken,
        _fractional(TEAM_NUMBERS).cast("bigint").alias("n_fractional"),
        F.lit(expected is None).alias("listed"),
    ).unionByName(
        matches.select(
            "source", zero.alias("n_teams"), record.alias("n_matches"),
            played.alias("n_finished"), broken,
            _fractional(MATCH_NUMBERS).cast("bigint").alias("n_fractional"),
            F.lit(expected is None).alias("listed"),
        )
    )
    counts = [c for c in rows.columns if c.startswith("n_")]
    if expected is not None:
        rows = rows.unionByName(
            expected.select("source", *[zero.alias(c) for c in counts], F.lit(True).alias("listed"))
        )
    status = (
        F.when(~F.col("listed"), "unlisted")
        .when(F.col("n_teams") == 0, "no_teams")
        .when(F.col("n_fractional") > 0, "bad_number")
        .when(F.col("n_matches") == 0, "no_matches")
        .otherwise("ok")
    )
    return (
        rows.groupBy("source")
        .agg(*[F.sum(c).alias(c) for c in counts], F.bool_or("listed").alias("listed"))
        .withColumn("status", status)
        .drop("listed")
    )


def ingest(
    spark: SparkSession,
    teams_path: str,
    matches_path: str,
    as_of: datetime,
    leagues: Sequence[tuple[str, str, str]] | None = None,
    whole_files: bool = False,
    place: Callable[[DataFrame, int], DataFrame] | None = None,
) -> Ingest:
    """All landed sources together; a bad source is left out, not fatal.

    With ``leagues`` given, only those sources are loaded and "first" follows
    their order; otherwise sources are taken in the order of their names. The
    JSON is parsed once: rows, health and broken text all come from the staged
    parse. The lists of sources, a row for each, are stored, so that Catalyst knows
    their size and broadcasts them: shuffled by its source, a large source would be
    one task's. ``place`` puts the match rows, at most so many, where their table wants
    them: by event, as the choice of the first copy wants them too.
    """
    expected = league_config(spark, leagues) if leagues is not None else None
    arrival = ["source" if expected is None else "_load_order", *ARRIVAL]

    def landed(path: str, field: str, record, mapping) -> Staged:
        responses = read_responses(spark, path, field, record, whole_files)
        if expected is not None:
            order = expected.select("source", F.col("load_order").alias("_load_order"))
            responses = responses.join(F.broadcast(order), "source", "left")  # the caller's list
        rest = [c for c in responses.columns if c != "records"]
        every = responses.select(
            *rest, F.posexplode_outer("records").alias("_position", "record")
        )
        return stage(mapping(every, as_of), field)

    all_teams = landed(teams_path, "teams", RAW_TEAM, map_teams)
    all_matches = landed(matches_path, "events", RAW_MATCH, map_matches)
    health = source_health(all_teams.df, all_matches.df, expected)

    listed: list[Staged] = []

    def sources(rows: DataFrame, label: str) -> DataFrame:
        listed.append(stage(rows.select("source").distinct(), label))
        return listed[-1].df

    def usable(staged: Staged, numbers: Sequence[str]) -> DataFrame:
        """Records of listed sources in which no record of this kind has a fraction."""
        rows = staged.df.where("_position IS NOT NULL")
        bad = sources(rows.where(_fractional(numbers)), "fractional-sources")
        if expected is not None:
            rows = rows.where("_load_order IS NOT NULL")
        return rows.join(bad, "source", "left_anti")

    team_rows = usable(all_teams, TEAM_NUMBERS)
    with_teams = sources(team_rows, "sources-with-teams")
    match_rows = usable(all_matches, MATCH_NUMBERS).join(with_teams, "source", "left_semi")
    if match_rows.isEmpty():
        raise EmptySource("no source returned matches")
    if place is not None:
        match_rows = place(match_rows, all_matches.df.count())
    return Ingest(
        teams=keep_first(team_rows, ["team_id"], arrival).select(*TEAM_COLUMNS),
        matches=keep_first(match_rows, ["event_id", "extract_date"], arrival).select(
            *MATCH_COLUMNS
        ),
        health=health,
        broken=all_teams.df.where("broken IS NOT NULL")
        .select(F.lit("teams").alias("kind"), "source", "broken")
        .unionByName(
            all_matches.df.where("broken IS NOT NULL").select(
                F.lit("matches").alias("kind"), "source", "broken"
            )
        ),
        staged_teams=all_teams,
        staged_matches=all_matches,
        staged_sources=tuple(listed),
    )
