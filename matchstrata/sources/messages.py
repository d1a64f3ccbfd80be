"""Keyed JSON messages: building, publishing, reading as a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from ..schema import MATCH_TOPIC, TEAM_TOPIC

MESSAGE = StructType(
    [
        StructField("topic", StringType()),
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("offset", LongType()),
        StructField("partition", IntegerType()),
        StructField("timestamp", TimestampType()),
        StructField("undecoded", StringType()),
    ]
)

# Offsets count within one partition of a topic; between partitions time decides.
ARRIVAL_ORDER = ("timestamp", "partition", "offset")


def to_messages(
    df: DataFrame, topic: str, key: str, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows as (topic, key, value): the key as text, the row as a JSON object.

    NULL fields stay in the object; ``names`` gives fields their published
    names. A row without key gets the empty text.
    """
    fields = [F.col(f"`{c}`").alias((names or {}).get(c, c)) for c in df.columns]
    return df.select(
        F.lit(topic).alias("topic"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


#: Messages in one file of a folder: a compressed file is read by one task.
FILE_MESSAGES = 500_000


def publish(
    messages: DataFrame,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    compression: str | None = None,
):
    """Append messages to a topic (connector options given) or to a JSON folder.

    ``compression`` names the codec of the folder's files, which readers tell by their names.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a path or connector options")
    if kafka is not None:
        encoded = messages.select(
            "topic", F.col("key").cast("binary"), F.col("value").cast("binary")
        )
        encoded.write.format("kafka").options(**kafka).save()
    else:
        writer = messages.write.mode("append").option("maxRecordsPerFile", FILE_MESSAGES)
        writer.json(path, compression=compression)


def file_stream(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Messages landed as JSON files, oldest files first.

    A batch admits at most so many files, or files of so many bytes together (one
    file at least), also when a run catches up with all that is there. Files of a
    finished batch move below ``archive``, which lies outside ``path``.
    """
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def kafka_stream(
    spark: SparkSession,
    options: Mapping[str, str],
    topics: Sequence[str] = (TEAM_TOPIC, MATCH_TOPIC),
    messages_per_batch: int | None = None,
) -> DataFrame:
    """Messages of the topics from their earliest offset.

    Offsets are kept in the query's checkpoint; ``options`` carries the broker
    addresses and the security settings.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if messages_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    return decoded(reader.load())


def decoded(raw: DataFrame) -> DataFrame:
    """Binary key and value as UTF-8 text.

    A value of other bytes is NULL and stands in ``undecoded``, base64-encoded; a
    key of other bytes is given base64-encoded.
    """
    value, key = F.col("value").cast("string"), F.col("key").cast("string")
    valid = F.is_valid_utf8(value)
    return raw.select(
        "topic",
        F.when(F.is_valid_utf8(key), key).otherwise(F.base64("key")).alias("key"),
        F.when(valid, value).alias("value"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("partition").cast("int").alias("partition"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.when(~valid, F.base64("value")).alias("undecoded"),
    )


def parsed(
    columns: Sequence[str], names: Mapping[str, str] | None = None, value: Column | str = "value"
) -> Column:
    """The JSON value as a struct of texts under its own keys.

    Select it under a name first and use :func:`is_object` and :func:`fields`
    on that name: the text is then parsed once per row.
    """
    keys = [(names or {}).get(c, c) for c in columns]
    layout = StructType([StructField(k, StringType()) for k in [*keys, "_broken"]])
    return F.from_json(value, layout, {"columnNameOfCorruptRecord": "_broken"})


def is_object(value: str, tree: str) -> Column:
    """Whether the text is one JSON object and nothing else."""
    text = F.btrim(value, F.lit(" \t\r\n"))
    whole = (
        text.startswith("{") & text.endswith("}")
        & F.col(tree).isNotNull() & F.col(f"{tree}._broken").isNull()
    )
    return F.coalesce(whole, F.lit(False))


def fields(
    tree: str, columns: Sequence[str], names: Mapping[str, str] | None = None
) -> list[Column]:
    """The columns of a parsed value under their own names."""
    return [F.col(f"{tree}.{(names or {}).get(c, c)}").alias(c) for c in columns]


def feed_line(messages: DataFrame, names: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """One readable line per message, for a console sink.

    Messages whose text is no JSON object show no line, whatever their topic.
    """
    names = names or {}
    team = ("name", "city", "venue")
    match = ("home_team", "away_team", "home_score", "away_score", "event_date", "status")
    is_match = F.coalesce(F.col("topic") == MATCH_TOPIC, F.lit(False))
    trees = messages.select(  # each value is parsed under one layout, that of its topic
        "topic", "key", "value",
        parsed(team, names.get(TEAM_TOPIC), F.when(~is_match, F.col("value"))).alias("team"),
        parsed(match, names.get(MATCH_TOPIC), F.when(is_match, F.col("value"))).alias("match"),
    )

    def shown(tree: str, columns: Sequence[str], topic: str) -> list[Column]:
        return [F.coalesce(c, F.lit("None")) for c in fields(tree, columns, names.get(topic))]

    # Wording of the lines.
    line = (
        F.when(
            F.col("topic") == TEAM_TOPIC,
            F.format_string(
                "EQUIPO | %s | Ciudad: %s | Estadio: %s", *shown("team", team, TEAM_TOPIC)
            ),
        )
        .when(
            F.col("topic") == MATCH_TOPIC,
            F.format_string(
                "PARTIDO | %s vs %s | %s-%s | Fecha: %s | Estado: %s",
                *shown("match", match, MATCH_TOPIC),
            ),
        )
        .otherwise(F.concat(F.lit("Mensaje de tópico desconocido: "), F.col("topic")))
    )
    shows = F.when(F.col("topic") == MATCH_TOPIC, is_object("value", "match")).otherwise(
        is_object("value", "team")
    )
    return trees.where(shows).select("topic", "key", line.alias("line"))
