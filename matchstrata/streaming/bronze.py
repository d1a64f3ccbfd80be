"""Message stream into the bronze tables, one upsert per topic and micro-batch."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import not_integral
from ..operators.dedup import keep_last
from ..schema import (
    BRONZE_MATCHES,
    BRONZE_TEAMS,
    MATCH_CHECKS,
    MATCH_COLUMNS,
    MATCH_NUMBERS,
    MATCH_TOPIC,
    TEAM_CHECKS,
    TEAM_COLUMNS,
    TEAM_NUMBERS,
    TEAM_TOPIC,
)
from ..session import stage
from ..sources.envelopes import type_bronze_matches, type_teams
from ..sources.messages import ARRIVAL_ORDER, fields, is_object, parsed
from ..sources.tables import LakeTable

REJECTED = StructType(
    [
        StructField("stream_id", StringType()),
        StructField("batch_id", LongType()),
        StructField("topic", StringType()),
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("offset", LongType()),
        StructField("reason", StringType()),
    ]
)


COUNTS = StructType(
    [
        StructField("stream_id", StringType()),
        StructField("batch_id", LongType()),
        StructField("topic", StringType()),
        StructField("n_messages", LongType()),
        StructField("n_rejected", LongType()),
        StructField("n_upserted", LongType()),
    ]
)


class BronzeStream:
    """Keeps the newest message per id in the tables the batch load fills too.

    A micro-batch is parsed once and staged by kind; each kind is typed,
    reduced to the last message per id, and upserted. Messages of an unknown
    topic, text that is no JSON object, fractional numbers and rows that would
    break a table constraint go to the quarantine table with the reason.

    A batch replayed after a failure changes nothing: the upserts give the same
    tables again, and rejected messages and counts land in a partition of their
    own (the id in the stream's checkpoint, the batch's number), which the replay
    overwrites. A fresh checkpoint has a new id, so its batches, counted from 0
    again, are all taken.

    ``counts`` holds a row for each batch and topic (NULL: all unknown topics
    together): messages that came, messages rejected, rows upserted (one per id).
    They are observed while the batch is written; nothing is aggregated for them.
    """

    def __init__(
        self,
        spark: SparkSession,
        teams_path: str,
        matches_path: str,
        rejected_path: str,
        team_topic: str = TEAM_TOPIC,
        match_topic: str = MATCH_TOPIC,
        name: str = "bronze",
        names: Mapping[str, Mapping[str, str]] | None = None,
    ):
        self.spark = spark
        self.name = name
        self.team_topic, self.match_topic = team_topic, match_topic
        self.names = names or {}
        self.teams = LakeTable(spark, teams_path).create(BRONZE_TEAMS, checks=TEAM_CHECKS, keys=["team_id"])
        self.matches = LakeTable(spark, matches_path).create(
            BRONZE_MATCHES, partition_by=["extract_date"], checks=MATCH_CHECKS, keys=["event_id"]
        )
        batch = ["stream_id", "batch_id"]
        self.rejected = LakeTable(spark, rejected_path).create(REJECTED, partition_by=batch)
        self.counts = LakeTable(spark, f"{rejected_path.rstrip('/')}_counts").create(COUNTS, partition_by=batch)
        self._checkpoint: str | None = None
        self._stream_id: str | None = None

    def classified(self, messages: DataFrame) -> DataFrame:
        """Messages with their parsed value, a ``kind`` to route by, a reason to reject."""
        is_team = F.col("topic") == self.team_topic
        is_match = F.col("topic") == self.match_topic
        undecoded = F.col("undecoded") if "undecoded" in messages.columns else F.lit(None).cast("string")
        trees = messages.select(
            "topic", "key", F.coalesce("value", undecoded).alias("value"), *ARRIVAL_ORDER,
            undecoded.isNotNull().alias("broken"),
            parsed(TEAM_COLUMNS, self._names(self.team_topic), F.when(is_team, F.col("value")))
            .alias("team"),
            parsed(MATCH_COLUMNS, self._names(self.match_topic), F.when(is_match, F.col("value")))
            .alias("match"),
        )

        def any_fraction(tree: str, topic: str, numbers: tuple[str, ...]) -> Column:
            found = [not_integral(c) for c in fields(tree, numbers, self._names(topic))]
            return reduce(or_, found)

        def any_null(tree: str, topic: str, required: tuple[str, ...]) -> Column:
            return reduce(or_, [c.isNull() for c in fields(tree, required, self._names(topic))])

        whole = F.when(is_team, is_object("value", "team")).otherwise(is_object("value", "match"))
        fraction = F.when(
            is_team, any_fraction("team", self.team_topic, TEAM_NUMBERS)
        ).otherwise(any_fraction("match", self.match_topic, MATCH_NUMBERS))
        keyless = F.when(
            is_team, any_null("team", self.team_topic, ("team_id", "name"))
        ).otherwise(any_null("match", self.match_topic, ("event_id",)))
        reason = (
            F.when(~F.coalesce(is_team | is_match, F.lit(False)), "unknown_topic")
            .when(F.col("broken"), "not_utf8")
            .when(~whole, "not_a_json_object")
            .when(fraction, "fractional_number")
            .when(keyless, "constraint")
        )
        kind = (
            F.when(F.col("reason").isNotNull(), "rejected")
            .when(is_team, "team")
            .otherwise("match")
        )
        return trees.withColumn("reason", reason).withColumn("kind", kind)

    def _names(self, topic: str) -> Mapping[str, str] | None:
        return self.names.get(topic)

    def stream_id(self) -> str | None:
        """The id that the running query keeps in its checkpoint."""
        if self._stream_id is None and self._checkpoint is not None:
            line = self.spark.read.text(f"{self._checkpoint}/metadata").first()
            self._stream_id = json.loads(line["value"])["id"]
        return self._stream_id

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch; safe to repeat with the same ``batch_id``.

        Called by hand, without :meth:`start`, there is no stream id; a repeated
        number then overwrites what was kept under it.
        """
        kinds = {"team": self.team_topic, "match": self.match_topic}
        seen = Observation("messages")
        came = [F.count_if(F.col("topic") == t).alias(k) for k, t in kinds.items()]
        rejected = [
            F.count_if((F.col("topic") == t) & (F.col("kind") == "rejected")).alias(f"{k}_rejected") for k, t in kinds.items()
        ]
        classified = self.classified(batch).observe(
            seen, F.count(F.lit(1)).alias("all"), F.count_if(F.col("kind") == "rejected").alias("all_rejected"), *came, *rejected
        )
        staged = stage(classified, "batch", partition_by=("kind",))
        n = seen.get
        upserted = {}
        for kind, table, typed, key, columns in (
            ("team", self.teams, type_teams, "team_id", TEAM_COLUMNS),
            ("match", self.matches, type_bronze_matches, "event_id", MATCH_COLUMNS),
        ):
            upserted[kind] = 0
            if n[kind] > n[f"{kind}_rejected"]:
                rows = staged.df.where(F.col("kind") == kind).select(
                    *ARRIVAL_ORDER, *fields(kind, columns, self._names(kinds[kind]))
                )
                upserted[kind] = self._upsert(table, typed, rows, key)
        mark = [F.lit(self.stream_id() or "by hand").alias("stream_id"), F.lit(batch_id).cast("bigint").alias("batch_id")]
        if n["all_rejected"]:
            rows = staged.df.where("kind = 'rejected'").select(*mark, "topic", "key", "value", "offset", "reason")
            self.rejected.save(rows, replace_partitions=True)
        if n["all"]:
            counts = [(kinds[k], n[k], n[f"{k}_rejected"], upserted[k]) for k in kinds]
            counts.append((None, n["all"] - sum(n[k] for k in kinds), n["all_rejected"] - sum(n[f"{k}_rejected"] for k in kinds), 0))
            schema = "topic string, n_messages bigint, n_rejected bigint, n_upserted bigint"
            rows = self.spark.createDataFrame([c for c in counts if c[1]], schema).coalesce(1)  # three rows at most
            self.counts.save(rows.select(*mark, "*"), replace_partitions=True)
        staged.discard()

    def _upsert(self, table, typed, rows, key) -> int:
        counted = Observation("latest")
        newest = typed(keep_last(rows, [key], list(ARRIVAL_ORDER))).observe(counted, F.count(F.lit(1)).alias("n"))
        latest = stage(newest, "latest")
        table.upsert(latest, [key], keys_are_unique=True)
        latest.discard()
        return counted.get["n"]

    def start(
        self, messages: DataFrame, checkpoint: str, until_caught_up: bool = True
    ) -> StreamingQuery:
        """Run the stream: to the end of what is there, or on and on."""
        self._checkpoint, self._stream_id = checkpoint, None
        writer = (
            messages.writeStream.queryName(self.name)
            .foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
        )
        if until_caught_up:
            writer = writer.trigger(availableNow=True)
        return writer.start()
