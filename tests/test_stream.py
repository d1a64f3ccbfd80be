import json
import os
from datetime import datetime

import pytest

from conftest import rows
from matchstrata.schema import (
    BRONZE_TEAMS,
    MATCH_COLUMNS,
    PUBLISHED_MATCHES,
    PUBLISHED_TEAMS,
    TEAM_COLUMNS,
)
from matchstrata.session import scratch_path
from matchstrata.sources import messages
from matchstrata.streaming import BronzeStream


def team(team_id, name, **values):
    fields = dict.fromkeys(TEAM_COLUMNS)
    return {**fields, "team_id": team_id, "name": name, "venue_capacity": "50000", **values}


def match(event_id, **values):
    fields = dict.fromkeys(MATCH_COLUMNS)
    return {**fields, "event_id": event_id, "home_score": "1", "away_score": "0",
            "extract_date": "2024-01-01", **values}


class Topic:
    """A folder of message files, one file per call, offsets counted up."""

    def __init__(self, folder):
        self.folder, self.offset = folder, 0
        folder.mkdir()

    def send(self, *items):
        lines = []
        for topic, value in items:
            text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
            lines.append(json.dumps({"topic": topic, "key": "", "value": text, "offset": self.offset}))
            self.offset += 1
        (self.folder / f"{self.offset:06d}.json").write_text("\n".join(lines) + "\n", "utf-8")


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


@pytest.fixture
def sink(spark):
    root = scratch_path(spark, "sink")
    return BronzeStream(spark, f"{root}/teams", f"{root}/matches", f"{root}/rejected")


def drain(spark, sink, topic, tmp_path, files_per_batch=None):
    stream = messages.file_stream(spark, str(topic.folder), files_per_batch)
    sink.start(stream, str(tmp_path / "checkpoint")).awaitTermination()


def test_teams_and_matches_reach_their_tables(spark, sink, topic, tmp_path):
    topic.send(("equipos", team("1", "North")), ("equipos", team("2", "Sürd")), ("partidos", match("m")))
    drain(spark, sink, topic, tmp_path)
    assert sink.teams.schema() == BRONZE_TEAMS
    assert rows(sink.teams.read(), "team_id", "name", "venue_capacity") == [
        ("1", "North", 50000), ("2", "Sürd", 50000)]
    assert rows(sink.matches.read(), "event_id", "home_score") == [("m", 1)]
    assert rows(sink.counts.read(), "topic", "n_messages", "n_rejected", "n_upserted") == [
        ("equipos", 2, 0, 2), ("partidos", 1, 0, 1)]


def test_last_message_wins_within_and_across_batches(spark, sink, topic, tmp_path):
    topic.send(("equipos", team("1", "a")), ("equipos", team("1", "b")))
    topic.send(("equipos", team("1", "c")), ("equipos", team("2", "x")))
    drain(spark, sink, topic, tmp_path, files_per_batch=1)
    assert rows(sink.teams.read(), "team_id", "name") == [("1", "c"), ("2", "x")]
    assert rows(sink.counts.read(), "batch_id", "topic", "n_upserted") == [(0, "equipos", 1), (1, "equipos", 2)]


def test_a_fresh_checkpoint_loses_nothing(spark, sink, topic, tmp_path):
    topic.send(("equipos", team("1", "a")), ("nowhere", "{}"))
    drain(spark, sink, topic, tmp_path)
    topic.send(("equipos", team("2", "b")), ("partidos", "{cut"))
    (tmp_path / "elsewhere").mkdir()
    drain(spark, sink, topic, tmp_path / "elsewhere")
    assert rows(sink.teams.read(), "team_id") == [("1",), ("2",)]
    # The first file is read again under the new checkpoint: its rejected message is kept again.
    assert rows(sink.rejected.read(), "topic") == [("nowhere",), ("nowhere",), ("partidos",)]


def test_time_decides_between_partitions_of_a_topic(spark, sink):
    at = [datetime(2024, 1, 1, 10, minute) for minute in (5, 9, 7)]
    batch = spark.createDataFrame(
        [("equipos", "1", json.dumps(team("1", name)), 4, part, t, None) for name, part, t in zip("abc", (0, 1, 2), at)],
        messages.MESSAGE)
    sink.process(batch, 0)
    assert rows(sink.teams.read(), "name") == [("b",)]


def test_restart_from_the_checkpoint_reads_only_what_is_new(spark, sink, topic, tmp_path):
    topic.send(("partidos", match("m", home_score="1")))
    drain(spark, sink, topic, tmp_path)
    version = sink.matches.version()
    drain(spark, sink, topic, tmp_path)
    assert sink.matches.version() == version
    topic.send(("partidos", match("m", home_score="4", extract_date="2024-01-02")))
    drain(spark, sink, topic, tmp_path)
    assert rows(sink.matches.read(), "event_id", "home_score", "extract_date") == [("m", 4, "2024-01-02")]


def test_a_replayed_batch_changes_nothing(spark, sink, topic, tmp_path):
    topic.send(("equipos", team("1", "North")), ("nowhere", "{}"))
    drain(spark, sink, topic, tmp_path)
    batch = spark.createDataFrame(
        [("equipos", "1", json.dumps(team("1", "North")), 0, 0, None, None), ("nowhere", "", "{}", 1, 0, None, None)], messages.MESSAGE)
    for _ in range(2):
        sink.process(batch, 0)
        assert rows(sink.teams.read(), "team_id", "name") == [("1", "North")]
        assert rows(sink.rejected.read(), "batch_id", "topic") == [(0, "nowhere")]
        assert rows(sink.counts.read(), "topic", "n_messages", "n_rejected", "n_upserted") == [("equipos", 1, 0, 1), (None, 1, 1, 0)]
    assert {r["stream_id"] for r in sink.counts.read().collect()} == {sink.stream_id()}


def test_bad_messages_are_kept_aside_with_the_reason(spark, sink, topic, tmp_path):
    topic.send(
        ("otros", team("1", "x")), ("equipos", "{cut"), ("equipos", "[1]"), ("equipos", "5"),
        ("equipos", '{"team_id":"1"} tail'), ("equipos", "null"), ("equipos", ""),
        ("equipos", team("1", "x", venue_capacity="2.5")), ("equipos", team("2", None)),
        ("partidos", match(None)), ("partidos", match("m", home_score="0.5")),
        ("equipos", team("9", "good")),
    )
    drain(spark, sink, topic, tmp_path)
    assert rows(sink.rejected.read(), "offset", "reason") == [
        (0, "unknown_topic"), (1, "not_a_json_object"), (10, "fractional_number"),
        (2, "not_a_json_object"), (3, "not_a_json_object"), (4, "not_a_json_object"),
        (5, "not_a_json_object"), (6, "not_a_json_object"), (7, "fractional_number"),
        (8, "constraint"), (9, "constraint")]
    assert rows(sink.teams.read(), "team_id") == [("9",)]


def test_stream_merges_by_id_over_all_days_of_the_batch_load(spark, sink, topic, tmp_path):
    """Copies of a match on several days all take the message's values."""
    from matchstrata.plans.jobs import load_matches
    from matchstrata.sources.envelopes import type_bronze_matches

    text = ", ".join(f"{c} string" for c in MATCH_COLUMNS)
    days = [tuple(match("m", extract_date=d).values()) for d in ("2024-01-01", "2024-01-02")]
    load_matches(type_bronze_matches(spark.createDataFrame(days, text)), sink.matches)
    topic.send(("partidos", match("m", home_score="7", extract_date="2024-01-03")))
    drain(spark, sink, topic, tmp_path)
    assert rows(sink.matches.read(), "event_id", "home_score", "extract_date") == [
        ("m", 7, "2024-01-03")] * 2


def test_messages_under_published_names(spark, tmp_path):
    df = spark.createDataFrame([tuple(team("1", "Ñandú").values()), tuple(team(None, "x").values())],
                               ", ".join(f"{c} string" for c in TEAM_COLUMNS))
    sent = messages.to_messages(df, "equipos", "team_id", PUBLISHED_TEAMS)
    values = {r["key"]: json.loads(r["value"]) for r in sent.collect()}
    assert set(values) == {"1", ""} and values["1"]["nombre"] == "Ñandú"
    assert values["1"]["ciudad"] is None and list(values["1"]) == list(PUBLISHED_TEAMS.values())
    assert "Ñandú" in sent.where("key = '1'").first()["value"]

    root = scratch_path(spark, "published")
    messages.publish(sent.selectExpr("*", "0L AS offset"), f"{root}/topic")
    sink = BronzeStream(spark, f"{root}/t", f"{root}/m", f"{root}/r",
                        names={"equipos": PUBLISHED_TEAMS, "partidos": PUBLISHED_MATCHES})
    sink.start(messages.file_stream(spark, f"{root}/topic"), f"{root}/c").awaitTermination()
    assert rows(sink.teams.read(), "team_id", "name") == [("1", "Ñandú")]
    with pytest.raises(ValueError):
        messages.publish(sent)


def test_feed_lines(spark):
    df = spark.createDataFrame(
        [("equipos", "1", json.dumps(team("1", "North", city="C", venue="V")), 0, 0, None, None),
         ("partidos", "m", json.dumps(match("m", home_team="A", away_team="B", status="FT",
                                            event_date="2024-02-02")), 1, 0, None, None),
         ("equipos", "2", "{cut", 3, 0, None, None), ("partidos", "n", "[1]", 4, 0, None, None),
         ("otros", "", "{}", 2, 0, None, None)], messages.MESSAGE)
    assert [r["line"] for r in messages.feed_line(df).orderBy("topic").collect()] == [
        "EQUIPO | North | Ciudad: C | Estadio: V",
        "Mensaje de tópico desconocido: otros",
        "PARTIDO | A vs B | 1-0 | Fecha: 2024-02-02 | Estado: FT"]


def test_connector_messages_are_decoded(spark):
    raw = spark.sql("SELECT 'equipos' AS topic, CAST('k' AS BINARY) AS key, "
                    "CAST('{\"name\":\"ñ\"}' AS BINARY) AS value, 7L AS offset, 3 AS partition, TIMESTAMP '2024-01-02 03:04:05' AS timestamp")
    assert rows(messages.decoded(raw)) == [
        ("equipos", "k", '{"name":"ñ"}', 7, 3, datetime(2024, 1, 2, 3, 4, 5), None)]


def test_bytes_that_are_no_text_end_in_quarantine(spark, sink):
    raw = spark.sql("""SELECT 'equipos' AS topic, key, value, n AS offset, 0 AS partition, TIMESTAMP '2024-01-02 03:04:05' AS timestamp
        FROM VALUES (X'FF', X'7B22C3', 1L), (CAST('k' AS BINARY), CAST('{"team_id":"1","name":"ñ"}' AS BINARY), 2L),
                    (NULL, NULL, 3L), (X'', X'', 4L) AS t(key, value, n)""")
    read = messages.decoded(raw)
    assert rows(read, "offset", "key", "value", "undecoded") == [
        (1, "/w==", None, "eyLD"), (2, "k", '{"team_id":"1","name":"ñ"}', None), (3, None, None, None), (4, "", "", None)]
    sink.process(read, 0)
    assert rows(sink.teams.read(), "team_id", "name") == [("1", "ñ")]
    assert rows(sink.rejected.read(), "offset", "value", "reason") == [
        (1, "eyLD", "not_utf8"), (3, None, "not_a_json_object"), (4, "", "not_a_json_object")]


def test_admission_by_bytes_makes_several_batches_and_archives_what_is_done(spark, topic, tmp_path):
    for i in range(6):
        topic.send(("equipos", team(str(i % 4), f"name {i}")), ("nowhere", "{}"))
    for i, file in enumerate(sorted(topic.folder.iterdir())):
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # files come in the order of their times
    found = {}
    for label, options in {"one": {}, "several": {"bytes_per_batch": 1, "archive": str(tmp_path / "done")}}.items():
        root = scratch_path(spark, label)
        sink = BronzeStream(spark, f"{root}/t", f"{root}/m", f"{root}/r")
        stream = messages.file_stream(spark, str(topic.folder), **options)
        sink.start(stream, f"{root}/checkpoint").awaitTermination()
        counts = sink.counts.read()
        found[label] = (
            rows(sink.teams.read(), "team_id", "name"), rows(sink.rejected.read(), "topic", "offset"),
            counts.where("topic = 'equipos'").agg({"n_messages": "sum"}).first()[0])
        assert counts.select("batch_id").distinct().count() == {"one": 1, "several": 6}[label]
    assert found["one"] == found["several"]
    left = len(list(topic.folder.glob("*.json")))
    assert left < 6 and left + len(list((tmp_path / "done").rglob("*.json"))) == 6


def test_published_messages_may_be_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(messages, "FILE_MESSAGES", 10)
    sent = spark.range(25).coalesce(1).selectExpr("'partidos' AS topic", "string(id) AS key", "'{}' AS value")
    messages.publish(sent, str(tmp_path / "topic"), compression="lz4")
    assert len(list((tmp_path / "topic").glob("part-*.json.lz4"))) == 3
    back = spark.read.schema(messages.MESSAGE).json(str(tmp_path / "topic"))
    assert rows(back, "key") == rows(sent, "key")
