import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from slumberline.functions.messages import decode_messages, encode_messages, may_concern
from slumberline.rules import SleepRule
from slumberline.sources import topic as topics
from slumberline.sources.topic import (
    Topic,
    peek,
    publish_files,
    read_message_files,
    read_options,
    read_topic,
    stream_topic,
    write_options,
)
from slumberline.streaming.scoring import scorable_rows

CASES = {
    '{"timestamp": 1700000000123, "sensor_id": "P02", "value": 612.5}': (1700000000123, "P02", 612.5),
    "not json": (None, None, None),
    '{"timestamp":"x","sensor_id":"P02","value":2}': (None, "P02", 2.0),
    '{"sensor_id":"P02","extra":1}': (None, "P02", None),
    '{"timestamp":1.5,"sensor_id":5,"value":"3"}': (None, "5", None),
    '{"timestamp":1,"sensor_id":"P02","value":1}{"x":1}': (1, "P02", 1.0),
    None: (None, None, None),
}


@pytest.mark.parametrize("text, expected", CASES.items())
def test_decoding(spark, text, expected):
    records = spark.createDataFrame([(text,)], "value string").select(F.col("value").cast("binary"))
    assert tuple(decode_messages(records).first()) == expected
    assert tuple(decode_messages(records, keep_corrupt=True).first())[:3] == expected


def test_text_of_bad_messages_is_kept_on_request(spark):
    records = spark.createDataFrame([(text,) for text in CASES], "value string")
    bad = {row["_corrupt_record"] for row in decode_messages(records, keep_corrupt=True).collect()} - {None}
    assert "not json" in bad and '{"timestamp":"x","sensor_id":"P02","value":2}' in bad
    assert '{"sensor_id":"P02","extra":1}' not in bad


TOKENS = ["P02", "P0", "p02", "5892", "5", "-5", "5.0", "true", "NaN", "1e2", "100.0", "A B", 'q"', "back\\slash", "é"]


def spelled(rng, text):
    """One of the ways to write an id in a message."""
    return rng.choice(
        [
            lambda: json.dumps(text),
            lambda: json.dumps(text, ensure_ascii=False),
            lambda: '"' + "".join(f"\\u{ord(c):04x}" if rng.random() < 0.5 else json.dumps(c)[1:-1] for c in text) + '"',
            lambda: "'" + text + "'",
            lambda: text,
            lambda: "[" + json.dumps(text) + "]",
            lambda: '{"sensor_id":' + json.dumps(text) + "}",
        ]
    )()


@pytest.mark.parametrize("sensor_id", TOKENS)
def test_no_message_of_the_sensor_is_passed_over_unparsed(spark, sensor_id):
    rng = random.Random(23)
    texts = []
    for token in TOKENS:
        for _ in range(60):
            field = rng.choice(["sensor_id", "sensor_id", "other", "Sensor_ID"])
            space = rng.choice(["", " ", "\t"])
            texts.append(f'{{"timestamp":{rng.randrange(9)},{space}"{field}"{space}:{spelled(rng, token)},"value":1}}')
    texts += [text[: rng.randrange(len(text))] for text in texts[::5]]
    records = spark.createDataFrame([(text,) for text in texts], "value string")
    records = records.select(F.col("value").cast("binary"))
    rule = SleepRule(sensor_id=sensor_id)
    kept, every = scorable_rows(records, rule), scorable_rows(records, rule, audit=True)
    assert kept.exceptAll(every).isEmpty() and every.exceptAll(kept).isEmpty()
    if sensor_id == "P02":
        assert every.count() > 10
        assert 0 < records.filter(may_concern(sensor_id)).count() < records.count() / 2


def test_roundtrip_through_files(spark, tmp_path):
    events = spark.createDataFrame(
        [(1, "P02", 6.55), (2, 'q"uo\\te é', None), (None, "M04", float("inf"))],
        "timestamp long, sensor_id string, value float",
    )
    path = str(tmp_path / "topic")
    publish_files(encode_messages(events), path)
    publish_files(encode_messages(events), path)
    back = decode_messages(read_message_files(spark, path))
    assert back.exceptAll(events.union(events)).isEmpty() and back.count() == 6


def topic_records(spark, n):
    return spark.range(n - 1, -1, -1, numPartitions=4).select(
        F.col("id").alias("offset"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.lit("k").alias("key"),
        F.format_string('{"timestamp":%d,"sensor_id":"P02","value":1.5}', "id").cast("binary").alias("value"),
    )


@pytest.mark.parametrize("columnar", [False, True])
@pytest.mark.parametrize("n", [0, 3, 40])
def test_peek_takes_the_first_offsets(spark, n, columnar):
    found = peek(topic_records(spark, n), columnar=columnar).collect()
    assert [row["offset"] for row in found] == list(range(min(n, 10)))
    assert all(row["timestamp"] == row["offset"] and row["key"] == "k" for row in found)


@pytest.mark.parametrize("columnar", [False, True])
def test_peek_over_partitions(spark, columnar):
    found = peek(topic_records(spark, 12), 6, position=("partition", "offset"), columnar=columnar).collect()
    assert [(row["partition"], row["offset"]) for row in found] == [(0, 0), (0, 3), (0, 6), (0, 9), (1, 1), (1, 4)]


@pytest.mark.parametrize("n, expected", [(0, []), (2, [(0, 0), (0, 3)]), (6, [(0, 0), (0, 3), (0, 6), (0, 9), (1, 1), (1, 4)])])
def test_peek_at_a_broker_reads_partition_by_partition(spark, monkeypatch, n, expected):
    read = []

    def partition_of(spark, topic, partition):
        read.append(topic_records(spark, 12).filter(F.col("partition") == partition).coalesce(1).sortWithinPartitions("offset"))
        return read[-1]

    monkeypatch.setattr(topics, "read_partition", partition_of)
    found = topics.peek_topic(spark, Topic("events", "host:9092"), n, partitions=(1, 0, 2))
    assert [(row["partition"], row["offset"]) for row in found.collect()] == expected
    assert all(row["timestamp"] == row["offset"] and row["key"] == "k" for row in found.collect())
    assert len(read) == (2 if n == 6 else 1)


def test_peek_finds_fewer_records_than_asked_for(spark, monkeypatch):
    monkeypatch.setattr(topics, "read_partition", lambda spark, topic, p: topic_records(spark, 12).filter(F.col("partition") == p))
    assert topics.peek_topic(spark, Topic("events", "host:9092"), 50, partitions=(0, 1)).count() == 8


def test_a_partition_is_assigned_not_subscribed():
    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            self.given = options
            return self

        def load(self):
            return self.given

    session = type("Session", (), {"read": Reader()})
    given = topics.read_partition(session, Topic("events", "host:9092"), 3)
    assert given["assign"] == '{"events": [3]}' and given["startingOffsets"] == "earliest" and "subscribe" not in given


def test_peek_in_source_order(spark):
    assert peek(topic_records(spark, 12), 4, position=()).count() == 4


def test_broker_options():
    topic = Topic("events", "host:9092")
    assert read_options(topic, "latest", 500) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "events",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500",
    }
    assert "maxOffsetsPerTrigger" not in read_options(topic, "earliest")
    assert write_options(topic) == {"kafka.bootstrap.servers": "host:9092", "topic": "events"}


def test_without_the_connector_the_broker_is_refused_at_once(spark):
    for read in (stream_topic, read_topic):
        with pytest.raises(AnalysisException, match="kafka"):
            read(spark, Topic())


def test_a_peek_at_a_broker_looks_into_all_partitions(spark, monkeypatch, tmp_path):
    """Most partitions are empty, or hold fewer records than wanted."""
    rows = [(p, o, b"k", ('{"timestamp":%d,"sensor_id":"click","value":1,"extra":{"p":%d}}' % (o, p)).encode()) for p, n in ((3, 2), (5, 3), (6, 50)) for o in range(n)]
    kind = "partition int, offset bigint, key binary, value binary"

    def of_partitions(session, topic):
        parts = [spark.createDataFrame([r for r in rows if r[0] == p], kind).coalesce(1) for p in range(8)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole.withColumn("topic", F.lit(topic.name))

    monkeypatch.setattr(topics, "read_topic", of_partitions)
    found = topics.peek_topic(spark, Topic("events", "host:9092"), 10)
    places = [(r["partition"], r["offset"]) for r in found.collect()]
    assert len(places) == 10 and places == sorted(places) and set(places) <= {r[:2] for r in rows}
    assert topics.peek_topic(spark, Topic("events", "host:9092"), 100).count() == 55
    any_shape = topics.peek_topic(spark, Topic("events", "host:9092"), 5, any_shape=True)
    assert any_shape.columns == ["partition", "offset", "key", "data", "text"]
    extra = any_shape.select(F.try_variant_get("data", "$.extra.p", "int").alias("p"), "partition").collect()
    assert len(extra) == 5 and all(r["p"] == r["partition"] for r in extra)


def test_peek_at_messages_of_any_shape(spark):
    rows = ['{"a":1,"b":{"c":[1,2]},"s":"x","d":1.50,"n":null}', '[1,"z"]', "oops", "7", None, "{}"]
    records = spark.createDataFrame([(i, b"k", v) for i, v in enumerate(rows)], "offset bigint, key binary, value string")
    peeked = topics.peek_any(records, 6)
    assert [r["text"] for r in peeked.collect()] == [None, None, "oops", None, None, None]
    fields = topics.message_fields(peeked)
    assert fields.columns == ["offset", "key", "field", "type", "data"]
    found = sorted((r[0], r[1] or "", r[2], r[3]) for r in fields.select("offset", "field", "type", F.to_json("data")).collect())
    assert found == [
        (0, "a", "BIGINT", "1"), (0, "b", "OBJECT<c: ARRAY<BIGINT>>", '{"c":[1,2]}'), (0, "d", "DECIMAL(2,1)", "1.5"),
        (0, "n", "VOID", "null"), (0, "s", "STRING", '"x"'), (1, "0", "BIGINT", "1"), (1, "1", "STRING", '"z"'),
        (2, "", None, None), (3, "", "BIGINT", "7"), (4, "", None, None), (5, "", "OBJECT<>", "{}"),
    ]
    assert topics.peek_any(records, 2, position=()).count() == 2
