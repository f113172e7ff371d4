"""Decoding, encoding, and storing events."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventide.schemas import USER_EVENT
from eventide.sources import events as io

GOOD = {
    "id": "e1",
    "user_id": "u1",
    "session_id": "s1",
    "event_type": "click",
    "page": "/",
    "duration_ms": 1.5,
    "metadata": {"device": "mobile"},
    "timestamp": "2024-01-01T14:00:00.123456789Z",
}
TEXT = json.dumps(GOOD)
AT = dt.datetime(2024, 1, 1, 14, 0, 0, 123456)


def decode(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    return io.decode_events(df).orderBy("n").collect()


def put(**changes):
    return json.dumps({**GOOD, **changes})


def test_good_record(spark):
    row = decode(spark, TEXT)[0]
    assert row.accepted
    assert tuple(row.event) == ("e1", "u1", "s1", "click", "/", 1.5, {"device": "mobile"}, AT)


def test_absent_and_null_fields_take_zero_values(spark):
    nulls = json.dumps(dict.fromkeys(GOOD))
    for row in decode(spark, "{}", nulls, "null"):
        assert row.accepted
        assert tuple(row.event) == ("", "", "", "", "", 0.0, None, None)


def test_last_of_equal_keys_unknown_keys_and_other_case(spark):
    rows = decode(
        spark,
        '{"id":"first",' + TEXT[1:],
        put(extra=[{"x": None}]),
        TEXT.replace('"id"', '"ID"').replace('"duration_ms"', '"Duration_MS"'),
        TEXT.replace('"metadata"', '"MetaData"').replace('"timestamp"', '"TIMESTAMP"'),
    )
    for row in rows:
        assert row.accepted
        assert (row.event.id, row.event.duration_ms, row.event.timestamp) == ("e1", 1.5, AT)
        assert row.event.metadata == {"device": "mobile"}


@pytest.mark.parametrize(
    "text",
    [
        "",
        None,
        TEXT[:-1],
        TEXT + " x",
        TEXT + TEXT,
        "5",
        "[]",
        put(id=5),
        put(page=True),
        put(user_id={"a": 1}),
        put(duration_ms="1.5"),
        put(duration_ms=[1]),
        put(duration_ms=True),
        TEXT.replace("1.5", "1e400"),
        TEXT.replace("1.5", "NaN"),
        put(metadata=5),
        put(metadata=["a"]),
        put(metadata={"a": 1}),
        put(timestamp=5),
        put(timestamp=""),
        put(timestamp="2024-01-01"),
        put(timestamp="2024-01-01 14:00:00Z"),
        put(timestamp="2024-01-01T14:00:00"),
        put(timestamp="2024-02-30T14:00:00Z"),
        put(timestamp="2024-01-01T24:00:00Z"),
    ],
)
def test_rejected_records(spark, text):
    row = decode(spark, text)[0]
    assert row.accepted is False
    assert row.event is None


def test_zone_offset_and_null_attributes(spark):
    row = decode(spark, put(timestamp="2024-01-01T16:00:00+02:00", metadata={"a": None, "b": "x"}))[0]
    assert row.event.timestamp == dt.datetime(2024, 1, 1, 14)
    assert row.event.metadata == {"a": "", "b": "x"}


def test_repeated_attribute_keeps_the_last(spark):
    row = decode(spark, TEXT.replace('{"device"', '{"device":"x","device"'))[0]
    assert row.event.metadata == {"device": "mobile"}


def test_encode_then_decode(spark):
    rows = [("e1", "u1", "s1", "click", "/a?b=<c>&d", 1.25, {"k": "v"}, AT)]
    rows.append(("e2", "u2", "s2", "login", "/", 0.0, None, AT))
    df = spark.createDataFrame(rows, USER_EVENT)
    encoded = io.encode_events(df)
    assert sorted(r.key for r in encoded.collect()) == ["u1", "u2"]
    back = io.accepted_events(io.decode_events(encoded)).orderBy("id").collect()
    assert [tuple(r) for r in back] == rows


def test_json_lines_sink_and_source(spark, tmp_path):
    df = spark.createDataFrame([("e1", "u1", "s", "click", "/", 1.0, None, AT)], USER_EVENT)
    io.write_json_lines(df, str(tmp_path / "events"))
    records = io.read_json_lines(spark, str(tmp_path / "events"), streaming=False)
    assert records.columns == ["value", "arrival"]
    assert io.accepted_events(io.decode_events(records)).first().id == "e1"


def test_split_is_stored_in_one_table(spark, tmp_path):
    df = spark.createDataFrame([(TEXT,), ("broken",)], "value string")
    path = str(tmp_path / "split")
    io.write_split(io.decode_events(df), "accepted", path, "r1")
    good = io.read_split(spark, "accepted", path)
    assert [r.id for r in good.select("event.id").collect()] == ["e1"]
    bad = io.read_split(spark, "accepted", path, good=False)
    assert [r.value for r in bad.select("value").collect()] == ["broken"]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        io.read_kafka(spark, streaming=False)


def test_filter_on_decoded_columns(spark):
    df = spark.createDataFrame([(TEXT,), (put(page="/x"),), ("broken",)], "value string")
    events = io.accepted_events(io.decode_events(df))
    assert events.filter(F.col("page") == "/x").count() == 1


def test_kafka_options_and_projection(spark):
    assert io.kafka_read_options("b:1", "t", "g", 500) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "kafka.group.id": "g",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
    }
    assert "maxOffsetsPerTrigger" not in io.kafka_read_options("b:1", "t", "g")
    assert io.kafka_write_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "topic": "t"}
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(TEXT.encode()), "t", 0, 5, AT, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    records = io.kafka_records(raw)
    assert records.columns == ["value", "arrival"]
    assert io.accepted_events(io.decode_events(records), "arrival").first().arrival == AT


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('{"id":"a","ID":"b"}', "b"),
        ('{"ID":"a","id":"b"}', "b"),
        ('{"id":"a","ID":5}', None),
        ('{"id":"a","id":null}', "a"),
        ('{"id":"a","duration_ms":"x","duration_ms":5}', None),
        ('{"id":"a","timestamp":"bad","timestamp":"2024-01-01T00:00:00Z"}', None),
    ],
)
def test_keys_are_taken_in_turn(spark, text, found):
    row = decode(spark, text)[0]
    assert row.accepted == (found is not None)
    assert (row.event.id if row.event else None) == found


def test_metadata_objects_are_merged(spark):
    text = '{"metadata":{"a":"1"},"Metadata":{"b":"2","a":null}}'
    assert decode(spark, text)[0].event.metadata == {"a": "", "b": "2"}
    assert decode(spark, '{"metadata":{"a":"1"},"metadata":null}')[0].event.metadata is None


def test_runs_of_events_do_not_replace_one_another(spark, tmp_path):
    path = str(tmp_path / "split")
    for run_id in ("r1", "r2", "r2"):
        df = spark.createDataFrame([(TEXT,), ("broken",)], "value string")
        io.write_split(io.decode_events(df), "accepted", path, run_id)
    assert io.read_split(spark, "accepted", path).count() == 2
    assert io.read_split(spark, "accepted", path, good=False).count() == 2
