"""Topics: envelope, order over partitions, rejects with reasons, one pass to two sinks, counters."""

import datetime as dt
import json
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from tramline import schemas
from tramline.operators import alerts as A
from tramline.operators import delay as D
from tramline.sources import feeds as FD
from tramline.sources import testdata as TD
from tramline.streaming import stateful as SF

AT = dt.datetime(2024, 1, 1, 8)
RAW = "key binary, value binary, partition int, offset long, timestamp timestamp"


def record(body, schema_id=7, magic=0):
    text = body if isinstance(body, bytes) else json.dumps(body).encode()
    return bytes([magic]) + schema_id.to_bytes(4, "big") + text


def raw(spark, rows):
    return spark.createDataFrame([(k and k.encode(), v, p, o, AT) for k, v, p, o in rows], RAW)


def as_json(schema):
    """Stands for the Avro decoder: nulls for what it cannot read."""
    return lambda body: F.from_json(body.cast("string"), schema)


POSITION = T.StructType([T.StructField("timestamp" if f.name == "feed_ts" else f.name, f.dataType)
                         for f in schemas.VEHICLE_POSITION if f.name not in ("event_time", "arrival_seq")])
ALERT = T.StructType([T.StructField("timestamp" if f.name == "feed_ts" else f.name, f.dataType)
                      for f in schemas.SERVICE_ALERT if f.name not in ("event_time", "arrival_seq", "has_body")])


def test_envelope(spark):
    good, bad = FD.open_envelope(raw(spark, [
        ("a", record(b"xyz"), 0, 0), ("a", record(b""), 1, 0), ("b", None, 1, 1), (None, None, 0, 1), ("c", b"\x00\x00", 0, 2), ("d", b"", 0, 3),
        ("e", record(b"x", magic=1), 0, 4), ("f", record(b"x", schema_id=8), 0, 5), ("g", record(b"\x00\xff", schema_id=4_000_000_000), 2, 0)]),
        [7, 4_000_000_000], 3)
    assert sorted((r.key, r.schema_id, r.body and bytes(r.body), r.arrival_seq) for r in good.collect()) == [
        ("a", 7, b"", 1), ("a", 7, b"xyz", 0), ("b", None, None, 4), ("g", 4_000_000_000, b"\x00\xff", 2)]
    assert sorted((r.offset, r.reason) for r in bad.collect()) == [
        (1, "empty"), (2, "too short"), (3, "too short"), (4, "no magic byte"), (5, "unknown schema")]


def test_arrival_order_is_unique_and_grows_in_each_partition(spark):
    rows = [(str(p), record(b"x"), p, o) for p in range(4) for o in range(25)]
    good, _ = FD.open_envelope(raw(spark, rows), [7], 4)
    got = good.select("key", "arrival_seq").collect()
    assert sorted(r.arrival_seq for r in got) == list(range(100))
    for p in range(4):
        assert [r.arrival_seq for r in got if r.key == str(p)] == sorted(r.arrival_seq for r in got if r.key == str(p))


def test_decoded_positions_fit_the_operators(spark):
    body = {"vehicle_id": "V1", "route_id": "504", "latitude": 1.5, "longitude": 2.5, "timestamp": 99, "direction_id": 1, "current_stop_sequence": 4}
    good, bad = FD.decode_topic(raw(spark, [("V1", record(body), 0, 3), ("V2", record(b"{broken"), 0, 4), ("V3", record(body, magic=9), 0, 5)]),
                                as_json(POSITION), "vehicle_id", [7], 2)
    rows = FD.position_rows(good)
    assert {f.name: f.dataType for f in rows.schema} == {f.name: f.dataType for f in schemas.VEHICLE_POSITION}
    assert [(r.vehicle_id, r.feed_ts, r.arrival_seq, r.event_time, r.bearing) for r in rows.collect()] == [("V1", 99, 6, AT, None)]
    assert D.route_windows(rows).first().vehicles == 1
    assert sorted((r.key, r.reason, r.arrival_seq) for r in bad.collect()) == [("V2", "undecodable", 8), ("V3", "no magic byte", 10)]


def test_decoded_alerts_and_tombstones(spark):
    body = {"alert_id": "A", "effect": "DETOUR", "header_text": "h", "affected_route_ids": ["1"], "affected_stop_ids": ["s"], "active_since": 1, "timestamp": 2}
    good, bad = FD.decode_topic(raw(spark, [("A", record(body), 0, 0), ("B", record({**body, "alert_id": "B"}), 0, 1), ("B", None, 0, 2)]),
                                as_json(ALERT), "alert_id", [7], 1)
    rows = FD.alert_rows(good)
    assert [f.name for f in rows.schema] == [f.name for f in schemas.SERVICE_ALERT] and bad.count() == 0
    assert [(r.alert_id, r.header_text, r.feed_ts) for r in A.current_alerts(rows).collect()] == [("A", "h", 2)]


def test_a_record_that_breaks_off_gives_no_fields(spark):
    good, bad = FD.parse_json_topic(spark.createDataFrame(
        [('{"route_id": "504", "delay_score": 1.5}',), ('{"route_id": "504", "delay_sc',), ('{"route_id": "504"} tail',), ("[]",), ("",), (None,), ('{"route_id": ""}',),
         ('{"delay_score": 2}',)], "value string"), schemas.DELAY_PREDICTION, "route_id")
    assert [(r.route_id, r.delay_score) for r in good.collect() if r.delay_score] == [("504", 1.5)]
    reasons = {r.value: r.reason for r in bad.collect()}
    assert reasons['{"route_id": "504", "delay_sc'] == "malformed" and reasons[None] == "empty"
    assert reasons['{"route_id": ""}'] == reasons['{"delay_score": 2}'] == "no key"


def test_one_pass_to_two_sinks_with_counters(spark, scratch):
    topic = TD.vehicle_topic(spark, SF_SMALL)
    topic.repartition(3).write.parquet(f"{scratch}/in")
    counts = SF.TopicCounts()
    spark.streams.addListener(counts)
    try:
        stream = spark.readStream.schema(topic.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        SF.start_topic(stream, FD.TOPIC_SCHEMA, "vehicle_id", "vehicles", f"{scratch}/good", f"{scratch}/dead", f"{scratch}/ck").awaitTermination()
        for _ in range(50):  # progress comes on a thread of its own
            if sum(n for n, _ in counts.batches.values()) >= topic.count():
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(counts)
    good, bad = FD.parse_json_topic(topic, FD.TOPIC_SCHEMA, "vehicle_id")
    landed, dead = (spark.read.parquet(f"{scratch}/{d}").drop("batch_id") for d in ("good", "dead"))
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, good.collect()))
    assert sorted(map(repr, dead.select("value", "arrival_seq", "reason").collect())) == sorted(map(repr, bad.select("value", "arrival_seq", "reason").collect()))
    assert [tuple(r) for r in counts.counts(spark).collect()] == [("vehicles", topic.count(), bad.count())]
