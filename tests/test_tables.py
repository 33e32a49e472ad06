"""State table, history and pinned versions over a manifest."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tramline.sinks.history import History
from tramline.sinks.manifest import Conflict, Manifest
from tramline.sinks.state_table import StateTable, batch_writer

AT = dt.datetime(2024, 1, 1)
NOW = int(AT.replace(tzinfo=dt.timezone.utc).timestamp())
STATE = "vehicle_id string, route_id string, event_time timestamp, arrival_seq long"


def _bytes(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


def _state(table, **k):
    return sorted((r.vehicle_id, r.route_id, r.arrival_seq) for r in table.read(**k).collect())


def test_replayed_older_and_expired_messages(spark, scratch):
    table = StateTable(spark, f"{scratch}/s", "vehicle_id", buckets=4)
    first = spark.createDataFrame([("V1", "1", AT, 1), ("V2", "2", AT, 2), ("", "9", AT, 3), (None, "9", AT, 3)], STATE)
    second = spark.createDataFrame([("V1", "5", AT + dt.timedelta(seconds=90), 4), ("V1", "4", AT, 0)], STATE)
    for batch in (first, second, second, first):
        table.upsert(batch, ttl_s=120, as_of_s=NOW + 100)
    assert _state(table) == [("V1", "5", 4), ("V2", "2", 2)]
    assert _state(table, ttl_s=120, as_of_s=NOW + 130) == [("V1", "5", 4)]
    table.upsert(spark.createDataFrame([], STATE))
    assert _state(table) == [("V1", "5", 4), ("V2", "2", 2)]


def test_messages_of_other_types_are_refused(spark, scratch):
    table = StateTable(spark, f"{scratch}/s", "vehicle_id", buckets=2)
    row = spark.createDataFrame([("V1", "1", AT, 1)], STATE)
    table.upsert(row)
    with pytest.raises(ValueError, match="columns"):
        table.upsert(row.withColumn("arrival_seq", F.lit(1)))


def test_written_bytes_grow_with_the_batch(spark, scratch):
    table = StateTable(spark, f"{scratch}/s", "vehicle_id", buckets=32)
    many = spark.range(40_000).select(F.concat(F.lit("V"), "id").alias("vehicle_id"), F.sha2(F.col("id").cast("string"), 256).alias("route_id"),
                                      F.lit(AT).alias("event_time"), F.col("id").alias("arrival_seq"))
    table.upsert(many)
    whole = _bytes(f"{scratch}/s")
    before = table.manifest.read()[1]["entries"]
    table.upsert(many.where("id = 7").withColumn("arrival_seq", F.lit(10**6).cast("long")))
    after = table.manifest.read()[1]["entries"]
    assert len(before) == 32 and sum(before[b] != after[b] for b in before) == 1
    assert _bytes(f"{scratch}/s") - whole < whole / 8
    assert table.read().count() == 40_000 and table.read().where("arrival_seq = 1000000").count() == 1


def test_two_writers_lose_nothing(spark, scratch, monkeypatch):
    """A second writer commits between the first one's read and its commit: the same key, then another bucket."""
    row = lambda v, r, n: spark.createDataFrame([(v, r, AT, n)], STATE)
    for rival in ("V1", "V2"):
        root = f"{scratch}/{rival}"
        ours, theirs = (StateTable(spark, root, "vehicle_id", buckets=64) for _ in range(2))
        ours.upsert(row("V0", "0", 0))
        commit, late = Manifest.commit, [True]

        def slow(self, base, content):
            if self is ours.manifest and late:
                late.clear()
                theirs.upsert(row(rival, "theirs", 9))
            return commit(self, base, content)

        monkeypatch.setattr(Manifest, "commit", slow)
        ours.upsert(row("V1", "ours", 5))
        monkeypatch.setattr(Manifest, "commit", commit)
        want = [("V0", "0", 0), ("V1", "theirs", 9)] if rival == "V1" else [("V0", "0", 0), ("V1", "ours", 5), ("V2", "theirs", 9)]
        assert _state(ours) == want and not late


def test_a_version_is_committed_once(spark, scratch):
    m = Manifest(spark, f"{scratch}/m")
    assert m.commit(0, {"entries": {}}) == 1
    with pytest.raises(Conflict):
        m.commit(0, {"entries": {}})
    assert m.versions() == [1] and not [n for n in m._names("_manifest") if n.endswith(".") or n.startswith(".") and not n.endswith(".crc")]


def test_cleaning_spares_current_and_pinned_versions(spark, scratch):
    table = StateTable(spark, f"{scratch}/s", "vehicle_id", buckets=1)
    for i in range(3):
        table.upsert(spark.createDataFrame([("V1", str(i), AT, i)], STATE))
    with table.manifest.pin() as held:
        rows = held.frame()
        for i in range(3, 6):
            table.upsert(spark.createDataFrame([("V1", str(i), AT, i)], STATE))
        assert table.manifest.clean(keep=1, young_s=0) > 0
        assert [r.route_id for r in rows.collect()] == ["2"]       # what the reader pinned
        assert _state(table) == [("V1", "5", 5)]
    table.manifest.clean(keep=1, young_s=0)
    assert len(table.manifest.versions()) == 1 and _state(table) == [("V1", "5", 5)]
    assert len(os.listdir(f"{scratch}/s/data")) == 1


def test_flushes_of_a_stream_go_to_the_table(spark, scratch):
    rows = [("V1", "1", AT, 1), ("V1", "2", AT, 2), ("V2", "3", AT, 3)]
    spark.createDataFrame(rows, STATE).coalesce(1).write.parquet(f"{scratch}/in")
    table = StateTable(spark, f"{scratch}/s", "vehicle_id", buckets=2)
    for _ in range(2):  # a lost checkpoint replays everything
        q = (spark.readStream.schema(STATE).parquet(f"{scratch}/in").writeStream.foreachBatch(batch_writer(table, clean_every=1))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    assert _state(table) == [("V1", "2", 2), ("V2", "3", 3)]


SCORES = "route_id string, window_start long, delay_score double"


def test_history_takes_a_batch_once(spark, scratch):
    # 2024-01-01 00:00 UTC is the evening before in Toronto; clocks went forward on 2024-03-10 at 07:00 UTC
    rows = [("504", 1704067200000, 1.0), ("504", 1704153600000, 2.0), ("505", 1710050340000, 3.0), ("505", 1710054060000, 4.0),
            ("506", 1710129599000, 5.0), ("506", 1710129600000, 6.0)]
    history = History(spark, f"{scratch}/h")
    frame = spark.createDataFrame(rows, SCORES)
    for batch, i in ((frame.limit(2), 0), (frame, 1), (frame.limit(2), 0), (frame, 1)):
        history.append(batch, i)
    by_day = {str(r.service_date): r["count"] for r in history.read().groupBy("service_date").count().collect()}
    assert by_day == {"2023-12-31": 2, "2024-01-01": 2, "2024-03-10": 3, "2024-03-11": 1}
    assert history.day("2024-01-01").count() == 2 and history.day("1999-01-01") is None
    # a replay with other rows replaces those of its batch
    history.append(frame.limit(1), 0)
    assert history.read().count() == 7


def test_history_compacts_and_still_takes_no_batch_twice(spark, scratch):
    history = History(spark, f"{scratch}/h")
    for i in range(4):
        history.append(spark.createDataFrame([("504", 1704067200000 + i, float(i)), ("504", 1704153600000 + i, float(i))], SCORES), i)
    want = sorted(map(tuple, history.read().collect()))
    history.compact("2023-12-31")
    entries = history.manifest.read()[1]["entries"]
    assert sorted(k for k in entries if k.startswith("2023-12-31")) == ["2023-12-31/all"] and len(entries) == 5
    assert sorted(map(tuple, history.read().collect())) == want
    history.append(spark.createDataFrame([("504", 1704067200002, 2.0), ("504", 1704153600002, 2.0)], SCORES), 2)
    assert sorted(map(tuple, history.read().collect())) == want
    history.append(spark.createDataFrame([("504", 1704067200009, 9.0)], SCORES), 9)
    history.compact("2023-12-31")
    assert history.day("2023-12-31").count() == 5
