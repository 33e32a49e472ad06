"""Keyed state machines: order within a key, bounded batches, lateness by record, snapshot then updates."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from conftest import SF_SMALL
from tramline import schemas
from tramline.operators import alerts as A
from tramline.operators import crowding as C
from tramline.operators import delay as D
from tramline.operators import live as LV
from tramline.operators import static as ST
from tramline.sinks import writers as K
from tramline.sources import testdata as TD
from tramline.streaming import jobs as J
from tramline.streaming import stateful as SF


def land(df, path, order, files):
    """Files in order of ``order``, rows within a file in no order."""
    ranged = df.repartitionByRange(files, *order).sortWithinPartitions(F.xxhash64(*order))
    ranged.write.parquet(path)
    for i, f in enumerate(sorted(f for f in os.listdir(path) if f.startswith("part-"))):
        os.utime(os.path.join(path, f), (1_700_000_000 + i, 1_700_000_000 + i))


def replay(spark, path, schema, max_files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def collect(df, mode, checkpoint):
    """(micro-batch, row) of all that a stream gives."""
    out = []
    writer = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
              .foreachBatch(lambda b, i: out.extend((i, r) for r in b.collect())))
    SF.start(writer).awaitTermination()
    return out


# --- ST-6 ---------------------------------------------------------------------------------------------------------

def test_changes_of_a_hot_alert_in_one_micro_batch(spark, scratch):
    """300,000 versions of one alert in a micro-batch, in Arrow batches of 5,000 rows, in no order."""
    one = F.lit(None).cast("string")
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 10 == 0, F.lit("B")).otherwise(F.lit("A")).alias("alert_id"), F.lit(True).alias("has_body"),
        F.lit("DETOUR").alias("effect"), one.alias("cause"), F.expr("cast((id div 10) div 7 % 3 as string)").alias("header_text"),
        one.alias("description_text"), F.array(F.lit("1")).alias("affected_route_ids"), F.array(F.lit("s")).alias("affected_stop_ids"),
        F.lit(0).cast("long").alias("active_since"), F.lit(0).cast("long").alias("feed_ts"),
        F.timestamp_seconds("id").alias("event_time"), F.col("id").alias("arrival_seq"))
    land(rows, f"{scratch}/in", ["arrival_seq"], 2)
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "5000")
    try:
        got = collect(SF.alert_changes_stream(replay(spark, f"{scratch}/in", rows.schema)), "append", f"{scratch}/ck")
    finally:
        spark.conf.set(key, old)
    want = {(r.alert_id, r.arrival_seq) for r in A.alert_changes(rows).collect()}
    assert len(got) == len(want) > 8000 and {(r.alert_id, r.arrival_seq) for _, r in got} == want


def test_a_query_of_ordered_rows_cannot_be_started_unchecked(spark, scratch):
    alerts = TD.service_alerts(spark, SF_SMALL)
    land(alerts, f"{scratch}/in", ["arrival_seq"], 1)
    stream = SF.alert_changes_stream(replay(spark, f"{scratch}/in", alerts.schema))
    with pytest.raises(Exception, match="Sorting is not supported"):
        stream.writeStream.format("noop").trigger(availableNow=True).start()
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck", "true") == "true"


def test_state_of_an_alert_is_forgotten_after_its_time(spark, scratch):
    """The same content again, after a stop: nothing new within an hour, new after a millisecond."""
    alerts = TD.service_alerts(spark, SF_SMALL).where("alert_id = 'A1' and has_body").limit(1).cache()

    def emitted(name, ttl, arrival):
        alerts.withColumn("arrival_seq", F.lit(arrival).cast("long")).write.mode("append").parquet(f"{scratch}/{name}")
        out = []
        # a state with a time to live keeps the query going: it is stopped when it has read the row
        q = SF.start(SF.alert_changes_stream(replay(spark, f"{scratch}/{name}", alerts.schema), ttl).writeStream
                     .option("checkpointLocation", f"{scratch}/ck-{name}").trigger(processingTime="0 seconds")
                     .foreachBatch(lambda b, i: out.extend(b.collect())))
        for _ in range(100):
            if sum(p["numInputRows"] for p in q.recentProgress) or q.exception():
                break
            time.sleep(0.3)
        q.stop()
        return len(out)

    assert [emitted("long", 3_600_000, i) for i in range(2)] == [1, 0]
    assert [emitted("short", 1, i) for i in range(2)] == [1, 1]


# --- ST-3 ---------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("sources", [1, 5])
def test_stream_marks_the_records_that_the_batch_marks(spark, scratch, sources):
    pos = D.route_present(TD.vehicle_positions(spark, SF_SMALL)).withColumn("source", (F.col("arrival_seq") % sources).cast("int"))
    land(pos, f"{scratch}/in", ["arrival_seq"], 4)
    SF.start_lateness(replay(spark, f"{scratch}/in", pos.schema), "source", f"{scratch}/good", f"{scratch}/late", f"{scratch}/ck").awaitTermination()
    batch = D.mark_late(pos, partition_col="source")
    cols = ["arrival_seq", "source", "stream_time", "is_late"]
    good, late = (spark.read.parquet(f"{scratch}/{side}") for side in ("good", "late"))
    got = sorted(map(tuple, good.select(cols).union(late.select(cols)).collect()))
    assert got == sorted(map(tuple, batch.select(cols).collect()))
    assert late.where("not is_late").count() == 0 and good.where("is_late").count() == 0 and late.count() > 0


def test_one_source_marks_what_the_registered_query_marks(spark, scratch):
    from tramline.plans.catalog import QUERIES

    pos = D.route_present(TD.vehicle_positions(spark, SF_SMALL)).withColumn("source", F.lit(0))
    land(pos, f"{scratch}/in", ["arrival_seq"], 3)
    got = collect(SF.late_stream(replay(spark, f"{scratch}/in", pos.schema), "source").where("is_late"), "append", f"{scratch}/ck")
    assert sorted(r.arrival_seq for _, r in got) == sorted(r.arrival_seq for r in QUERIES["late_positions"](spark, SF_SMALL).collect())


def test_replayed_batch_of_two_sinks_overwrites_itself(spark, scratch):
    write = SF.split_writer({"even": ("id % 2 = 0", f"{scratch}/even"), "odd": ("id % 2 = 1", f"{scratch}/odd")})
    for batch, i in ((spark.range(10), 0), (spark.range(10, 14), 1), (spark.range(10), 0)):
        write(batch, i)
    assert spark.read.parquet(f"{scratch}/even").count() == spark.read.parquet(f"{scratch}/odd").count() == 7


# --- ST-13 / S-7 --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Numbered messages of positions and crowding levels, in parts as a topic has them."""
    begin = int(dt.datetime(2024, 1, 1, 8, tzinfo=dt.timezone.utc).timestamp())
    # a message a second of 23 vehicles; some are silent for longer than a client waits
    seq = F.col("arrival_seq")
    pos = (TD.vehicle_positions(spark, SF_SMALL).where("arrival_seq < 900").withColumns({
        "vehicle_id": F.concat(F.lit("V"), seq % 23), "received_at": F.timestamp_seconds(F.lit(begin) + seq)})
        .where((seq % 23 < 15) | (F.floor(seq / 250) % 2 == 0)))
    est = spark.range(60).select(
        F.concat(F.lit("V"), F.col("id") * 7 % 25).alias("vehicle_id"), F.lit("504").alias("route_id"), (F.col("id") % 2).cast("int").alias("direction_id"),
        F.lit(1.0).alias("gap_ahead_minutes"), F.lit(1.0).alias("crowding_ratio"), F.lit(5.0).alias("scheduled_headway_minutes"),
        F.element_at(F.array(F.lit("NORMAL"), F.lit("LIKELY_EMPTY"), F.lit("LIKELY_CROWDED")), (F.col("id") % 3 + 1).cast("int")).alias("crowding_level"),
        ((F.col("id") * 14 + begin) * 1000).alias("window_end"))
    place = str(tmp_path_factory.mktemp("feed"))
    pos.write.parquet(f"{place}/pos")
    est.write.parquet(f"{place}/est")
    pos, est = spark.read.parquet(f"{place}/pos"), spark.read.parquet(f"{place}/est")
    part = F.pmod(F.xxhash64("vehicle_id"), F.lit(3)).cast("int")
    numbered = SF.client_messages(pos, est).withColumn("part", part).withColumn(
        "offset", F.row_number().over(W.partitionBy("part").orderBy("at", F.col("is_position").desc(), "seq", "vehicle_id")).cast("long"))
    land(numbered, f"{place}/messages", ["at"], 6)
    assert est.count() > 0
    return pos, est, spark.read.parquet(f"{place}/messages"), place


def _final(rows, as_of_us, stale_us=180_000_000):
    """Last row of each vehicle, without those gone or silent for too long."""
    last = {}
    for batch, r in sorted(rows, key=lambda x: (x[0], not x[1].gone)):
        last[r.vehicle_id] = r
    return {v: r.asDict() for v, r in last.items() if not r.gone and r.last_seen_us >= as_of_us - stale_us}


def test_snapshot_then_updates_is_the_whole_stream(spark, feed, scratch):
    pos, est, messages, place = feed
    end = messages.agg(F.unix_micros(F.max("at"))).first()[0]
    whole = _final(collect(SF.client_stream(replay(spark, f"{place}/messages", messages.schema)), "update", f"{scratch}/whole"), end)
    assert len(whole) > 5
    # the batch form gives the same state at the end
    batch = LV.client_snapshot(pos, est, end // 1_000_000 + 1)
    assert {r.vehicle_id: r.crowding_level for r in batch.collect() if r.last_seen_us >= end - 180_000_000} == {
        v: r["crowding_level"] for v, r in whole.items()}
    first = messages.agg(F.unix_micros(F.min("at"))).first()[0]
    for share in (0.2, 0.5, 0.85):
        cut = int((first + (end - first) * share) // 1_000_000)
        held = messages.where(F.unix_micros("at") <= cut * 1_000_000)
        root = f"{scratch}/published-{share}"
        K.publish_reference_tables(spark, {
            "vehicles": LV.client_snapshot(pos.where(F.unix_micros("received_at") <= cut * 1_000_000), est, cut),
            "offsets": held.groupBy("part").agg(F.max("offset").alias("offset"))}, root)
        seed, offsets = (K.read_reference_table(spark, root, t) for t in ("vehicles", "offsets"))
        # the replay begins with the first message; what the snapshot holds is skipped
        rest = SF.after_snapshot(replay(spark, f"{place}/messages", messages.schema), offsets)
        rows = collect(SF.client_stream(rest, seed), "update", f"{scratch}/ck-{share}")
        assert 0 < len(rows)
        seeded = {r.vehicle_id: (-1, r) for r in seed.withColumn("gone", F.lit(False)).select(
            "vehicle_id", *SF._FIELDS, "gone").collect()}
        assert _final([*seeded.values(), *rows], end) == whole, share


def test_a_silent_vehicle_of_the_snapshot_goes(spark, scratch):
    at = dt.datetime(2024, 1, 1, 8, 0, 0)
    us = int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    state = f"vehicle_id string, {SF.CLIENT_STATE}"
    seed = spark.createDataFrame([("old", "1", 1.0, 1.0, None, None, 0, "FULL", None, None, 3, "NORMAL", 1, us)], state)
    rows = [("new", at + dt.timedelta(seconds=s), i, True, "2", 1.0, 1.0, None, None, 0, None, None, None, None, None, 0, i)
            for i, s in enumerate((10, 400, 420))]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], SF.MESSAGE).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    land(spark.createDataFrame(rows, SF.MESSAGE), f"{scratch}/landed", ["offset"], 3)
    out = collect(SF.client_stream(replay(spark, f"{scratch}/landed", spark.createDataFrame([], SF.MESSAGE).schema), seed), "update", f"{scratch}/ck")
    assert [(r.vehicle_id, r.gone, r.occupancy) for _, r in out if r.vehicle_id == "old"] == [("old", True, "FULL")]


def test_starting_offsets_follow_the_snapshot():
    assert json.loads(SF.starting_offsets("positions", {1: 7, 0: 41})) == {"positions": {"0": 42, "1": 8}}


# --- A-3 / ST-9 ---------------------------------------------------------------------------------------------------

def test_crowding_stream_with_50000_vehicles_in_one_window(spark, scratch):
    at = F.lit(dt.datetime(2024, 1, 1, 12, 1, 0))
    rows = spark.range(50_000).select(
        F.concat(F.lit("V"), "id").alias("vehicle_id"), F.lit("504").alias("route_id"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"),
        F.lit(None).cast("float").alias("bearing"), F.lit(None).cast("float").alias("speed"), F.lit(0).cast("long").alias("feed_ts"),
        F.lit(None).cast("string").alias("occupancy"), F.lit(None).cast("string").alias("trip_id"), F.lit(0).alias("direction_id"),
        (F.col("id") % 61).cast("int").alias("current_stop_sequence"), F.col("id").alias("arrival_seq"), at.alias("event_time"))
    end = rows.limit(1).withColumns({"route_id": F.lit("999"), "event_time": F.lit(dt.datetime(2024, 1, 2)), "arrival_seq": F.lit(60_000).cast("long")})
    both = rows.unionByName(end).select([f.name for f in schemas.VEHICLE_POSITION])
    land(both, f"{scratch}/in", ["arrival_seq"], 3)
    trips = spark.createDataFrame([], "trip_id string, route_id string, direction_id int")
    headways = spark.createDataFrame([("504", h, 5.0) for h in range(24)], "route_id string, hour_of_day int, scheduled_headway_minutes double")
    J.start_crowding(replay(spark, f"{scratch}/in", both.schema), trips, headways, f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    cols = ["vehicle_id", "gap_ahead_minutes", "crowding_ratio", "crowding_level", "window_end"]
    got = spark.read.parquet(f"{scratch}/out").select(cols)
    want = C.crowding_estimates(both, trips, headways).select(cols)
    assert got.count() == want.count() == 50_000
    assert got.exceptAll(want).count() == 0
