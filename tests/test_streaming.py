"""Streaming forms equal the batch forms on on-time data."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tramline import schemas
from tramline.operators import alerts as A
from tramline.operators import crowding as C
from tramline.operators import delay as D
from tramline.operators import static as ST
from tramline.sources import feeds as FD
from tramline.sources import testdata as TD
from tramline.streaming import jobs as J
from tramline.streaming import stateful as SF

N_FILES = 4


def _on_time_positions(spark):
    """Positions without the deliberately late rows, plus a far-future sentinel
    (on an unscheduled route) that pushes the watermark past every window."""
    pos = TD.vehicle_positions(spark, SF_SMALL).where(F.col("arrival_seq") % 17 != 0)
    assert D.mark_late(pos).where("is_late").count() == 0
    sentinel = spark.createDataFrame(
        [("VS", "999", 0.0, 0.0, None, None, 0, None, None, 0, 1,
          dt.datetime(2024, 1, 3, 0, 0, 0), 10 ** 9)], schemas.VEHICLE_POSITION)
    return pos.unionByName(sentinel)


def _land(df, path, order="arrival_seq"):
    """Write rows as N files in arrival order, with increasing modification
    times, so the file source replays them the way a topic delivers them."""
    (df.repartitionByRange(N_FILES, order).sortWithinPartitions(order)
     .write.mode("overwrite").parquet(path))
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    for i, f in enumerate(parts):
        os.utime(os.path.join(path, f), (1_700_000_000 + i, 1_700_000_000 + i))


def _run(stream_df, name, mode="append"):
    q = (stream_df.writeStream.format("memory").queryName(name).outputMode(mode)
         .trigger(availableNow=True))
    q = SF.start(q)
    q.awaitTermination()
    return q


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_delay_stream_equals_batch(spark, scratch):
    pos = _on_time_positions(spark)
    _land(pos, f"{scratch}/pos")
    t = ST.prepare(TD.gtfs_tables(spark, SF_SMALL))
    hw = ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"], t["calendar"], TD.AS_OF_DATE)
    stream = FD.read_positions(spark, f"{scratch}/pos", streaming=True, max_files=1)
    _run(J.delay_scores_stream(stream, hw), "delay_stream")
    got = _rows(spark.table("delay_stream"))
    want = _rows(D.delay_scores(spark.read.parquet(f"{scratch}/pos"), hw))
    assert got == want and len(want) > 0


def test_crowding_stream_equals_batch(spark, scratch):
    pos = _on_time_positions(spark)
    _land(pos, f"{scratch}/pos")
    t = ST.prepare(TD.gtfs_tables(spark, SF_SMALL))
    hw = ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"], t["calendar"], TD.AS_OF_DATE)
    trips = ST.trip_directions(t["trips"])
    stream = FD.read_positions(spark, f"{scratch}/pos", streaming=True, max_files=1)
    J.start_crowding(stream, trips, hw, f"{scratch}/out", f"{scratch}/ckpt").awaitTermination()
    got = _rows(spark.read.parquet(f"{scratch}/out").drop("batch_id"))
    want = _rows(C.crowding_estimates(spark.read.parquet(f"{scratch}/pos"), trips, hw))
    assert got == want and len(want) > 0


def _alerts_landed(spark, scratch):
    alerts = TD.service_alerts(spark, SF_SMALL)
    _land(alerts, f"{scratch}/alerts")
    return alerts


def test_alert_changes_stream_equals_batch(spark, scratch):
    alerts = _alerts_landed(spark, scratch)
    stream = FD.read_alerts(spark, f"{scratch}/alerts", streaming=True, max_files=1)
    _run(SF.alert_changes_stream(stream), "changes_stream")
    cols = ["alert_id", "arrival_seq"]
    got = _rows(spark.table("changes_stream").select(*cols))
    want = _rows(A.alert_changes(alerts).select(*cols))
    assert got == want and len(want) > 0


def test_ripple_stream_equals_batch(spark, scratch):
    alerts = _alerts_landed(spark, scratch)
    t = ST.prepare(TD.gtfs_tables(spark, SF_SMALL))
    served = ST.stop_routes(t["trips"], t["stop_times"])
    feeders = ST.station_feeder_routes(t["routes"], t["stops"], served,
                                       ST.subway_stations(t["routes"], t["stops"], served))
    stream = FD.read_alerts(spark, f"{scratch}/alerts", streaming=True, max_files=1)
    q = J.start_ripples(stream, feeders, f"{scratch}/ripples", f"{scratch}/ckpt")
    q.awaitTermination()
    got = _rows(spark.read.parquet(f"{scratch}/ripples").drop("batch_id"))
    want = _rows(A.ripples(alerts, feeders))
    assert got == want and len(want) > 0


def test_live_state_stream_expires(spark, scratch):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [("V1", "501", base, 1), ("V2", "502", base + dt.timedelta(seconds=10), 2),
            ("V1", "501", base + dt.timedelta(seconds=60), 3),
            ("V3", "503", base + dt.timedelta(seconds=400), 4)]
    df = spark.createDataFrame(rows, "vehicle_id string, route_id string, event_time timestamp, "
                                     "arrival_seq long")
    for i, r in enumerate(rows):
        spark.createDataFrame([r], df.schema).write.parquet(f"{scratch}/in/f{i}")
    stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{scratch}/in"))
    _run(J.live_state_stream(stream, "vehicle_id", ttl_s=120), "live_stream", "update")
    out = spark.table("live_stream").select("vehicle_id", "arrival_seq", "expired").collect()
    expired = {r.vehicle_id for r in out if r.expired}
    # V1 (last write at +60s) and V2 (+10s) expire once the +400s record moves
    # the watermark; V3 is still alive.
    assert expired == {"V1", "V2"}
    assert {(r.vehicle_id, r.arrival_seq) for r in out if not r.expired} >= {("V1", 3), ("V3", 4)}


def test_restart_resumes_from_checkpoint(spark, scratch):
    """Stop after part of the stream, restart on the same checkpoint: the
    combined output equals one uninterrupted run (no loss, no duplicates)."""
    pos = _on_time_positions(spark)
    _land(pos, f"{scratch}/all")
    parts = sorted(f for f in os.listdir(f"{scratch}/all") if f.startswith("part-"))
    os.makedirs(f"{scratch}/in")
    t = ST.prepare(TD.gtfs_tables(spark, SF_SMALL))
    hw = ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"], t["calendar"], TD.AS_OF_DATE)

    def run(out):
        stream = FD.read_positions(spark, f"{scratch}/in", streaming=True, max_files=1)
        q = (J.delay_scores_stream(stream, hw).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", f"{scratch}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    for i, f in enumerate(parts):
        os.link(f"{scratch}/all/{f}", f"{scratch}/in/{f}")
        os.utime(f"{scratch}/in/{f}", (1_700_000_000 + i, 1_700_000_000 + i))
        if i == 1:
            run(f"{scratch}/out")            # first run sees two files, then stops
    run(f"{scratch}/out")                    # restart: picks up the rest
    got = _rows(spark.read.parquet(f"{scratch}/out"))
    want = _rows(D.delay_scores(spark.read.parquet(f"{scratch}/all"), hw))
    assert got == want and len(want) > 0


def test_stream_with_late_rows_accepts_a_superset(spark, scratch):
    """With late rows in the input, Spark's micro-batch watermark accepts at
    least what the per-record rule (``mark_late``) accepts (ST-3)."""
    pos = TD.vehicle_positions(spark, SF_SMALL)
    sentinel = spark.createDataFrame(
        [("VS", "999", 0.0, 0.0, None, None, 0, None, None, 0, 1,
          dt.datetime(2024, 1, 3, 0, 0, 0), 10 ** 9)], schemas.VEHICLE_POSITION)
    _land(pos.unionByName(sentinel), f"{scratch}/pos")
    stream = FD.read_positions(spark, f"{scratch}/pos", streaming=True, max_files=1)
    _run(J.route_windows_stream(stream), "late_stream")
    got = {(r.route_id, r.w.start): r.vehicles for r in spark.table("late_stream").collect()}
    on_time = D.mark_late(D.route_present(pos)).where(~F.col("is_late"))
    want = {(r.route_id, r.w.start): r.vehicles for r in D.route_windows(on_time).collect()}
    assert D.mark_late(D.route_present(pos)).where("is_late").count() > 0
    assert set(want) <= set(got)
    assert all(got[k] >= v for k, v in want.items())


def test_live_state_keeps_newest_by_arrival_order(spark, scratch):
    """A message that arrives in a later micro-batch but is older by arrival
    order (e.g. replayed) does not replace the newer state."""
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [("V1", "501", base, 5), ("V1", "999", base + dt.timedelta(seconds=5), 3),
            ("V2", "502", base + dt.timedelta(seconds=6), 6)]
    schema = "vehicle_id string, route_id string, event_time timestamp, arrival_seq long"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).write.parquet(f"{scratch}/in/f{i}")
        os.utime(f"{scratch}/in/f{i}", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{scratch}/in"))
    _run(J.live_state_stream(stream, "vehicle_id", ttl_s=120), "live_order", "update")
    out = sorted((r.vehicle_id, r.route_id, r.arrival_seq) for r in
                 spark.table("live_order").where("not expired").collect())
    assert out == [("V1", "501", 5), ("V2", "502", 6)]


def test_changes_then_ripples_equals_batch(spark, scratch):
    """J1 into J5: change detection feeds the cascade, with feeders that are read anew each batch."""
    alerts = _alerts_landed(spark, scratch)
    feeders = spark.createDataFrame([(f"S{10 * i}", f"Stop {i}", str(510 + i), 10.0 * i) for i in range(10)],
                                    "station_id string, station_name string, route_id string, distance_meters double")
    reads = []

    def read_feeders():
        reads.append(1)
        return feeders

    stream = FD.read_alerts(spark, f"{scratch}/alerts", streaming=True, max_files=1)
    q = J.start_ripples(SF.alert_changes_stream(stream), read_feeders, f"{scratch}/ripples", f"{scratch}/ckpt")
    q.awaitTermination()
    got = _rows(spark.read.parquet(f"{scratch}/ripples").drop("batch_id"))
    want = _rows(A.ripples(A.alert_changes(alerts), feeders))
    assert got == want and len(want) > 0 and len(reads) > 1
