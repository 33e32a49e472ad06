"""Hand-made cases for each trap and tie rule."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions import exprs as X
from tramline.operators import alerts as A
from tramline.operators import crowding as C
from tramline.operators import delay as D
from tramline.operators import live as LV
from tramline.operators import static as ST
from tramline.sinks import writers as K
from tramline.sources import feeds as FD
from tramline.sources import gtfs as G


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


# ---------------------------------------------------------------------------
# Expressions
# ---------------------------------------------------------------------------
def test_round_half_up_matches_java(spark):
    assert one(spark, X.round_half_up2(F.lit(-1.125))) == -1.12
    assert one(spark, X.round_half_up2(F.lit(1.125))) == 1.13
    assert one(spark, X.round_half_up2(F.lit(3.5))) == 3.5


def test_half_even_rounding(spark):
    assert one(spark, X.round_half_even(F.lit(60.0) / F.lit(96), 2)) == 0.62
    assert one(spark, X.round_half_even(F.lit(60.0) / F.lit(480), 2)) == 0.12


def test_gtfs_hour_wraps_past_midnight(spark):
    assert one(spark, X.gtfs_hour(F.lit("25:10:00"))) == 1
    assert one(spark, X.gtfs_hour(F.lit("07:15:00"))) == 7
    assert one(spark, X.gtfs_hour(F.lit("xx:00:00"))) is None


def test_local_hour_is_dst_aware(spark):
    jan = F.lit(dt.datetime(2024, 1, 15, 3, 30)).cast("timestamp")
    jul = F.lit(dt.datetime(2024, 7, 15, 3, 30)).cast("timestamp")
    assert one(spark, X.local_hour(jan)) == 22
    assert one(spark, X.local_hour(jul)) == 23


@pytest.mark.parametrize("ratio,level", [(None, "UNKNOWN"), (1.5, "LIKELY_CROWDED"),
                                         (0.5, "LIKELY_EMPTY"), (1.0, "NORMAL"),
                                         (1.84, "LIKELY_CROWDED"), (0.0, "LIKELY_EMPTY")])
def test_crowding_level_thresholds_inclusive(spark, ratio, level):
    assert one(spark, X.crowding_level(F.lit(ratio).cast("double"))) == level


def test_arc_metres(spark):
    # one degree of latitude
    d = one(spark, X.arc_metres(F.lit(43.0), F.lit(-79.0), F.lit(44.0), F.lit(-79.0)))
    assert abs(d - math.radians(1) * 6_371_000) < 1e-6


def test_display_helpers(spark):
    assert one(spark, X.signed2(F.lit(3.5))) == "+3.50"
    assert one(spark, X.signed2(F.lit(0.0))) == "0.00"
    assert one(spark, X.signed2(F.lit(-1.2))) == "-1.20"
    assert one(spark, X.delay_band(F.lit(2.0))) == "bad"
    assert one(spark, X.delay_band(F.lit(-2.0))) == "ahead"
    assert one(spark, X.vehicle_kind(F.lit(None).cast("int"))) == "bus"
    assert one(spark, X.vehicle_kind(F.lit(0))) == "streetcar"
    assert one(spark, X.display_level(F.lit("BOGUS"))) == "UNKNOWN"
    assert one(spark, X.split_list(F.lit(" 1, ,2 "))) == ["1", "2"]
    assert one(spark, X.distinct_non_empty(F.array(*[F.lit(v) for v in ["b", "", "a", "b"]]))) == ["b", "a"]


# ---------------------------------------------------------------------------
# Static schedule build on a hand-made feed
# ---------------------------------------------------------------------------
def gtfs(spark, with_calendar=True):
    routes = [("R1", "1", "1"), ("R300", "300", "3"), ("R94", "94", "3"), ("RB", "", "")]
    trips = [
        ("t1", "R1", "WK", "0", "s1"), ("t1b", "R1", "WK", "1", "s1"),
        ("t2", "R300", "WK", "0", "A"), ("t3", "R300", "SAT", "0", "A"),
        ("t4", "R300", "WK", "0", "B"), ("t5", "R300", "OLD", "", "A"),
        ("t6", "RB", "WK", "1", "L"), ("t7", "RX", "WK", "0", "X"),
    ]
    stops = [
        ("STA", "Bloor-Yonge Station", "43.6710", "-79.3857", "1", ""),
        ("P1", "Bloor-Yonge Platform", "43.6711", "-79.3857", "", "STA"),
        ("B1", "Near stop", "43.6717", "-79.3857", "", ""),
        ("B2", "Far stop", "43.6810", "-79.3857", "", ""),
        ("LOOP", "Bus loop", "43.7000", "-79.3000", "1", ""),
        ("BAD", "Unparsable", "n/a", "-79.3", "", ""),
    ]
    stop_times = [
        ("t1", "P1", "1", "06:00:00"), ("t1b", "P1", "1", "06:30:00"),
        ("t2", "B1", "1", "07:10:00"), ("t2", "B2", "2", "07:20:00"), ("t2", "B1", "3", "07:30:00"),
        ("t3", "B1", "1", "25:10:00"), ("t4", "B2", "1", "07:40:00"),
        ("t5", "B1", "2", "08:00:00"), ("t5", "B2", "1", ""),
        ("t6", "LOOP", "1", "09:00:00"), ("t7", "B1", "1", "09:00:00"),
    ]
    calendar = [("WK", "1", "20240101", "20240630"), ("SAT", "0", "20240101", "20240630"),
                ("OLD", " 1 ", "20230101", "20231231")]
    g = {
        "routes": spark.createDataFrame(routes, "route_id string, route_short_name string, route_type string"),
        "trips": spark.createDataFrame(trips, "trip_id string, route_id string, service_id string, "
                                              "direction_id string, shape_id string"),
        "stops": spark.createDataFrame(stops, "stop_id string, stop_name string, stop_lat string, "
                                              "stop_lon string, location_type string, parent_station string"),
        "stop_times": spark.createDataFrame(stop_times, "trip_id string, stop_id string, "
                                                        "stop_sequence string, arrival_time string"),
        "calendar": spark.createDataFrame(calendar, "service_id string, wednesday string, "
                                                    "start_date string, end_date string") if with_calendar else None,
    }
    return ST.prepare(g)


def headway_map(t, as_of="20240115"):
    hw = ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"], t["calendar"], as_of)
    return {(r.route_id, r.hour_of_day): r.scheduled_headway_minutes for r in hw.collect()}


def test_weekday_window_and_headways(spark):
    hw = headway_map(gtfs(spark))
    # WK trips only: t2 (07h, dir 0) and t4 (07h, dir 0) -> 2 trips -> 30 min
    assert hw[("300", 7)] == 30.0
    assert ("300", 1) not in hw          # t3 runs on Saturday
    assert ("300", 8) not in hw          # t5 belongs to an old board period
    assert hw[("1", 6)] == 60.0          # busier direction: 1 trip each way


def test_as_of_outside_every_window_takes_greatest(spark):
    hw = headway_map(gtfs(spark), as_of="20300101")
    assert hw[("300", 7)] == 30.0        # (20240101, 20240630) > (20230101, 20231231)


def test_no_calendar_counts_every_trip(spark):
    hw = headway_map(gtfs(spark, with_calendar=False))
    assert hw[("300", 1)] == 60.0        # 25:10 -> hour 1
    assert hw[("300", 8)] == 60.0        # blank direction counts as '0'
    assert ("RX", 9) not in hw            # unknown route ignored


def test_paths_keep_first_visit_and_fall_back(spark):
    t = gtfs(spark)
    paths = ST.route_paths(t["routes"], t["trips"], t["stops"], t["stop_times"])
    p300 = sorted((r.stop_id, r.stop_sequence) for r in paths.where("route_id = '300'").collect())
    assert p300 == [("B1", 1), ("B2", 2)]       # dominant shape A (3 trips), loop visit dropped
    fb = ST.path_for(paths, "RB", 0).collect()   # RB runs direction 1 only
    assert {r.direction_id for r in fb} == {1}


def test_stations_and_feeders(spark):
    t = gtfs(spark)
    served = ST.stop_routes(t["trips"], t["stop_times"])
    stations = ST.subway_stations(t["routes"], t["stops"], served)
    assert [r.station_id for r in stations.collect()] == ["STA"]   # LOOP is not a station
    feeders = ST.station_feeder_routes(t["routes"], t["stops"], served, stations).collect()
    got = {(r.station_id, r.route_id): r.distance_meters for r in feeders}
    assert set(got) == {("STA", "300")}                  # B2 is ~1 km away; R1 is subway
    assert got[("STA", "300")] == round(
        2 * 6371000 * math.asin(math.sin(math.radians(0.0007) / 2)), 1)


def test_grid_join_equals_brute_force(spark):
    """The grid equi-join finds exactly the pairs a full comparison finds,
    including at high latitude and across the antimeridian."""
    rnd = random.Random(7)
    centers = [(43.67, -79.39), (78.2, 15.6), (-33.9, 151.2), (0.0, 179.9995)]
    stations, stops = [], []
    for i, (la, lo) in enumerate(centers):
        stations.append((f"ST{i}", f"S{i}", la, lo))
        for j in range(60):
            dla, dlo = rnd.uniform(-0.006, 0.006), rnd.uniform(-0.03, 0.03)
            lon = lo + dlo
            lon = lon - 360 if lon > 180 else lon
            stops.append((f"p{i}_{j}", la + dla, lon))
    st_df = spark.createDataFrame(stations, "station_id string, station_name string, latitude double, longitude double")
    stop_df = spark.createDataFrame(
        [(s, "n", la, lo, "", "") for s, la, lo in stops],
        "stop_id string, stop_name string, latitude double, longitude double, location_type string, parent_station string")
    routes = spark.createDataFrame([("R", "7", 3)], "route_id string, route_short_name string, route_type int")
    served = spark.createDataFrame([(s, "R") for s, _, _ in stops], "stop_id string, route_id string")
    got = {(r.station_id, r.distance_meters) for r in
           ST.station_feeder_routes(routes, stop_df, served, st_df).collect()}

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    want = set()
    for sid, _, la, lo in stations:
        ds = [hav(la, lo, a, b) for _, a, b in stops]
        near = [d for d in ds if d <= 300]
        if near:
            want.add((sid, round(min(near), 1)))
    assert got == want and len(want) == len(centers)


# ---------------------------------------------------------------------------
# Delay and crowding on hand-made positions
# ---------------------------------------------------------------------------
T0 = dt.datetime(2024, 1, 15, 13, 0, 0)   # 08:00 in Toronto


def positions(spark, rows):
    full = []
    for i, r in enumerate(rows):
        vid, route, seq, feed_ts, secs = r[:5]
        direction = r[5] if len(r) > 5 else 0
        full.append((vid, route, 43.6, -79.4, None, None, feed_ts, None, None, direction, seq,
                     T0 + dt.timedelta(seconds=secs), i))
    return spark.createDataFrame(full, schemas.VEHICLE_POSITION)


def hw(spark, route="504", hour=8, minutes=5.0):
    return spark.createDataFrame([(route, hour, minutes)],
                                 "route_id string, hour_of_day int, scheduled_headway_minutes double")


def test_delay_counts_empty_vehicle_and_rounds_last(spark):
    pos = positions(spark, [("V1", "504", 1, 0, 10), ("", "504", 2, 0, 20), ("V1", "504", 3, 0, 30),
                            ("V9", "", 3, 0, 30)])
    out = D.delay_scores(pos, hw(spark, minutes=3.625)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.actual_headway_minutes == 2.5 and r.delay_score == -1.12   # 2.5 - 3.625 = -1.125


def test_delay_drops_unscheduled_windows(spark):
    pos = positions(spark, [("V1", "504", 1, 0, 10)])
    assert D.delay_scores(pos, hw(spark, route="505")).count() == 0
    assert D.unscheduled_windows(pos, hw(spark, route="505")).count() == 1


def test_mark_late_per_record(spark):
    # second record moves stream time past the first window end + grace
    pos = positions(spark, [("V1", "504", 1, 0, 10), ("V2", "504", 1, 0, 400), ("V3", "504", 1, 0, 20),
                            ("V4", "504", 1, 0, 320)])
    late = {r.vehicle_id for r in D.mark_late(pos, block=2).where("is_late").collect()}
    assert late == {"V3"}


def test_crowding_single_vehicle_is_unknown(spark):
    pos = positions(spark, [("V1", "504", 5, 10, 10)])
    trips = spark.createDataFrame([], "trip_id string, route_id string, direction_id int")
    r = C.crowding_estimates(pos, trips, hw(spark, hour=8)).collect()
    assert len(r) == 1 and r[0].crowding_level == "UNKNOWN" and r[0].gap_ahead_minutes is None


def test_crowding_snapshot_and_gaps(spark):
    pos = positions(spark, [
        ("V1", "504", 10, 10, 10), ("V1", "504", 2, 5, 20),      # out of order: keep feed_ts 10
        ("V2", "504", 4, 7, 15), ("V2", "504", 6, 7, 25),        # equal feed ts: later arrival wins
        ("V3", "504", 16, 3, 5)])
    trips = spark.createDataFrame([], "trip_id string, route_id string, direction_id int")
    for array_form in (False, True):
        rows = {r.vehicle_id: r for r in
                C.crowding_estimates(pos, trips, hw(spark, hour=8, minutes=0.5),
                                     array_form=array_form).collect()}
        # seqs: V2=6, V1=10, V3=16; span 10 -> 0.5 min/stop
        assert rows["V2"].gap_ahead_minutes == 2.0 and rows["V2"].crowding_level == "LIKELY_CROWDED"
        assert rows["V1"].gap_ahead_minutes == 3.0 and rows["V1"].crowding_ratio == 6.0
        assert rows["V3"].gap_ahead_minutes is None and rows["V3"].crowding_level == "UNKNOWN"


def test_crowding_with_a_headway_of_zero_minutes(spark):
    """F1 to F8: a schedule so dense that its headway rounds to 0.00 fails no query."""
    pos = positions(spark, [("V1", "504", 4, 10, 10), ("V2", "504", 6, 10, 15), ("V3", "504", 6, 10, 16)])
    trips = spark.createDataFrame([], "trip_id string, route_id string, direction_id int")
    for array_form in (False, True):
        rows = {r.vehicle_id: r for r in
                C.crowding_estimates(pos, trips, hw(spark, hour=8, minutes=0.0), array_form=array_form).collect()}
        assert rows["V1"].crowding_ratio == float("inf") and rows["V1"].crowding_level == "LIKELY_CROWDED"
        assert rows["V2"].gap_ahead_minutes == 0.0 and rows["V2"].crowding_ratio != rows["V2"].crowding_ratio
        assert rows["V3"].crowding_ratio is None and rows["V3"].crowding_level == "UNKNOWN"
        assert all(r.scheduled_headway_minutes == 0.0 for r in rows.values())
    assert one(spark, X.round_half_up2(F.lit(float("-inf")))) == float("-inf")
    assert one(spark, X.round_half_up2(F.lit(None).cast("double"))) is None


# ---------------------------------------------------------------------------
# Alerts, ripples, live state
# ---------------------------------------------------------------------------
def alerts_df(spark, rows):
    full = [(aid, body, "NO_SERVICE", None, header, None, routes, stops, 0, 0, T0, seq)
            for seq, (aid, body, header, routes, stops) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.SERVICE_ALERT)


def test_change_detection_a_a_b_a(spark):
    a = alerts_df(spark, [("X", True, "A", ["1"], ["s"]), ("X", True, "A", ["1"], ["s"]),
                          ("X", True, "B", ["1"], ["s"]), ("X", True, "A", ["1"], ["s"]),
                          ("X", True, "A", ["1"], ["s"])])
    for block in (2, 1 << 16):
        got = [r.arrival_seq for r in A.alert_changes(a, block=block).orderBy("arrival_seq").collect()]
        assert got == [0, 2, 3]


def test_stop_order_does_not_count_as_change(spark):
    a = alerts_df(spark, [("X", True, "A", ["1"], ["s1", "s2"]), ("X", True, "A", ["1"], ["s2", "s1"])])
    assert A.alert_changes(a).count() == 1


def test_reinjected_alert_and_tombstone(spark):
    a = alerts_df(spark, [("X", True, "Version ONE", ["1"], ["s"]), ("X", True, "Version TWO", ["1"], ["s"]),
                          ("Y", True, "gone", ["2"], ["s"]), ("Y", False, None, None, None)])
    cur = {r.alert_id: r.header_text for r in A.current_alerts(a).collect()}
    assert cur == {"X": "Version TWO"}


def test_contents_are_reduced_before_the_last_version_is_taken(spark):
    """F11 to F13: of versions that repeat a content, one meets the feeders; the live ripples stay the same."""
    n = 60
    a = alerts_df(spark, [("X", True, f"v{i % 3}", ["2"], [["H"], ["M"], ["H", "M"]][i // 20]) for i in range(n)]
                  + [("Y", True, "y", ["2"], ["M"]), ("Y", False, None, None, None)])
    feeders = demo_feeders(spark)
    every, last = A.ripples(a, feeders), A.latest_ripples(a, feeders)
    assert every.count() > 100 and last.count() < 40
    now = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) + 60
    rows = lambda r: sorted(map(tuple, LV.live_ripples(r, now).select(every.columns).collect()))
    assert rows(last) == rows(every) != []
    assert {(r.alert_id, r.header_text, r.arrival_seq) for r in A.last_bodies(a).collect()} == {("X", "v2", n - 1), ("Y", "y", n)}
    bodiless = a.where("alert_id = 'Y' or arrival_seq < 3").withColumn("feed_ts", F.col("arrival_seq") * 10)
    assert {(r.alert_id, r.feed_ts) for r in A.current_alerts(bodiless).collect()} == {("X", 20)}


def demo_feeders(spark):
    """Two made-up stations: route 41 feeds both, 7 and 88 one each, 2 is the closed line itself."""
    rows = [("H", "Harbour", "41", 60.5), ("M", "Mill", "41", 190.0),
            ("H", "Harbour", "7", 140.0), ("M", "Mill", "88", 20.0), ("H", "Harbour", "2", 5.0)]
    return spark.createDataFrame(rows, "station_id string, station_name string, route_id string, "
                                       "distance_meters double")


def test_alert_reaches_feeders_of_its_stations(spark):
    a = alerts_df(spark, [("c9", True, "Line 2 closed", ["2"], ["H", "M", "H"])])
    out = {r.feeder_route_id: r for r in A.ripples(a, demo_feeders(spark)).collect()}
    assert set(out) == {"41", "7", "88"}                         # none for the alert's own route
    assert out["41"].affected_station == "Harbour"               # the closer of its two stations
    assert out["88"].affected_station == "Mill"
    assert out["41"].ripple_id == "c9-41"
    assert out["41"].header_text == "Feeder route 41 near Harbour station: Line 2 closed"


def test_tombstone_yields_no_ripples(spark):
    a = alerts_df(spark, [("61", False, None, None, None)])
    assert A.ripples(a, demo_feeders(spark)).count() == 0


def test_live_ttl_and_sticky_merge(spark):
    pos = positions(spark, [("V1", "504", 1, 0, 0), ("V2", "505", 2, 0, 100), ("V1", "504", None, 0, 150)])
    now = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) + 200
    live = {r.vehicle_id: r for r in LV.live_vehicles(pos, now).collect()}
    assert set(live) == {"V1", "V2"} and live["V1"].current_stop_sequence is None
    assert {r.vehicle_id for r in LV.live_vehicles(pos, now + 50).collect()} == {"V1"}  # V2 expired at +220s
    sticky = {r.vehicle_id: r for r in LV.sticky_state(pos).collect()}
    assert sticky["V1"].current_stop_sequence == 1                    # absent field keeps old value


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------
def test_read_gtfs_bom_and_missing_calendar(spark, scratch):
    with open(os.path.join(scratch, "routes.txt"), "w", encoding="utf-8-sig") as f:
        f.write("route_id,route_short_name,route_type\nR1,504,0\nR2,,3\n")
    with open(os.path.join(scratch, "trips.txt"), "w") as f:
        f.write("route_id,service_id,trip_id\nR1,WK,t1\n")          # no direction/shape columns
    with open(os.path.join(scratch, "stops.txt"), "w") as f:
        f.write('stop_id,stop_name,stop_lat,stop_lon\nS1,"King, St",43.6,-79.4\n')
    with open(os.path.join(scratch, "stop_times.txt"), "w") as f:
        f.write("trip_id,stop_id,stop_sequence,arrival_time\nt1,S1,1,07:00:00\n")
    g = G.read_gtfs(spark, scratch)
    assert g["calendar"] is None
    assert g["routes"].columns == ["route_id", "route_short_name", "route_type", "file_pos"]
    assert [r.route_id for r in g["routes"].orderBy("route_id").collect()] == ["R1", "R2"]
    assert g["stops"].first().stop_name == "King, St"
    t = ST.prepare(g)
    assert headway_map(t) == {("504", 7): 60.0}


def test_parse_json_topic_rejects(spark):
    raw = spark.createDataFrame([('{"route_id": "504", "delay_score": 1.5}',), ("oops",),
                                 ('{"route_id": ""}',)], "value string")
    good, bad = FD.parse_json_topic(raw, schemas.DELAY_PREDICTION, "route_id")
    assert [r.route_id for r in good.collect()] == ["504"]
    assert bad.count() == 2


def test_normalize_alert_feed(spark):
    alert = {"effect": None, "cause": "STRIKE",
             "header_text": {"translation": [{"text": ""}, {"text": "Hello"}]},
             "description_text": {"translation": [{"text": ""}]},
             "informed_entity": [{"route_id": "2", "stop_id": None}, {"route_id": "", "stop_id": "s9"},
                                 {"route_id": "1", "stop_id": "s9"}, {"route_id": "2", "stop_id": "s1"}],
             "active_period": []}
    ent = spark.createDataFrame([("a1", alert, 0), ("a2", None, 7)], schemas.ALERT_ENTITY)
    rows = FD.normalize_alert_feed(ent, now_s=1234).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.alert_id, r.effect, r.cause, r.header_text, r.description_text) == \
        ("a1", "UNKNOWN_EFFECT", "STRIKE", "Hello", None)
    assert r.affected_route_ids == ["2", "1"] and r.affected_stop_ids == ["s9", "s1"]
    assert r.feed_ts == 1234 and r.active_since == 1234


def test_normalize_vehicle_feed_defaults(spark):
    ent = spark.createDataFrame([("e1", {"vehicle": None, "trip": None, "position": None, "timestamp": 5,
                                         "occupancy_status": None, "current_stop_sequence": None}),
                                 ("e2", None)], schemas.VEHICLE_ENTITY)
    rows = FD.normalize_vehicle_feed(ent).collect()
    assert [(r.vehicle_id, r.route_id, r.latitude, r.longitude, r.feed_ts, r.bearing) for r in rows] == \
        [("", "", 0.0, 0.0, 5, None)]


def test_publish_and_upsert(spark, scratch):
    r1 = spark.createDataFrame([("R1", "504", 0), ("R2", "505", 0)], "route_id string, route_short_name string, route_type int")
    K.publish_reference_tables(spark, {"routes": r1}, scratch)
    r2 = spark.createDataFrame([("R2", "505X", 3)], r1.schema)
    merged = K.upsert_routes(K.read_reference_table(spark, scratch, "routes"), r2)
    K.publish_reference_tables(spark, {"routes": merged}, scratch)
    assert K.current_version(spark, scratch) == 2
    got = {r.route_id: r.route_short_name for r in K.read_reference_table(spark, scratch, "routes").collect()}
    assert got == {"R1": "504", "R2": "505X"}


def test_keyed_json_sparse_and_explicit_nulls(spark):
    df = spark.createDataFrame([("V1", None)], "vehicle_id string, gap double")
    assert K.to_keyed_json(df, "vehicle_id").first().value == '{"vehicle_id":"V1"}'
    assert K.to_keyed_json(df, "vehicle_id", True).first().value == '{"vehicle_id":"V1","gap":null}'


def test_schedule_build_serves_pairs_once(spark, scratch):
    """the stop times meet the trips once for all tables that need the served pairs, and are not copied."""
    from conftest import SF_SMALL
    from tramline.sources import testdata as TD
    calls, paired, fed, feeders = [], ST.stop_routes, [], ST.station_feeder_routes
    try:
        ST.stop_routes = lambda *a: calls.append(a) or paired(*a)
        ST.station_feeder_routes = lambda *a: fed.append(feeders(*a)) or fed[-1]
        K.build_and_publish(spark, TD.gtfs_tables(spark, SF_SMALL), f"{scratch}/ref", TD.AS_OF_DATE)
    finally:
        ST.stop_routes, ST.station_feeder_routes = paired, feeders
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "orders" not in fed[0].inputFiles() and not any("lineitem" in f for f in fed[0].inputFiles())
    assert len(calls) == 1 and "LogicalRDD" not in plan(calls[0][1]) and "shuffle_hash" in plan(paired(*calls[0]))


def test_build_and_publish_reference_tables(spark, scratch):
    from conftest import SF_SMALL
    from tramline.sources import testdata as TD
    version = K.build_and_publish(spark, TD.gtfs_tables(spark, SF_SMALL), f"{scratch}/ref", TD.AS_OF_DATE)
    assert K.current_version(spark, f"{scratch}/ref") == version
    hw = K.read_reference_table(spark, f"{scratch}/ref", "scheduled_headways")
    t = ST.prepare(TD.gtfs_tables(spark, SF_SMALL))
    want = ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"], t["calendar"], TD.AS_OF_DATE)
    assert sorted(map(tuple, hw.collect())) == sorted(map(tuple, want.collect()))
    for name in ("routes", "trips", "route_stops", "station_feeder_routes"):
        assert K.read_reference_table(spark, f"{scratch}/ref", name).count() > 0


def test_views_helpers(spark):
    d = spark.createDataFrame([("504", 1.25, 5.0, 0.35)], "route_id string, actual_headway_minutes double, "
                                                          "scheduled_headway_minutes double, delay_score double")
    r = LV.headway_display(d).first()
    assert (r.delay_display, r.headway_display) == ("+0.35", "1.3 / 5.0")
    raw = spark.createDataFrame([('{"a":1}', 1), ("junk", 2), ('{"b":2}', 3)], "value string, arrival_seq long")
    assert [r.arrival_seq for r in LV.peek(raw, n=10, last=True).collect()] == [3, 1]
    routes = spark.createDataFrame([("R2", "10", 3), ("R1", "2", 3)], "route_id string, route_short_name string, route_type int")
    assert [r.route_id for r in LV.natural_route_order(routes.withColumnRenamed("route_id", "rid")
            .withColumnRenamed("route_short_name", "route_id")).collect()] == ["2", "10"]
    doc = LV.snapshot_document(routes, d, routes, d)
    assert sorted({r.section for r in doc.collect()}) == ["alerts", "delays", "ripples", "vehicles"]
    seen = spark.createDataFrame([("V1", T0), ("V2", T0 + dt.timedelta(seconds=300))], "vehicle_id string, seen_at timestamp")
    now = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) + 400
    assert [r.vehicle_id for r in LV.client_prune(seen, "seen_at", now).collect()] == ["V2"]
    good = FD.with_reject_counts(raw, schemas.DELAY_PREDICTION, "route_id")
    assert good.count() == 0


def test_reduced_first_snapshots_equal_per_record_path(spark):
    from conftest import SF_MID
    from tramline.sources import testdata as TD
    t = ST.prepare(TD.gtfs_tables(spark, SF_MID))
    pos, trips = TD.vehicle_positions(spark, SF_MID), ST.trip_directions(t["trips"])
    a = C.latest_snapshots(C.eligible(pos, trips))
    b = C.latest_snapshots_reduced_first(pos, trips)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 1000


def test_alerts_without_ripples_reports_unmatched(spark):
    a = alerts_df(spark, [("61", True, "matched", ["2"], ["H"]), ("62", True, "elevator", ["7"], ["12345"]),
                          ("63", True, "same sets as 61", ["2"], ["H", "H"])])
    assert [r.alert_id for r in A.alerts_without_ripples(a, demo_feeders(spark)).collect()] == ["62"]
    rip = {(r.source_alert_id, r.feeder_route_id) for r in A.ripples(a, demo_feeders(spark)).collect()}
    assert rip == {("61", "41"), ("61", "7"), ("63", "41"), ("63", "7")}


def test_client_state_and_counters(spark):
    pos = positions(spark, [("V1", "504", 3, 0, 0), ("V1", "504", None, 0, 30), ("V2", "505", 4, 0, 10)])
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    est = spark.createDataFrame(
        [("V1", "504", 0, None, None, 5.0, "NORMAL", t0 + 1000), ("V1", "504", 0, None, None, 5.0, "LIKELY_CROWDED", t0 + 2000),
         ("V9", "504", 0, None, None, 5.0, "LIKELY_EMPTY", t0 + 2000)], schemas.CROWDING_ESTIMATE)
    state = {r.vehicle_id: r for r in LV.client_vehicle_state(pos, est, t0 // 1000 + 60, "event_time").collect()}
    assert set(state) == {"V1", "V2"}                       # V9 is not a known vehicle
    assert state["V1"].crowding_level == "LIKELY_CROWDED" and state["V1"].current_stop_sequence == 3
    assert state["V2"].crowding_level is None
    counts = {r.counter: r.value for r in LV.live_counts(pos, est, est.limit(1)).collect()}
    assert counts == {"vehicles": 3, "alerts": 3, "ripples": 1}


def test_insert_ignore(spark):
    trips = spark.createDataFrame([("t1", "R2", 1), ("t1", "R1", 0), ("t2", "R3", None)],
                                  "trip_id string, route_id string, direction_id int")
    got = {r.trip_id: (r.route_id, r.direction_id) for r in
           K.insert_ignore(trips, ["trip_id"], ["route_id"]).collect()}
    assert got == {"t1": ("R1", 0), "t2": ("R3", None)}


def test_write_stream_keyed_json(spark, scratch):
    rows = spark.createDataFrame([("V1", 1, None), ("V2", 2, 0.5)], "vehicle_id string, seq int, gap double")
    rows.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{scratch}/in")
    K.write_stream(stream, "vehicle_id", f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    out = {r.key: r.value for r in spark.read.json(f"{scratch}/out").collect()}
    assert out == {"V1": '{"vehicle_id":"V1","seq":1}', "V2": '{"vehicle_id":"V2","seq":2,"gap":0.5}'}


def test_path_for_is_in_visiting_order(spark):
    paths = spark.createDataFrame([("7", 0, "C", 9), ("7", 0, "A", 1), ("7", 0, "B", 4), ("7", 1, "Z", 1)],
                                  "route_id string, direction_id int, stop_id string, stop_sequence int")
    assert [r.stop_id for r in ST.path_for(paths, "7", 0).collect()] == ["A", "B", "C"]
    assert [r.stop_id for r in ST.path_for(paths, "7", 1).collect()] == ["Z"]


def test_first_departure_hours_match_report_form(spark):
    st = spark.createDataFrame(
        [("a", "2", "07:00:00"), ("a", "1", "09:30:00"), ("b", "1", "-1:00:00"), ("c", "3", "xx:00:00"),
         ("c", "3", "05:00:00"), ("d", "1", "xx:00:00"), ("e", "1", "26:05:00"), ("e", "1", "", )],
        "trip_id string, stop_id string, arrival_time string").withColumnRenamed("stop_id", "stop_sequence")
    t = ST.normalize_stop_times(st.withColumn("stop_id", F.lit("S")))
    hours = {r.trip_id: r.hour_of_day for r in ST.first_departure_hours(t).collect()}
    report = {r.trip_id: r.arrival_time for r in ST.first_departures(t).collect()}
    # c: of two rows at one sequence the first counts, though it has no hour
    assert hours == {"a": 9, "b": 23, "c": None, "d": None, "e": 2}
    assert report == {"a": "09:30:00", "b": "-1:00:00", "c": "xx:00:00", "d": "xx:00:00", "e": "26:05:00"}


@pytest.mark.parametrize("block,super_block", [(2, 1), (7, 3), (64, 4)])
def test_blocked_helpers_equal_plain_windows(spark, block, super_block):
    """Two-level blocked forms equal the plain per-key window at any block sizes."""
    from conftest import SF_MID
    from pyspark.sql.window import Window as W
    from tramline.sources import testdata as TD
    pos = D.route_present(TD.vehicle_positions(spark, SF_MID))
    plain = pos.withColumn("st", F.max("event_time").over(
        W.orderBy("arrival_seq").rowsBetween(W.unboundedPreceding, 0)))
    blocked = D.mark_late(pos, block=block, super_block=super_block)
    a = plain.select("arrival_seq", "st").exceptAll(blocked.select("arrival_seq", F.col("stream_time").alias("st")))
    assert a.count() == 0
    alerts = TD.service_alerts(spark, SF_MID)
    fp = A.with_fingerprint(alerts.where("has_body"))
    want = fp.withColumn("p", F.lag("fingerprint").over(W.partitionBy("alert_id").orderBy("arrival_seq")))
    got = A.previous_value(fp, ["alert_id"], "arrival_seq", "fingerprint", "p", block, super_block)
    assert want.select("arrival_seq", "p").exceptAll(got.select("arrival_seq", "p")).count() == 0
    assert got.count() == want.count()


def test_mark_late_per_partition_stream_time(spark):
    """With a partition column, stream time advances per partition: a record is
    late only relative to its own partition's history."""
    pos = positions(spark, [("V1", "504", 1, 0, 10), ("V2", "504", 1, 0, 400), ("V3", "504", 1, 0, 20),
                            ("V4", "504", 1, 0, 30)])
    part = pos.withColumn("part", F.when(F.col("vehicle_id").isin("V1", "V2", "V3"), 0).otherwise(1))
    for block, sup in ((1 << 20, 1 << 10), (1, 1)):
        late = {r.vehicle_id for r in D.mark_late(part, partition_col="part", block=block, super_block=sup)
                .where("is_late").collect()}
        assert late == {"V3"}              # V4 (partition 1) never saw the +400 s record


def test_repeated_trip_ids_count_once(spark):
    """Two rows of T1 and one T2 in an hour are two trips: a headway of 30 minutes, not 20."""
    trips = spark.createDataFrame([("T1", "R1", "s", "0", "a"), ("T1", "R1", "s", "0", "a"), ("T2", "R1", "s", "0", "a")],
                                  "trip_id string, route_id string, service_id string, direction_id string, shape_id string")
    routes = spark.createDataFrame([("R1", "5", "3")], "route_id string, route_short_name string, route_type string")
    times = spark.createDataFrame([("T1", "x", "1", "08:00:00"), ("T2", "x", "1", "08:30:00")],
                                  "trip_id string, stop_id string, stop_sequence string, arrival_time string")
    out = ST.scheduled_headways(ST.normalize_routes(routes), ST.normalize_trips(trips), ST.normalize_stop_times(times), None, "20240115")
    assert [(r.hour_of_day, r.scheduled_headway_minutes) for r in out.collect()] == [(8, 30.0)]


def test_tombstones_do_not_reach_live_views(spark):
    a = alerts_df(spark, [("Y", True, "stays", ["2"], ["s"]), ("Y", False, None, None, None)])
    assert A.current_alerts(a).count() == 0
    assert [r.header_text for r in A.last_bodies(a).collect()] == ["stays"]


def test_client_forgets_a_silent_vehicle(spark):
    """Old fields go with the vehicle; a level counts only while it is known."""
    rows = [("V", 0, "FULL", 1), ("V", 1000, None, 2), ("V", 1100, None, 3), ("W", 1000, "EMPTY", 4), ("X", 100, "FULL", 5)]
    pos = spark.createDataFrame([(v, t, o, s, "1", 1.0, 1.0, None, None, t, None, None, None) for v, t, o, s in rows],
                                "vehicle_id string, at long, occupancy string, arrival_seq long, route_id string, latitude double, longitude double, "
                                "bearing float, speed float, feed_ts long, trip_id string, direction_id int, current_stop_sequence int")
    pos = pos.withColumn("received_at", F.timestamp_seconds("at"))
    levels = spark.createDataFrame([("V", 900_000, "1", 0, "NORMAL"), ("W", 1_010_000, "1", 0, "LIKELY_EMPTY")],
                                   "vehicle_id string, window_end long, route_id string, direction_id int, crowding_level string")
    out = {r.vehicle_id: (r.occupancy, r.crowding_level) for r in LV.client_vehicle_state(pos, levels, 1150).collect()}
    assert out == {"V": (None, None), "W": ("EMPTY", "LIKELY_EMPTY")}


def test_crowding_groups_with_a_third_of_all_rows(spark):
    """Gaps by different stop sequences equal gaps by a full sort of the group's vehicles."""
    rows = [("r1" if i % 3 == 0 else f"r{i}", 0, f"V{i:04d}", (i * 7) % 13) for i in range(900)]
    w = F.struct(F.timestamp_seconds(F.lit(0)).alias("start"), F.timestamp_seconds(F.lit(300)).alias("end")).alias("w")
    snaps = spark.createDataFrame(rows, "route_id string, direction_id int, vehicle_id string, seq int").select("*", w)
    scheduled = snaps.withColumn("scheduled_headway_minutes", F.lit(5.0))
    got = {(r.route_id, r.vehicle_id): r.gap_ahead_minutes for r in C.gaps_by_window_function(scheduled).collect()}
    groups = {}
    for r, _, v, s in rows:
        groups.setdefault(r, []).append((s, v))
    for r, g in groups.items():
        g.sort()
        span = g[-1][0] - g[0][0]
        for (s, v), ahead in zip(g, [*g[1:], None]):
            want = None if ahead is None or span <= 0 else math.floor((ahead[0] - s) * (5.0 / span) * 100 + 0.5) / 100
            assert got[r, v] == want, (r, v)


def test_publishing_during_a_read_changes_nothing(spark, scratch):
    """One version for all tables of a query, also when the next ones come and old ones are cleaned meanwhile."""
    from tramline.sinks import writers as K
    from tramline.sinks.manifest import Manifest
    publish = lambda n: K.publish_reference_tables(spark, {t: spark.range(n) for t in ("a", "b")}, scratch)
    assert K.current_version(spark, scratch) is None and publish(1) == 1
    with Manifest(spark, scratch).pin() as held:
        a = held.table("a")
        assert [publish(n) for n in (2, 3, 4)] == [2, 3, 4]
        Manifest(spark, scratch).clean(keep=1, young_s=0)
        assert a.count() == held.table("b").count() == 1
        assert K.read_reference_table(spark, scratch, "a").count() == 4
    Manifest(spark, scratch).clean(keep=1, young_s=0)
    assert Manifest(spark, scratch).versions() == [4]


def test_no_checkpoint_folder_is_made_up(spark):
    from tramline.session import checkpoint_root

    class Unset:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})

    assert checkpoint_root(spark)
    with pytest.raises(RuntimeError):
        checkpoint_root(Unset)
