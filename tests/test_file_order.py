"""First, last and every row of repeated keys, in the order of rows in their files."""

import random

import pytest
from pyspark.sql import functions as F

from tramline.operators import static as ST
from tramline.sources import gtfs
from tramline.sources.order import FILE_POS, first_row, last_row, with_file_pos


def _text(path, header, rows):
    path.write_text("\n".join([header, *(",".join(r) for r in rows)]) + "\n")


@pytest.fixture()
def small_splits(spark):
    """Splits of some 200 bytes, several files to a task."""
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_text_rows_keep_their_order_over_splits(small_splits, tmp_path):
    rng = random.Random(1)
    rows = [(f"T{rng.randrange(60)}", f"R{i}", "s", "", "x" * rng.randrange(30)) for i in range(1500)]
    _text(tmp_path / "trips.txt", "trip_id,route_id,service_id,direction_id,shape_id", rows)
    table = gtfs.read_gtfs_file(small_splits, str(tmp_path / "trips.txt"), ["trip_id", "route_id"])
    assert table.rdd.getNumPartitions() > 50
    assert [r.route_id for r in table.orderBy(FILE_POS).collect()] == [r[1] for r in rows]
    last, first = {}, {}
    for trip, route, *_ in rows:
        last[trip] = route
        first.setdefault(trip, route)
    assert {r.trip_id: r.route_id for r in last_row(table, "trip_id").collect()} == last
    assert {r.trip_id: r.route_id for r in first_row(table, "trip_id").collect()} == first


def test_several_files_follow_by_name(small_splits, tmp_path):
    rows, folder = [], tmp_path / "stop_times.txt"
    folder.mkdir()
    for part in ("part-2", "part-0", "part-1"):
        own = [(part, str(i)) for i in range(30 if part == "part-1" else 7)]
        _text(folder / part, "file,number", own)
        rows += own
    table = gtfs.read_gtfs_file(small_splits, str(folder), ["file", "number"])
    got = [(r.file, r.number) for r in table.orderBy(FILE_POS).collect()]
    assert got == sorted(rows, key=lambda r: (r[0], int(r[1])))


def test_parquet_rows_keep_their_order(small_splits, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        small_splits.range(i * 1000, i * 1000 + 1000).coalesce(1).write.mode("append").parquet(path)
    names = sorted(f.name for f in (tmp_path / "t").iterdir() if f.name.startswith("part"))
    table = with_file_pos(small_splits.read.parquet(path), numbered=True)
    marked = table.orderBy(FILE_POS).select("id", F.input_file_name().alias("f")).collect()
    ids = [r.id for r in marked]
    assert sorted(ids) == list(range(3000)) and len(names) == 3
    assert [ids[i:i + 1000] == list(range(ids[i], ids[i] + 1000)) for i in (0, 1000, 2000)] == [True] * 3


TRIPS = "trip_id string, route_id string, service_id string, direction_id string, shape_id string"
ROUTES = "route_id string, route_short_name string, route_type string"
TIMES = "trip_id string, stop_id string, stop_sequence string, arrival_time string"
CALENDAR = "service_id string, wednesday string, start_date string, end_date string"


def _frame(spark, rows, schema):
    """One partition: the order of the list is the order of the rows."""
    return spark.createDataFrame(rows, schema).coalesce(1)


def _case(spark, trips, times=(), routes=(("R1", "5", "3"), ("R2", "6", "3"))):
    calendar = _frame(spark, [("WK", "1", "20240101", "20241231"), ("ZSAT", "0", "20240101", "20241231")], CALENDAR)
    return (ST.normalize_routes(_frame(spark, list(routes), ROUTES)), ST.normalize_trips(_frame(spark, trips, TRIPS)),
            ST.normalize_stop_times(_frame(spark, list(times), TIMES)), calendar)


def test_one_id_under_two_services(spark):
    """The weekday row of T1 counts for headways though another service's row follows; both count for the shape."""
    routes, trips, times, calendar = _case(
        spark, [("T1", "R1", "WK", "0", "s1"), ("T1", "R1", "ZSAT", "0", "s1"), ("T2", "R1", "WK", "0", "s2")],
        [("T1", "a", "1", "08:00:00"), ("T2", "a", "1", "08:30:00")])
    headways = ST.scheduled_headways(routes, trips, times, calendar, "20240115").collect()
    assert [(r.route_id, r.hour_of_day, r.scheduled_headway_minutes) for r in headways] == [("5", 8, 30.0)]
    assert [(r.shape_id, r.trip_count, r.rep_trip_id) for r in ST.dominant_shapes(routes, trips).collect()] == [("s1", 2, "T1")]


def test_four_rules_for_one_repeated_id(spark):
    routes, trips, times, calendar = _case(
        spark, [("T1", "R1", "WK", "1", "s"), ("T1", "R2", "WK", "", "s"), ("T1", "R1", "ZSAT", "0", "s")], [("T1", "a", "1", "09:00:00")])
    assert [tuple(r) for r in ST.trip_directions(trips).collect()] == [("T1", "R1", 1)]                    # first of all
    assert [tuple(r) for r in ST.stop_routes(trips, times).collect()] == [("a", "R1")]                     # last of all
    assert [(r.route_id, r.direction_id) for r in ST.trips_per_hour_direction(
        routes, trips, times, calendar, "20240115").collect()] == [("6", "0")]                             # last weekday row
    assert sorted((r.route_id, r.direction_id, r.trip_count) for r in ST.dominant_shapes(routes, trips).collect()) == [
        ("5", 0, 1), ("5", 1, 1), ("6", 0, 1)]                                                             # every row


def test_last_weekday_row_of_an_unknown_route_takes_the_trip_away(spark):
    routes, trips, times, calendar = _case(spark, [("T1", "R1", "WK", "0", "s"), ("T1", "R9", "WK", "0", "s")], [("T1", "a", "1", "09:00:00")])
    assert ST.scheduled_headways(routes, trips, times, calendar, "20240115").count() == 0


def test_equal_shape_counts_go_to_the_first_shape_and_its_first_trip(spark):
    routes, trips, *_ = _case(spark, [("T9", "R1", "WK", "0", "z"), ("T2", "R1", "WK", "0", "a"), ("T1", "R1", "WK", "0", "z"), ("T3", "R1", "WK", "0", "a")])
    assert [(r.shape_id, r.trip_count, r.rep_trip_id) for r in ST.dominant_shapes(routes, trips).collect()] == [("z", 2, "T9")]


def test_a_trip_that_stands_for_two_paths_draws_the_later_one(spark):
    routes, trips, times, _ = _case(spark, [("T1", "R2", "WK", "0", "s"), ("T1", "R1", "WK", "0", "s")], [("T1", "a", "1", "08:00:00")])
    assert len(ST.dominant_shapes(routes, trips).collect()) == 2
    assert [tuple(r) for r in ST.representatives(routes, trips).collect()] == [("T1", "5", 0)]


def test_routes_and_stops_keep_their_last_row(spark):
    routes = ST.normalize_routes(_frame(spark, [("R1", "9", "3"), ("R1", "5", "")], ROUTES))
    assert [tuple(r) for r in routes.collect()] == [("R1", "5", None)]
    stops = ST.normalize_stops(_frame(spark, [("a", "one", "1", "2", "", ""), ("a", "two", "3", "4", "", ""), ("a", "bad", "n/a", "4", "", "")],
                                      "stop_id string, stop_name string, stop_lat string, stop_lon string, location_type string, parent_station string"))
    assert [(r.stop_name, r.latitude) for r in stops.collect()] == [("two", 3.0)]


def test_first_departure_of_equal_sequences_is_the_first_row(spark):
    times = ST.normalize_stop_times(_frame(spark, [("T", "a", "2", "05:00:00"), ("T", "b", "1", "09:10:00"), ("T", "c", "1", "08:00:00")], TIMES))
    assert [tuple(r) for r in ST.first_departures(times).collect()] == [("T", 1, "09:10:00")]
