"""Transit views over the driver's synthetic tables (FIXTURES.md §3).

The driver ships TPC-H-like tables plus an ``events`` stream; these
projections turn them into the transit inputs the operators expect:
``vehicle_positions`` and ``service_alerts`` (streams), and the GTFS text
files ``routes_txt``, ``trips_txt``, ``calendar_txt``, ``stops_txt`` and
``stop_times_txt`` (all string-typed, as a CSV scan would give them).

The expressions are the Spark spelling of the mapping the DuckDB oracle uses,
so both engines see identical inputs. Each view reads only the columns it
needs, so the parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from .order import FILE_POS, with_file_pos

# Thirty days of events are compressed 60x into twelve hours from this epoch.
EPOCH_US = 1704067200000000
# As-of date used to pick the weekday calendar window.
AS_OF_DATE = "20240115"
# Wall clock for live views (TTL checks): 2024-01-01 12:00:00 UTC.
AS_OF_EPOCH_S = 1704110400

_EVENT_TIME_US = f"({EPOCH_US} + (unix_micros(cast(ts as timestamp)) - {EPOCH_US}) div 60)"


# Declared schemas of the driver tables (only the columns used here), so a
# scan needs no schema-inference job and reads just these columns.
DRIVER_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "supplier": "s_suppkey bigint",
    "nation": "n_nationkey int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _read_file(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """With every row's place in its file, as ``read_gtfs`` gives it."""
    return with_file_pos(_read(spark, sf_dir, name), numbered=True)


def vehicle_positions(spark: SparkSession, sf_dir: str, received: bool = False) -> DataFrame:
    """Positions; ``received`` adds when each arrived (its record time may be older)."""
    configure(spark)
    more = [f"timestamp_micros({_EVENT_TIME_US}) as received_at"] if received else []
    return _read(spark, sf_dir, "events").selectExpr(
        "case when event_id % 97 = 0 then '' else 'V' || user_id end as vehicle_id",
        "case when event_type = 'error' then '' else cast(500 + user_id % 12 as string) end as route_id",
        "case when event_id % 101 = 0 then cast(0 as double) "
        "else cast(43.6 + (user_id % 50) * 0.002 as double) end as latitude",
        "case when event_id % 101 = 0 then cast(0 as double) "
        "else cast(-79.4 + (user_id % 50) * 0.002 as double) end as longitude",
        "case when event_id % 4 = 0 then null else cast(event_id % 360 as float) end as bearing",
        "cast(null as float) as speed",
        "case when event_id % 5 = 0 then 'EMPTY' end as occupancy",
        "case when event_id % 13 = 0 then null else 'T' || (user_id div 12 + 1) end as trip_id",
        "case when event_id % 29 = 0 then cast(user_id % 2 as int) end as direction_id",
        "case when event_type = 'signup' then null "
        "else cast(floor(value) as int) % 60 end as current_stop_sequence",
        f"timestamp_micros({_EVENT_TIME_US} "
        "- case when event_id % 17 = 0 then 400000000 else 0 end) as event_time",
        f"{_EVENT_TIME_US} div 1000000 - (event_id % 3) * 20 as feed_ts",
        "event_id as arrival_seq",
        *more,
    )


def vehicle_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of a JSON topic (value, arrival_seq), some of them damaged: cut off, no JSON at all,
    without a key, or empty."""
    configure(spark)
    whole = ("'{\"vehicle_id\":\"' || case when event_id % 37 = 5 then '' else 'V' || user_id end || '\",\"route_id\":\"' "
             "|| (500 + user_id % 12) || '\",\"event_id\":' || event_id || '}'")
    return _read(spark, sf_dir, "events").selectExpr(
        f"case when event_id % 31 = 3 then substring({whole}, 1, length({whole}) - 4) when event_id % 41 = 7 then 'no JSON ' || event_id "
        f"when event_id % 43 = 11 then null else {whole} end as value", "event_id as arrival_seq")


def service_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert changelog; ``has_body = false`` rows are tombstones.

    ``event_time`` / ``feed_ts`` use the same 60x compression as positions.
    """
    configure(spark)
    version = "case when (event_id div 500) % 3 = 1 then 1 else 0 end"
    return (_read(spark, sf_dir, "events").selectExpr(
        "'A' || (user_id % 40) as alert_id",
        "event_id % 333 <> 0 and not (user_id % 8 = 3 and event_id % 2 = 0) as has_body",
        "case when user_id % 4 = 0 then 'NO_SERVICE' else 'DETOUR' end as effect",
        "case when (event_id div 700) % 2 = 1 then 'CONSTRUCTION' end as cause",
        f"'Alert ' || (user_id % 40) || ' v' || ({version}) as header_text",
        "case when user_id % 3 = 0 then 'Detail ' || ((event_id div 300) % 4) end as description_text",
        "array(cast(500 + user_id % 12 as string)) as affected_route_ids",
        f"case when user_id % 8 = 5 then array('X' || user_id % 40, 'X0') else "
        f"array('S' || (10 * (user_id % 10)), 'S' || (10 * ((user_id + {version}) % 10))) end "
        "as affected_stop_ids",
        f"{_EVENT_TIME_US} div 1000000 as active_since",
        f"{_EVENT_TIME_US} div 1000000 as feed_ts",
        f"timestamp_micros({_EVENT_TIME_US}) as event_time",
        "event_id as arrival_seq",
    ))


def routes_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return (_read_file(spark, sf_dir, "nation")
            .selectExpr(
                "'R' || n_nationkey as route_id",
                "case when n_nationkey = 10 then '' when n_nationkey = 12 then '503' "
                "else cast(500 + n_nationkey as string) end as route_short_name",
                "case when n_nationkey < 2 then 1 when n_nationkey < 5 then 0 "
                "when n_nationkey = 9 then null else 3 end as route_type", FILE_POS))


def trips_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _read_file(spark, sf_dir, "orders").selectExpr(
        # every 50th order repeats the trip id of the one before it; R25 is no route
        "'T' || case when o_orderkey % 50 = 7 then o_orderkey - 1 else o_orderkey end as trip_id",
        "'R' || (o_custkey % 26) as route_id",
        "o_orderpriority as service_id",
        "case when o_orderkey % 7 = 0 then '' else cast(o_orderkey % 2 as string) end as direction_id",
        "o_orderstatus as shape_id", FILE_POS)


# Fixed test calendar (FIXTURES.md §3): service_id, wednesday, start, end.
CALENDAR_ROWS = [
    ("1-URGENT", "1", "20240101", "20240630"),
    ("2-HIGH", "1", "20240101", "20240630"),
    ("3-MEDIUM", " 1 ", "20230701", "20231231"),
    ("4-NOT SPECIFIED", "0", "20240101", "20240630"),
    ("5-LOW", "1", "20231015", "20240630"),
]


def calendar_txt(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    configure(spark)
    # A VALUES relation stays in the JVM (no Python-side RDD behind it).
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in CALENDAR_ROWS)
    return spark.sql(f"select * from values {values} as t(service_id, wednesday, start_date, end_date)")


def stops_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _read_file(spark, sf_dir, "supplier").selectExpr(
        "'S' || s_suppkey as stop_id",
        "'Stop ' || s_suppkey as stop_name",
        "case when s_suppkey % 37 = 5 then 'n/a' "
        "else cast(43.60 + (s_suppkey % 10) * 0.0005 + (s_suppkey % 7) * 0.0001 as string) end as stop_lat",
        "cast(-79.40 + (s_suppkey div 10) * 0.002 as string) as stop_lon",
        "case when s_suppkey % 10 = 0 then '1' else '' end as location_type",
        "case when s_suppkey % 10 in (1, 2) then 'S' || (s_suppkey - s_suppkey % 10) else '' end "
        "as parent_station", FILE_POS)


def stop_times_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return (_read_file(spark, sf_dir, "lineitem")
            .selectExpr(
                "'T' || l_orderkey as trip_id",
                "'S' || l_suppkey as stop_id",
                "cast(l_linenumber as string) as stop_sequence",
                "case when l_linenumber = 1 and l_returnflag = 'R' then '' "
                "else lpad(cast(l_orderkey % 28 as string), 2, '0') || ':' || lpad(cast(l_suppkey % 60 as string), 2, '0') "
                "|| ':00' end as arrival_time", FILE_POS))


def gtfs_tables(spark: SparkSession, sf_dir: str) -> dict:
    """The five GTFS text tables, keyed like ``read_gtfs`` returns them.

    Values are zero-argument builders, so only the tables a job uses are read.
    """
    return {
        "routes": lambda: routes_txt(spark, sf_dir),
        "trips": lambda: trips_txt(spark, sf_dir),
        "calendar": lambda: calendar_txt(spark, sf_dir),
        "stops": lambda: stops_txt(spark, sf_dir),
        "stop_times": lambda: stop_times_txt(spark, sf_dir),
    }
