"""Explicit schemas of the data model (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, F_, I, L, TS = (T.StringType(), T.DoubleType(), T.FloatType(),
                      T.IntegerType(), T.LongType(), T.TimestampType())


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# A normalized vehicle position. ``feed_ts`` is the feed's own timestamp in
# epoch seconds; ``event_time`` is the record time used for windowing;
# ``arrival_seq`` is the record's position in the stream (offset).
VEHICLE_POSITION = _struct(
    ("vehicle_id", S, False), ("route_id", S, False),
    ("latitude", D, False), ("longitude", D, False),
    ("bearing", F_, True), ("speed", F_, True), ("feed_ts", L, False),
    ("occupancy", S, True), ("trip_id", S, True), ("direction_id", I, True),
    ("current_stop_sequence", I, True),
    ("event_time", TS, False), ("arrival_seq", L, False),
)

# A service alert version on the changelog. A row whose ``has_body`` is false
# is a tombstone (deletion of ``alert_id``).
SERVICE_ALERT = _struct(
    ("alert_id", S, False), ("has_body", T.BooleanType(), False),
    ("effect", S, True), ("cause", S, True), ("header_text", S, True),
    ("description_text", S, True),
    ("affected_route_ids", T.ArrayType(S), True),
    ("affected_stop_ids", T.ArrayType(S), True),
    ("active_since", L, True), ("feed_ts", L, True),
    ("event_time", TS, True), ("arrival_seq", L, False),
)

DELAY_PREDICTION = _struct(
    ("route_id", S, False), ("window_start", L, False), ("window_end", L, False),
    ("actual_headway_minutes", D, False), ("scheduled_headway_minutes", D, False),
    ("delay_score", D, False),
)

CROWDING_ESTIMATE = _struct(
    ("vehicle_id", S, False), ("route_id", S, False), ("direction_id", I, False),
    ("gap_ahead_minutes", D, True), ("crowding_ratio", D, True),
    ("scheduled_headway_minutes", D, False), ("crowding_level", S, False),
    ("window_end", L, False),
)

RIPPLE_ALERT = _struct(
    ("ripple_id", S, False), ("source_alert_id", S, False), ("source_effect", S, True),
    ("affected_station", S, False), ("feeder_route_id", S, False),
    ("predicted_impact", S, False), ("header_text", S, False),
)

# Raw GTFS text files as read by header name: every column is a string.
GTFS_COLUMNS = {
    "routes": ["route_id", "route_short_name", "route_type"],
    "calendar": ["service_id", "wednesday", "start_date", "end_date"],
    "trips": ["trip_id", "route_id", "service_id", "direction_id", "shape_id"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type",
              "parent_station"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time"],
}

# Vehicle feed entity as landed from the live feed (one row per entity).
VEHICLE_ENTITY = _struct(
    ("id", S, True),
    ("vehicle", _struct(
        ("vehicle", _struct(("id", S, True)), True),
        ("trip", _struct(("route_id", S, True), ("trip_id", S, True),
                         ("direction_id", I, True)), True),
        ("position", _struct(("latitude", F_, False), ("longitude", F_, False),
                             ("bearing", F_, True), ("speed", F_, True)), True),
        ("timestamp", L, True),
        ("occupancy_status", S, True),
        ("current_stop_sequence", I, True),
    ), True),
)

_TRANSLATED = _struct(("translation", T.ArrayType(_struct(("text", S, True))), True))

# Alert feed entity; ``header_timestamp`` is the feed header's timestamp.
ALERT_ENTITY = _struct(
    ("id", S, True),
    ("alert", _struct(
        ("effect", S, True), ("cause", S, True),
        ("header_text", _TRANSLATED, True), ("description_text", _TRANSLATED, True),
        ("informed_entity", T.ArrayType(_struct(("route_id", S, True),
                                                ("stop_id", S, True))), True),
        ("active_period", T.ArrayType(_struct(("start", L, True))), True),
    ), True),
    ("header_timestamp", L, True),
)
