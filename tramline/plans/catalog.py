"""Registered queries: each is ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through ``sources.testdata`` and runs
over them whole. Queries of the schedule job build it; those of the live jobs read
the tables it has published (``serving``). Columns whose wire form is an epoch (window bounds,
detection times) are returned as epoch milliseconds and arrays as
comma-joined text, so results compare across engines without type
ambiguity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import alerts as A
from ..operators import crowding as C
from ..operators import delay as D
from ..operators import live as LV
from ..operators import static as ST
from ..session import checkpoint_root
from ..sinks import writers as K
from ..sources import feeds as FD
from ..sources import testdata as TD
from .serving import served

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = TD.AS_OF_DATE
NOW = TD.AS_OF_EPOCH_S


# ---------------------------------------------------------------------------
# Shared building blocks (lazy; each query builds its own plan)
# ---------------------------------------------------------------------------
def _t(spark, sf_dir) -> dict[str, DataFrame]:
    return ST.prepare(TD.gtfs_tables(spark, sf_dir))


def _headways(t) -> DataFrame:
    return ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"], t["calendar"], AS_OF)


def _feeders(t) -> DataFrame:
    """Feeder routes; the served pairs (a few per stop) are staged once, for the stations, the
    surface stops and the pairs all need them and each would scan the stop times anew."""
    pairs = ST.stop_routes(t["trips"], t["stop_times"])
    checkpoint_root(pairs.sparkSession)
    pairs = pairs.checkpoint()
    stations = ST.subway_stations(t["routes"], t["stops"], pairs)
    return ST.station_feeder_routes(t["routes"], t["stops"], pairs, stations)


def _positions(spark, sf_dir) -> DataFrame:
    return TD.vehicle_positions(spark, sf_dir)


def _alerts(spark, sf_dir) -> DataFrame:
    return TD.service_alerts(spark, sf_dir)


def _crowding(spark, sf_dir, array_form=False) -> DataFrame:
    known = served(spark, sf_dir)
    return C.crowding_estimates(_positions(spark, sf_dir), known.trips, known.headways, array_form=array_form)


def _ripples(spark, sf_dir) -> DataFrame:
    return A.ripples(_alerts(spark, sf_dir), served(spark, sf_dir).feeders)


def _live_ripples(spark, sf_dir) -> DataFrame:
    return LV.live_ripples(A.latest_ripples(_alerts(spark, sf_dir), served(spark, sf_dir).feeders), NOW)


def _text(df: DataFrame, *array_cols: str) -> DataFrame:
    for c in array_cols:
        df = df.withColumn(c, F.array_join(c, ","))
    return df


ALERT_OUT = ["alert_id", "effect", "header_text", "affected_route_ids", "affected_stop_ids",
             "feed_ts", "arrival_seq"]


# ---------------------------------------------------------------------------
# J2: static schedule build
# ---------------------------------------------------------------------------
def q_routes(spark, sf_dir):
    return _t(spark, sf_dir)["routes"]


def q_weekday_trips(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.weekday_trips(t["trips"], t["calendar"], AS_OF).select(
        "trip_id", "route_id", "service_id", "direction_raw")


def q_trip_directions(spark, sf_dir):
    return ST.trip_directions(_t(spark, sf_dir)["trips"])


def q_trips_first_row(spark, sf_dir):
    """A-16: the trips table as it is loaded, a later row of an id ignored."""
    return ST.trip_directions(_t(spark, sf_dir)["trips"])


def q_trips_last_row(spark, sf_dir):
    """A-16: the route that a trip's stops count for, a later row of an id in place of the one before."""
    return ST.trip_routes(_t(spark, sf_dir)["trips"])


def q_first_departures(spark, sf_dir):
    return ST.first_departures(_t(spark, sf_dir)["stop_times"])


def q_trips_per_hour_direction(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.trips_per_hour_direction(t["routes"], t["trips"], t["stop_times"], t["calendar"], AS_OF)


def q_scheduled_headways(spark, sf_dir):
    return _headways(_t(spark, sf_dir))


def q_route_headway_report(spark, sf_dir):
    """L-7: one route's headways by hour (the loader's sanity report)."""
    return (_headways(_t(spark, sf_dir)).where(F.col("route_id") == "504")
            .orderBy("hour_of_day"))


def q_dominant_shapes(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.dominant_shapes(t["routes"], t["trips"])


def q_route_paths(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.route_paths(t["routes"], t["trips"], t["stops"], t["stop_times"])


def q_route_path_fallback(spark, sf_dir):
    return ST.path_for(q_route_paths(spark, sf_dir), None, 0)


def q_stop_routes(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.stop_routes(t["trips"], t["stop_times"])


def q_subway_stations(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ST.subway_stations(t["routes"], t["stops"], ST.stop_routes(t["trips"], t["stop_times"]))


def q_station_feeder_routes(spark, sf_dir):
    return _feeders(_t(spark, sf_dir))


def q_station_feeders_report(spark, sf_dir):
    """L-7 / F-17: feeders of stations whose name contains a text, by route."""
    return (_feeders(_t(spark, sf_dir))
            .where(F.lower("station_name").contains("stop 10"))
            .orderBy("route_id", "station_name", "distance_meters"))


# ---------------------------------------------------------------------------
# J3: delay
# ---------------------------------------------------------------------------
def q_delay_scores(spark, sf_dir):
    return D.delay_scores(_positions(spark, sf_dir), served(spark, sf_dir).headways)


def q_delay_scores_on_time_only(spark, sf_dir):
    return D.delay_scores_on_time(_positions(spark, sf_dir), served(spark, sf_dir).headways)


def q_unscheduled_windows(spark, sf_dir):
    return D.unscheduled_windows(_positions(spark, sf_dir), served(spark, sf_dir).headways)


def q_late_positions(spark, sf_dir):
    marked = D.mark_late(D.route_present(_positions(spark, sf_dir)))
    return marked.where("is_late").select(
        "arrival_seq", "route_id", "vehicle_id",
        X.epoch_ms("event_time").alias("event_time_ms"),
        X.epoch_ms("stream_time").alias("stream_time_ms"))


# ---------------------------------------------------------------------------
# J4: crowding
# ---------------------------------------------------------------------------
def q_resolved_direction(spark, sf_dir):
    return C.eligible(_positions(spark, sf_dir), served(spark, sf_dir).trips).select(
        "arrival_seq", "vehicle_id", "route_id", "direction_id", "current_stop_sequence")


def q_latest_vehicle_snapshot(spark, sf_dir):
    snaps = C.latest_snapshots_reduced_first(_positions(spark, sf_dir), served(spark, sf_dir).trips)
    return snaps.select("route_id", "direction_id", X.epoch_ms("w.start").alias("window_start"),
                        "vehicle_id", F.col("seq").alias("current_stop_sequence"), "feed_ts",
                        "arrival_seq")


def q_crowding_estimates(spark, sf_dir):
    return _crowding(spark, sf_dir)


def q_crowding_estimates_array_form(spark, sf_dir):
    return _crowding(spark, sf_dir, array_form=True)


# ---------------------------------------------------------------------------
# J1 alerts + J5 ripples
# ---------------------------------------------------------------------------
def q_alert_changes(spark, sf_dir):
    out = A.alert_changes(_alerts(spark, sf_dir)).select(*ALERT_OUT)
    return _text(out, "affected_route_ids", "affected_stop_ids")


def q_current_alerts(spark, sf_dir):
    out = A.current_alerts(_alerts(spark, sf_dir)).select(*ALERT_OUT)
    return _text(out, "affected_route_ids", "affected_stop_ids")


def q_ripple_changelog(spark, sf_dir):
    return _ripples(spark, sf_dir).select(
        "ripple_id", "source_alert_id", "source_effect", "affected_station", "feeder_route_id",
        "predicted_impact", "header_text", "arrival_seq")


def q_ripples_live(spark, sf_dir):
    return _live_ripples(spark, sf_dir).select(
        "ripple_id", "source_alert_id", "affected_station", "feeder_route_id", "header_text",
        "arrival_seq", X.epoch_ms("written_at").alias("detected_at"))


def q_alerts_without_ripples(spark, sf_dir):
    out = A.alerts_without_ripples(_alerts(spark, sf_dir), served(spark, sf_dir).feeders).select(
        "alert_id", "effect", "header_text", "affected_stop_ids", "arrival_seq")
    return _text(out, "affected_stop_ids")


# ---------------------------------------------------------------------------
# J6: live state and serving views
# ---------------------------------------------------------------------------
VEHICLE_OUT = ["vehicle_id", "route_id", "latitude", "longitude", "bearing", "feed_ts",
               "occupancy", "trip_id", "direction_id", "current_stop_sequence", "arrival_seq"]


CROWDING_OUT = ["vehicle_id", "route_id", "direction_id", "gap_ahead_minutes", "crowding_ratio", "scheduled_headway_minutes",
                "crowding_level", "window_end"]
RIPPLE_OUT = ["ripple_id", "source_alert_id", "source_effect", "affected_station", "feeder_route_id", "predicted_impact",
              "header_text", "arrival_seq"]


def _live_vehicles(spark, sf_dir):
    return LV.live_vehicles(_positions(spark, sf_dir), NOW)


def q_live_vehicles(spark, sf_dir):
    return _live_vehicles(spark, sf_dir).select(*VEHICLE_OUT)


def q_vehicle_sticky_state(spark, sf_dir):
    return LV.sticky_state(_positions(spark, sf_dir)).select(
        "vehicle_id", "route_id", "latitude", "longitude", "bearing", "occupancy", "trip_id",
        "direction_id", "current_stop_sequence", "feed_ts", "arrival_seq")


def _snapshot(spark, sf_dir):
    return LV.vehicle_snapshot(_live_vehicles(spark, sf_dir),
                               LV.live_crowding(_crowding(spark, sf_dir), NOW))


def q_vehicle_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*VEHICLE_OUT, "crowding_level")


def q_vehicle_client_state(spark, sf_dir):
    return LV.client_vehicle_state(TD.vehicle_positions(spark, sf_dir, received=True),
                                   _crowding(spark, sf_dir), NOW).select(
        "vehicle_id", "route_id", "latitude", "longitude", "bearing", "occupancy", "trip_id",
        "direction_id", "current_stop_sequence", "feed_ts", "arrival_seq", "crowding_level")


def q_live_counters(spark, sf_dir):
    return LV.live_counts(_live_vehicles(spark, sf_dir), A.last_bodies(_alerts(spark, sf_dir)),
                          _live_ripples(spark, sf_dir))


def q_map_vehicles(spark, sf_dir):
    return LV.map_vehicles(_snapshot(spark, sf_dir), served(spark, sf_dir).routes)


def q_delay_board(spark, sf_dir):
    return LV.delay_board(q_delay_scores(spark, sf_dir))


def q_routes_by_short_name(spark, sf_dir):
    return LV.routes_by_short_name(_t(spark, sf_dir)["routes"])


def q_delay_board_by_route(spark, sf_dir):
    return LV.delay_board_by_route(q_delay_scores(spark, sf_dir))


def q_delay_envelopes(spark, sf_dir):
    """U-6 / P-3: the delay messages of the firehose with their payload."""
    rows = q_delay_scores(spark, sf_dir).select(
        "route_id", "window_start", "window_end", "actual_headway_minutes", "scheduled_headway_minutes", "delay_score")
    return LV.envelopes(delay_update=rows)


def _firehose(spark, sf_dir) -> dict[str, DataFrame]:
    """U-6: what each of the five streams sends, with epochs in milliseconds."""
    return {
        "vehicle_update": LV.keyed_messages(_positions(spark, sf_dir), "vehicle_id").select(*VEHICLE_OUT),
        "delay_update": q_delay_scores(spark, sf_dir).select(
            "route_id", "window_start", "window_end", "actual_headway_minutes", "scheduled_headway_minutes", "delay_score"),
        "crowding_update": _crowding(spark, sf_dir).select(*CROWDING_OUT),
        "alert_update": _alerts(spark, sf_dir).where("has_body").select(*ALERT_OUT),
        "ripple_update": _ripples(spark, sf_dir).select(*RIPPLE_OUT),
    }


def q_update_envelopes(spark, sf_dir):
    """U-6 / P-3: every message of the live firehose with its payload."""
    return LV.envelopes(**_firehose(spark, sf_dir))


def q_snapshot_document(spark, sf_dir):
    """U-3: the document a client gets on connecting, one JSON object per row and section."""
    vehicles = _snapshot(spark, sf_dir).select(*VEHICLE_OUT, "crowding_level")
    delays = LV.latest_by_key(_firehose(spark, sf_dir)["delay_update"], ["route_id"], ["window_start"])
    alerts = A.last_bodies(_alerts(spark, sf_dir)).select(*ALERT_OUT)
    ripples = _live_ripples(spark, sf_dir).select(*RIPPLE_OUT)
    return LV.snapshot_document(vehicles, delays, alerts, ripples)


def q_vehicle_messages(spark, sf_dir):
    """P-1 / K-1: positions as keyed JSON without the fields they lack."""
    return K.to_keyed_json(LV.keyed_messages(_positions(spark, sf_dir), "vehicle_id").select(*VEHICLE_OUT), "vehicle_id")


def q_crowding_messages(spark, sf_dir):
    """P-2 / K-1: estimates as keyed JSON with explicit nulls."""
    return K.to_keyed_json(_crowding(spark, sf_dir).select(*CROWDING_OUT), "vehicle_id", explicit_nulls=True)


def q_delay_board_by_route_descending(spark, sf_dir):
    return LV.delay_board_by_route(q_delay_scores(spark, sf_dir), ascending=False)


def q_topic_rejects(spark, sf_dir):
    """S-6: records of a damaged JSON topic that the jobs skip, and why."""
    _, rejects = FD.parse_json_topic(TD.vehicle_topic(spark, sf_dir), FD.TOPIC_SCHEMA, "vehicle_id")
    return rejects.select("arrival_seq", "reason", "value")


def q_topic_counters(spark, sf_dir):
    """S-6 / A-15: records, good ones and rejects of the topic by reason."""
    good, rejects = FD.parse_json_topic(TD.vehicle_topic(spark, sf_dir), FD.TOPIC_SCHEMA, "vehicle_id")
    marked = good.select(F.lit("good").alias("outcome")).unionByName(rejects.select(F.col("reason").alias("outcome")))
    return marked.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def q_load_counters(spark, sf_dir):
    """A-15: rows that the schedule job has loaded, by table, and alert records read, published and new."""
    known, bodies = served(spark, sf_dir), _alerts(spark, sf_dir).where("has_body")
    return LV.named_counts(routes=known.routes, trips=known.trips, scheduled_headways=known.headways,
                           station_feeder_routes=known.feeders, route_stops=known.pin.table("route_stops"),
                           alert_records=bodies, alerts_published=A.alert_changes(_alerts(spark, sf_dir)),
                           alerts_new=bodies.select("alert_id").distinct())


def q_alert_peek(spark, sf_dir):
    """L-8: the ten last alert records as JSON (a limit is the feature)."""
    bodies = _alerts(spark, sf_dir).where("has_body").select(
        "arrival_seq", F.to_json(F.struct("alert_id", "effect", "header_text")).alias("value"))
    return LV.peek(bodies, last=True)


def q_active_alerts(spark, sf_dir):
    alerts = A.last_bodies(_alerts(spark, sf_dir))
    ripples = _live_ripples(spark, sf_dir)
    return LV.active_alerts(alerts, ripples)


def q_alert_feed(spark, sf_dir):
    alerts = A.last_bodies(_alerts(spark, sf_dir))
    ripples = _live_ripples(spark, sf_dir)
    return LV.alert_feed(alerts, ripples)


def q_update_envelope_counts(spark, sf_dir):
    positions = _positions(spark, sf_dir)
    alerts = _alerts(spark, sf_dir)
    return LV.envelope_counts(
        vehicle_update=LV.keyed_messages(positions, "vehicle_id"),
        delay_update=D.delay_scores(positions, served(spark, sf_dir).headways),
        crowding_update=_crowding(spark, sf_dir),
        alert_update=alerts.where(F.col("has_body")),
        ripple_update=_ripples(spark, sf_dir))


# ---------------------------------------------------------------------------
# J1: feed normalization (landed entities derived from the events table)
# ---------------------------------------------------------------------------
def q_vehicle_feed_normalized(spark, sf_dir):
    entities = FD.vehicle_entities_from_positions(_positions(spark, sf_dir))
    return FD.normalize_vehicle_feed(entities).select(
        "vehicle_id", "route_id", "latitude", "longitude", "bearing", "feed_ts", "occupancy",
        "trip_id", "direction_id", "current_stop_sequence", "arrival_seq")


def q_alert_feed_normalized(spark, sf_dir):
    entities = FD.alert_entities_from_alerts(_alerts(spark, sf_dir))
    out = FD.normalize_alert_feed(entities).select(
        "alert_id", "effect", "cause", "header_text", "description_text", "affected_route_ids",
        "affected_stop_ids", "active_since", "feed_ts", "arrival_seq")
    return _text(out, "affected_route_ids", "affected_stop_ids")


QUERIES: dict[str, Query] = {
    "delay_scores": q_delay_scores,
    "delay_scores_on_time_only": q_delay_scores_on_time_only,
    "unscheduled_windows": q_unscheduled_windows,
    "late_positions": q_late_positions,
    "crowding_estimates": q_crowding_estimates,
    "crowding_estimates_array_form": q_crowding_estimates_array_form,
    "latest_vehicle_snapshot": q_latest_vehicle_snapshot,
    "resolved_direction": q_resolved_direction,
    "routes": q_routes,
    "weekday_trips": q_weekday_trips,
    "trip_directions": q_trip_directions,
    "trips_first_row": q_trips_first_row,
    "trips_last_row": q_trips_last_row,
    "first_departures": q_first_departures,
    "trips_per_hour_direction": q_trips_per_hour_direction,
    "scheduled_headways": q_scheduled_headways,
    "route_headway_report": q_route_headway_report,
    "dominant_shapes": q_dominant_shapes,
    "route_paths": q_route_paths,
    "route_path_fallback": q_route_path_fallback,
    "stop_routes": q_stop_routes,
    "subway_stations": q_subway_stations,
    "station_feeder_routes": q_station_feeder_routes,
    "station_feeders_report": q_station_feeders_report,
    "alert_changes": q_alert_changes,
    "current_alerts": q_current_alerts,
    "ripple_changelog": q_ripple_changelog,
    "ripples_live": q_ripples_live,
    "alerts_without_ripples": q_alerts_without_ripples,
    "live_vehicles": q_live_vehicles,
    "vehicle_sticky_state": q_vehicle_sticky_state,
    "vehicle_snapshot": q_vehicle_snapshot,
    "vehicle_client_state": q_vehicle_client_state,
    "live_counters": q_live_counters,
    "map_vehicles": q_map_vehicles,
    "delay_board": q_delay_board,
    "routes_by_short_name": q_routes_by_short_name,
    "delay_board_by_route": q_delay_board_by_route,
    "delay_board_by_route_descending": q_delay_board_by_route_descending,
    "delay_envelopes": q_delay_envelopes,
    "update_envelopes": q_update_envelopes,
    "snapshot_document": q_snapshot_document,
    "vehicle_messages": q_vehicle_messages,
    "crowding_messages": q_crowding_messages,
    "topic_rejects": q_topic_rejects,
    "topic_counters": q_topic_counters,
    "load_counters": q_load_counters,
    "alert_peek": q_alert_peek,
    "active_alerts": q_active_alerts,
    "alert_feed": q_alert_feed,
    "update_envelope_counts": q_update_envelope_counts,
    "vehicle_feed_normalized": q_vehicle_feed_normalized,
    "alert_feed_normalized": q_alert_feed_normalized,
}
