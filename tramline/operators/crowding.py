"""Per-vehicle crowding from the gap to the vehicle ahead (batch forms).

Pipeline: resolve direction (event, else static trip lookup) -> eligible
records -> latest snapshot per (route, direction, window, vehicle) ->
schedule at the local hour of the window *end* -> order vehicles by stop
sequence -> gap to the next vehicle, scaled to minutes by the window's stop
span -> ratio to the scheduled headway -> level.

Only the different stop sequences of a group are ordered, of which there are
as many as a route has stops, whatever the number of vehicles: a vehicle that is
not the last (by vehicle_id) at its sequence has its follower there, at gap 0; the
last one's gap reaches to the next sequence. ``gaps_by_window_function`` finds
the next one with ``lead``, ``gaps_by_array`` in a sorted array of them. The
streaming job applies this to the windows that a micro-batch closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import exprs as X

GROUP = ["route_id", "direction_id", "w"]


def resolve_direction(positions: DataFrame, trips: DataFrame) -> DataFrame:
    """direction_id = event direction, else the trips table's (J-2, F-16).

    ``trips`` is the reference table (trip_id, route_id, direction_id). It is
    joined on trip_id as is: Spark broadcasts it when its measured size is
    under the broadcast threshold (AQE re-checks at run time) and shuffles
    both sides otherwise. Rows that need no lookup or have no trip get a key
    that no trip has, by vehicle, so they do not gather under one null key.
    """
    known = (trips.where(F.col("direction_id").isNotNull())
             .select(F.col("trip_id").alias("_trip"), F.col("direction_id").alias("_trip_direction")))
    needs = F.col("direction_id").isNull() & F.col("trip_id").isNotNull()
    key = F.when(needs, F.col("trip_id")).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64("vehicle_id").cast("string")))
    return (positions.withColumn("_trip", key).join(known, "_trip", "left")
            .withColumn("direction_id", F.coalesce(F.col("direction_id"), F.col("_trip_direction")))
            .drop("_trip", "_trip_direction"))


def eligible(positions: DataFrame, trips: DataFrame) -> DataFrame:
    """F-2: route, vehicle, stop sequence present and direction resolvable."""
    pre = positions.where(
        F.col("route_id").isNotNull() & (F.col("route_id") != "")
        & F.col("vehicle_id").isNotNull() & (F.col("vehicle_id") != "")
        & F.col("current_stop_sequence").isNotNull())
    return resolve_direction(pre, trips).where(F.col("direction_id").isNotNull())


def latest_snapshots(records: DataFrame, window: str = X.WINDOW) -> DataFrame:
    """Latest snapshot per (route, direction, window, vehicle) (A-2).

    Latest = greatest feed timestamp; equal timestamps keep the later arrival.
    A plain aggregate: partial aggregation happens map-side.
    """
    return (records.groupBy("route_id", "direction_id", F.window("event_time", window).alias("w"),
                            "vehicle_id")
            .agg(F.max(F.struct("feed_ts", "arrival_seq", "current_stop_sequence")).alias("s"))
            .select("route_id", "direction_id", "w", "vehicle_id",
                    F.col("s.current_stop_sequence").alias("seq"),
                    F.col("s.feed_ts").alias("feed_ts"), F.col("s.arrival_seq").alias("arrival_seq")))


def latest_snapshots_reduced_first(positions: DataFrame, trips: DataFrame,
                                   window: str = X.WINDOW) -> DataFrame:
    """``latest_snapshots(eligible(positions, trips))``, reduced before the trip join.

    Direction resolution needs a join with the trips table on trip_id; done
    per record, it shuffles every position whenever the trips table is too
    big to broadcast. Here positions are first reduced to the latest
    candidate per (route, window, vehicle, trip, event direction) — a
    map-side-combined aggregate — and only those candidates meet the trips
    table. The max over candidates of the same resolved direction is the
    max over their records, so the result is identical.
    """
    pre = positions.where(
        F.col("route_id").isNotNull() & (F.col("route_id") != "")
        & F.col("vehicle_id").isNotNull() & (F.col("vehicle_id") != "")
        & F.col("current_stop_sequence").isNotNull())
    candidates = (pre.groupBy("route_id", F.window("event_time", window).alias("w"), "vehicle_id",
                              "trip_id", "direction_id")
                  .agg(F.max(F.struct("feed_ts", "arrival_seq", "current_stop_sequence")).alias("s")))
    resolved = resolve_direction(candidates, trips).where(F.col("direction_id").isNotNull())
    return (resolved.groupBy("route_id", "direction_id", "w", "vehicle_id")
            .agg(F.max("s").alias("s"))
            .select("route_id", "direction_id", "w", "vehicle_id",
                    F.col("s.current_stop_sequence").alias("seq"),
                    F.col("s.feed_ts").alias("feed_ts"), F.col("s.arrival_seq").alias("arrival_seq")))


def with_schedule(snapshots: DataFrame, headways: DataFrame, tz: str = X.LOCAL_TZ) -> DataFrame:
    """Attach the schedule at the local hour of the window end; unscheduled groups drop (J-3)."""
    keyed = snapshots.withColumn("hour_of_day", X.local_hour(F.col("w.end"), tz))
    return keyed.join(headways, ["route_id", "hour_of_day"])


def _finish(df: DataFrame, crowded: float, empty: float) -> DataFrame:
    """gap_stops, span, scheduled -> output row (X-8, X-9, X-4)."""
    gap_min = F.col("gap_stops") * X.minutes_per_stop("span")
    ratio = X.ratio_of(gap_min, "scheduled_headway_minutes")
    return df.select(
        "vehicle_id", "route_id", "direction_id",
        X.round_half_up2(gap_min).alias("gap_ahead_minutes"),
        X.round_half_up2(ratio).alias("crowding_ratio"),
        X.round_half_up2("scheduled_headway_minutes").alias("scheduled_headway_minutes"),
        X.crowding_level(ratio, crowded, empty).alias("crowding_level"),
        X.epoch_ms(F.col("w.end")).alias("window_end"))


def gaps_by_window_function(scheduled: DataFrame, crowded: float = X.CROWDED_RATIO,
                            empty: float = X.EMPTY_RATIO) -> DataFrame:
    """W-1 with ``lead`` over a group's different stop sequences."""
    group = W.partitionBy(*GROUP)
    steps = _steps(scheduled).select(
        "*", F.lead("seq").over(group.orderBy("seq")).alias("_next"),
        (F.max("seq").over(group) - F.min("seq").over(group)).alias("span"))
    return _finish(_follow(scheduled, steps), crowded, empty)


def _steps(scheduled: DataFrame) -> DataFrame:
    """Per group and stop sequence: the last vehicle there (combined map-side)."""
    return scheduled.groupBy(*GROUP, "seq").agg(F.max("vehicle_id").alias("_last"))


def _follow(scheduled: DataFrame, steps: DataFrame) -> DataFrame:
    """Every vehicle with its gap in stops; null for the one ahead of all."""
    return scheduled.join(steps, [*GROUP, "seq"]).withColumn(
        "gap_stops", F.when(F.col("vehicle_id") != F.col("_last"), F.lit(0))
        .otherwise(F.col("_next") - F.col("seq")))


def gaps_by_array(snapshots: DataFrame, headways: DataFrame, crowded: float = X.CROWDED_RATIO,
                  empty: float = X.EMPTY_RATIO, tz: str = X.LOCAL_TZ) -> DataFrame:
    """W-1 with a sorted array of a group's different stop sequences."""
    scheduled = with_schedule(snapshots, headways, tz)
    v = F.col("v")
    lists = _steps(scheduled).groupBy(*GROUP).agg(
        F.sort_array(F.collect_list(F.struct("seq", "_last"))).alias("v"))
    steps = lists.select(
        *GROUP, (F.element_at(v, -1).getField("seq") - F.element_at(v, 1).getField("seq")).alias("span"),
        F.explode(F.transform(v, lambda x, i: F.struct(
            x.getField("seq").alias("seq"), x.getField("_last").alias("_last"),
            F.get(v, i + 1).getField("seq").alias("_next")))).alias("e")).select(*GROUP, "span", "e.*")
    return _finish(_follow(scheduled, steps), crowded, empty)


def crowding_estimates(positions: DataFrame, trips: DataFrame, headways: DataFrame,
                       window: str = X.WINDOW, crowded: float = X.CROWDED_RATIO,
                       empty: float = X.EMPTY_RATIO, array_form: bool = False,
                       tz: str = X.LOCAL_TZ) -> DataFrame:
    """One estimate per vehicle per closed (route, direction) window."""
    snapshots = latest_snapshots_reduced_first(positions, trips, window)
    if array_form:
        return gaps_by_array(snapshots, headways, crowded, empty, tz)
    return gaps_by_window_function(with_schedule(snapshots, headways, tz), crowded, empty)
