"""Live state and the views served from it (batch forms).

Live state is "latest message per key, expiring ``ttl`` after its write".
The write clock of a message is its record time (``event_time`` for
positions and alert versions, the window end for crowding); ``as_of_s`` is
the wall clock the view is taken at. Latest = greatest arrival order.
All latest-per-key steps are plain aggregates (``max_by`` over a struct), so
a hot key is combined map-side instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as X

POSITION_FIELDS = ["route_id", "latitude", "longitude", "bearing", "speed", "feed_ts",
                   "occupancy", "trip_id", "direction_id", "current_stop_sequence"]


def _alive(written_at: Column, ttl_s: int, as_of_s: int) -> Column:
    return F.unix_micros(written_at) + F.lit(ttl_s * 1_000_000) > F.lit(as_of_s * 1_000_000)


def latest_by_key(df: DataFrame, keys: list[str], order: list[str], ttl_s: int | None = None,
                  as_of_s: int | None = None, written_at: str = "event_time") -> DataFrame:
    """Last write per key (A-13), optionally only if not yet expired (ST-10)."""
    rest = [c for c in df.columns if c not in keys]
    latest = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v"))
              .select(*keys, "_v.*"))
    if ttl_s is not None:
        latest = latest.where(_alive(F.col(written_at), ttl_s, as_of_s))
    return latest


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """F-14: live messages need a non-empty key."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def live_vehicles(positions: DataFrame, as_of_s: int, ttl_s: int = X.VEHICLE_TTL_S) -> DataFrame:
    return latest_by_key(keyed_messages(positions, "vehicle_id"), ["vehicle_id"],
                         ["arrival_seq"], ttl_s, as_of_s)


def sticky_state(positions: DataFrame, key: str = "vehicle_id", order: str = "arrival_seq",
                 fields: list[str] | None = None) -> DataFrame:
    """Client-side merge ``{...old, ...new}`` of sparse messages (A-14).

    Absent (null) fields keep their previous value: each field is its last
    non-null value in arrival order.
    """
    fields = fields or POSITION_FIELDS
    return keyed_messages(positions, key).groupBy(key).agg(
        *[F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields],
        F.max(order).alias(order))


def live_crowding(estimates: DataFrame, as_of_s: int, ttl_s: int = X.CROWDING_TTL_S) -> DataFrame:
    """Latest estimate per vehicle; written when its window closed, after the grace."""
    stamped = keyed_messages(estimates, "vehicle_id").withColumn(
        "written_at", F.timestamp_millis(F.col("window_end") + X.GRACE_SECONDS * 1000))
    return latest_by_key(stamped, ["vehicle_id"], ["window_end", "route_id", "direction_id"],
                         ttl_s, as_of_s, "written_at")


def vehicle_snapshot(vehicles: DataFrame, crowding: DataFrame) -> DataFrame:
    """Live vehicles with the crowding level of the same vehicle id (J-5).

    The match is on vehicle_id alone, as in the reference.
    """
    return vehicles.join(crowding.select("vehicle_id", "crowding_level"), "vehicle_id", "left")


def route_types_by_short_name(routes: DataFrame) -> DataFrame:
    """short name -> route_type; duplicate short names keep the greatest route_id (J-6)."""
    return (routes.groupBy("route_short_name")
            .agg(F.max_by("route_type", "route_id").alias("route_type")))


def map_vehicles(snapshot: DataFrame, routes: DataFrame) -> DataFrame:
    """Vehicles that can be drawn, with their icon kind and ring level (F-15, X-17, X-19)."""
    drawable = snapshot.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                              & ~((F.col("latitude") == 0) & (F.col("longitude") == 0)))
    types = route_types_by_short_name(routes).withColumnRenamed("route_short_name", "route_id")
    return drawable.join(types, "route_id", "left").select(
        "vehicle_id", "route_id", "latitude", "longitude",
        X.vehicle_kind("route_type").alias("vehicle_kind"),
        X.display_level("crowding_level").alias("crowding_level"))


def delay_board(delays: DataFrame) -> DataFrame:
    """Latest score per route (no TTL), worst first (L-5, X-18, X-24)."""
    latest = latest_by_key(delays, ["route_id"], ["window_start"])
    return latest.select(
        "route_id", "window_start", "delay_score", "actual_headway_minutes",
        "scheduled_headway_minutes",
        X.delay_band("delay_score").alias("band"),
        X.signed2("delay_score").alias("delay_display")).orderBy(F.col("delay_score").desc())


def natural_route_order(df: DataFrame, ascending: bool = True) -> DataFrame:
    """Route column in natural numeric order ('2' < '10'), then text."""
    num = F.regexp_extract("route_id", r"^(\d+)", 1).try_cast("long")
    if ascending:
        return df.orderBy(num.asc_nulls_last(), F.col("route_id").asc())
    return df.orderBy(num.desc_nulls_last(), F.col("route_id").desc())


def live_ripples(ripple_rows: DataFrame, as_of_s: int, ttl_s: int = X.RIPPLE_TTL_S) -> DataFrame:
    """Latest version of each ripple id, kept for ``ttl_s`` after its write; never retracted."""
    return latest_by_key(ripple_rows, ["ripple_id"], ["arrival_seq"], ttl_s, as_of_s, "written_at")


def active_alerts(alerts: DataFrame, ripples: DataFrame) -> DataFrame:
    """Current alerts and live ripples in one list (U-1)."""
    a = alerts.select("alert_id", "effect", "cause", "header_text", "description_text",
                      F.array_join("affected_route_ids", ",").alias("affected_route_ids"),
                      F.array_join("affected_stop_ids", ",").alias("affected_stop_ids"),
                      "active_since", F.col("feed_ts").alias("timestamp"))
    r = ripples.select("ripple_id", "source_alert_id", "source_effect", "affected_station",
                       "feeder_route_id", "predicted_impact", "header_text",
                       X.epoch_ms("written_at").alias("detected_at"))
    return a.unionByName(r, allowMissingColumns=True)


def alert_feed(alerts: DataFrame, ripples: DataFrame) -> DataFrame:
    """Tagged union sorted newest first on a common time (U-2, X-20, X-21)."""
    a = alerts.select(
        F.lit("alert").alias("kind"), F.col("alert_id").alias("item_id"),
        X.feed_sort_time_ms(F.lit(None).cast("long"), F.col("feed_ts")).alias("sort_time_ms"),
        X.severity("effect").alias("severity"), X.effect_label("effect").alias("label"),
        F.col("header_text").alias("text"))
    r = ripples.select(
        F.lit("ripple").alias("kind"), F.col("ripple_id").alias("item_id"),
        X.feed_sort_time_ms(X.epoch_ms("written_at"), F.lit(None).cast("long")).alias("sort_time_ms"),
        F.lit("ripple").alias("severity"), X.impact_label("predicted_impact").alias("label"),
        F.concat(F.lit("Route "), F.col("feeder_route_id"), F.lit(" near "),
                 F.col("affected_station"), F.lit(" - cascaded from "),
                 F.col("source_alert_id")).alias("text"))
    return a.unionByName(r).orderBy(F.col("sort_time_ms").desc(), "kind", "item_id")


def envelopes(**streams: DataFrame) -> DataFrame:
    """Tag each update as ``{"type": ..., "data": {...}}`` JSON (P-3, U-6).

    ``streams`` maps a message type (``ENVELOPE_TYPES``) to its DataFrame.
    """
    parts = [df.select(F.lit(t).alias("type"), F.to_json(F.struct(*df.columns)).alias("data"))
             for t, df in streams.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def envelope_counts(**streams: DataFrame) -> DataFrame:
    """Messages per type on the live firehose (A-15)."""
    parts = [df.select(F.lit(t).alias("type")) for t, df in streams.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("type").agg(F.count(F.lit(1)).alias("messages"))


def routes_by_short_name(routes: DataFrame) -> DataFrame:
    """L-4: the routes listing in order of short name (ties by id), with each one's rank.

    The rank needs one ordered list; the routes table has a row per route.
    """
    order = W.orderBy("route_short_name", "route_id")
    return routes.select("route_id", "route_short_name", "route_type",
                         F.row_number().over(order).alias("listing_rank")).orderBy("listing_rank")


def delay_board_by_route(delays: DataFrame, ascending: bool = True) -> DataFrame:
    """L-5: the board in natural route order ('2' before '10', then text) or its reverse, with ranks."""
    number = F.regexp_extract("route_id", r"^(\d+)", 1).try_cast("long")
    order = W.orderBy(number.asc_nulls_last(), "route_id") if ascending else W.orderBy(
        number.desc_nulls_first(), F.col("route_id").desc())
    latest = latest_by_key(delays, ["route_id"], ["window_start"])
    return headway_display(latest).withColumn("board_rank", F.row_number().over(order)).orderBy("board_rank")


def headway_display(delays: DataFrame) -> DataFrame:
    """X-24: 'actual / scheduled' with one decimal, next to the signed score.

    Halves round up on the decimal form (1.25 -> 1.3); a value whose binary
    form sits just under a midpoint may differ from a browser's toFixed.
    """
    return delays.select(
        "route_id", X.signed2("delay_score").alias("delay_display"),
        F.concat(F.format_string("%.1f", "actual_headway_minutes"), F.lit(" / "),
                 F.format_string("%.1f", "scheduled_headway_minutes")).alias("headway_display"))


def snapshot_document(vehicles: DataFrame, delays: DataFrame, alerts: DataFrame,
                      ripples: DataFrame) -> DataFrame:
    """U-3: the four live sections as one relation of (section, json) rows."""
    parts = [df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("json"))
             for name, df in (("vehicles", vehicles), ("delays", delays), ("alerts", alerts),
                              ("ripples", ripples))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def client_prune(state: DataFrame, seen_col: str, as_of_s: int,
                 stale_s: int = X.CLIENT_STALE_S) -> DataFrame:
    """ST-11: keep entries received within ``stale_s`` of ``as_of_s``.

    Staleness is measured on the receipt time, not the feed's own timestamp.
    """
    return state.where(F.unix_micros(F.col(seen_col)) >= F.lit((as_of_s - stale_s) * 1_000_000))


def flush_latest(batch: DataFrame, key: str, order: str = "arrival_seq") -> DataFrame:
    """ST-12: the last update per key within one flush batch (for foreachBatch)."""
    return latest_by_key(batch, [key], [order])


def peek(records: DataFrame, value_col: str = "value", n: int = 10, last: bool = False,
         order: str = "arrival_seq") -> DataFrame:
    """L-8: first or last ``n`` JSON-looking records of a topic (a limit is the feature)."""
    looking = records.where(F.col(value_col).startswith("{"))
    ordered = looking.orderBy(F.col(order).desc() if last else F.col(order).asc())
    return ordered.limit(n)


def last_runs(positions: DataFrame, seen: str, stale_s: int = X.CLIENT_STALE_S) -> DataFrame:
    """(vehicle_id, run_start, last_seen): since when the client knows each vehicle.

    It forgets a vehicle that was silent for more than ``stale_s`` and starts
    anew with the next message (ST-11). Messages are first combined into
    steps of ``stale_s`` (no longer silence fits inside one), so only steps
    are ordered per vehicle.
    """
    stale = stale_s * 1_000_000
    at = F.unix_micros(seen)
    steps = keyed_messages(positions, "vehicle_id").groupBy("vehicle_id", F.floor(at / stale).alias("step")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"))
    before = F.lag("last").over(W.partitionBy("vehicle_id").orderBy("step"))
    marked = steps.withColumn("begins", before.isNull() | (F.col("first") - before > stale))
    return marked.groupBy("vehicle_id").agg(
        F.max(F.when(F.col("begins"), F.col("first"))).alias("run_start"), F.max("last").alias("last_seen"))


def client_vehicle_state(positions: DataFrame, estimates: DataFrame, as_of_s: int, seen: str = "received_at",
                         stale_s: int = X.CLIENT_STALE_S) -> DataFrame:
    """A-14 + J-13 + ST-11: the client's merged vehicle state at ``as_of_s``.

    Sparse position messages merge field by field (``sticky_state``) within the
    vehicle's last run; a vehicle silent for more than ``stale_s`` is gone, its old
    fields with it. A crowding message only sets ``crowding_level`` while the
    vehicle is known, and does not count as a sign of life.
    """
    return client_snapshot(positions, estimates, as_of_s, seen, stale_s).drop("last_seen_us")


def client_snapshot(positions: DataFrame, estimates: DataFrame, as_of_s: int, seen: str = "received_at",
                    stale_s: int = X.CLIENT_STALE_S) -> DataFrame:
    """``client_vehicle_state`` with when each vehicle was last seen: all that a client needs to go on from here."""
    runs = last_runs(positions, seen, stale_s).where(
        F.col("last_seen") >= F.lit((as_of_s - stale_s) * 1_000_000))
    known = (positions.join(runs.select("vehicle_id", "run_start"), "vehicle_id")
             .where(F.unix_micros(seen) >= F.col("run_start")))
    written = (F.col("window_end") + X.GRACE_SECONDS * 1000) * 1000
    levels = (keyed_messages(estimates, "vehicle_id").join(runs, "vehicle_id")
              .where((written >= F.col("run_start")) & (written <= F.col("last_seen") + stale_s * 1_000_000)
                     & (written <= F.lit(as_of_s * 1_000_000)))
              .select("vehicle_id", "window_end", "route_id", "direction_id", "crowding_level"))
    latest_level = latest_by_key(levels, ["vehicle_id"], ["window_end", "route_id", "direction_id"])
    timed = known.withColumn("last_seen_us", F.unix_micros(seen))
    return sticky_state(timed, fields=[*POSITION_FIELDS, "last_seen_us"]).join(
        latest_level.select("vehicle_id", "crowding_level"), "vehicle_id", "left")


def named_counts(**frames: DataFrame) -> DataFrame:
    """A-15 counters in long form, one ``(counter, value)`` row per input:
    live vehicles / alerts / ripples for the header, rows loaded per
    published table. Each count is distributed; rows are tagged and unioned
    (no cross join of single-row aggregates)."""
    parts = [df.select(F.lit(name).alias("counter")) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("counter").agg(F.count(F.lit(1)).alias("value"))


def live_counts(vehicles: DataFrame, alerts: DataFrame, ripples: DataFrame) -> DataFrame:
    """A-15: the dashboard's header counters."""
    return named_counts(vehicles=vehicles, alerts=alerts, ripples=ripples)
