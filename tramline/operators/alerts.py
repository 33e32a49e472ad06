"""Service alerts: change detection, current state, ripple cascade (batch forms).

``alerts`` rows follow ``schemas.SERVICE_ALERT``: one row per alert version
with ``arrival_seq`` as the stream order; ``has_body = false`` marks a
tombstone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from .ordered import last_of_contents, previous_value  # noqa: F401 (re-exported for tests)

def with_fingerprint(alerts: DataFrame) -> DataFrame:
    """X-12 as canonical JSON text: a total, null-safe identity of the content."""
    return alerts.withColumn("fingerprint", F.to_json(X.alert_fingerprint()))


def alert_changes(alerts: DataFrame, block: int = 1 << 20, super_block: int = 1 << 10) -> DataFrame:
    """Versions whose content differs from the previous published one (W-2).

    A -> A -> B -> A publishes three times; tombstones are not alert
    content and are skipped. Equivalent to comparing with
    ``lag(fingerprint)`` per alert, computed hot-key safe.
    """
    bodies = with_fingerprint(alerts.where(F.col("has_body")))
    prev = previous_value(bodies, ["alert_id"], "arrival_seq", "fingerprint", "_prev_fp", block,
                          super_block)
    return prev.where(~F.col("fingerprint").eqNullSafe(F.col("_prev_fp"))).drop("_prev_fp",
                                                                                "fingerprint")


def current_alerts(alerts: DataFrame) -> DataFrame:
    """Changelog read as a table: latest version per alert, deletes applied (S-4).

    Latest by ``arrival_seq`` (never by upstream compaction); null keys dropped.
    Versions repeat their content, so they are first reduced to the last of each.
    """
    cols = [c for c in alerts.columns if c != "alert_id"]
    latest = (last_of_contents(alerts.where(F.col("alert_id").isNotNull()), ["alert_id"], "arrival_seq")
              .groupBy("alert_id")
              .agg(F.max_by(F.struct(*cols), F.col("arrival_seq")).alias("a"))
              .select("alert_id", "a.*"))
    return latest.where(F.col("has_body"))


def last_bodies(alerts: DataFrame) -> DataFrame:
    """What the live views show: the last version with a body of each alert.

    A tombstone is skipped there, not applied (F-14): alerts have no expiry,
    so an alert stays until its next version.
    """
    return current_alerts(alerts.where(F.col("has_body")))


def ripples(alerts: DataFrame, feeders: DataFrame) -> DataFrame:
    """Every alert version cascaded to the feeder routes of its stations (J-4, F-13, A-4, X-11).

    Which feeder routes a version reaches, and through which station, depends
    only on its *set* of stops and *set* of own routes, and versions repeat
    the same sets over and over. So the cascade is computed once per distinct
    (stops, routes) combination — ``station_id = ANY(stops)`` as an explode
    and an equi-join with ``station_feeder_routes``; own routes excluded; a
    route feeding several stations keeps the closest (ties: smallest
    station_id) — and joined back to the versions on the combination.
    Tombstones yield nothing.
    """
    return _cascade(_versions(alerts), feeders)


def latest_ripples(alerts: DataFrame, feeders: DataFrame) -> DataFrame:
    """The rows of ``ripples`` among which the latest of each ripple id are (ST-10).

    Which ripples a version has depends on its alert, stops and own routes, and
    only the last version of an id is live. So versions are reduced to the last
    of each alert, stops, own routes and text before they are cascaded, not after:
    a cascade has a row per version and feeder route.
    """
    return _cascade(last_of_contents(_versions(alerts), ["alert_id"], "arrival_seq"), feeders)


def _versions(alerts: DataFrame) -> DataFrame:
    """Versions with a body, with their set of stops and of own routes."""
    stops = F.array_sort(F.array_distinct(F.coalesce("affected_stop_ids", F.array().cast("array<string>"))))
    own = F.array_sort(F.array_distinct(F.coalesce("affected_route_ids", F.array().cast("array<string>"))))
    return alerts.where(F.col("has_body")).select(
        "alert_id", "effect", "header_text", "arrival_seq", "event_time",
        stops.alias("_stops"), own.alias("_own"))


def _cascade(versions: DataFrame, feeders: DataFrame) -> DataFrame:
    combos = versions.select("_stops", "_own").distinct()
    reached = (combos.select("_stops", "_own", F.explode("_stops").alias("station_id"))
               .join(feeders, "station_id")
               .where(~F.array_contains("_own", F.col("route_id")))
               .groupBy("_stops", "_own", "route_id")
               .agg(F.min_by("station_name", F.struct("distance_meters", "station_id"))
                    .alias("station_name")))
    return versions.join(reached, ["_stops", "_own"]).select(
        X.ripple_id("alert_id", "route_id").alias("ripple_id"),
        F.col("alert_id").alias("source_alert_id"),
        F.col("effect").alias("source_effect"),
        F.col("station_name").alias("affected_station"),
        F.col("route_id").alias("feeder_route_id"),
        F.lit(X.PREDICTED_IMPACT).alias("predicted_impact"),
        X.ripple_header("route_id", "station_name", "header_text").alias("header_text"),
        "arrival_seq",
        F.col("event_time").alias("written_at"))


def alerts_without_ripples(alerts: DataFrame, feeders: DataFrame) -> DataFrame:
    """Current alerts whose stops match no feeder station (F-4 report)."""
    current = current_alerts(alerts)
    stops = current.select("alert_id", F.explode(F.array_distinct("affected_stop_ids"))
                           .alias("station_id"))
    matched = stops.join(feeders.select("station_id").distinct(), "station_id", "left_semi")
    return current.join(matched.select("alert_id").distinct(), "alert_id", "left_anti")
