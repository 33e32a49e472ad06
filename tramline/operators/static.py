"""Static schedule build: GTFS text tables -> reference tables.

Inputs are string-typed GTFS tables (as ``sources.gtfs.read_gtfs`` or the
test mapping return them). Outputs:

* ``routes``               route_id, route_short_name, route_type
* ``trips``                trip_id, route_id, direction_id            (all service days)
* ``scheduled_headways``   route_id (short name), hour_of_day, scheduled_headway_minutes
* ``route_stops``          route_id, direction_id, stop_id, stop_name, latitude, longitude, stop_sequence
* ``station_feeder_routes`` station_id, station_name, route_id, distance_meters

``route_id`` means the GTFS id in ``routes``/``trips`` and the rider-facing
short name (falling back to the id) everywhere else.

Rows that repeat a key follow the order of rows in their file (``file_pos``,
``sources.order``), which the loader reads from top to bottom. Four rules hold
for a repeated trip id: the trips table keeps its first row, the stops it
serves count for the route of its last row, headways for its last row among
the weekday ones, and shapes are counted on every row. Routes and stops keep
their last row. Equal shape counts go to the shape that comes first, and its
representative is its first trip.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources.order import FILE_POS, first_row, in_order, last_row


# ---------------------------------------------------------------------------
# Normalization of the raw text tables
# ---------------------------------------------------------------------------
def _blank(c: str) -> Column:
    """Missing CSV cell -> '' (the reference reads absent cells as '')."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def normalize_routes(routes_raw: DataFrame) -> DataFrame:
    """route_id, route_short_name ('' when blank), route_type (int or null): the last row of each id."""
    return last_row(in_order(routes_raw).select(
        F.col("route_id").cast("string").alias("route_id"),
        _blank("route_short_name").alias("route_short_name"),
        X.parse_int("route_type").alias("route_type"), FILE_POS), "route_id")


def normalize_trips(trips_raw: DataFrame) -> DataFrame:
    """Every row of the trips, in file order, with the raw direction text next to its parsed form.

    Which row of a repeated id counts depends on the table that is built (A-16), see above.
    """
    return in_order(trips_raw).select(
        F.col("trip_id").cast("string").alias("trip_id"),
        F.col("route_id").cast("string").alias("route_id"),
        _blank("service_id").alias("service_id"),
        _blank("direction_id").alias("direction_raw"),
        X.parse_int("direction_id").alias("direction_id"),
        F.trim(_blank("shape_id")).alias("shape_id"), FILE_POS)


def normalize_stops(stops_raw: DataFrame) -> DataFrame:
    """Stops with parseable coordinates only (F-7): the last such row of each id."""
    typed = in_order(stops_raw).select(
        F.col("stop_id").cast("string").alias("stop_id"),
        _blank("stop_name").alias("stop_name"),
        X.parse_double("stop_lat").alias("latitude"),
        X.parse_double("stop_lon").alias("longitude"),
        F.trim(_blank("location_type")).alias("location_type"),
        F.trim(_blank("parent_station")).alias("parent_station"), FILE_POS,
    ).where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return last_row(typed, "stop_id")


def normalize_stop_times(stop_times_raw: DataFrame) -> DataFrame:
    """trip_id, stop_id, stop_sequence (int or null), arrival_time (trimmed), file_pos."""
    return in_order(stop_times_raw).select(
        F.col("trip_id").cast("string").alias("trip_id"),
        F.col("stop_id").cast("string").alias("stop_id"),
        X.parse_int("stop_sequence").alias("stop_sequence"),
        F.trim(_blank("arrival_time")).alias("arrival_time"), FILE_POS)


def route_key(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips of known routes with their short-name key (inner join, F-10/J-8)."""
    return trips.join(routes.select("route_id", "route_short_name"), "route_id").withColumn(
        "route_key", X.short_name_or_id("route_short_name", "route_id"))


# ---------------------------------------------------------------------------
# Services and trips
# ---------------------------------------------------------------------------
def weekday_calendar(calendar_raw: DataFrame) -> DataFrame:
    """Calendar rows active on Wednesdays (F-5)."""
    return calendar_raw.select(
        F.col("service_id").cast("string").alias("service_id"),
        F.trim(_blank("wednesday")).alias("wednesday"),
        _blank("start_date").alias("start_date"),
        _blank("end_date").alias("end_date"),
    ).where(F.col("wednesday") == "1")


def weekday_services(calendar_raw: DataFrame, as_of: str) -> DataFrame:
    """service_id of the one validity window kept (F-6, A-11, L-1).

    Windows are (start_date, end_date) groups of Wednesday services; the
    greatest window containing ``as_of`` wins, else the greatest overall.
    Dates compare as text (YYYYMMDD).
    """
    weekday = weekday_calendar(calendar_raw)
    contains = (F.col("start_date") <= F.lit(as_of)) & (F.lit(as_of) <= F.col("end_date"))
    chosen = weekday.agg(
        F.max(F.struct(contains.alias("contains"), "start_date", "end_date")).alias("w")
    ).select("w.start_date", "w.end_date")
    # ``chosen`` is a single row: a semi join against it is a broadcast of one row.
    return (weekday.join(F.broadcast(chosen), ["start_date", "end_date"], "left_semi")
            .select("service_id").distinct())


def weekday_trips(trips: DataFrame, calendar_raw: DataFrame | None, as_of: str) -> DataFrame:
    """Trips of the chosen weekday services (J-7): of a repeated id the last row among theirs.

    With no calendar, or no Wednesday row in it, every row counts (S-9).
    The emptiness test is an uncorrelated EXISTS subquery, evaluated once.
    """
    if calendar_raw is None:
        return last_row(trips, "trip_id")
    services = weekday_services(calendar_raw, as_of).withColumn("_kept", F.lit(True))
    has_weekday = weekday_calendar(calendar_raw).exists()
    kept = (trips.join(services, "service_id", "left")
            .where(F.col("_kept") | ~has_weekday)
            .drop("_kept"))
    return last_row(kept, "trip_id")


def trip_directions(trips: DataFrame) -> DataFrame:
    """The ``trips`` reference table: every trip of every service day, the first row of each id."""
    return first_row(trips.select("trip_id", "route_id", "direction_id", FILE_POS), "trip_id")


def trip_routes(trips: DataFrame) -> DataFrame:
    """trip_id, route_id: the last row of each id, of all service days (what serves a stop)."""
    return last_row(trips.select("trip_id", "route_id", FILE_POS), "trip_id")


# ---------------------------------------------------------------------------
# Headways
# ---------------------------------------------------------------------------
def _timed(stop_times: DataFrame) -> DataFrame:
    return stop_times.where((F.col("arrival_time") != "") & F.col("stop_sequence").isNotNull())


def first_departures(stop_times: DataFrame) -> DataFrame:
    """Per trip: arrival at the lowest stop_sequence among rows with an arrival (A-7).

    Rows with a blank arrival are ignored (F-9); rows whose sequence does not
    parse are dropped. Of equal sequences the first row counts.
    """
    return (_timed(stop_times).groupBy("trip_id")
            .agg(F.min(F.struct("stop_sequence", FILE_POS, "arrival_time")).alias("f"))
            .select("trip_id", "f.stop_sequence", "f.arrival_time"))


def first_departure_hours(stop_times: DataFrame) -> DataFrame:
    """trip_id, hour_of_day of its first departure (null where the time has no hour)."""
    return first_departures(stop_times).select("trip_id", X.gtfs_hour("arrival_time").alias("hour_of_day"))


def unusable_stop_times(stop_times_raw: DataFrame) -> DataFrame:
    """F-9 report: rows with an arrival time but no parseable stop_sequence.

    The reference aborts on these; here they are dropped from the headway
    input and listed by this report instead.
    """
    return stop_times_raw.where(
        (F.trim(_blank("arrival_time")) != "") & X.parse_int("stop_sequence").isNull())


def trips_per_hour_direction(routes: DataFrame, trips: DataFrame, stop_times: DataFrame,
                             calendar_raw: DataFrame | None, as_of: str) -> DataFrame:
    """Weekday trips per (route short name, departure hour, direction text) (A-8).

    A blank direction counts as '0'.
    """
    wk = weekday_trips(trips, calendar_raw, as_of).select(
        "trip_id", "route_id",
        F.when(F.col("direction_raw") == "", F.lit("0")).otherwise(F.col("direction_raw"))
        .alias("direction_id"))
    keyed = route_key(wk, routes)
    dep = first_departure_hours(stop_times)
    return (keyed.join(dep, "trip_id")
            .where(F.col("hour_of_day").isNotNull())
            .groupBy(F.col("route_key").alias("route_id"), "hour_of_day", "direction_id")
            .agg(F.count(F.lit(1)).alias("trip_count")))


def scheduled_headways(routes: DataFrame, trips: DataFrame, stop_times: DataFrame,
                       calendar_raw: DataFrame | None, as_of: str) -> DataFrame:
    """Minutes between trips of the busier direction, per route and hour (A-9, A-10)."""
    counts = trips_per_hour_direction(routes, trips, stop_times, calendar_raw, as_of)
    return (counts.groupBy("route_id", "hour_of_day")
            .agg(F.max("trip_count").alias("n"))
            .where(F.col("n") > 0)
            .select("route_id", "hour_of_day",
                    X.round_half_even(F.lit(60.0) / F.col("n"), 2).alias("scheduled_headway_minutes")))


# ---------------------------------------------------------------------------
# Representative paths
# ---------------------------------------------------------------------------
def _dominant(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """``dominant_shapes`` and where the (route, direction) comes first in the file."""
    keyed = route_key(trips, routes).select(
        F.col("route_key").alias("route_id"),
        F.coalesce(F.col("direction_id"), F.lit(0)).alias("direction_id"),
        "shape_id", "trip_id", FILE_POS)
    per_shape = keyed.groupBy("route_id", "direction_id", "shape_id").agg(
        F.count(F.lit(1)).alias("trip_count"), F.min_by("trip_id", FILE_POS).alias("rep_trip_id"),
        F.min(FILE_POS).alias("seen_at"))
    return per_shape.groupBy("route_id", "direction_id").agg(
        F.max_by(F.struct("shape_id", "trip_count", "rep_trip_id"),
                 F.struct("trip_count", (-F.col("seen_at")).alias("earlier"))).alias("b"),
        F.min("seen_at").alias("seen_at")).select("route_id", "direction_id", "b.*", "seen_at")


def dominant_shapes(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """Most-run shape per (route short name, direction) over all service days.

    Every row of the trips counts, also one that repeats an id. Returns route_id
    (short name), direction_id (blank -> 0), shape_id, trip_count and rep_trip_id
    (A-6, A-12, L-2); of equal counts the shape that comes first, and its first trip.
    """
    return _dominant(routes, trips).drop("seen_at")


def representatives(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """trip_id, route_id, direction_id: one path per representative trip. An id that stands for
    several (route, direction) pairs gives its path to the one that comes last in the file."""
    return _dominant(routes, trips).groupBy(F.col("rep_trip_id").alias("trip_id")).agg(
        F.max_by(F.struct("route_id", "direction_id"), "seen_at").alias("p")).select("trip_id", "p.*")


def route_paths(routes: DataFrame, trips: DataFrame, stops: DataFrame,
                stop_times: DataFrame) -> DataFrame:
    """Stops of each representative trip in visiting order, first visit kept (J-12, W-3).

    The representative trips are one per (route, direction), so AQE turns the
    join against ``stop_times`` into a broadcast at run time: the big table
    is scanned once and never shuffled.
    """
    rep = representatives(routes, trips)
    visits = (stop_times.where(F.col("stop_sequence").isNotNull())
              .select("trip_id", "stop_id", "stop_sequence")
              .join(rep, "trip_id"))
    first_visit = visits.groupBy("route_id", "direction_id", "stop_id").agg(
        F.min("stop_sequence").alias("stop_sequence"))
    return first_visit.join(stops.select("stop_id", "stop_name", "latitude", "longitude"),
                            "stop_id").select(
        "route_id", "direction_id", "stop_id", "stop_name", "latitude", "longitude",
        "stop_sequence")


def path_for(paths: DataFrame, route_id: str | None = None, direction: int = 0) -> DataFrame:
    """Path of one direction; asking for 0 falls back to 1 when 0 is empty (U-4).

    With ``route_id=None`` the rule is applied to every route at once.
    """
    scoped = paths if route_id is None else paths.where(F.col("route_id") == route_id)
    in_order = ["route_id", "direction_id", "stop_sequence"]          # L-3: visiting order
    if direction != 0:
        return scoped.where(F.col("direction_id") == direction).orderBy(*in_order)
    candidates = scoped.where(F.col("direction_id").isin(0, 1))
    chosen = candidates.groupBy("route_id").agg(F.min("direction_id").alias("direction_id"))
    return candidates.join(chosen, ["route_id", "direction_id"], "left_semi").orderBy(*in_order)


# ---------------------------------------------------------------------------
# Stations and feeder routes
# ---------------------------------------------------------------------------
def stop_routes(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Distinct (stop_id, route_id) served on any service day (J-9).

    A repeated trip id serves for the route of its last row. The one shuffle of
    ``stop_times``: hash-partitioned on trip_id for the join, then partially
    aggregated before the distinct's shuffle. Each partition's trips, one row per
    id, are looked up by hash, so the stop times are not sorted.
    """
    return (stop_times.select("trip_id", "stop_id")
            .join(trip_routes(trips).hint("shuffle_hash"), "trip_id")
            .select("stop_id", "route_id").distinct())


def subway_stations(routes: DataFrame, stops: DataFrame, served: DataFrame) -> DataFrame:
    """Parents of platforms served by a route_type=1 route, parent must exist (J-11)."""
    subway = routes.where(F.col("route_type") == X.SUBWAY_ROUTE_TYPE).select("route_id")
    platforms = served.join(subway, "route_id", "left_semi").select("stop_id").distinct()
    parents = (platforms.join(stops.select("stop_id", "parent_station"), "stop_id")
               .where(F.col("parent_station") != "")
               .select(F.col("parent_station").alias("stop_id")).distinct())
    return parents.join(stops, "stop_id").select(
        F.col("stop_id").alias("station_id"), F.col("stop_name").alias("station_name"),
        "latitude", "longitude")


def surface_stop_routes(routes: DataFrame, stops: DataFrame, served: DataFrame) -> DataFrame:
    """(stop_id, route short name) for non-subway service at non-station stops (F-8, U-5)."""
    surface_routes = routes.where(~F.col("route_type").eqNullSafe(X.SUBWAY_ROUTE_TYPE)).select(
        "route_id", X.short_name_or_id("route_short_name", "route_id").alias("route_key"))
    kept_stops = stops.where(F.col("location_type") != "1").select("stop_id")
    return (served.join(surface_routes, "route_id")
            .join(kept_stops, "stop_id", "left_semi")
            .select("stop_id", "route_key"))


def _lon_reach_deg(lat: Column, radius_m: float, margin_deg: float) -> Column:
    """Largest |dlon| (degrees) any point within ``radius_m`` can have.

    On the sphere sin(|dlon|/2) <= sin(d/2R) / cos(phi_max), with phi_max
    the largest |latitude| allowed by the latitude prefilter.
    """
    s = math.sin(radius_m / (2.0 * X.EARTH_RADIUS_M))
    phi_max = F.least(F.abs(lat) + F.lit(margin_deg), F.lit(90.0))
    cosine = F.cos(F.radians(phi_max))
    return F.when(cosine <= s, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.lit(s) / cosine)) * 2.0 * 1.0001)


def station_feeder_routes(routes: DataFrame, stops: DataFrame, served: DataFrame,
                          stations: DataFrame, radius_m: float = X.FEEDER_RADIUS_M) -> DataFrame:
    """Surface routes stopping within ``radius_m`` of each station (J-10, A-5).

    Spatial theta join as an equi-join on a lat/lon grid: each station is
    replicated to the cells its radius can reach (3 latitude cells x enough
    longitude cells for its latitude), each stop sits in one cell. Exact: no
    pair within the radius is missed, at any latitude. Stops in a crowded cell
    are a skewed join key that AQE's skew-join handling splits.
    """
    margin = X.lat_cell_deg(radius_m)
    cell = margin  # grid step in degrees, >= the latitude reach
    n_lon = int(math.ceil(360.0 / cell))
    # every cell within half a turn either way: with an even number of cells the
    # farthest is listed twice, and the distinct below keeps it once
    max_k = n_lon // 2

    def lon_cell(lon: Column) -> Column:
        return F.pmod(F.floor((lon + 180.0) / cell).cast("long"), F.lit(n_lon))

    station_cells = stations.select(
        "station_id", "station_name",
        F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"),
        F.floor(F.col("latitude") / cell).cast("long").alias("base_lat"),
        lon_cell(F.col("longitude")).alias("base_lon"),
        F.least(F.ceil(_lon_reach_deg(F.col("latitude"), radius_m, margin) / cell),
                F.lit(max_k)).cast("int").alias("k"),
    ).select(
        "station_id", "station_name", "s_lat", "s_lon", "base_lat", "base_lon", "k",
        F.explode(F.sequence(F.lit(-1), F.lit(1))).alias("dlat"),
    ).select(
        "station_id", "station_name", "s_lat", "s_lon", "base_lat", "base_lon", "dlat",
        F.explode(F.sequence(-F.col("k"), F.col("k"))).alias("dlon"),
    ).select(
        "station_id", "station_name", "s_lat", "s_lon",
        (F.col("base_lat") + F.col("dlat")).alias("lat_cell"),
        F.pmod(F.col("base_lon") + F.col("dlon"), F.lit(n_lon)).alias("lon_cell"))
    station_cells = station_cells.distinct()

    pairs = surface_stop_routes(routes, stops, served)
    surface = (stops.join(pairs.select("stop_id").distinct(), "stop_id")
               .select("stop_id", F.col("latitude").alias("p_lat"), F.col("longitude").alias("p_lon"),
                       F.floor(F.col("latitude") / cell).cast("long").alias("lat_cell"),
                       lon_cell(F.col("longitude")).alias("lon_cell")))

    near = (station_cells.join(surface, ["lat_cell", "lon_cell"])
            .where(F.abs(F.col("p_lat") - F.col("s_lat")) <= margin)
            .withColumn("distance", X.arc_metres("s_lat", "s_lon", "p_lat", "p_lon"))
            .where(F.col("distance") <= radius_m)
            .select("station_id", "station_name", "stop_id", "distance"))

    return (near.join(pairs, "stop_id")
            .groupBy("station_id", F.col("route_key").alias("route_id"))
            .agg(F.max("station_name").alias("station_name"),
                 F.min("distance").alias("distance"))
            .select("station_id", "station_name", "route_id",
                    X.round_half_even("distance", 1).alias("distance_meters")))


# ---------------------------------------------------------------------------
# Whole build
# ---------------------------------------------------------------------------
class _LazyTables(dict):
    """Mapping whose values are built on first access (plans are only
    constructed for the tables a job actually uses)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        value = self._builders[key]()
        self[key] = value
        return value

    def get(self, key, default=None):
        return self[key] if key in self._builders else default


def prepare(gtfs) -> dict[str, DataFrame]:
    """Typed views of the raw GTFS tables, built lazily on first use.

    ``gtfs`` maps a table name to a DataFrame or to a zero-argument callable
    returning one (so unused raw tables are never read either).
    """
    def raw(name):
        v = gtfs.get(name)
        return v() if callable(v) else v

    return _LazyTables({
        "routes": lambda: normalize_routes(raw("routes")),
        "trips": lambda: normalize_trips(raw("trips")),
        "stops": lambda: normalize_stops(raw("stops")),
        "stop_times": lambda: normalize_stop_times(raw("stop_times")),
        "calendar": lambda: raw("calendar"),
    })


def build_reference_tables(gtfs: dict[str, DataFrame], as_of: str,
                           radius_m: float = X.FEEDER_RADIUS_M) -> dict[str, DataFrame]:
    """All five reference tables from the raw GTFS tables (lazy DataFrames)."""
    t = prepare(gtfs)
    served = stop_routes(t["trips"], t["stop_times"])
    stations = subway_stations(t["routes"], t["stops"], served)
    return {
        "routes": t["routes"],
        "trips": trip_directions(t["trips"]),
        "scheduled_headways": scheduled_headways(t["routes"], t["trips"], t["stop_times"],
                                                 t["calendar"], as_of),
        "route_stops": route_paths(t["routes"], t["trips"], t["stops"], t["stop_times"]),
        "station_feeder_routes": station_feeder_routes(t["routes"], t["stops"], served,
                                                       stations, radius_m),
    }
