"""Sinks: keyed JSON streams, reference-table publication.

* K-1  keyed JSON records: ``to_keyed_json`` / ``write_stream`` (sparse JSON
       by default, explicit nulls on request — P-1, P-2).
* K-3  the reference tables are published together: each build writes new
       folders, and only after every table is written is the next version
       committed (``manifest``). Readers never see a half-refreshed set, and a
       pinned version stays while it is read (S-10).
* K-4  ``routes`` is upserted: old rows not in the new feed stay.
* K-5  insert-ignore on a key, in the order of the file.

The live state (K-6) is in ``state_table``, the history (K-7) in ``history``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import static as ST
from ..session import checkpoint_root
from ..sources.order import FILE_POS
from .manifest import Manifest


def to_keyed_json(df: DataFrame, key: str, explicit_nulls: bool = False) -> DataFrame:
    options = {"ignoreNullFields": "false"} if explicit_nulls else {}
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*df.columns), options).alias("value"))


def write_stream(df: DataFrame, key: str, path: str, checkpoint: str, fmt: str = "json",
                 trigger: dict | None = None, explicit_nulls: bool = False,
                 output_mode: str = "append"):
    """Start a streaming query writing ``(key, value-json)`` records (K-1)."""
    return (to_keyed_json(df, key, explicit_nulls).writeStream.format(fmt)
            .option("path", path).option("checkpointLocation", checkpoint)
            .outputMode(output_mode).trigger(**(trigger or {"availableNow": True})).start())


# ---------------------------------------------------------------------------
# Reference tables (K-3, K-4, K-5)
# ---------------------------------------------------------------------------
def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the published version; None before the first."""
    return Manifest(spark, root).read()[0] or None


def read_reference_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of the current version; a query over several takes them from one ``Manifest.pin`` (S-10)."""
    m = Manifest(spark, root)
    return m.table(m.read()[1], name)


def upsert_routes(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """K-4: new rows replace old ones by route_id; routes absent from the new
    feed are kept."""
    if existing is None:
        return incoming
    return existing.join(incoming.select("route_id"), "route_id", "left_anti").unionByName(incoming)


def insert_ignore(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """K-5: one row per key, the smallest by ``order`` (stand-in for 'first')."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*keys, "_r.*"))


def publish_reference_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> int:
    """K-3: write every table, then commit them together as the next version."""
    m = Manifest(spark, root)
    folder = m.new_folder()
    for name, df in tables.items():
        df.write.parquet(f"{m.root}/{folder}/{name}")
    content = {"entries": {name: f"{folder}/{name}" for name in tables}, "schemas": {name: df.schema.jsonValue() for name, df in tables.items()}}
    return m.update(lambda _: content)


def build_and_publish(spark: SparkSession, gtfs: dict, root: str, as_of: str,
                      radius_m: float = 300) -> int:
    """The whole static job: build the tables, publish them together.

    The served pairs (a few per stop) are staged once by a reliable ``checkpoint()``
    in the cluster's shared checkpoint folder: stations, surface stops and feeder
    pairs all need them, and each would join the stop times with the trips anew.
    ``stop_times`` itself is not staged. Three plans scan it, each for the columns
    it needs, which costs less than to write and read all of it as rows; a lost
    executor's share is read again from the files. ``routes`` is upserted onto the
    published one.
    """
    checkpoint_root(spark)
    t = ST.prepare(gtfs)
    served = ST.stop_routes(t["trips"], t["stop_times"]).checkpoint(eager=True)
    stations = ST.subway_stations(t["routes"], t["stops"], served)
    try:
        previous = read_reference_table(spark, root, "routes")
    except FileNotFoundError:
        previous = None
    tables = {
        "routes": upsert_routes(previous, t["routes"]),
        "trips": insert_ignore(t["trips"].select("trip_id", "route_id", "direction_id", FILE_POS), ["trip_id"], [FILE_POS]).drop(FILE_POS),
        "scheduled_headways": ST.scheduled_headways(t["routes"], t["trips"], t["stop_times"],
                                                    t["calendar"], as_of),
        "route_stops": ST.route_paths(t["routes"], t["trips"], t["stops"], t["stop_times"]),
        "station_feeder_routes": ST.station_feeder_routes(t["routes"], t["stops"], served,
                                                          stations, radius_m),
    }
    return publish_reference_tables(spark, tables, root)
