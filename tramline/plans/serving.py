"""Published reference tables for the live queries (S-10).

The live jobs of the application read the tables that the schedule job has
published; they do not build the schedule themselves. ``served`` publishes
them once for a set of input files (known by path, size and time of change) under
the shared checkpoint folder and pins that version for the application, so every
table of a query comes from one version, which cleaning spares.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root
from ..sinks import writers as K
from ..sinks.manifest import Manifest, Pin
from ..sources import testdata as TD

_PINS: dict[tuple[str, str], Pin] = {}
#: An application's pin lasts this long at most, should it end without releasing it.
PIN_S = 24 * 3600


class Served:
    """The tables of one published version."""

    def __init__(self, pin: Pin):
        self.pin = pin

    @property
    def routes(self) -> DataFrame:
        return self.pin.table("routes")

    @property
    def trips(self) -> DataFrame:
        return self.pin.table("trips")

    @property
    def headways(self) -> DataFrame:
        return self.pin.table("scheduled_headways")

    @property
    def feeders(self) -> DataFrame:
        return self.pin.table("station_feeder_routes")


def _inputs(spark: SparkSession, sf_dir: str) -> str:
    """What the schedule is built from: path, bytes and time of change of each table (metadata only)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    known = []
    for name in ("nation", "orders", "supplier", "lineitem"):
        place = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = place.getFileSystem(conf)
        known.append(f"{place} {fs.getContentSummary(place).getLength()} {fs.getFileStatus(place).getModificationTime()}")
    return hashlib.sha256("\n".join([*known, TD.AS_OF_DATE]).encode()).hexdigest()[:16]


def served(spark: SparkSession, sf_dir: str) -> Served:
    """The published tables for ``sf_dir``; the schedule job runs where there are none yet."""
    root = f"{checkpoint_root(spark)}/reference/{_inputs(spark, sf_dir)}"
    key = (spark.sparkContext.applicationId, root)
    if key not in _PINS:
        if not Manifest(spark, root).versions():
            K.build_and_publish(spark, TD.gtfs_tables(spark, sf_dir), root, TD.AS_OF_DATE)
        _PINS[key] = Manifest(spark, root).pin(PIN_S)
    return Served(_PINS[key])
