"""GTFS static text files (S-8, S-9).

Files are CSV with a header, read by column name with every value kept as
text (no inference); a leading byte-order mark is dropped by the CSV
reader. Columns a file lacks come back as nulls, which the static build
treats as blank. ``calendar.txt`` is optional. ``file_pos`` is a row's place in
its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GTFS_COLUMNS
from .order import FILE_POS, with_file_pos

REQUIRED = ("routes", "trips", "stops", "stop_times")
OPTIONAL = ("calendar",)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's filesystem (driver metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_gtfs_file(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    raw = (spark.read.option("header", "true").option("inferSchema", "false")
           .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
           .csv(path))
    raw = with_file_pos(raw, numbered=False)
    present = {c.lstrip("﻿").strip(): c for c in raw.columns}
    return raw.select([F.col(f"`{present[c]}`").alias(c) if c in present
                       else F.lit(None).cast("string").alias(c) for c in columns] + [FILE_POS])


def read_gtfs(spark: SparkSession, directory: str) -> dict[str, DataFrame | None]:
    """The five tables of an extracted GTFS directory; ``calendar`` may be None."""
    out: dict[str, DataFrame | None] = {}
    for name in REQUIRED + OPTIONAL:
        path = f"{directory.rstrip('/')}/{name}.txt"
        if not path_exists(spark, path):
            if name in OPTIONAL:
                out[name] = None
                continue
            raise FileNotFoundError(path)
        out[name] = read_gtfs_file(spark, path, GTFS_COLUMNS[name])
    return out
