"""Place of a row in its input files, from top to bottom.

A loader that reads a file row by row gives "first" and "last" a meaning that
a table split over many tasks lacks. ``with_file_pos`` restores it as a
number: of two rows the later one has the greater ``file_pos``, whatever task
read it. Files are ordered by path. Parquet numbers its rows itself
(``_metadata.row_index``). A text row's place is the byte where its split
begins plus its number in the task: a row takes at least a byte, and a task
never reads two splits of one file (all but a file's last split have the full
size), so the sum grows along the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_POS = "file_pos"
#: Bytes, or rows, that one file may have.
_PER_FILE = 1 << 44
_IN_TASK = (1 << 33) - 1


def with_file_pos(df: DataFrame, numbered: bool) -> DataFrame:
    """``df``, a scan of files, with ``file_pos``; ``numbered`` if the format numbers its rows."""
    place = (F.col("_metadata.row_index") if numbered else
             F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(_IN_TASK))
    names = sorted({path.rsplit("/", 1)[-1] for path in df.inputFiles()})
    if len(names) < 2:
        return df.withColumn(FILE_POS, place)
    # one row per file: Spark broadcasts it or not by its size
    files = df.sparkSession.createDataFrame([(n, i * _PER_FILE) for i, n in enumerate(names)], "_file string, _from long")
    placed = df.withColumn(FILE_POS, place).withColumn("_file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    return placed.join(files, "_file").withColumn(FILE_POS, F.col(FILE_POS) + F.col("_from")).drop("_file", "_from")


def in_order(df: DataFrame) -> DataFrame:
    """``df`` with ``file_pos``; a table that has none gets the order of its partitions and their rows."""
    return df if FILE_POS in df.columns else df.withColumn(FILE_POS, F.monotonically_increasing_id())


def _rest(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in (*keys, FILE_POS)]


def last_row(df: DataFrame, *keys: str) -> DataFrame:
    """The last row of each key, combined map-side; ``file_pos`` goes."""
    rest = _rest(df, list(keys))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), FILE_POS).alias("_r")).select(*keys, "_r.*")


def first_row(df: DataFrame, *keys: str) -> DataFrame:
    """The first row of each key, combined map-side; ``file_pos`` goes."""
    rest = _rest(df, list(keys))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), FILE_POS).alias("_r")).select(*keys, "_r.*")
