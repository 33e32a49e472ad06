"""What the operators share: staged tables, size-checked joins, input columns.

Documents come with any columns; an operator reads ``doc_id`` and ``text`` (the
pipeline stages pass all columns on). Inside an operator every column of its own
starts with two underscores or lives in a frame of its own, so a column of the
caller's cannot clash with one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this many bytes (rows times row width), else it is shuffled.
BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only where it is unset, one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
        named = spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and a lost
    executor costs a reread. Column names are kept; the folder is new for each call."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same(a: Column, b: Column) -> Column:
    """Equality that holds for two nulls as well; still an equi-join key for Spark."""
    return a.eqNullSafe(b)


def small_enough(rows: int, width: int) -> bool:
    """Whether ``rows`` rows of ``width`` bytes may be broadcast."""
    return rows * width <= BROADCAST_BYTES


def sized(keys: DataFrame, rows: int, width: int) -> DataFrame:
    """``keys`` with a broadcast hint if its counted size is within the bound, as it is otherwise."""
    return F.broadcast(keys) if small_enough(rows, width) else keys


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(docs: DataFrame, own) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with every column that is named as one of ``own`` renamed, and the way back."""
    names = {c: f"__theirs_{i}" for i, c in enumerate(docs.columns) if c in own}
    return docs.withColumnsRenamed(names), {v: k for k, v in names.items()}


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(id, doc_id, text), and whether id is a number of its own: id is doc_id where that is unique and never null; else documents are
    numbered by doc_id (null first), then text, so rows that repeat a doc_id are documents of
    their own, the smaller text first."""
    plain = docs.select("doc_id", "text")
    odd = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    if odd.isEmpty():
        return plain.select(F.col("doc_id").cast("long").alias("id"), "doc_id", "text"), False
    ordered = plain.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = stage(ordered.withColumn("id", F.monotonically_increasing_id()), "numbered")
    return numbered.select("id", "doc_id", "text"), True
