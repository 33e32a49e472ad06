"""Order-dependent helpers that stay parallel when one key is hot.

A window partitioned by a key puts all of that key's rows in one task. When
a key may hold a large share of the data, the order column is cut into
blocks: per-(key, block) summaries form a small table on which the
cross-block step runs, and the per-row step runs inside (key, block)
partitions whose size is bounded by the block width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

#: Values of a fixed width, which a hash aggregate updates in place.
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def last_of_contents(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The last row by ``order_col`` of each key and content of text and arrays.

    The last row of a key is among them, as ``max_by`` over a struct finds it. That
    alone would sort all rows by key first: a struct has no fixed width, and such
    aggregates are no hash aggregates. Here only values of a fixed width are
    aggregated, so a task holds a row per key and content, however often it is sent.
    A row without an order comes before all others, as in a struct.
    """
    place = F.coalesce(F.col(order_col), F.lit(-(1 << 63)))
    fixed = [f.name for f in df.schema if isinstance(f.dataType, _FIXED) and f.name not in (*keys, order_col)]
    content = [c for c in df.columns if c not in (*fixed, order_col)]
    return df.groupBy(*content).agg(
        *[F.max_by(c, place).alias(c) for c in fixed], F.max(order_col).alias(order_col)).select(*df.columns)


def previous_value(df: DataFrame, keys: list[str], order_col: str, value_col: str,
                   out_col: str = "previous", block: int = 1 << 20,
                   super_block: int = 1 << 10) -> DataFrame:
    """Add ``out_col`` = ``value_col`` of the preceding row of the same key.

    Equivalent to ``lag(value).over(partitionBy(keys).orderBy(order_col))``
    (``order_col`` unique within a key), without a per-key partition: the
    last value of each (key, block) is carried to the next block through
    (key, super-block) partitions, and across super-blocks through a table
    of one row per (key, super-block).
    """
    blocked = df.withColumn("_blk", F.floor(F.col(order_col) / block))
    last = (blocked.groupBy(*keys, "_blk")
            .agg(F.max_by(F.col(value_col), F.col(order_col)).alias("_last"),
                 F.max(order_col).alias("_last_at"))
            .withColumn("_sup", F.floor(F.col("_blk") / super_block)))
    sup_carry = (last.groupBy(*keys, "_sup")
                 .agg(F.max_by("_last", "_last_at").alias("_slast"))
                 .select(*keys, "_sup",
                         F.lag("_slast").over(W.partitionBy(*keys).orderBy("_sup")).alias("_scarry")))
    in_sup = W.partitionBy(*keys, "_sup").orderBy("_blk")
    carried = last.join(sup_carry, [*keys, "_sup"], "left").select(
        *keys, "_blk",
        F.when(F.row_number().over(in_sup) == 1, F.col("_scarry"))
        .otherwise(F.lag("_last").over(in_sup)).alias("_carry"))
    inside = W.partitionBy(*keys, "_blk").orderBy(order_col)
    return (blocked.join(carried, [*keys, "_blk"])
            .withColumn(out_col, F.when(F.row_number().over(inside) == 1, F.col("_carry"))
                        .otherwise(F.lag(value_col).over(inside)))
            .drop("_blk", "_carry"))
