"""Route delay score per 5-minute event-time window (batch form).

The streaming form (``streaming.jobs.delay_scores_stream``) shares
``score_windows``; only the distinct-count differs (``collect_set`` on
streams, where ``countDistinct`` is not supported).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import exprs as X


def route_present(positions: DataFrame) -> DataFrame:
    """F-1: the record has a non-empty route."""
    return positions.where(F.col("route_id").isNotNull() & (F.col("route_id") != ""))


def route_windows(positions: DataFrame, window: str = X.WINDOW) -> DataFrame:
    """Distinct vehicles per (route, tumbling window) (A-1, ST-1).

    Both directions count together and an empty vehicle id counts as a
    vehicle, as in the reference.
    """
    return (route_present(positions)
            .groupBy("route_id", F.window("event_time", window).alias("w"))
            .agg(F.countDistinct("vehicle_id").alias("vehicles")))


def score_windows(windows: DataFrame, headways: DataFrame, window_minutes: float = X.WINDOW_MINUTES,
                  tz: str = X.LOCAL_TZ) -> DataFrame:
    """Closed route windows -> delay rows (X-3, X-4, X-6, X-7, J-1, F-3).

    ``windows`` has route_id, w (window struct) and vehicles. The schedule
    is looked up at the local hour of the window *start*; windows without a
    schedule are dropped. The score subtracts the stored (already rounded)
    schedule from the unrounded actual headway and rounds last.
    """
    actual = F.lit(window_minutes) / F.col("vehicles")
    keyed = windows.withColumn("hour_of_day", X.local_hour(F.col("w.start"), tz))
    return keyed.join(headways, ["route_id", "hour_of_day"]).select(
        "route_id",
        X.epoch_ms(F.col("w.start")).alias("window_start"),
        X.epoch_ms(F.col("w.end")).alias("window_end"),
        X.round_half_up2(actual).alias("actual_headway_minutes"),
        X.round_half_up2("scheduled_headway_minutes").alias("scheduled_headway_minutes"),
        X.round_half_up2(actual - F.col("scheduled_headway_minutes")).alias("delay_score"))


def delay_scores(positions: DataFrame, headways: DataFrame, window: str = X.WINDOW,
                 tz: str = X.LOCAL_TZ) -> DataFrame:
    """Delay rows for every (route, window) with a schedule.

    The headway table is tiny (routes x 24), so it is joined after the
    aggregation: one lookup per window, not per record.
    """
    return score_windows(route_windows(positions, window), headways, tz=tz)


def unscheduled_windows(positions: DataFrame, headways: DataFrame, window: str = X.WINDOW,
                        tz: str = X.LOCAL_TZ) -> DataFrame:
    """Route windows dropped for lack of a schedule (F-3 report)."""
    w = route_windows(positions, window).withColumn("hour_of_day", X.local_hour(F.col("w.start"), tz))
    return w.join(headways, ["route_id", "hour_of_day"], "left_anti").select(
        "route_id", "hour_of_day",
        X.epoch_ms(F.col("w.start")).alias("window_start"),
        X.epoch_ms(F.col("w.end")).alias("window_end"),
        "vehicles")


# ---------------------------------------------------------------------------
# Lateness (W-5, ST-3)
# ---------------------------------------------------------------------------
def _window_end(ts: Column, window_s: int) -> Column:
    secs = F.unix_seconds(ts)
    return secs - F.pmod(secs, F.lit(window_s)) + window_s


def mark_late(df: DataFrame, window_s: int = 300, grace_s: int = X.GRACE_SECONDS,
              order_col: str = "arrival_seq", partition_col: str | None = None,
              block: int = 1 << 20, super_block: int = 1 << 10) -> DataFrame:
    """Flag records a per-record stream processor would drop as late.

    Stream time is the running max of ``event_time`` in ``order_col`` order
    (per ``partition_col`` if given, else one stream). A record is late when
    its window end <= stream time - grace.

    A running max over the whole stream would put every row in one task.
    Instead the order is cut into blocks of ``block`` offsets, and blocks into
    super-blocks of ``super_block`` blocks:

    1. per-block maxima are aggregated (one row per block);
    2. the exclusive prefix max over super-blocks runs on one row per
       super-block (N / 2^30 rows with the defaults);
    3. the exclusive prefix max over blocks runs per super-block;
    4. inside each block (bounded size) a windowed running max finishes.

    Exact, and every step but the tiny step 2 is partitioned.
    """
    parts = [partition_col] if partition_col else []
    with_block = df.withColumn("_blk", F.floor(F.col(order_col) / block))
    block_max = (with_block.groupBy(*parts, "_blk").agg(F.max("event_time").alias("_bmax"))
                 .withColumn("_sup", F.floor(F.col("_blk") / super_block)))
    sup_before = (block_max.groupBy(*parts, "_sup").agg(F.max("_bmax").alias("_smax"))
                  .select(*parts, "_sup",
                          F.max("_smax").over(W.partitionBy(*parts).orderBy("_sup")
                                              .rowsBetween(W.unboundedPreceding, -1))
                          .alias("_sbefore")))
    prefix = block_max.join(sup_before, [*parts, "_sup"], "left").select(
        *parts, "_blk",
        F.greatest(F.max("_bmax").over(W.partitionBy(*parts, "_sup").orderBy("_blk")
                                       .rowsBetween(W.unboundedPreceding, -1)),
                   F.col("_sbefore")).alias("_before"))
    inside = W.partitionBy(*parts, "_blk").orderBy(order_col).rowsBetween(W.unboundedPreceding, 0)
    marked = (with_block.join(prefix, [*parts, "_blk"], "left")
              .withColumn("stream_time", F.greatest(F.max("event_time").over(inside),
                                                    F.col("_before"))))
    late = (_window_end(F.col("event_time"), window_s)
            <= F.unix_seconds(F.col("stream_time")) - grace_s)
    return marked.withColumn("is_late", late).drop("_blk", "_before")


def delay_scores_on_time(positions: DataFrame, headways: DataFrame, window_s: int = 300,
                         grace_s: int = X.GRACE_SECONDS) -> DataFrame:
    """Delay rows counting only records that arrive within the grace period.

    Stream time advances only with records that reach the window aggregate,
    i.e. after the route filter, so lateness is marked after it.
    """
    on_time = mark_late(route_present(positions), window_s, grace_s).where(~F.col("is_late"))
    return delay_scores(on_time, headways, f"{window_s} seconds")
