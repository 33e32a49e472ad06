"""Structured Streaming forms of the jobs.

They share the batch operators' column logic; only what streams require
changes:

* distinct vehicles per window: ``countDistinct`` is not supported on
  streams, so the count is a chain of two stateful aggregates
  (route, window, vehicle) -> (route, window); state is one row per
  vehicle-window, never a growing array, and the watermark closes both;
* the gap to the vehicle ahead: ``lead`` is not supported on streams, but all
  vehicles of a window come out when it closes, in one micro-batch, which is
  then finished as a batch (``foreachBatch``);
* ripples need a per-version "closest station" aggregate with no event-time
  column: each micro-batch is processed as a batch (``foreachBatch``),
  written idempotently per batch id;
* TTL'd live state is a keyed state machine (``applyInPandasWithState``); those
  that fold a key's rows in arrival order are in ``streaming.stateful``.

Windows emit once, when the watermark (max event time - grace) passes their
end (append mode), like the reference's suppress-until-close.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import exprs as X
from ..operators import alerts as A
from ..operators import crowding as C
from ..operators import delay as D
from ..session import remove, stream_checkpoint
from .stateful import start


# ---------------------------------------------------------------------------
# J3 / J4: windowed jobs
# ---------------------------------------------------------------------------
def route_windows_stream(positions: DataFrame, window: str = X.WINDOW,
                         grace: str = X.GRACE) -> DataFrame:
    """Distinct vehicles per closed (route, window) as a chain of two stateful
    aggregates (append mode)."""
    timed = D.route_present(positions).withWatermark("event_time", grace)
    per_vehicle = (timed.groupBy("route_id", F.window("event_time", window).alias("w"), "vehicle_id")
                   .agg(F.count(F.lit(1)).alias("_records")))
    return (per_vehicle
            .groupBy("route_id", F.window(F.window_time("w"), window).alias("w"))
            .agg(F.count(F.lit(1)).alias("vehicles")))


def delay_scores_stream(positions: DataFrame, headways: DataFrame, window: str = X.WINDOW,
                        grace: str = X.GRACE, tz: str = X.LOCAL_TZ) -> DataFrame:
    """Streaming delay scores (append mode); ``headways`` is a static DataFrame."""
    return D.score_windows(route_windows_stream(positions, window, grace), headways,
                           tz=tz)


def closed_snapshots_stream(positions: DataFrame, trips: DataFrame, window: str = X.WINDOW,
                            grace: str = X.GRACE) -> DataFrame:
    """The last snapshot of each vehicle in every closed (route, direction, window) (append mode).

    State is one row per vehicle and open window. All vehicles of a window come out in the
    micro-batch whose watermark passes its end.
    """
    timed = C.eligible(positions, trips).withWatermark("event_time", grace)
    return C.latest_snapshots(timed, window)


def crowding_batch_writer(headways: DataFrame | Callable[[], DataFrame], path: str, crowded: float = X.CROWDED_RATIO,
                          empty: float = X.EMPTY_RATIO, tz: str = X.LOCAL_TZ, fmt: str = "parquet"):
    """foreachBatch function: estimates for the windows that a micro-batch has closed, to ``path/batch_id=<id>``.

    A closed window is whole within its micro-batch, so the gaps are those of the batch form: only
    the different stop sequences of a group are ordered, and no list of its vehicles is made anywhere.
    The closed vehicles are written first (to ``path/_closed``, which readers of ``path`` skip) and read
    twice from there, so that a lost executor costs a reread and not the stateful step.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, staged = batch.sparkSession, f"{path.rstrip('/')}/_closed/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        closed = spark.read.schema(batch.schema).parquet(staged)
        scheduled = C.with_schedule(closed, headways() if callable(headways) else headways, tz)
        (C.gaps_by_window_function(scheduled, crowded, empty).write.mode("overwrite")
         .format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}"))
        remove(spark, staged)
    return write


def start_crowding(positions: DataFrame, trips: DataFrame, headways: DataFrame | Callable[[], DataFrame], path: str,
                   checkpoint: str | None = None, trigger: dict | None = None, window: str = X.WINDOW, grace: str = X.GRACE,
                   **rule):
    """Start the crowding job (ST-9); the checkpoint defaults to the shared checkpoint folder."""
    checkpoint = checkpoint or stream_checkpoint(positions.sparkSession, "crowding")
    w = (closed_snapshots_stream(positions, trips, window, grace).writeStream.outputMode("append")
         .foreachBatch(crowding_batch_writer(headways, path, **rule)).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


# ---------------------------------------------------------------------------
# J5: ripples per micro-batch
# ---------------------------------------------------------------------------
def ripples_batch_writer(feeders: DataFrame | Callable[[], DataFrame], path: str, fmt: str = "parquet"):
    """foreachBatch function: cascade each batch of alert versions and write it
    to ``path/batch_id=<id>``. Re-running a batch after a failure overwrites
    the same directory, so output keyed by ripple_id stays exact (ST-14).

    ``feeders`` may be a function, called for every micro-batch: a schedule
    published meanwhile then counts from the next batch on. The cascade uses its
    alerts twice, so the batch is kept while it is written and read once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            (A.ripples(kept, feeders() if callable(feeders) else feeders).write.mode("overwrite")
             .format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}"))
        finally:
            kept.unpersist()
    return write


def start_ripples(alerts: DataFrame, feeders: DataFrame | Callable[[], DataFrame], path: str, checkpoint: str | None = None,
                  trigger: dict | None = None):
    """Start the ripple job; the checkpoint defaults to the shared checkpoint folder."""
    checkpoint = checkpoint or stream_checkpoint(alerts.sparkSession, "ripples")
    w = (alerts.writeStream.foreachBatch(ripples_batch_writer(feeders, path))
         .option("checkpointLocation", checkpoint))
    return start(w.trigger(**(trigger or {"availableNow": True})))  # alerts may come from the ordered change detection


# ---------------------------------------------------------------------------
# J6: latest-per-key live state with TTL (ST-10)
# ---------------------------------------------------------------------------
def live_state_stream(df: DataFrame, key: str, ttl_s: int, order: str = "arrival_seq",
                      written_at: str = "event_time", delay: str = "0 seconds") -> DataFrame:
    """Latest message per key; expires ``ttl_s`` after its write (event time).

    Output (update mode): the new latest row with ``expired = false`` each
    time a key changes, and the last row with ``expired = true`` when it
    expires (the watermark passed write time + TTL). An older message (by
    ``order``) never replaces a newer one.
    """
    payload = [c for c in df.columns if c not in (written_at,)]
    rows = df.where(F.col(key).isNotNull() & (F.col(key) != "")).select(
        *payload, F.col(written_at), X.epoch_ms(written_at).alias("written_at_ms"))
    rows = rows.withWatermark(written_at, delay)
    fields = [f for f in rows.schema.fields if f.name != written_at]
    state_schema = T.StructType(fields)
    out_schema = T.StructType(fields + [T.StructField("expired", T.BooleanType())])
    names = [f.name for f in fields]
    ttl_ms = ttl_s * 1000

    def track(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = dict(zip(names, state.get))
            state.remove()
            yield pd.DataFrame([{**last, "expired": True}], columns=names + ["expired"])
            return
        newest = None
        for pdf in batches:  # one row is held, however many a key has
            best = pdf.loc[pdf[order].idxmax(), names]
            newest = best if newest is None or best[order] > newest[order] else newest
        if state.exists and dict(zip(names, state.get))[order] >= newest[order]:
            return
        expires_at = int(newest["written_at_ms"]) + ttl_ms
        if expires_at <= state.getCurrentWatermarkMs():
            return  # already expired on arrival
        state.update(tuple(newest.tolist()))
        state.setTimeoutTimestamp(expires_at)
        yield pd.DataFrame([{**newest.to_dict(), "expired": False}], columns=names + ["expired"])

    return rows.groupBy(key).applyInPandasWithState(
        track, out_schema, state_schema, "update", GroupStateTimeout.EventTimeTimeout)
