"""Keyed state machines over streams: change detection, per-record lateness, client state.

Each folds a key's rows in arrival order, one Arrow batch (or row) at a time, and
keeps a state of fixed size, so a key may hold any share of a micro-batch. The
order comes from Spark: ``ordered`` shuffles by key and sorts each partition by
(key, order), and the state operator needs no shuffle or sort of its own on
top. Spark refuses a sort on a stream in general, for a stream has no end; within
a micro-batch it is defined. ``start`` switches that check off for the one query
it starts, and a query of these that is started otherwise is refused by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

from ..functions import exprs as X
from ..operators import alerts as A
from ..operators.live import POSITION_FIELDS
from ..sources import feeds as FD

_CHECK = "spark.sql.streaming.unsupportedOperationCheck"


def ordered(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of a key together, in order, within each micro-batch."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def start(writer):
    """``writer.start()`` for a stream that ``ordered`` feeds."""
    conf = writer._spark.conf
    before = conf.get(_CHECK, "true")
    conf.set(_CHECK, "false")
    try:
        return writer.start()  # the query keeps a copy of the settings
    finally:
        conf.set(_CHECK, before)


# ---------------------------------------------------------------------------
# ST-6: changes of a key's content
# ---------------------------------------------------------------------------
class _Changes(StatefulProcessor):
    """Rows whose fingerprint differs from the one before; the state is one fingerprint."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "fingerprint string", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.exists()
        last = self.last.get()[0] if known else None
        for pdf in rows:
            now = pdf["fingerprint"].to_numpy()
            changed = np.empty(len(now), bool)
            changed[1:] = now[1:] != now[:-1]
            changed[0] = not known or now[0] != last
            known, last = True, now[-1]
            if changed.any():
                yield pdf[changed]
        self.last.update((last,))  # also renews its time to live

    def close(self) -> None:
        pass


def alert_changes_stream(alerts: DataFrame, state_ttl_ms: int | None = None) -> DataFrame:
    """Alert versions whose content differs from the last published one of the alert (A, A, B, A -> 3 rows).

    With ``state_ttl_ms`` an alert not seen for that long (by the clock) is forgotten; such a
    query runs until it is stopped (Spark ends none that waits for the clock, whatever the trigger). The
    whole alert row comes out, and its fingerprint, so ``jobs.start_ripples`` can take it.
    """
    bodies = A.with_fingerprint(alerts.where(F.col("has_body")))
    return ordered(bodies, "alert_id", "arrival_seq").groupBy("alert_id").transformWithStateInPandas(
        _Changes(state_ttl_ms), bodies.schema, "Append", "ProcessingTime" if state_ttl_ms else "None")


# ---------------------------------------------------------------------------
# ST-3: lateness by record
# ---------------------------------------------------------------------------
class _StreamTime(StatefulProcessor):
    """Every row with the greatest event time of its source partition so far; the state is that time."""

    def __init__(self, window_s: int, grace_s: int):
        self.window_s, self.grace_s = window_s, grace_s

    def init(self, handle) -> None:
        self.time = handle.getValueState("time", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        time = self.time.get()[0] if self.time.exists() else np.iinfo(np.int64).min
        for pdf in rows:
            at = pdf["event_us"].to_numpy(np.int64)
            so_far = np.maximum(np.maximum.accumulate(at), time)
            time = so_far[-1]
            seconds = at // 1_000_000
            window_end = seconds - seconds % self.window_s + self.window_s
            yield pdf.assign(stream_us=so_far, is_late=window_end <= so_far // 1_000_000 - self.grace_s)
        self.time.update((int(time),))

    def close(self) -> None:
        pass


def late_stream(positions: DataFrame, partition: str, window_s: int = 300, grace_s: int = X.GRACE_SECONDS,
                order: str = "arrival_seq") -> DataFrame:
    """``delay.mark_late`` on a stream: ``stream_time`` and ``is_late`` of every record.

    Stream time runs per source partition (the column ``partition``), as in a processor that
    owns one; partitions are independent, so there are as many tasks. Feed it the records
    that reach the window aggregate (``delay.route_present``).
    """
    at = positions.withColumn("event_us", F.unix_micros("event_time"))
    schema = T.StructType([*at.schema, T.StructField("stream_us", T.LongType()), T.StructField("is_late", T.BooleanType())])
    marked = ordered(at, partition, order).groupBy(partition).transformWithStateInPandas(
        _StreamTime(window_s, grace_s), schema, "Append", "None")
    return marked.withColumn("stream_time", F.timestamp_micros("stream_us")).drop("event_us", "stream_us")


def split_writer(paths: dict[str, tuple[str, str]], fmt: str = "parquet"):
    """foreachBatch function: one micro-batch to several places, read once.

    ``paths`` maps a name to (condition, folder). Each part goes to ``batch_id=<id>`` of its
    folder, so a replayed batch overwrites what it wrote before.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for condition, folder in paths.values():
                (kept.where(condition).write.mode("overwrite").format(fmt)
                 .save(f"{folder.rstrip('/')}/batch_id={batch_id}"))
        finally:
            kept.unpersist()
    return write


def start_lateness(positions: DataFrame, partition: str, on_time: str, late: str, checkpoint: str,
                   trigger: dict | None = None, **rule):
    """On-time records to one folder, late ones to a side folder (ST-3)."""
    parts = {"on time": ("not is_late", on_time), "late": ("is_late", late)}
    writer = (late_stream(positions, partition, **rule).writeStream.foreachBatch(split_writer(parts))
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    return start(writer)


# ---------------------------------------------------------------------------
# S-6 / A-15: one pass over a topic, counters of it
# ---------------------------------------------------------------------------
class TopicCounts(StreamingQueryListener):
    """Records and rejects of each topic, from the progress of the queries that read them.

    A micro-batch is counted once, also if its progress is reported again.
    """

    def __init__(self):
        self.batches: dict[tuple[str, int], tuple[int, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for topic, row in (event.progress.observedMetrics or {}).items():
            self.batches[topic, event.progress.batchId] = (row["records"], row["rejected"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def counts(self, spark: SparkSession) -> DataFrame:
        """(topic, records, rejected): the counters as a relation, to be published as any table."""
        total: dict[str, list[int]] = {}
        for (topic, _), (records, rejected) in self.batches.items():
            own = total.setdefault(topic, [0, 0])
            own[0] += records
            own[1] += rejected
        return spark.createDataFrame([(t, *n) for t, n in sorted(total.items())], "topic string, records long, rejected long")


def start_topic(raw: DataFrame, schema: T.StructType, key: str, topic: str, good: str, dead: str, checkpoint: str,
                trigger: dict | None = None):
    """A JSON topic in one pass: whole records to ``good``, the others with their reason to ``dead`` (S-6)."""
    marked = FD.marked_with_counts(raw, schema, key, topic)
    flat = marked.select(*[F.col("_rec").getField(f.name).alias(f.name) for f in schema],
                         F.struct(*raw.columns).alias("_raw"), F.col("reason").alias("_reason"))
    names = [f.name for f in schema]

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            place = f"batch_id={batch_id}"
            kept.where("_reason is null").select(*names).write.mode("overwrite").parquet(f"{good.rstrip('/')}/{place}")
            (kept.where("_reason is not null").select("_raw.*", F.col("_reason").alias("reason"))
             .write.mode("overwrite").parquet(f"{dead.rstrip('/')}/{place}"))
        finally:
            kept.unpersist()

    return (flat.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


# ---------------------------------------------------------------------------
# ST-13 / S-7: a client's state, seeded from a snapshot, then updated
# ---------------------------------------------------------------------------
#: A message of the live feed to one client: a sparse position, or a crowding level (``is_position`` false).
MESSAGE = ("vehicle_id string, at timestamp, seq long, is_position boolean, route_id string, latitude double, longitude double, "
           "bearing float, speed float, feed_ts long, occupancy string, trip_id string, direction_id int, "
           "current_stop_sequence int, crowding_level string, part int, offset long")
#: What a client holds of a vehicle.
CLIENT_STATE = ("route_id string, latitude double, longitude double, bearing float, speed float, feed_ts long, occupancy string, "
                "trip_id string, direction_id int, current_stop_sequence int, crowding_level string, arrival_seq long, last_seen_us long")
_FIELDS = [*POSITION_FIELDS, "crowding_level", "arrival_seq", "last_seen_us"]


class _Client(StatefulProcessor):
    """Sparse messages merged field by field; a vehicle silent for too long is forgotten with its fields."""

    def __init__(self, stale_s: int):
        self.stale_us = stale_s * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("vehicle", CLIENT_STATE)

    def _keep(self, state: dict) -> None:
        self.state.update(tuple(state[f] for f in _FIELDS))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((state["last_seen_us"] + self.stale_us) // 1000 + 1)

    def _row(self, key, state: dict, gone: bool) -> Row:
        return Row(vehicle_id=key[0], **state, gone=gone)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep({f: initialState[f] for f in _FIELDS})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = dict(zip(_FIELDS, self.state.get())) if self.state.exists() else None
        touched = False
        for m in rows:
            at = m["at_us"]
            if state and at - state["last_seen_us"] > self.stale_us:
                state = None
            if m["is_position"]:
                state = state or dict.fromkeys(_FIELDS)
                state.update((f, m[f]) for f in POSITION_FIELDS if m[f] is not None)
                state["arrival_seq"] = max(m["seq"], state["arrival_seq"] or m["seq"])
                state["last_seen_us"] = at
                touched = True
            elif state:
                state["crowding_level"] = m["crowding_level"]
                touched = True
        if state and touched:
            self._keep(state)
            yield self._row(key, state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            state = dict(zip(_FIELDS, self.state.get()))
            self.state.clear()
            yield self._row(key, state, True)

    def close(self) -> None:
        pass


def client_messages(positions: DataFrame, estimates: DataFrame, seen: str = "received_at") -> DataFrame:
    """Both kinds of message in one relation (``MESSAGE`` without part and offset): positions at their
    receipt, crowding levels when their window has closed."""
    written = F.timestamp_millis(F.col("window_end") + X.GRACE_SECONDS * 1000)
    sparse = positions.select("vehicle_id", F.col(seen).alias("at"), F.col("arrival_seq").alias("seq"),
                              F.lit(True).alias("is_position"), *POSITION_FIELDS, F.lit(None).cast("string").alias("crowding_level"))
    levels = estimates.select(
        "vehicle_id", written.alias("at"), F.coalesce("direction_id", F.lit(-1)).cast("long").alias("seq"), F.lit(False).alias("is_position"),
        F.col("route_id"), *[F.lit(None).cast(positions.schema[f].dataType).alias(f) for f in POSITION_FIELDS if f != "route_id"],
        "crowding_level")
    both = sparse.unionByName(levels)
    return both.where(F.col("vehicle_id").isNotNull() & (F.col("vehicle_id") != ""))


def starting_offsets(topic: str, offsets: dict[int, int]) -> str:
    """S-7: a snapshot's offsets as the start option of a topic source: each partition goes on behind what
    the snapshot holds (``offsets``: the last one of each partition)."""
    return json.dumps({topic: {str(p): o + 1 for p, o in sorted(offsets.items())}})


def after_snapshot(messages: DataFrame, offsets: DataFrame) -> DataFrame:
    """S-7: the messages that a snapshot does not hold; ``offsets`` has the last one it holds of each part.

    A replay may begin anywhere before: what the snapshot has already is skipped, so none counts twice.
    """
    held = offsets.select(F.col("part").alias("_part"), F.col("offset").alias("_held"))
    return (messages.join(held, F.col("part") == F.col("_part"), "left")
            .where(F.col("_held").isNull() | (F.col("offset") > F.col("_held"))).drop("_part", "_held"))


def client_stream(messages: DataFrame, snapshot: DataFrame | None = None, stale_s: int = X.CLIENT_STALE_S,
                  delay: str = "10 seconds") -> DataFrame:
    """ST-13: a client's vehicles as messages arrive; rows come out in update mode, ``gone`` when one is forgotten.

    ``snapshot`` (``live.client_snapshot``) is the state to begin with, as a client gets it on
    connecting; ``messages`` are then those behind it (``after_snapshot``). Micro-batches may
    overlap in time by ``delay``; a message older than that is dropped.
    """
    rows = messages.withColumn("at_us", F.unix_micros("at")).withWatermark("at", delay)
    # at one instant positions come first, then levels by (route, direction), of which the last counts
    rows = ordered(rows.withColumn("level_of", F.when(~F.col("is_position"), F.col("route_id"))),
                   "vehicle_id", "at_us", "level_of", "seq")
    schema = f"vehicle_id string, {CLIENT_STATE}, gone boolean"
    seeds = None if snapshot is None else snapshot.select("vehicle_id", *_FIELDS).groupBy("vehicle_id")
    return rows.groupBy("vehicle_id").transformWithState(_Client(stale_s), schema, "Update", "EventTime", initialState=seeds)
