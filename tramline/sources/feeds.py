"""Live feed sources: landed feed entities, topic files, JSON payloads.

The live feeds arrive as snapshots of entities (protobuf in the wild). Here
they are *landed* rows with the nested shape of ``schemas.VEHICLE_ENTITY`` /
``schemas.ALERT_ENTITY`` (JSON or Parquet files, batch or stream), and
normalization is a column projection. Kafka and Avro connectors are not on
this machine: ``read_positions`` / ``read_alerts`` read the same records
from files and are the one place a Kafka source would plug in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import exprs as X


# ---------------------------------------------------------------------------
# S-1 / S-2: normalization of landed entities
# ---------------------------------------------------------------------------
def normalize_vehicle_feed(entities: DataFrame) -> DataFrame:
    """Feed entities -> vehicle_position rows (S-1).

    Entities without a vehicle are skipped; an absent id or route becomes '',
    an absent position 0.0/0.0, an absent timestamp 0; optional fields keep
    their presence (null is not 0). Record metadata columns pass through.
    """
    v = F.col("vehicle")
    pos = v.getField("position")
    trip = v.getField("trip")
    meta = [c for c in ("event_time", "arrival_seq") if c in entities.columns]
    return entities.where(v.isNotNull()).select(
        F.coalesce(v.getField("vehicle").getField("id"), F.lit("")).alias("vehicle_id"),
        F.coalesce(trip.getField("route_id"), F.lit("")).alias("route_id"),
        F.coalesce(pos.getField("latitude").cast("double"), F.lit(0.0)).alias("latitude"),
        F.coalesce(pos.getField("longitude").cast("double"), F.lit(0.0)).alias("longitude"),
        pos.getField("bearing").alias("bearing"),
        pos.getField("speed").alias("speed"),
        F.coalesce(v.getField("timestamp"), F.lit(0)).cast("long").alias("feed_ts"),
        v.getField("occupancy_status").alias("occupancy"),
        trip.getField("trip_id").alias("trip_id"),
        trip.getField("direction_id").alias("direction_id"),
        v.getField("current_stop_sequence").alias("current_stop_sequence"),
        *meta)


def normalize_alert_feed(entities: DataFrame, now_s=None) -> DataFrame:
    """Feed entities -> service_alert rows (S-2).

    First non-empty translation; distinct non-empty route/stop ids in
    first-seen order; blank description -> null; an absent effect is the
    protocol default ``UNKNOWN_EFFECT``; a zero feed timestamp falls back to
    ``now_s`` (default: the query's current time); ``active_since`` is the
    first period's start when positive, else the feed time.
    """
    a = F.col("alert")
    now = F.unix_seconds(F.current_timestamp()) if now_s is None else F.lit(now_s)
    feed_ts = F.when(F.coalesce(F.col("header_timestamp"), F.lit(0)) == 0, now).otherwise(
        F.col("header_timestamp"))
    informed = a.getField("informed_entity")
    meta = [c for c in ("event_time", "arrival_seq") if c in entities.columns]
    return entities.where(a.isNotNull()).select(
        F.col("id").alias("alert_id"),
        F.lit(True).alias("has_body"),
        F.coalesce(a.getField("effect"), F.lit("UNKNOWN_EFFECT")).alias("effect"),
        a.getField("cause").alias("cause"),
        X.first_translation(a.getField("header_text")).alias("header_text"),
        F.nullif(X.first_translation(a.getField("description_text")), F.lit("")).alias(
            "description_text"),
        X.distinct_non_empty(F.transform(informed, lambda e: e.getField("route_id"))).alias(
            "affected_route_ids"),
        X.distinct_non_empty(F.transform(informed, lambda e: e.getField("stop_id"))).alias(
            "affected_stop_ids"),
        X.active_since(a.getField("active_period"), feed_ts).alias("active_since"),
        feed_ts.alias("feed_ts"),
        *meta)


def alert_from_list_text(alert_id: str, effect: str, header: str, routes_text: str,
                         stops_text: str):
    """X-25: a hand-entered alert with comma lists (as the demo injector takes)."""
    return F.struct(F.lit(alert_id).alias("alert_id"), F.lit(effect).alias("effect"),
                    F.lit(header).alias("header_text"),
                    X.split_list(F.lit(routes_text)).alias("affected_route_ids"),
                    X.split_list(F.lit(stops_text)).alias("affected_stop_ids"))


# ---------------------------------------------------------------------------
# Landed entities derived from the test tables (for the round-trip queries)
# ---------------------------------------------------------------------------
def vehicle_entities_from_positions(positions: DataFrame) -> DataFrame:
    """Re-nest normalized positions into feed entities, dropping what the
    feed would omit ('' ids, (0,0) positions); plus entity rows without a
    vehicle, which normalization must skip."""
    c = F.col
    has_pos = ~((c("latitude") == 0) & (c("longitude") == 0))
    vehicle = F.struct(
        F.when(c("vehicle_id") != "", F.struct(c("vehicle_id").alias("id"))).alias("vehicle"),
        F.struct(F.nullif(c("route_id"), F.lit("")).alias("route_id"), c("trip_id").alias("trip_id"),
                 c("direction_id").alias("direction_id")).alias("trip"),
        F.when(has_pos, F.struct(c("latitude").cast("float").alias("latitude"),
                                 c("longitude").cast("float").alias("longitude"),
                                 c("bearing").alias("bearing"),
                                 c("speed").alias("speed"))).alias("position"),
        c("feed_ts").alias("timestamp"),
        c("occupancy").alias("occupancy_status"),
        c("current_stop_sequence").alias("current_stop_sequence"))
    with_vehicle = positions.select(
        F.concat(F.lit("e"), c("arrival_seq").cast("string")).alias("id"),
        vehicle.alias("vehicle"), "event_time", "arrival_seq")
    without = positions.where(c("arrival_seq") % 50 == 7).select(
        F.concat(F.lit("x"), c("arrival_seq").cast("string")).alias("id"),
        F.lit(None).cast(schemas.VEHICLE_ENTITY["vehicle"].dataType).alias("vehicle"),
        "event_time", "arrival_seq")
    return with_vehicle.unionByName(without)


def alert_entities_from_alerts(alerts: DataFrame) -> DataFrame:
    """Re-nest alert versions into feed entities with the feed's untidiness:
    an empty first translation on every other version, a blank informed
    entity, repeated stop ids, a zero period start; tombstones have no alert."""
    c = F.col
    even = c("arrival_seq") % 2 == 0
    header = F.struct(F.when(even, F.array(F.struct(F.lit("").alias("text")),
                                           F.struct(c("header_text").alias("text"))))
                      .otherwise(F.array(F.struct(c("header_text").alias("text"))))
                      .alias("translation"))
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField("text", T.StringType())])))
    desc = F.struct(F.when(c("description_text").isNull(), none)
                    .otherwise(F.array(F.struct(c("description_text").alias("text")))).alias("translation"))
    informed = F.concat(
        F.transform("affected_route_ids", lambda r: F.struct(r.alias("route_id"),
                                                             F.lit(None).cast("string").alias("stop_id"))),
        F.array(F.struct(F.lit("").alias("route_id"), F.lit("").alias("stop_id"))),
        F.transform("affected_stop_ids", lambda s: F.struct(F.lit(None).cast("string").alias("route_id"),
                                                            s.alias("stop_id"))))
    periods = F.array(F.struct(F.when(even, F.lit(0).cast("long")).otherwise(c("active_since"))
                               .alias("start")))
    alert = F.struct(c("effect").alias("effect"), c("cause").alias("cause"),
                     header.alias("header_text"), desc.alias("description_text"),
                     informed.alias("informed_entity"), periods.alias("active_period"))
    return alerts.select(
        c("alert_id").alias("id"),
        F.when(c("has_body"), alert).alias("alert"),
        c("feed_ts").alias("header_timestamp"), "event_time", "arrival_seq")


# ---------------------------------------------------------------------------
# S-3 / S-6: topic files, batch or stream
# ---------------------------------------------------------------------------
def _reader(spark: SparkSession, streaming: bool, max_files: int | None = None):
    if not streaming:
        return spark.read
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r


def read_positions(spark: SparkSession, path: str, streaming: bool = False,
                   fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Vehicle positions landed as files with the registered schema."""
    return _reader(spark, streaming, max_files).schema(schemas.VEHICLE_POSITION).format(fmt).load(path)


def read_alerts(spark: SparkSession, path: str, streaming: bool = False,
                fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Service alert versions landed as files with the registered schema."""
    return _reader(spark, streaming, max_files).schema(schemas.SERVICE_ALERT).format(fmt).load(path)


#: Bytes in front of a registry-encoded record: the magic byte 0 and a schema id of four bytes.
ENVELOPE_BYTES = 5


def open_envelope(raw: DataFrame, schema_ids: list[int], partitions: int, partition: str = "partition") -> tuple[DataFrame, DataFrame]:
    """S-3: binary topic records -> (good, rejects).

    ``raw`` has key, value (binary), partition, offset and timestamp, as a topic source gives them. Good rows get
    ``schema_id``, ``body`` (without the envelope; null for a tombstone, which has a key and no value), ``event_time``
    and ``arrival_seq``: offsets only count within a partition, so the order over all of them is
    ``offset * partitions + partition``, unique and growing in each partition (a key stays in one). A record
    without the magic byte, too short for the envelope, or of a schema that is not in ``schema_ids`` goes to ``rejects``
    with a reason.
    """
    value = F.col("value")
    schema_id = F.conv(F.hex(F.expr("substring(value, 2, 4)")), 16, 10).cast("long")
    reason = (F.when(value.isNull(), F.when(F.col("key").isNull(), F.lit("empty")))
              .when(F.length(value) < ENVELOPE_BYTES, F.lit("too short"))
              .when(F.hex(F.expr("substring(value, 1, 1)")) != "00", F.lit("no magic byte"))
              .when(~schema_id.isin(*schema_ids), F.lit("unknown schema")))
    marked = raw.withColumn("reason", reason)
    good = marked.where("reason is null").select(
        F.col("key").cast("string").alias("key"), schema_id.alias("schema_id"),
        F.expr(f"substring(value, {ENVELOPE_BYTES + 1}, length(value) - {ENVELOPE_BYTES})").alias("body"),
        F.col("timestamp").alias("event_time"),
        (F.col("offset") * partitions + F.col(partition)).alias("arrival_seq"))
    return good, marked.where("reason is not null")


def position_rows(decoded: DataFrame) -> DataFrame:
    """Decoded position records (``r``, event_time, arrival_seq) with the operators' columns."""
    r = F.col("r")
    names = {f.name: f.dataType for f in schemas.VEHICLE_POSITION}
    fields = [r.getField("timestamp" if n == "feed_ts" else n).cast(t).alias(n) for n, t in names.items() if n not in ("event_time", "arrival_seq")]
    return decoded.where(r.isNotNull()).select(*fields, "event_time", "arrival_seq")


def alert_rows(decoded: DataFrame) -> DataFrame:
    """Decoded alert records (key, ``r``, event_time, arrival_seq) with the operators' columns; a record without a body is a tombstone."""
    r = F.col("r")
    names = {f.name: f.dataType for f in schemas.SERVICE_ALERT}
    own = ("alert_id", "has_body", "event_time", "arrival_seq")
    fields = {n: r.getField("timestamp" if n == "feed_ts" else n).cast(t) for n, t in names.items() if n not in own}
    fields |= {"alert_id": F.coalesce(r.getField("alert_id"), F.col("key")), "has_body": r.isNotNull(),
               "event_time": F.col("event_time"), "arrival_seq": F.col("arrival_seq")}
    return decoded.select(*[fields[n].alias(n) for n in names])


def decode_topic(raw: DataFrame, decode: Callable[[Column], Column], key: str, schema_ids: list[int],
                 partitions: int) -> tuple[DataFrame, DataFrame]:
    """S-3: envelope opened and body decoded -> (key, ``r``, event_time, arrival_seq; rejects).

    ``decode`` turns the body into a struct and a body it cannot read into nulls; such a record, which lacks its
    ``key`` field, goes to the rejects as undecodable. A tombstone stays, without ``r``.
    """
    good, rejects = open_envelope(raw, schema_ids, partitions)
    decoded = good.withColumn("r", F.when(F.col("body").isNotNull(), decode(F.col("body"))))
    broken = F.col("body").isNotNull() & F.col("r").getField(key).isNull()
    lost = decoded.where(broken).select("key", F.col("body").alias("value"), "arrival_seq", F.lit("undecodable").alias("reason"))
    rest = rejects.select(F.col("key").cast("string").alias("key"), "value",
                          (F.col("offset") * partitions + F.col("partition")).alias("arrival_seq"), "reason")
    return decoded.where(~broken).drop("body"), rest.unionByName(lost)


def read_avro_topic(spark: SparkSession, bootstrap: str, topic: str, avro_schema_json: str, key: str, schema_ids: list[int],
                    partitions: int, streaming: bool = True, starting: str = "latest") -> tuple[DataFrame, DataFrame]:
    """S-3 on a cluster with the topic-source and Avro modules: ``decode_topic`` over a registry-encoded topic.

    ``position_rows`` and ``alert_rows`` give the records the operators' columns. ``starting='earliest'`` replays a
    compacted topic to rebuild state, ``stateful.starting_offsets`` goes on behind a snapshot (S-7). The modules
    are not installed here; all but the two calls of theirs is tested on binary rows.
    """
    from pyspark.sql.avro.functions import from_avro

    r = spark.readStream if streaming else spark.read
    raw = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap)
           .option("subscribe", topic).option("startingOffsets", starting).load())
    return decode_topic(raw, lambda body: from_avro(body, avro_schema_json, {"mode": "PERMISSIVE"}), key, schema_ids, partitions)


#: Records of ``testdata.vehicle_topic``.
TOPIC_SCHEMA = T.StructType([T.StructField("vehicle_id", T.StringType()), T.StructField("route_id", T.StringType()),
                             T.StructField("event_id", T.LongType())])
_CORRUPT = "_corrupt_record"


def _parsed(raw: DataFrame, schema: T.StructType, key: str, value_col: str) -> DataFrame:
    """``raw`` with the record and, where it is to be skipped, the reason."""
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json(F.col(value_col), whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rec, k = F.col("_rec"), F.col("_rec").getField(key)
    reason = (F.when(F.col(value_col).isNull(), F.lit("empty"))
              .when(rec.isNull() | rec.getField(_CORRUPT).isNotNull(), F.lit("malformed"))
              .when(k.isNull() | (k == ""), F.lit("no key")))
    return raw.withColumn("_rec", record).withColumn("reason", reason)


def parse_json_topic(raw: DataFrame, schema: T.StructType, key: str,
                     value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON text records -> (good, rejects) (S-5, S-6).

    Text that is no whole JSON record, a missing or empty key, and no value at all go to ``rejects``, as they came and
    with a reason; nothing is dropped silently, and no field of a record that breaks off counts.
    """
    parsed = _parsed(raw, schema, key, value_col)
    good = parsed.where("reason is null").select(*[F.col("_rec").getField(f.name).alias(f.name) for f in schema])
    return good, parsed.where("reason is not null").drop("_rec")


def marked_with_counts(raw: DataFrame, schema: T.StructType, key: str, name: str = "topic",
                       value_col: str = "value") -> DataFrame:
    """S-6 metrics: the same parse, with good and rejected records counted through ``DataFrame.observe`` (readable from
    the query's progress or the observation) instead of a log line per bad record. All rows stay, with ``reason``."""
    return _parsed(raw, schema, key, value_col).observe(
        name, F.count(F.lit(1)).alias("records"), F.count("reason").alias("rejected"))


def with_reject_counts(raw: DataFrame, schema: T.StructType, key: str, name: str = "topic",
                       value_col: str = "value") -> DataFrame:
    """The good records of ``marked_with_counts``; the rejected ones are only counted."""
    return marked_with_counts(raw, schema, key, name, value_col).where("reason is null").select("_rec.*").drop(_CORRUPT)
