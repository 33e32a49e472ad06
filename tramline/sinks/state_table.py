"""K-6: the live state as a table of hash buckets, one row per key.

A micro-batch is first reduced to the last message of each key, then merged into the
buckets its keys fall in; the other buckets' files stay as they are, so what is
written grows with the batch and not with the table. Merging the same messages
again, or older ones, changes nothing, and two writers that touch a bucket at once
are merged one after the other (``manifest``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.live import flush_latest, keyed_messages, latest_by_key
from .manifest import Conflict, Manifest

BUCKET = "_bucket"


class StateTable:
    """``buckets``: so many that a bucket of the whole table is a file or a few (some 128 MB)."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: str = "arrival_seq", buckets: int = 64,
                 written_at: str = "event_time"):
        self.manifest = Manifest(spark, root)
        self.key, self.order, self.buckets, self.written_at = key, order, buckets, written_at

    def _latest(self, rows: DataFrame, ttl_s: int | None = None, as_of_s: int | None = None) -> DataFrame:
        return latest_by_key(rows, [self.key], [self.order], ttl_s, as_of_s, self.written_at)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def upsert(self, updates: DataFrame, ttl_s: int | None = None, as_of_s: int | None = None, attempts: int = 50) -> int:
        """Merge messages; of the touched buckets expired rows go (if a TTL is given). Returns the version."""
        m = self.manifest
        schema = updates.schema
        known = m.read()[1].get("schema")
        if known and T.StructType.fromJson(known).simpleString() != schema.simpleString():
            raise ValueError(f"the table has the columns {T.StructType.fromJson(known).simpleString()}, these are {schema.simpleString()}")
        # the reduced batch, by bucket: what every attempt merges
        staged = m.new_folder()
        (self._bucketed(self._latest(keyed_messages(updates, self.key))).select(*updates.columns, BUCKET)
         .repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{m.root}/{staged}"))
        touched = sorted(n.split("=")[1] for n in m._names(staged) if n.startswith(f"{BUCKET}="))
        new = m.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{m.root}/{staged}")
        for _ in range(attempts):
            base, content = m.read()
            if content.get("buckets", self.buckets) != self.buckets:
                raise ValueError(f"the table has {content['buckets']} buckets")
            old = m.frame(content, touched)
            merged = new if old is None else old.unionByName(new)
            folder = m.new_folder()
            (self._bucketed(self._latest(merged, ttl_s, as_of_s).select(*updates.columns)).repartition(BUCKET)
             .write.partitionBy(BUCKET).parquet(f"{m.root}/{folder}"))
            written = {n.split("=")[1] for n in m._names(folder) if n.startswith(f"{BUCKET}=")}
            entries = {b: f for b, f in content["entries"].items() if b not in touched}
            entries |= {b: f"{folder}/{BUCKET}={b}" for b in written}
            seen = {b: content["entries"].get(b) for b in touched}
            while True:
                try:
                    return m.commit(base, {"entries": entries, "schema": schema.jsonValue(), "buckets": self.buckets})
                except Conflict:
                    base, now = m.read()
                    if {b: now["entries"].get(b) for b in touched} != seen:
                        break  # one of these buckets has changed: merge with what is there now
                    # other buckets only: their new folders are taken over
                    entries = {b: f for b, f in now["entries"].items() if b not in touched} | {b: f"{folder}/{BUCKET}={b}" for b in written}
        raise Conflict(f"{m.root}: {attempts} other writers came first")

    def read(self, ttl_s: int | None = None, as_of_s: int | None = None) -> DataFrame | None:
        """The current rows, without those expired at ``as_of_s``; pin the manifest for more than one read."""
        rows = self.manifest.frame(self.manifest.read()[1])
        if rows is None or ttl_s is None:
            return rows
        return rows.where(F.unix_micros(self.written_at) + ttl_s * 1_000_000 > F.lit(as_of_s * 1_000_000))


def batch_writer(table: StateTable, ttl_s: int | None = None, clean_every: int = 100):
    """foreachBatch function: the last update of each key of a flush goes to the state table (ST-12, K-6)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(flush_latest(keyed_messages(batch, table.key), table.key, table.order).select(*batch.columns), ttl_s,
                     int(time.time()) if ttl_s else None)
        if batch_id % clean_every == clean_every - 1:
            table.manifest.clean()
    return write
