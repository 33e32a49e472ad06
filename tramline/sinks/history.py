"""K-7: history of scores, by local service date and micro-batch; safe against replay.

Every batch is an entry per service date. Appending a batch again replaces its own
entries in one commit, whatever rows the replay has, and other batches stay. Compacting
a date rewrites its batches as one entry that remembers which it holds, so that a
replay of one of them changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from .manifest import Manifest

DATE = "service_date"


class History:
    def __init__(self, spark: SparkSession, root: str, time_col_ms: str = "window_start", tz: str = X.LOCAL_TZ):
        self.manifest, self.time_col_ms, self.tz = Manifest(spark, root), time_col_ms, tz

    def append(self, scores: DataFrame, batch_id: int) -> int:
        """Add a batch; one that is there already is replaced, one that was compacted stays as it is."""
        m = self.manifest
        dated = scores.withColumn(DATE, F.to_date(F.from_utc_timestamp(F.timestamp_millis(self.time_col_ms), self.tz)))
        folder = m.new_folder()
        dated.withColumn("_date", F.col(DATE).cast("string")).repartition("_date").write.partitionBy("_date").parquet(f"{m.root}/{folder}")
        dates = [n.split("=")[1] for n in m._names(folder) if n.startswith("_date=")]

        def change(content: dict) -> dict | None:
            compacted = content.get("compacted", {})
            done = {d for d, ids in compacted.items() if batch_id in ids}
            entries = {k: f for k, f in content["entries"].items() if k.split("/")[1] != str(batch_id) or k.split("/")[0] in done}
            entries |= {f"{d}/{batch_id}": f"{folder}/_date={d}" for d in dates if d not in done}
            if entries == content["entries"]:
                return None
            return {"entries": entries, "schema": dated.schema.jsonValue(), "compacted": compacted}

        return m.update(change)

    def read(self) -> DataFrame | None:
        return self.manifest.frame(self.manifest.read()[1])

    def day(self, date: str) -> DataFrame | None:
        """Rows of one service date: only its folders are read."""
        _, content = self.manifest.read()
        return self.manifest.frame(content, [k for k in content["entries"] if k.split("/")[0] == date])

    def compact(self, date: str, files: int = 1) -> int:
        """The batches of a date as one entry of ``files`` files."""
        m = self.manifest
        _, content = m.read()
        old = {k: f for k, f in content["entries"].items() if k.split("/")[0] == date}
        if len(old) < 2:
            return m.read()[0]
        folder = m.new_folder()
        m.frame(content, list(old)).repartition(files, self.time_col_ms).write.parquet(f"{m.root}/{folder}")
        held = {int(k.split("/")[1]) for k in old if k.split("/")[1] != "all"}

        def change(now: dict) -> dict | None:
            if {k: now["entries"].get(k) for k in old} != old:
                return None  # a batch was replayed meanwhile: left for the next time
            entries = {k: f for k, f in now["entries"].items() if k not in old} | {f"{date}/all": folder}
            compacted = dict(now.get("compacted", {}))
            compacted[date] = sorted(held | set(compacted.get(date, [])))
            return {**now, "entries": entries, "compacted": compacted}

        return m.update(change)
