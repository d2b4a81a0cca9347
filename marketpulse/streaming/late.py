"""Bars that late ticks correct.

A windowed aggregation with a watermark drops rows that come after their
bucket was closed. Here a micro-batch job keeps bars as mergeable aggregates
(first and last price with the order key they were chosen by, high, low,
volume):

* ticks of open buckets are merged into the state, the table of open bars;
* buckets that the watermark (largest time so far less ``delay``) has passed
  leave the state for the table of closed bars, partitioned by day;
* ticks of closed buckets are late: they are stored as they are, counted, and
  merged into exactly the bars they belong to. Only the days they touch are
  written anew;
* ticks without a time belong to no bucket: they are stored and counted.

Everything a batch makes goes into folders of its own, and a small manifest
(watermark, state, the current folder of each day, figures) is replaced at the
end: that is the commit. A batch that fails leaves the manifest as it was; the
same batch after its commit is skipped. So no tick is counted twice, after a
replay or with any number of late ticks, and the closed bars equal the batch
bars of all ticks so far.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.picking import order_key
from marketpulse.sources.files import Files
from marketpulse.streaming.jobs import query_id, run

_EMPTY = {"token": None, "watermark": None, "state": None, "days": {}, "late": 0, "untimed": 0, "corrected": 0}


class BarStore:
    """Closed bars, open bars and late ticks under one folder."""

    def __init__(self, spark: SparkSession, path: str, every: str = "1 hour", delay_minutes: int = 15,
                 key: str = "ticker", ts: str = "datetime", tie_cols: Sequence[str] = ("tie_key",)):
        self.spark, self.path, self.files = spark, path, Files(spark)
        self.every, self.delay, self.key, self.ts, self.ties = every, delay_minutes * 60_000_000, key, ts, list(tie_cols)

    def manifest(self) -> dict:
        return json.loads(self.files.read_safe(f"{self.path}/manifest.json") or json.dumps(_EMPTY))

    # --- aggregates ------------------------------------------------------------

    def _parts(self, ticks: DataFrame) -> DataFrame:
        """One mergeable row per key and bucket."""
        some = ticks.withColumns({"_first": order_key(ticks, [self.ts, *self.ties], False),
                                  "_last": order_key(ticks, [self.ts, *self.ties], True)})
        agg = some.groupBy(F.col(self.key), F.window(self.ts, self.every).alias("_w")).agg(
            F.min_by("price", "_first").alias("open"), F.min("_first").alias("_first"), F.max("price").alias("high"),
            F.min("price").alias("low"), F.max_by("price", "_last").alias("close"), F.max("_last").alias("_last"),
            F.sum("volume").alias("volume"))
        return agg.select(self.key, F.col("_w.end").cast("timestamp").alias(self.ts), "open", "high", "low", "close",
                          "volume", "_first", "_last")

    def _merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(self.key, self.ts).agg(
            F.min_by("open", "_first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "_last").alias("close"), F.sum("volume").alias("volume"), F.min("_first").alias("_first"),
            F.max("_last").alias("_last"))

    # --- a micro-batch --------------------------------------------------------------

    def _days(self, m: dict, days: list[str]) -> DataFrame | None:
        """Closed bars of those days."""
        found = [f"{self.path}/bars/{m['days'][d]}/day={d}" for d in days if d in m["days"]]
        return self.spark.read.parquet(*found) if found else None

    def update(self, batch: DataFrame, token: str) -> dict:
        """One batch of ticks; returns the manifest after it."""
        m = self.manifest()
        if m["token"] == token:
            return m
        batch = batch.persist()
        try:
            micros = F.unix_micros(F.col(self.ts).cast("timestamp"))
            seen = batch.agg(F.max(micros).alias("most"), F.count_if(F.col(self.ts).isNull()).alias("untimed")).first()
            before = m["watermark"]
            after = max((x for x in (before, seen["most"] - self.delay if seen["most"] is not None else None)
                         if x is not None), default=None)
            end = F.unix_micros(F.window(self.ts, self.every)["end"].cast("timestamp"))
            timed = batch.filter(F.col(self.ts).isNotNull())
            timed = timed.withColumn("_late", end <= F.lit(before) if before is not None else F.lit(False))
            late = timed.filter("_late").drop("_late")
            n_late = late.count()
            if n_late:
                late.write.mode("overwrite").parquet(f"{self.path}/late/batch={token}")
            if seen["untimed"]:
                batch.filter(F.col(self.ts).isNull()).write.mode("overwrite").parquet(f"{self.path}/untimed/batch={token}")
            now = self._parts(timed.filter("not _late").drop("_late"))
            if m["state"]:
                now = self._merged(self.spark.read.parquet(f"{self.path}/open/batch={m['state']}").unionByName(now))
            now = now.persist()
            try:
                past = F.unix_micros(self.ts) <= F.lit(after) if after is not None else F.lit(False)
                now.filter(~past).write.mode("overwrite").parquet(f"{self.path}/open/batch={token}")
                closed = now.filter(past)
                corrections = self._parts(late) if n_late else None
                new = closed if corrections is None else closed.unionByName(corrections)
                new = new.withColumn("day", F.to_date(self.ts).cast("string"))
                days = [r["day"] for r in new.select("day").distinct().collect()]   # the days a batch touches
                if days:
                    stored = self._days(m, days)
                    every = new.drop("day") if stored is None else stored.unionByName(new.drop("day"))
                    (self._merged(every).withColumn("day", F.to_date(self.ts).cast("string"))
                     .repartition("day").write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/bars/batch={token}"))
                corrected = corrections.count() if corrections is not None else 0
            finally:
                now.unpersist()
            done = {"token": token, "watermark": after, "state": token,
                    "days": m["days"] | {d: f"batch={token}" for d in days}, "late": m["late"] + n_late,
                    "untimed": m["untimed"] + seen["untimed"], "corrected": m["corrected"] + corrected}
            self.files.write(f"{self.path}/manifest.json", json.dumps(done))
            self._tidy(m, done)
            return done
        finally:
            batch.unpersist()

    def _tidy(self, before: dict, after: dict) -> None:
        """Deletes what the manifest no longer names."""
        if before["state"]:
            self.files.delete(f"{self.path}/open/batch={before['state']}")
        for day, folder in before["days"].items():
            if after["days"][day] != folder:
                self.files.delete(f"{self.path}/bars/{folder}/day={day}")

    # --- reading ---------------------------------------------------------------------

    def closed(self) -> DataFrame | None:
        """All closed bars; None before the first."""
        m = self.manifest()
        found = self._days(m, sorted(m["days"]))
        return None if found is None else found.drop("_first", "_last")

    def late(self, schema) -> DataFrame:
        """The late ticks, as they came."""
        if not self.files.exists(f"{self.path}/late"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/late")


def bars_with_late_ticks(spark: SparkSession, ticks: DataFrame, store: BarStore, checkpoint: str, **trigger):
    """A stream of ticks (``datetime`` a timestamp) into ``store``."""
    def write_batch(batch: DataFrame, n: int) -> None:
        store.update(batch, f"{query_id(spark, checkpoint)}-{n}")

    return run(ticks.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), **trigger)
