"""Structured Streaming forms of the market and post layers.

* ``bars_stream``: event-time watermark + tumbling OHLCV bars, append mode
  (a bar is emitted once the watermark passes its end).
* ``append_lagged``: previous close per ticker across micro-batches: each
  batch is a window over its new bars and the last stored bar of each ticker.
* ``score_posts_stream``: post silver by id: a post is stored the first time
  it arrives, however old it is; nothing is dropped for lateness.
* ``insert_new_stream``: ``foreachBatch`` sink that appends only unseen keys,
  so a replayed micro-batch (after a failure) inserts nothing twice.
* ``route_stream``: topic messages to one table per topic, and rejects.

Every job writes its checkpoint and output under the shared checkpoint
directory and can be run with ``availableNow`` (bounded catch-up) or a
processing-time trigger (continuous).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketpulse.functions.windowing import exact, price_scale, safe_div
from marketpulse.operators import bars as B
from marketpulse.operators import indicators as I
from marketpulse.operators import social as P
from marketpulse.operators.ingest import parse_messages, rejects, route
from marketpulse.session import scratch_path
from marketpulse.sources.files import Files
from marketpulse.sources.sinks import insert_new, table_exists

DEFAULT_DELAY = "15 minutes"


# --- feeding a stream from a table ---------------------------------------------

def time_slice(df: DataFrame, order_col: str, n: int):
    """Column: which of ``n`` consecutive time ranges a row lies in (the cuts are
    approximate quantiles: one small aggregate); 0 for rows without a time."""
    micros = F.unix_micros(F.col(order_col).cast("timestamp"))
    probs = [i / n for i in range(1, n)]
    cuts = (df.select(F.percentile_approx(micros, probs, 10000).alias("q")).first()["q"] or []) if probs else []
    out = F.lit(0)
    for cut in cuts:
        out = out + F.coalesce((micros > F.lit(cut)).cast("int"), F.lit(0))
    return out


def feed_in_order(df: DataFrame, path: str, slice_of, n_slices: int, run_once) -> None:
    """Simulate data arriving over time: append one slice (column ``slice_of``,
    0 to n - 1) to ``path``, then ``run_once()`` (a query restarted from the same
    checkpoint with ``availableNow``), and repeat. The table is read once and
    staged by slice, in as many files as it has partitions."""
    spark = df.sparkSession
    staged = scratch_path(spark, "slices")
    df.withColumn("_slice", slice_of).write.partitionBy("_slice").parquet(staged)
    for i in range(n_slices):
        spark.read.parquet(staged).filter(F.col("_slice") == i).select(*df.columns).write.mode(
            "append").parquet(path)
        run_once()


def run(query_builder, trigger_available_now: bool = True, processing_time: str | None = None):
    """Start a writeStream builder and, for availableNow, wait for it to finish."""
    if trigger_available_now:
        q = query_builder.trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        return q
    return query_builder.trigger(processingTime=processing_time or "1 minute").start()


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                fmt: str = "parquet", **options) -> DataFrame:
    """File stream of any format; ``max_files_per_trigger`` bounds a batch."""
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


# --- market ------------------------------------------------------------------------

def bars_stream(ticks: DataFrame, every: str = "1 hour", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Closed OHLCV bars of a tick stream (``datetime`` must be a timestamp)."""
    return B.ohlcv_bars(ticks.withWatermark("datetime", delay), every)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its query; a new checkpoint has another.
    Batch numbers start at 0 again with a new checkpoint, the pair never repeats."""
    return json.loads(Files(spark).read(f"{checkpoint}/metadata"))["id"]


def with_previous_close(bars: DataFrame, last: DataFrame | None, key: str = "ticker",
                        ts: str = "datetime", close: str = "close") -> DataFrame:
    """``bars`` with PrctChange and Direction against the bar before, the first
    of a series against its row in ``last`` (key, ts, close). Bars that are not
    later than the last one are repeats of what was processed and left out."""
    scale = price_scale(bars, close)
    if last is not None:
        seen = last.select(F.col(key).alias("_key"), F.col(ts).alias("_seen"),
                           F.col(close).alias("_close"))
        bars = bars.join(seen, F.col(key).eqNullSafe(F.col("_key")), "left").filter(
            F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).drop("_key", "_seen")
    else:
        bars = bars.withColumn("_close", F.lit(None).cast(bars.schema[close].dataType))
    w = Window.partitionBy(key).orderBy(ts)
    c = exact(close, scale)
    # the stored close stands before the first new bar only
    prev = F.when(F.row_number().over(w) == 1, exact("_close", scale)).otherwise(F.lag(c).over(w))
    pct = safe_div((c - prev).cast("double"), prev.cast("double")) * F.lit(100.0)
    return bars.withColumn("PrctChange", pct).drop("_close").withColumn(
        "Direction", I.direction_col(F.col("PrctChange")))


def append_lagged(spark: SparkSession, bars: DataFrame, out: str, state: str, checkpoint: str, **trigger):
    """Stream of closed bars -> ``out/batch_id=<query>-<n>`` with PrctChange and
    Direction; ``state`` holds the last bar of each ticker and a pointer to it,
    which is moved when a batch is whole. A batch that the pointer names is done
    and not written again; one that was cut off is written over, from the state
    before it. A new checkpoint sends all bars again under a new query's name:
    those not later than the stored last bar are left out, the others are kept.
    No directory is listed."""
    files, pointer = Files(spark), f"{state}/last.json"

    def write_batch(batch: DataFrame, n: int) -> None:
        token = f"{query_id(spark, checkpoint)}-{n}"
        at = json.loads(files.read_safe(pointer) or "{}")
        if at.get("token") == token:
            return
        last = spark.read.parquet(f"{state}/batch={at['token']}") if at else None
        slim = batch.select("ticker", "datetime", "close")
        both = slim if last is None else last.unionByName(slim)
        now = both.groupBy("ticker").agg(F.max("datetime").alias("datetime"),
                                         F.max_by("close", "datetime").alias("close"))
        now.write.mode("overwrite").parquet(f"{state}/batch={token}")
        with_previous_close(batch, last).write.mode("overwrite").parquet(f"{out}/batch_id={token}")
        files.write(pointer, json.dumps({"token": token}))
        if at:
            files.delete(f"{state}/batch={at['token']}")

    return run(bars.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), **trigger)


# --- posts ---------------------------------------------------------------------------

INGEST_METRICS = "ingest"


def posts_stream(posts: DataFrame) -> DataFrame:
    """A bronze post stream with the figures ``ingest`` observed in every
    micro-batch: consumed rows, and rows whose time does not parse."""
    p = P.parse_created(posts, out="_parsed")
    p = p.observe(INGEST_METRICS, F.count(F.lit(1)).alias("consumed"),
                  F.count_if(F.col("_parsed").isNull()).alias("errors"))
    return p.drop("_parsed")


def score_posts_stream(spark: SparkSession, posts: DataFrame, target: str, checkpoint: str,
                       counts: str | None = None, **trigger):
    """Bronze posts -> silver table of unique ids. A post counts as new when its
    id is not stored, whatever its time, as posts of quiet communities arrive
    days after they were written; repeats add nothing. New posts are scored."""
    return insert_new_stream(spark, posts_stream(posts), target, checkpoint, ["id"], None,
                             counts=counts, transform=P.score_posts, **trigger)


# --- sinks ----------------------------------------------------------------------------

def append_stream(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                  options: dict | None = None, **trigger):
    w = (df.writeStream.format(fmt).outputMode("append").options(**(options or {}))
         .option("checkpointLocation", checkpoint))
    return run(w.option("path", out_path) if out_path else w, **trigger)


def _write_counts(spark: SparkSession, counts: str, batch_id: int, rows: list[tuple]) -> None:
    """A batch's figures, in a directory of its own (a replay replaces them)."""
    spark.createDataFrame(rows, "topic string, consumed long, inserted long, errors long").coalesce(1).write.mode(
        "overwrite").parquet(f"{counts}/batch_id={batch_id}")


def insert_new_stream(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str,
                      key: Sequence[str], arrival: Sequence[str] | None, range_col: str | None = None,
                      partition_by: Sequence[str] | None = None, counts: str | None = None,
                      topic: str | None = None, transform: Callable | None = None, **trigger):
    """Each micro-batch appends only keys not yet in ``target`` (first arrival
    within the batch wins). Replaying a batch inserts nothing. ``counts`` is a
    table of (topic, consumed, inserted, errors) per batch; rows without a key
    are its errors."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            n = insert_new(spark, batch, target, key, arrival, range_col, "parquet", partition_by, transform)
        finally:
            batch.unpersist()
        if counts:
            _write_counts(spark, counts, batch_id, [(topic, n["consumed"], n["inserted"], n["keyless"])])

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return run(w, **trigger)


def ingest_topics(spark: SparkSession, messages: DataFrame, schemas: dict, keys: dict, targets: dict,
                  rejected: str, counts: str, checkpoint: str, **trigger):
    """Topic messages -> one table of unique keys per topic (``keys[topic]``),
    the messages that no route takes to ``rejected``, and (topic, consumed,
    inserted, errors) of each batch to ``counts``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            figures = []
            for topic, schema in schemas.items():
                parsed = parse_messages(batch.filter(F.col("topic") == topic), schema)
                bad = parsed.filter("_bad").count()
                good = parsed.filter("not _bad").select("_m.*").select(*schema.fieldNames())
                n = insert_new(spark, good, targets[topic], keys[topic])
                figures.append((topic, n["consumed"] + bad, n["inserted"], bad + n["keyless"]))
            rejects(batch, schemas).write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
            _write_counts(spark, counts, batch_id, figures)
        finally:
            batch.unpersist()

    w = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return run(w, **trigger)


def route_stream(spark: SparkSession, messages: DataFrame, schemas: dict, targets: dict,
                 checkpoint: str, rejected: str | None = None, **trigger):
    """Topic stream -> one table per topic. Each micro-batch is persisted once
    and split by topic inside ``foreachBatch`` (one read of the source per
    batch, however many targets); messages that do not parse or have no table
    go to ``rejected``, if given.

    Every batch overwrites its own ``batch_id=<n>`` directory, so a batch
    replayed after a failure replaces its earlier output instead of adding
    to it."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for topic, parsed in route(batch, schemas).items():
                good = parsed.filter(~F.col("_bad")).drop("_bad")
                good.write.mode("overwrite").parquet(f"{targets[topic]}/batch_id={batch_id}")
            if rejected:
                rejects(batch, schemas).write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return run(w, **trigger)


def read_output(spark: SparkSession, path: str, schema) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
