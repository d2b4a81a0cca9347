"""Freshness of streams as a stream: state per source, with timers.

A source that falls silent sends no row that could report it. Each source
therefore has a state (its latest event time) and an event-time timer at that
time plus the limit. When the watermark, which the other sources move on,
passes the timer, the source turns STALE without a row of its own. Sources are
registered by a row without a time, so one that never sends anything is
reported as NO DATA. Output is in update mode: a row when a source's status is
set or changes, and for new data.

The watermark is moved by rows of their own (``clock``: the latest time a task
has seen). The sources' rows carry no event time, so none is dropped for being
older than the watermark: a source that sends old rows only is STALE, not
NO DATA.

Rows are reduced to the latest time of each source before the shuffle, task by
task, so a source that sends a third of all rows sends one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketpulse.operators.monitor import FRESH_MINUTES
from marketpulse.streaming.jobs import query_id, run

_TIME = pa.timestamp("us", tz="UTC")
_BEAT = pa.schema([("stream", pa.string()), ("latest", _TIME), ("clock", _TIME)])
_BEAT_SQL = "stream string, latest timestamp, clock timestamp"
STATUS = "stream string, latest timestamp, status string"


def _latest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The latest time of each source of a task (null for one without), and of all."""
    best: dict[str, object] = {}
    for batch in batches:
        t = pa.Table.from_batches([batch]).group_by("stream").aggregate([("latest", "max")])
        for name, latest in zip(t["stream"].to_pylist(), t["latest_max"].to_pylist()):
            old = best.get(name)
            best[name] = latest if old is None else old if latest is None else max(old, latest)
    times = [t for t in best.values() if t is not None]
    names = [*best, *([None] if times else [])]
    latest = [*best.values(), *([None] if times else [])]
    clock = [None] * len(best) + ([max(times)] if times else [])
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pc.cast(pa.array(latest), _TIME),
                                      pc.cast(pa.array(clock), _TIME)], schema=_BEAT)


def beats(rows: DataFrame, stream: str = "stream", ts: str = "datetime") -> DataFrame:
    """(stream, latest, clock): one row per source and task, and one for its clock.
    A source without a name is the one named by the empty text."""
    return rows.select(F.coalesce(F.col(stream).cast("string"), F.lit("")).alias("stream"),
                       F.col(ts).cast("timestamp").alias("latest")).mapInArrow(_latest, _BEAT_SQL)


def _micros(t: pd.Timestamp) -> int:
    return t.value // 1000


def _track(limit_ms: int):
    def track(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] is None:      # the clock
            return
        old = state.get[0] if state.exists else None
        if state.hasTimedOut:
            latest, status = old, "STALE"
        else:
            times = [t for f in frames for t in f["latest"] if not pd.isna(t)]
            latest = max([_micros(t) for t in times] + ([old] if old is not None else []), default=None)
            due = None if latest is None else latest // 1000 + limit_ms
            status = "NO DATA" if due is None else "OK" if due > state.getCurrentWatermarkMs() else "STALE"
            if latest == old and state.exists:
                status = state.get[1]      # the source's registration again, or a repeat
        state.update((latest, status))
        if status == "OK":
            state.setTimeoutTimestamp(latest // 1000 + limit_ms)
        shown = pd.Series([None if latest is None else pd.Timestamp(latest, unit="us")], dtype="datetime64[us]")
        yield pd.DataFrame({"stream": [key[0]], "latest": shown, "status": [status]})
    return track


def freshness_stream(rows: DataFrame, stream: str = "stream", ts: str = "datetime",
                     limit_minutes: int = FRESH_MINUTES, delay: str = "0 seconds") -> DataFrame:
    """(stream, latest, status) updates of the sources in a stream of rows."""
    marked = beats(rows, stream, ts).withWatermark("clock", delay)
    return marked.groupBy("stream").applyInPandasWithState(
        _track(limit_minutes * 60_000), STATUS, "latest long, status string", "update", GroupStateTimeout.EventTimeTimeout)


def follow_freshness(spark: SparkSession, updates: DataFrame, target: str, checkpoint: str, **trigger):
    """Writes the updates of each micro-batch to ``target``, with the batch's number
    (``n``); a replayed batch replaces its own. The few updates are put together
    by a shuffle: all partitions of the state are worked on side by side."""
    def write_batch(batch: DataFrame, n: int) -> None:
        token = f"{query_id(spark, checkpoint)}-{n}"
        batch.withColumn("n", F.lit(n).cast("long")).repartition(1).write.mode("overwrite").parquet(f"{target}/batch={token}")

    return run(updates.writeStream.outputMode("update").foreachBatch(write_batch)
               .option("checkpointLocation", checkpoint), **trigger)


def current(updates: DataFrame, as_of, limit_minutes: int = FRESH_MINUTES) -> DataFrame:
    """(stream, age_minutes, status): the last update of each source; its age is
    measured at ``as_of``."""
    last = updates.groupBy("stream").agg(F.max_by(F.struct("latest", "status"), "n").alias("last"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("last.latest")).cast("double") / F.lit(60e6)
    return last.select("stream", F.round(age, 3).alias("age_minutes"), F.col("last.status").alias("status"))
