"""Profile versions over time and as-of lookups.

``versions`` turns repeated snapshots of profiles into validity intervals: a
version lasts until the next snapshot that differs. ``as_of`` gives every event
the version that was valid at its time, without a range join: events and
versions are united, sorted, and the last version is carried forward.

A key that holds a large share of the events is cut by calendar bucket: the
last version of each bucket is carried over a small table of (key, bucket),
and within a bucket from its start. So one task has one key's rows of one
bucket, not all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.functions.picking import pick


def versions(snapshots: DataFrame, key: str, ts: str, cols: Sequence[str]) -> DataFrame:
    """(key, cols, valid_from, valid_to): a row for each change of ``cols``;
    ``valid_to`` is open (null) for the current version. Of snapshots with the
    same key and time one counts (``pick``'s choice); snapshots without a key or
    a time are left out, as they are valid at no time."""
    cols = list(cols)
    some = snapshots.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, ts, *cols)
    one = pick(some, [key, ts], [ts], cols)
    by_time = Window.partitionBy(key).orderBy(ts)
    now = F.struct(*cols)
    changed = one.withColumns({"_before": F.lag(now).over(by_time), "_n": F.row_number().over(by_time)}).filter(
        (F.col("_n") == 1) | ~now.eqNullSafe(F.col("_before")))
    return changed.select(key, *cols, F.col(ts).alias("valid_from"), F.lead(ts).over(by_time).alias("valid_to"))


def as_of(events: DataFrame, history: DataFrame, key: str, ts: str, cols: Sequence[str],
          bucket: str = "month") -> DataFrame:
    """``events`` with the ``cols`` of ``history`` (``versions``) at each event's
    time, a version's first moment included. Events without a key or a time, or
    before the first version, have nulls; every event comes back once. A column
    of ``events`` with one of these names is replaced."""
    cols = list(cols)
    events = events.drop(*cols)
    row = F.struct(*[F.col(c) for c in cols])
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    v = history.select(F.col(key).alias("_k"), F.col("valid_from").cast("timestamp").alias("_t"), row.alias("_v"))
    v = v.withColumn("_b", F.date_trunc(bucket, "_t"))
    e = events.filter(known).select(F.col(key).alias("_k"), F.col(ts).cast("timestamp").alias("_t"),
                                    F.struct(*[F.col(c) for c in events.columns]).alias("_e"))
    e = e.withColumn("_b", F.date_trunc(bucket, "_t"))
    # the version in force at the start of each bucket that has events
    ends = v.groupBy("_k", "_b").agg(F.max_by("_v", "_t").alias("_last"))
    spots = e.select("_k", "_b").distinct().join(ends, ["_k", "_b"], "full")
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = spots.select("_k", "_b", F.last("_last", True).over(before).alias("_v")).filter("_v is not null")
    # within a bucket: its start, then versions before events of the same moment
    none = F.lit(None)
    event, version = e.schema["_e"].dataType, v.schema["_v"].dataType
    rows = (e.select("_k", "_b", "_t", F.lit(2).alias("_o"), none.cast(version).alias("_v"), "_e")
            .unionByName(v.select("_k", "_b", "_t", F.lit(1).alias("_o"), "_v", none.cast(event).alias("_e")))
            .unionByName(start.select("_k", "_b", F.col("_b").alias("_t"), F.lit(0).alias("_o"), "_v", none.cast(event).alias("_e"))))
    forward = Window.partitionBy("_k", "_b").orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_v", F.last("_v", True).over(forward)).filter("_e is not null")
    kinds = {f.name: f.dataType for f in version}
    rest = events.filter(~known)
    return found.select("_e.*", *[F.col("_v")[c].alias(c) for c in cols]).unionByName(
        rest.withColumns({c: F.lit(None).cast(kinds[c]) for c in cols}))
