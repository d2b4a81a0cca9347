"""Skew check from Spark's event log: one hot ticker holding a third of rows.

    python tools/skew_report.py [sf_dir]

Builds ticks from line items where every third row belongs to one ticker,
runs the indicator job with ``strategy="partition"`` and ``"chunked"``, and
reads the event log (written to a fresh scratch folder) to report, for the
largest stage of each run: tasks, the most shuffle records one task read,
and the longest task. Prints one JSON line per strategy.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from marketpulse.operators import indicators as I  # noqa: E402
from marketpulse.session import get_session  # noqa: E402
from marketpulse.sources import fixtures as X  # noqa: E402


def hot_ticks(spark, sf_dir):
    t = X.ticks_wide(spark, sf_dir)
    t = t.withColumn("ticker", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("ticker")))
    return t.withColumns({"open": F.col("price"), "high": F.col("price"),
                          "low": F.col("price"), "close": F.col("price")})


def stage_stats(log_dir: str, job_group: str) -> dict:
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus"))
    stages: dict[int, dict] = {}
    stage_group: dict[int, str] = {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    sid = ev["Stage ID"]
                    info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    s = stages.setdefault(sid, {"tasks": 0, "max_records": 0, "max_ms": 0, "records": 0})
                    s["tasks"] += 1
                    s["records"] += read
                    s["max_records"] = max(s["max_records"], read)
                    s["max_ms"] = max(s["max_ms"], info["Finish Time"] - info["Launch Time"])
    mine = {sid: s for sid, s in stages.items() if stage_group.get(sid) == job_group}
    if not mine:
        return {}
    sid, top = max(mine.items(), key=lambda kv: kv[1]["records"])
    return {"stage": sid, **top}


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = get_session("local[8]", app="marketpulse-skew", shuffle_partitions=16, driver_memory="16g",
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ticks = hot_ticks(spark, sf_dir)
    order = list(X.WIDE_ORDER)
    total = ticks.count()
    hot = ticks.filter(F.col("ticker") == -1).count()
    results = {}
    for strategy in ("partition", "chunked"):
        spark.sparkContext.setJobGroup(strategy, strategy)
        t0 = time.perf_counter()
        df = I.with_indicators(ticks, ["ticker"], order, strategy=strategy, chunk_rows=8192)
        df.write.format("noop").mode("overwrite").save()
        results[strategy] = round(time.perf_counter() - t0, 3)
    spark.stop()
    for strategy, secs in results.items():
        print(json.dumps({"strategy": strategy, "seconds": secs, "rows": total, "hot_rows": hot,
                          "largest_stage": stage_stats(log_dir, strategy)}))


if __name__ == "__main__":
    main(sys.argv[1:])
