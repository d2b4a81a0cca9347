"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (no collect to the
driver). ``ref_*`` entries time the reference's formulation of the same
answer, written by us: one window partition for the whole series, a Python
row UDF for sentiment, re-scanning the source for each gold output, and
fetching stored keys to the client for insert-new. They and
``stream_bars_1h`` are reported separately and not included in ``value``. Every
other figure is the median of three runs.
"""

from __future__ import annotations

import json
import math
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marketpulse.operators import indicators as I  # noqa: E402
from marketpulse.operators import sentiment as S  # noqa: E402
from marketpulse.operators import star as T  # noqa: E402
from marketpulse.plans import QUERIES, load_all  # noqa: E402
from marketpulse.plans.market import bars_1h  # noqa: E402
from marketpulse.session import get_session  # noqa: E402
from marketpulse.sources import fixtures as X  # noqa: E402

HEADLINE = [
    "market_silver", "market_silver_wide", "market_silver_long", "bars_1h", "dedup_keep_first",
    "insert_new_bars", "posts_silver", "sentiment_compound", "star_market_rollup",
    "star_sentiment_by_author", "monitor_recent_activity", "posts_topic_filter",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int = 3) -> float:
    """Median of ``runs`` runs."""
    took = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        took.append(time.perf_counter() - t0)
    return round(statistics.median(took), 3)


# --- the reference's formulations ---------------------------------------------------

def ref_silver_long(spark, sf_dir):
    """All indicators with one window partition for the whole series."""
    t = X.ticks(spark, sf_dir).withColumn("ticker", F.lit("ALL"))
    t = t.withColumns({"open": F.col("price"), "high": F.col("price"),
                       "low": F.col("price"), "close": F.col("price")})
    return I.add_all(t, [], ["datetime", "tie_key"])


def ref_sentiment_row_udf(spark, sf_dir):
    """The same lexicon formula in a row-at-a-time Python UDF."""
    lex = {w: v / 10.0 for w, v in S.LEXICON_TENTHS.items()}
    pat = re.compile(r"[^\W\d_]+")

    @F.udf("double")
    def compound(text):
        s = sum(lex.get(t, 0.0) for t in pat.findall((text or "").lower()))
        return 0.0 if s == 0 else s / math.sqrt(s * s + S.ALPHA)

    return X.posts(spark, sf_dir).select("id", compound("selftext").alias("VaderScore"))


def ref_star_fanout(spark, sf_dir):
    """Three gold outputs, each recomputing the silver source."""
    for make in (lambda f: f, T.ticker_dim, T.time_dim):
        fact = I.with_indicators(bars_1h(spark, sf_dir), ["ticker"], ["datetime"], strategy="partition")
        run_noop(make(fact))


def our_star_fanout(spark, sf_dir):
    """Three gold outputs from one persisted silver table."""
    fact = I.with_indicators(bars_1h(spark, sf_dir), ["ticker"], ["datetime"],
                             strategy="partition").persist()
    for make in (lambda f: f, T.ticker_dim, T.time_dim):
        run_noop(make(fact))
    fact.unpersist()


def ref_insert_client_keys(spark, sf_dir):
    """Stored keys fetched to the driver as a set, each new key looked up in it."""
    k = F.concat_ws("|", "ticker", F.col("datetime").cast("string"), F.col("tie_key").cast("string"))
    stored = {r[0] for r in X.stored_ticks(spark, sf_dir).select(k).collect()}
    held = spark.sparkContext.broadcast(stored)

    @F.udf("boolean")
    def known(key):
        return key in held.value
    inc = X.ticks_dup(spark, sf_dir)
    w = Window.partitionBy("ticker", "datetime", "tie_key").orderBy("arrival")
    first = inc.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return first.filter(~known(k))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    spark = get_session(f"local[{cpus}]", app="marketpulse-bench",
                        shuffle_partitions=max(8, int(cpus) * 2), driver_memory="16g",
                        extra={"spark.eventLog.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    # warm-up (JVM, code generation, Python workers) on the smallest tables,
    # so the timings below measure steady-state work on $BENCH_SF_DIR
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run_noop(QUERIES[name](spark, warm))
    run_noop(X.ticks(spark, sf_dir))

    queries = {}
    for name in HEADLINE:
        queries[name] = timed(lambda n=name: run_noop(QUERIES[n](spark, sf_dir)))
    queries["star_fanout"] = timed(lambda: our_star_fanout(spark, sf_dir))
    value = round(sum(queries.values()), 3)

    # not part of the total: four restarts from a checkpoint
    queries["stream_bars_1h"] = timed(lambda: run_noop(QUERIES["stream_bars_1h"](spark, sf_dir)), 1)
    queries["ref_market_silver_long"] = timed(lambda: run_noop(ref_silver_long(spark, sf_dir)))
    queries["ref_sentiment_row_udf"] = timed(lambda: run_noop(ref_sentiment_row_udf(spark, sf_dir)))
    queries["ref_star_fanout"] = timed(lambda: ref_star_fanout(spark, sf_dir))
    queries["ref_insert_client_keys"] = timed(lambda: run_noop(ref_insert_client_keys(spark, sf_dir)))

    print(json.dumps({"metric": "total_sec", "value": value, "unit": "sec", "queries": queries,
                      "sf": float(sf.group(1)) if sf else None, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
