"""Pipeline-health queries over the bronze tables.

Each figure the reference asks the database for one by one is a column of a
single aggregate here. ``as_of`` is always an argument or derived from the
data (``max`` of the time column), never the wall clock, so results are
reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.picking import order_key

# The look-back windows (minutes), freshness limit (minutes) and
# the number of communities in the top list.
RECENT_MINUTES = (5, 15, 60)
FRESH_MINUTES = 10
TOP_COMMUNITIES = 5


def _minutes_before(as_of, m: int) -> Column:
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))


def totals(streams: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("total")).withColumn("stream", F.lit(name))
             for name, df in streams.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("stream", "total")


def recent_activity(df: DataFrame, ts: str, name: str,
                    minutes: Sequence[int] = RECENT_MINUTES) -> DataFrame:
    """Rows in the last m minutes before the latest row, for each m, in one
    pass (``as_of`` = the latest time, a scalar subquery in the same plan) over
    the rows of the longest look-back only."""
    as_of = df.select(F.max(ts)).scalar()
    df = df.filter(F.col(ts) >= _minutes_before(as_of, max(minutes)))
    aggs = [F.count_if(F.col(ts) >= _minutes_before(as_of, m)).alias(f"last_{m}_min")
            for m in minutes]
    return df.agg(*aggs).withColumn("stream", F.lit(name)).select(
        "stream", *[f"last_{m}_min" for m in minutes])


def price_move(ticks: DataFrame, as_of, minutes: int = 60, key: str = "ticker",
               ts: str = "datetime", price: str = "price", tie: str = "tie_key") -> DataFrame:
    """Per ticker over the last ``minutes``: first, last, change, change %,
    high and low; only tickers with more than one row."""
    recent = ticks.filter(F.col(ts) >= _minutes_before(as_of, minutes))
    first, last = (order_key(recent, [ts, tie], side) for side in (False, True))
    p = F.col(price)
    agg = recent.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(p, first).alias("start_price"), F.max_by(p, last).alias("end_price"),
        F.max(p).alias("high_price"), F.min(p).alias("low_price"))
    change = F.col("end_price") - F.col("start_price")
    return agg.filter(F.col("n") > 1).select(
        key,
        F.col("start_price").cast("double").alias("start_price"),
        F.col("end_price").cast("double").alias("end_price"),
        change.cast("double").alias("change"),
        (F.try_divide(change.cast("double"), F.col("start_price").cast("double")) * F.lit(100.0))
        .alias("change_pct"),
        F.col("high_price").cast("double").alias("high_price"),
        F.col("low_price").cast("double").alias("low_price"))


def top_communities(posts: DataFrame, as_of, ts: str = "datetime", minutes: int = 60,
                    k: int = TOP_COMMUNITIES) -> DataFrame:
    """Top k communities by posts in the last ``minutes`` (name breaks ties)."""
    recent = posts.filter(F.col(ts) >= _minutes_before(as_of, minutes))
    return (recent.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_posts"))
            .orderBy(F.col("n_posts").desc(), F.col("subreddit")).limit(k))


def freshness(latest: DataFrame, as_of, limit_minutes: int = FRESH_MINUTES) -> DataFrame:
    """``latest`` has (stream, latest ts or null). Total elapsed minutes (days
    included); OK under the limit, STALE otherwise, NO DATA when empty."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = (F.unix_micros(as_of.cast("timestamp"))
           - F.unix_micros(F.col("latest").cast("timestamp"))).cast("double") / F.lit(60e6)
    status = (F.when(F.col("latest").isNull(), F.lit("NO DATA"))
              .when(age < limit_minutes, F.lit("OK")).otherwise(F.lit("STALE")))
    return latest.select("stream", F.round(age, 3).alias("age_minutes"), status.alias("status"))
