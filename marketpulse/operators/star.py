"""Gold layer: star schema dimensions, facts and rollups.

Dimensions are ``distinct`` projections (partially aggregated before the
shuffle). Fact-to-dimension joins carry no broadcast hint: the dimension
sizes grow with the data (every distinct timestamp, every author), so the
choice is left to AQE, which broadcasts only when the measured size of the
materialised side is under the threshold and otherwise keeps a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.picking import pick
from marketpulse.functions.windowing import exact, price_scale
from marketpulse.operators.social import AUTHOR_DIM_COLUMNS

# The financial fact columns of the streaming gold layer.
FINANCIAL_FACT_STREAM_COLUMNS = ["ticker", "datetime", "open", "close", "high", "low",
                                 "volume", "PrctChange", "Direction"]
# The sentiment fact columns of the streaming gold layer.
SENTIMENT_FACT_STREAM_COLUMNS = ["subreddit", "datetime", "VaderScore", "TextblobScore",
                                 "SocialIndex", "VaderFullScore", "TextblobFullScore",
                                 "score", "num_comments", "upvote_ratio"]
# The platform name of the platform dimension.
PLATFORM = "Reddit"


def ticker_dim(fact: DataFrame) -> DataFrame:
    return fact.select("ticker").distinct()


def time_dim(fact: DataFrame, col: str = "datetime") -> DataFrame:
    """Calendar parts of every distinct timestamp (ISO week)."""
    t = F.col(col)
    parts = {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
             "week": F.weekofyear(t), "quarter": F.quarter(t), "hour": F.hour(t),
             "minute": F.minute(t), "second": F.second(t)}
    return fact.select(col).distinct().withColumns({k: v.cast("long") for k, v in parts.items()})


def author_dim(silver: DataFrame) -> DataFrame:
    """Distinct author rows (a changed profile appears once per version)."""
    cols = [c for c in AUTHOR_DIM_COLUMNS if c in silver.columns]
    return silver.select(*cols).distinct()


def author_dim_latest(silver: DataFrame, time_col: str = "datetime") -> DataFrame:
    """One row per author: the profile seen on the author's latest post.

    ``max_by`` per author aggregates map-side, so a prolific author does not
    gather all of its posts in one task."""
    cols = [c for c in AUTHOR_DIM_COLUMNS if c in silver.columns and c != "author"]
    order = [time_col, "id"] if "id" in silver.columns else [time_col]
    return pick(silver.filter(F.col("author").isNotNull()), ["author"], order, cols, last=True)


def platform_dim(silver: DataFrame, platform: str = PLATFORM) -> DataFrame:
    return silver.select("subreddit").distinct().withColumn("Platform", F.lit(platform))


def financial_fact_stream_shape(silver: DataFrame) -> DataFrame:
    return silver.select(*FINANCIAL_FACT_STREAM_COLUMNS)


def sentiment_fact_stream_shape(silver: DataFrame) -> DataFrame:
    return silver.select(*SENTIMENT_FACT_STREAM_COLUMNS)


def market_rollup(fact: DataFrame, tdim: DataFrame) -> DataFrame:
    """Per ticker, year and quarter: bars, exact mean close, high, low, volume."""
    parts = tdim.withColumnRenamed("datetime", "_time")   # facts without a time stay, with null parts
    j = fact.join(parts, F.col("datetime").eqNullSafe(F.col("_time")), "left")
    close = exact("close", price_scale(fact, "close"))
    return j.groupBy("ticker", "year", "quarter").agg(
        F.count(F.lit(1)).alias("n_bars"),
        (F.sum(close).cast("double") / F.count(close)).alias("avg_close"),
        F.max(F.col("high").cast("double")).alias("max_high"),
        F.min(F.col("low").cast("double")).alias("min_low"),
        F.sum("volume").alias("total_volume"),
    )


def sentiment_by_author(fact: DataFrame, adim: DataFrame) -> DataFrame:
    """Per verified flag and gold flag of the author: posts, mean scores. Every
    post of the fact counts, and counts once: an account (``author_fullname``)
    with several rows in the dimension, as after a change of name, has the flags
    of the row with the greatest name. Unknown authors have null flags."""
    one = pick(adim.filter(F.col("author_fullname").isNotNull()), ["author_fullname"], ["author"],
               ["author_verified", "author_is_gold"])
    j = fact.join(one, "author_fullname", "left")
    return j.groupBy("author_verified", "author_is_gold").agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.round(F.avg("VaderScore"), 6).alias("avg_vader"),
        F.round(F.avg("TextblobScore"), 6).alias("avg_textblob"),
        F.sum("score").alias("total_score"),
    )


def latest_per_key(df: DataFrame, key: str, order_cols, cols) -> DataFrame:
    """Top-1 row per key by the ordering, without a global sort."""
    return pick(df, [key], list(order_cols), list(cols), last=True)

