"""Market and social inputs derived from the driver's tables.

The reference's real inputs (price bars of a ticker, forum posts, author
profiles, topic messages) are modelled on top of the generated TPC-H-like
tables so that every query reads data whose volume grows with the scale
factor. Each derivation here has an SQL twin in ``marketpulse.plans.oracle``.
All derivations are narrow projections/joins, so Catalyst prunes the scans
to the columns actually used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.sources.tables import read_table

PRICE = "decimal(18,2)"

# Author names that never resolve to a profile.
SENTINEL_AUTHORS = ["[deleted]", "[removed]", "AutoModerator"]


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market stream: one row per event, ticker = event type."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("ticker"),
        F.col("ts").alias("datetime"),
        F.col("event_id").alias("tie_key"),
        F.col("value").cast(PRICE).alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
    )


def ticks_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many tickers: line items as ticks, ticker = supplier key."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("ticker"),
        F.col("l_shipdate").alias("datetime"),
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        F.col("l_quantity").cast("long").alias("volume"),
    )


WIDE_ORDER = ("datetime", "l_orderkey", "l_linenumber", "l_partkey")


def ticks_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks plus a later, re-priced arrival of every 7th event."""
    t = ticks(spark, sf_dir)
    first = t.withColumn("arrival", F.lit(0))
    again = (t.filter(F.col("tie_key") % 7 == 0)
             .withColumn("price", (F.col("price") + F.lit(1)).cast(PRICE))
             .withColumn("arrival", F.lit(1)))
    return first.unionByName(again)


def ticks_dup_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticks_dup`` where every 5th event does not say when it arrived first."""
    unknown = (F.col("arrival") == 0) & (F.col("tie_key") % 5 == 0)
    return ticks_dup(spark, sf_dir).withColumn("arrival", F.when(~unknown, F.col("arrival")))


def stored_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier load already stored: every second event."""
    return ticks(spark, sf_dir).filter(F.col("tie_key") % 2 == 0)


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author profiles; one in ten is without its author's name, so that those
    authors' posts find no profile."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.when(k % 10 != 9, k.cast("string")).alias("author"),
        F.floor("c_acctbal").cast("long").alias("author_total_karma"),
        F.floor(F.col("c_acctbal") / 2).cast("long").alias("author_comment_karma"),
        F.floor(F.col("c_acctbal") / 4).cast("long").alias("author_link_karma"),
        F.when(k % 50 == 0, F.lit(0).cast("long"))
         .otherwise(F.lit(1100000000) + k * 3600).alias("author_created_utc"),
        (k % 3 == 0).alias("author_verified"),
        (k % 7 == 0).alias("author_is_gold"),
    )


def _first_line(text: Column) -> Column:
    return F.split_part(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(1))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum posts: documents joined to the order with the same key."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    j = d.join(o, d.doc_id == o.o_orderkey, "left")
    did = F.col("doc_id")
    author = (F.when(did % 25 == 0, F.lit("[deleted]"))
              .when(did % 40 == 1, F.lit("AutoModerator"))
              .otherwise(F.col("o_custkey").cast("string")))
    return j.select(
        did.cast("string").alias("id"),
        _first_line(F.col("text")).alias("title"),
        F.col("text").alias("selftext"),
        F.col("source").alias("subreddit"),
        author.alias("author"),
        F.when(author.isin(SENTINEL_AUTHORS), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("t2_"), author)).alias("author_fullname"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("score"),
        (F.col("n_chars") % 300).alias("num_comments"),
        ((did % 101).cast("double") / F.lit(100.0)).alias("upvote_ratio"),
        F.when(did % 200 == 3, F.lit(0).cast("long"))
         .otherwise(F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))).alias("created_utc"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_datetime"),
        (did % 60 == 5).alias("stickied"),
    )


def author_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author profiles as seen at three times; every 4th author has another name
    and another flag from the third on, the second repeats the first."""
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 10 != 9)
    seen = F.explode(F.array(*[F.lit(t) for t in ("1990-01-01", "1994-06-01", "1995-06-17")])).alias("seen_at")
    key = F.col("c_custkey")
    new = (key % 4 == 0) & (F.col("seen_at") == "1995-06-17")
    return c.select("c_custkey", seen).select(
        F.concat(F.lit("t2_"), key.cast("string")).alias("author_fullname"), F.col("seen_at").cast("timestamp").alias("seen_at"),
        F.concat(F.when(new, F.lit("new-")).otherwise(F.lit("")), key.cast("string")).alias("profile_name"),
        ((key % 3 == 0) != new).alias("author_verified"), (key % 7 == 0).alias("author_is_gold"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages of two shapes in one table, as a broker would hold them;
    some are malformed, cut off, null or empty, and some of an unknown topic."""
    t = ticks(spark, sf_dir)
    k = F.col("tie_key") % 97
    good = F.to_json(F.struct("ticker", F.col("price").cast("double").alias("price"), "volume"))
    m = t.select(F.when(k == 9, F.lit("other")).otherwise(F.lit("market")).alias("topic"),
                 F.when(k == 5, F.lit("not json")).when(k == 6, F.lit('{"ticker": "'))
                 .when(k == 7, F.lit(None)).when(k == 8, F.lit("{}")).otherwise(good).alias("value"))
    p = posts(spark, sf_dir).select(
        F.lit("posts").alias("topic"),
        F.to_json(F.struct("id", "subreddit", "score")).alias("value"))
    return m.unionByName(p)
