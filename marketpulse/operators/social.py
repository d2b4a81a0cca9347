"""Social operators: post filters, author enrichment, engagement features,
the post silver table.

Author enrichment is a left outer join on ``author``. Placeholder authors
(``[deleted]`` and friends) can be a large share of all posts and never have
a profile, so their join key is replaced by a per-post unique value: they
neither match nor pile up in one shuffle partition. Skew on a real author is
left to AQE's skew-join split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.operators import sentiment as S
from marketpulse.operators.ingest import drop_columns
from marketpulse.sources.fixtures import SENTINEL_AUTHORS

# Profile fields and the value used when a known profile lacks one.
AUTHOR_DEFAULTS = {
    "author_link_karma": 0, "author_comment_karma": 0, "author_total_karma": 0,
    "author_created_utc": 0,
    "author_verified": False, "author_has_verified_email": False,
    "author_is_gold": False, "author_is_mod": False,
}
# Post creation text format and the zone of author creation times.
CREATED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
AUTHOR_ZONE = "Africa/Casablanca"

# Columns the silver step discards.
SILVER_DROPPED = [
    "archived", "author_created_utc", "author_created_ts", "author_flair", "created_utc",
    "distinguished_type", "edited", "edited_datetime", "flair", "flair_css", "gilded",
    "is_distinguished", "is_gallery", "is_self", "is_video", "locked", "media_type",
    "over_18", "permalink", "selftext", "spoiler", "total_awards", "url", "created_datetime",
    "log_post_score", "log_num_comments", "log_author_karma", "log_author_comment_karma",
]

# Author columns moved from the fact to the author dimension.
AUTHOR_DIM_COLUMNS = [
    "author", "author_account_age_days", "author_comment_karma", "author_created_datetime",
    "author_fullname", "author_has_verified_email", "author_is_gold", "author_is_mod",
    "author_link_karma", "author_premium", "author_total_karma", "author_verified",
]


# --- filters --------------------------------------------------------------------

def is_real_author(author: Column) -> Column:
    return author.isNotNull() & (author != "") & ~author.isin(SENTINEL_AUTHORS)


def real_authors(posts: DataFrame, author: str = "author") -> DataFrame:
    return posts.filter(is_real_author(F.col(author)))


def valid_posts(posts: DataFrame) -> DataFrame:
    """Drop pinned posts and posts without a creation time."""
    return posts.filter(~F.coalesce(F.col("stickied"), F.lit(False))
                        & F.col("created_utc").isNotNull() & (F.col("created_utc") != 0))


def in_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Inclusive [start, end] on a time column (pushed to the scan when the
    column is stored)."""
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    return df.filter(F.col(col).between(lo, hi))


def created_ts(col: str = "created_utc") -> Column:
    return F.timestamp_seconds(F.col(col))


def allowlisted(posts: DataFrame, names: Sequence[str], col: str = "subreddit") -> DataFrame:
    """Membership in a fixed, small list: an ``isin`` predicate, which the
    optimizer turns into an InSet and pushes to the scan."""
    return posts.filter(F.col(col).isin(list(names)))


def topic_posts(posts: DataFrame, topic_communities: Sequence[str], keywords: Sequence[str],
                per_community: int = 20, text_cols: Sequence[str] = ("title", "selftext")) -> DataFrame:
    """All posts of topic communities plus keyword-matching posts of the others,
    then the newest ``per_community`` of each community.

    ``row_number() <= N`` lets Spark insert a per-partition group limit before
    the shuffle, so a community with a huge backlog ships only N rows per task."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    match = S.has_any_word(text, keywords)
    keep = posts.filter(F.col("subreddit").isin(list(topic_communities)) | match)
    w = F.row_number().over(Window.partitionBy("subreddit")
                            .orderBy(F.col("created_utc").desc(), F.col("id")))
    return keep.withColumn("_rn", w).filter(F.col("_rn") <= per_community).drop("_rn")


# --- enrichment -----------------------------------------------------------------

def enrich(posts: DataFrame, authors: DataFrame, author: str = "author",
           defaults: dict | None = None, id_col: str = "id") -> DataFrame:
    """Left-join author profiles; profile values overwrite same-named post
    values when the author is known, otherwise the post stays unchanged.
    Known profiles missing a field get its default (0 / false). ``posts`` may be
    a stream. Posts of placeholder authors get a key made from ``id_col``, which
    matches nothing and spreads them."""
    defaults = AUTHOR_DEFAULTS if defaults is None else defaults
    a_cols = [c for c in authors.columns if c != author]
    prof = authors.filter(is_real_author(F.col(author))).select(
        F.col(author).alias("_akey"), F.lit(True).alias("_matched"),
        *[F.col(c).alias(f"_a_{c}") for c in a_cols])
    key = F.when(is_real_author(F.col(author)), F.col(author)).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64(id_col).cast("string")))
    j = posts.withColumn("_pkey", key).join(prof, F.col("_pkey") == F.col("_akey"), "left")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    out = {}
    for c in a_cols:
        val = F.col(f"_a_{c}")
        if c in defaults:
            val = F.coalesce(val, F.lit(defaults[c]))
        out[c] = F.when(matched, val).otherwise(F.col(c)) if c in posts.columns else \
            F.when(matched, val)
    for c, d in defaults.items():
        if c not in a_cols:
            prev = F.col(c) if c in posts.columns else F.lit(None)
            out[c] = F.when(matched, F.coalesce(prev, F.lit(d))).otherwise(prev)
    j = j.withColumns(out)
    keep = list(posts.columns) + [c for c in out if c not in posts.columns]
    return j.select(*keep)


def with_account_age(df: DataFrame, as_of_epoch, created: str = "author_created_utc") -> DataFrame:
    """Whole days between the author's creation and ``as_of`` (epoch seconds:
    a number or a scalar Column such as ``posts.select(max(...)).scalar()``);
    null when the creation time is 0 or missing."""
    as_of = as_of_epoch if isinstance(as_of_epoch, Column) else F.lit(int(as_of_epoch))
    c = F.nullif(F.col(created), F.lit(0))
    return df.withColumn("author_account_age_days", F.floor((as_of - c) / F.lit(86400)))


# --- features -------------------------------------------------------------------

def log_features(df: DataFrame) -> DataFrame:
    """log(1 + x) of score, comments, karma and comment karma (null for x <= -1)."""
    return df.withColumns({
        "log_post_score": F.log1p("score"),
        "log_num_comments": F.log1p("num_comments"),
        "log_author_karma": F.log1p("author_total_karma"),
        "log_author_comment_karma": F.log1p("author_comment_karma"),
    })


def social_index(df: DataFrame) -> DataFrame:
    """Sum of the four logs plus the upvote ratio (null if any part is null)."""
    si = (F.col("log_post_score") + F.col("log_num_comments") + F.col("log_author_karma")
          + F.col("log_author_comment_karma") + F.col("upvote_ratio"))
    return df.withColumn("SocialIndex", si)


def full_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "VaderFullScore": F.col("SocialIndex") * F.col("VaderScore"),
        "TextblobFullScore": F.col("SocialIndex") * F.col("TextblobScore"),
    })


def parse_created(df: DataFrame, col: str = "created_datetime", out: str = "datetime") -> DataFrame:
    """Post creation text -> timestamp (null when the text does not parse)."""
    return df.withColumn(out, F.try_to_timestamp(F.col(col), F.lit(CREATED_FORMAT)))


def author_created(df: DataFrame, zone: str = AUTHOR_ZONE) -> DataFrame:
    """Epoch seconds -> UTC timestamp -> wall clock in ``zone``."""
    ts = F.timestamp_seconds(F.col("author_created_utc"))
    return df.withColumns({"author_created_ts": ts,
                           "author_created_datetime": F.from_utc_timestamp(ts, zone)})


def score_posts(df: DataFrame, with_author_time: bool = True) -> DataFrame:
    """Post silver: sentiment, engagement index and its products, event time;
    raw text and helper columns dropped. Shared by batch and streaming."""
    df = S.add_scores(df)
    df = social_index(log_features(df))
    df = full_scores(df)
    df = parse_created(df)
    if with_author_time and "author_created_utc" in df.columns:
        df = author_created(df)
    return drop_columns(df, SILVER_DROPPED)


def sentiment_fact(silver: DataFrame) -> DataFrame:
    """The fact: silver minus author attributes (author_fullname stays as key)."""
    return drop_columns(silver, [c for c in AUTHOR_DIM_COLUMNS if c != "author_fullname"]
                        + ["author_created_ts"])


def run_summary(posts: DataFrame, listed: Sequence[str], start: int | None = None, end: int | None = None) -> DataFrame:
    """(subreddit, n_posts) of a crawl: each listed community, zero included, and
    ``ALL``, their total, from one scan by grouping sets. ``start`` and ``end``
    (epoch seconds, both included) bound ``created_utc``; posts without one are
    in no range."""
    some = posts.filter(F.col("subreddit").isin(list(listed)))
    if start is not None:
        some = some.filter(F.col("created_utc") >= start)
    if end is not None:
        some = some.filter(F.col("created_utc") <= end)
    names = posts.sparkSession.createDataFrame([(s,) for s in listed], "subreddit string")
    rows = some.select("subreddit", F.lit(1).alias("n")).unionByName(names.withColumn("n", F.lit(0)))
    return (rows.groupingSets([["subreddit"], []], "subreddit")
            .agg(F.sum("n").alias("n_posts"), F.grouping("subreddit").alias("all"))
            .select(F.when(F.col("all") == 1, "ALL").otherwise(F.col("subreddit")).alias("subreddit"), "n_posts"))
