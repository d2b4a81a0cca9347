"""Pipeline-health queries over the market and post streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketpulse.operators import monitor as M
from marketpulse.plans import oracle as O
from marketpulse.plans.catalog import register
from marketpulse.plans.social import _r
from marketpulse.sources import fixtures as X


def post_stream(spark, sf_dir):
    """Posts with their event time (creation) as the stream's time column."""
    return X.posts(spark, sf_dir).withColumn("datetime", F.timestamp_seconds("created_utc")
                                             .cast("timestamp_ntz"))


_PTIME = ", pt as (select *, make_timestamp(created_utc * 1000000) as datetime from posts)"


@register("monitor_totals", O.with_(O.TICKS, O.POSTS)
          + "select 'market' as stream, count(*) as total from ticks union all "
          "select 'posts', count(*) from posts")
def q_monitor_totals(spark, sf_dir):
    return M.totals({"market": X.ticks(spark, sf_dir), "posts": X.posts(spark, sf_dir)})


def _recent_sql(table: str, name: str) -> str:
    cols = ", ".join(f"count(*) filter (where datetime >= m - interval {k} minute) as last_{k}_min"
                     for k in M.RECENT_MINUTES)
    return f"select '{name}' as stream, {cols} from {table}, (select max(datetime) as m from {table})"


@register("monitor_recent_activity", O.with_(O.TICKS, O.POSTS) + _PTIME + " "
          + _recent_sql("ticks", "market") + " union all " + _recent_sql("pt", "posts"))
def q_monitor_recent_activity(spark, sf_dir):
    """Rows in the last 5 / 15 / 60 minutes before each stream's latest row."""
    a = M.recent_activity(X.ticks(spark, sf_dir), "datetime", "market")
    b = M.recent_activity(post_stream(spark, sf_dir), "datetime", "posts")
    return a.unionByName(b)


@register("monitor_price_move", O.with_(O.TICKS)
          + ", r as (select * from ticks where datetime >= (select max(datetime) from ticks) - interval 60 minute) "
          "select ticker, arg_min(price, (datetime, tie_key))::double as start_price, "
          "arg_max(price, (datetime, tie_key))::double as end_price, "
          "(arg_max(price, (datetime, tie_key)) - arg_min(price, (datetime, tie_key)))::double as change, "
          "(arg_max(price, (datetime, tie_key)) - arg_min(price, (datetime, tie_key)))::double "
          "/ nullif(arg_min(price, (datetime, tie_key))::double, 0) * 100 as change_pct, "
          "max(price)::double as high_price, min(price)::double as low_price from r group by ticker having count(*) > 1")
def q_monitor_price_move(spark, sf_dir):
    """Last-hour price movement per ticker (as of the latest tick)."""
    t = X.ticks(spark, sf_dir)
    return M.price_move(t, t.select(F.max("datetime")).scalar())


@register("monitor_top_communities", O.with_(O.POSTS) + _PTIME
          + " select subreddit, count(*) as n_posts from pt where datetime >= "
          "(select max(datetime) from pt) - interval 60 minute group by subreddit "
          "order by n_posts desc, subreddit limit 5")
def q_monitor_top_communities(spark, sf_dir):
    """Top 5 communities by posts in the last hour before the newest post."""
    p = post_stream(spark, sf_dir)
    return M.top_communities(p, p.select(F.max("datetime")).scalar())


# when a row was taken in: some time after the event
_TAKEN = (", tk as (select *, datetime + interval (tie_key % 5) second as scraped_at from ticks), "
          "ps as (select *, datetime + interval (id::bigint % 7) minute as scraped_at from pt)")


def _taken(spark, sf_dir):
    """The market and post streams with the time at which each row was taken in,
    and a stream without rows."""
    t = X.ticks(spark, sf_dir)
    t = t.withColumn("scraped_at", t.datetime + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), t.tie_key % 5))
    p = post_stream(spark, sf_dir)
    minutes = (F.col("id").cast("long") % 7).cast("int")
    p = p.withColumn("scraped_at", F.col("datetime") + F.make_dt_interval(F.lit(0), F.lit(0), minutes))
    return {"market": t, "posts": p, "alerts": t.filter(F.col("volume").isNull() & F.col("volume").isNotNull())}


@register("monitor_recent_ingest", O.with_(O.TICKS, O.POSTS) + _PTIME + _TAKEN + " "
          + " union all ".join(
              _recent_sql(t, n).replace("datetime", "scraped_at") for t, n in (("tk", "market"), ("ps", "posts"))))
def q_monitor_recent_ingest(spark, sf_dir):
    """Rows taken in during the last 5 / 15 / 60 minutes of each stream."""
    streams = _taken(spark, sf_dir)
    return M.recent_activity(streams["market"], "scraped_at", "market").unionByName(
        M.recent_activity(streams["posts"], "scraped_at", "posts"))


@register("monitor_freshness", O.with_(O.TICKS, O.POSTS) + _PTIME + _TAKEN
          + ", l as (select 'market' as stream, (select max(scraped_at) from tk) as latest "
          "union all select 'posts', (select max(scraped_at) from ps) union all select 'alerts', null), "
          "a as (select max(latest) as as_of from l) "
          "select stream, " + _r("(epoch_us(as_of) - epoch_us(latest))::double / 60e6", 3)
          + " as age_minutes, case when latest is null then 'NO DATA' "
          "when (epoch_us(as_of) - epoch_us(latest))::double / 60e6 < 10 then 'OK' else 'STALE' end as status from l, a")
def q_monitor_freshness(spark, sf_dir):
    """Minutes since each stream took in its latest row, as of the latest of all."""
    parts = [df.agg(F.max("scraped_at").alias("latest")).withColumn("stream", F.lit(name))
             for name, df in _taken(spark, sf_dir).items()]
    latest = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return M.freshness(latest, latest.select(F.max("latest")).scalar())


@register("latest_post", O.with_(O.POSTS) + _PTIME
          + " select arg_max(subreddit, (datetime, id)) as subreddit, "
          "substring(coalesce(arg_max(title, (datetime, id)), ''), 1, 60) as title, "
          "arg_max(score, (datetime, id)) as score, max(datetime) as datetime from pt")
def q_latest_post(spark, sf_dir):
    """The newest post: community, title prefix, score, time. The top row of
    each task, then of those."""
    p = post_stream(spark, sf_dir).select("id", "subreddit", "title", "score", "datetime")
    latest = p.orderBy(F.col("datetime").desc(), F.col("id").desc()).limit(1)
    return latest.select("subreddit", F.substring(F.coalesce(F.col("title"), F.lit("")), 1, 60).alias("title"),
                         "score", "datetime")
