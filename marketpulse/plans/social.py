"""Social queries: filters, enrichment, features, sentiment, post silver and
the social half of the star schema."""

from __future__ import annotations

import calendar
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.operators import phrases as W
from marketpulse.operators import sentiment as S
from marketpulse.operators import sketches as K
from marketpulse.operators import social as P
from marketpulse.operators import star as T
from marketpulse.operators import versions as V
from marketpulse.plans import oracle as O
from marketpulse.plans.catalog import register
from marketpulse.session import materialise, scratch_path
from marketpulse.sources import fixtures as X
from marketpulse.sources.arrays import read_json_array
from marketpulse.sources.sinks import new_rows, write_json_arrays

# Query parameters (our own community names and keywords).
ALLOWLIST = [f"src{i}" for i in range(16)]
LISTED = ALLOWLIST + ["src99"]
TOPIC_COMMUNITIES = ["src0", "src1", "src2", "src3"]
KEYWORDS = ["ist", "que"]
RANGE_START, RANGE_END = "1995-01-01 00:00:00", "1996-12-31 23:59:59"


def _epoch(text: str) -> int:
    return calendar.timegm(datetime.strptime(text, "%Y-%m-%d %H:%M:%S").timetuple())


def _r(x: str, scale: int = 6) -> str:
    """SQL rounding matching Spark's round(double): half-up on the shortest text."""
    return f"round(({x})::varchar::decimal(38,20), {scale})::double"


def _ntz(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def round6(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# --- SQL building blocks ------------------------------------------------------------

_LEX = "lex(word, v) as (values " + ", ".join(f"('{w}', {v})" for w, v in S.LEXICON_TENTHS.items()) + ")"

ENRICHED = """enriched as (
  select p.*, a.author_total_karma, a.author_comment_karma, a.author_link_karma, a.author_created_utc,
         a.author_verified, a.author_is_gold,
         case when a.author is not null then false end as author_has_verified_email,
         case when a.author is not null then false end as author_is_mod,
         floor(((select max(created_utc) from posts) - nullif(a.author_created_utc, 0)) / 86400)::bigint
           as author_account_age_days
  from posts p left join authors a on p.author = a.author)"""

SENT = _LEX + """,
toks as (select id, unnest(regexp_extract_all(lower(coalesce(selftext, '')), '(\\p{L}+(?:[''\u2019]\\p{L}+)*)', 1)) as t from posts),
sent as (select toks.id, sum(lex.v) as s, count(lex.v) as n from toks join lex on toks.t = lex.word group by toks.id)"""


def _lg(x: str) -> str:
    return f"case when {x} > -1 then ln(1 + {x}) end"


SCORED = """scored as (
  select e.*, coalesce(sent.s, 0) as s, coalesce(sent.n, 0) as n,
    case when coalesce(sent.s, 0) = 0 then 0.0::double
         else (sent.s::double / 10.0::double) / sqrt((sent.s::double / 10.0::double) * (sent.s::double / 10.0::double) + 15.0::double) end as VaderScore,
    coalesce((sent.s::double / nullif(sent.n, 0)::double) / 40.0::double, 0.0::double) as TextblobScore,
    """ + f"""{_lg('score')} as log_post_score, {_lg('num_comments')} as log_num_comments,
    {_lg('author_total_karma')} as log_author_karma, {_lg('author_comment_karma')} as log_author_comment_karma
  from enriched e left join sent on sent.id = e.id),
silver as (
  select *, log_post_score + log_num_comments + log_author_karma + log_author_comment_karma + upvote_ratio as SocialIndex
  from scored)"""

SOCIAL = O.with_(O.POSTS, O.AUTHORS, ENRICHED, SENT, SCORED)

SILVER_SELECT = f"""select id, title, subreddit, author, author_fullname, score, num_comments, upvote_ratio, stickied,
  author_total_karma, author_comment_karma, author_link_karma, author_verified, author_is_gold,
  author_has_verified_email, author_is_mod, author_account_age_days, VaderScore, TextblobScore,
  {_r('SocialIndex')} as SocialIndex, {_r('SocialIndex * VaderScore')} as VaderFullScore,
  {_r('SocialIndex * TextblobScore')} as TextblobFullScore,
  try_strptime(created_datetime, '%Y-%m-%dT%H:%M:%S') as datetime,
  timezone('Africa/Casablanca', to_timestamp(author_created_utc)) as author_created_datetime
from silver"""


# --- Spark side -----------------------------------------------------------------------

def enriched_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = X.posts(spark, sf_dir)
    e = P.enrich(posts, X.authors(spark, sf_dir))
    return P.with_account_age(e, posts.select(F.max("created_utc")).scalar())


def posts_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.score_posts(enriched_posts(spark, sf_dir))


def silver_out(df: DataFrame) -> DataFrame:
    df = round6(df, ["SocialIndex", "VaderFullScore", "TextblobFullScore"])
    return _ntz(df, [c for c in ["datetime", "author_created_datetime"] if c in df.columns])


# --- filters ------------------------------------------------------------------------------

@register("posts_valid", O.with_(O.POSTS)
          + "select id, subreddit, created_utc from posts where not coalesce(stickied, false) "
          "and created_utc is not null and created_utc <> 0")
def q_posts_valid(spark, sf_dir):
    return P.valid_posts(X.posts(spark, sf_dir)).select("id", "subreddit", "created_utc")


@register("posts_in_range", O.with_(O.POSTS)
          + f"select id, created_utc from posts where created_utc between {_epoch(RANGE_START)} and {_epoch(RANGE_END)}")
def q_posts_in_range(spark, sf_dir):
    """Posts created in an inclusive time range: the bounds become epoch
    seconds, so the stored column itself is compared."""
    return P.in_range(X.posts(spark, sf_dir), "created_utc", _epoch(RANGE_START),
                      _epoch(RANGE_END)).select("id", "created_utc")


@register("real_authors", O.with_(O.POSTS)
          + "select id, author from posts where author is not null and author <> '' "
          "and author not in ('[deleted]', '[removed]', 'AutoModerator')")
def q_real_authors(spark, sf_dir):
    return P.real_authors(X.posts(spark, sf_dir)).select("id", "author")


@register("posts_allowlist", O.with_(O.POSTS)
          + "select id, subreddit from posts where subreddit in ("
          + ", ".join(f"'{s}'" for s in ALLOWLIST) + ")")
def q_posts_allowlist(spark, sf_dir):
    return P.allowlisted(X.posts(spark, sf_dir), ALLOWLIST).select("id", "subreddit")


@register("posts_topic_filter", O.with_(O.POSTS)
          + "select id, subreddit, created_utc from posts where subreddit in ("
          + ", ".join(f"'{s}'" for s in TOPIC_COMMUNITIES) + ") or list_has_any(regexp_extract_all("
          "lower(coalesce(title, '') || ' ' || coalesce(selftext, '')), '(\\p{L}+)', 1), ["
          + ", ".join(f"'{k}'" for k in KEYWORDS) + "]) qualify row_number() over "
          "(partition by subreddit order by created_utc desc, id) <= 20")
def q_posts_topic_filter(spark, sf_dir):
    """Topic communities in full, keyword posts elsewhere, newest 20 each."""
    t = P.topic_posts(X.posts(spark, sf_dir), TOPIC_COMMUNITIES, KEYWORDS, 20)
    return t.select("id", "subreddit", "created_utc")


@register("posts_newest", O.with_(O.POSTS) + "select id, created_utc from posts")
def q_posts_newest(spark, sf_dir):
    """All posts, newest first (missing creation time sorts as 0)."""
    return (X.posts(spark, sf_dir).select("id", "created_utc")
            .orderBy(F.coalesce(F.col("created_utc"), F.lit(0)).desc(), "id"))


# --- enrichment and features --------------------------------------------------------------

@register("posts_enriched", O.with_(O.POSTS, O.AUTHORS, ENRICHED) + "select * exclude (author_account_age_days) from enriched")
def q_posts_enriched(spark, sf_dir):
    """Posts with author profile fields (left join; unknown authors unchanged)."""
    return P.enrich(X.posts(spark, sf_dir), X.authors(spark, sf_dir))


@register("author_defaults", O.with_(O.POSTS, O.AUTHORS, ENRICHED)
          + "select id, author_total_karma, author_has_verified_email, author_is_mod from enriched")
def q_author_defaults(spark, sf_dir):
    e = P.enrich(X.posts(spark, sf_dir), X.authors(spark, sf_dir))
    return e.select("id", "author_total_karma", "author_has_verified_email", "author_is_mod")


@register("account_age", O.with_(O.POSTS, O.AUTHORS, ENRICHED)
          + "select id, author, author_account_age_days from enriched")
def q_account_age(spark, sf_dir):
    """Account age in whole days as of the newest post; null for unknown time."""
    return enriched_posts(spark, sf_dir).select("id", "author", "author_account_age_days")


@register("author_created", O.with_(O.POSTS, O.AUTHORS, ENRICHED)
          + "select id, make_timestamp(author_created_utc * 1000000) as author_created_ts, "
          "timezone('Africa/Casablanca', to_timestamp(author_created_utc)) as author_created_datetime from enriched")
def q_author_created(spark, sf_dir):
    e = P.author_created(P.enrich(X.posts(spark, sf_dir), X.authors(spark, sf_dir)))
    return _ntz(e.select("id", "author_created_ts", "author_created_datetime"),
                ["author_created_ts", "author_created_datetime"])


@register("parse_created", O.with_(O.POSTS)
          + "select id, try_strptime(created_datetime, '%Y-%m-%dT%H:%M:%S') as datetime from posts")
def q_parse_created(spark, sf_dir):
    return _ntz(P.parse_created(X.posts(spark, sf_dir)).select("id", "datetime"), ["datetime"])


_LOGS = ["log_post_score", "log_num_comments", "log_author_karma", "log_author_comment_karma"]


@register("log_features", SOCIAL + "select id, " + ", ".join(f"{_r(c)} as {c}" for c in _LOGS) + " from silver")
def q_log_features(spark, sf_dir):
    return round6(P.log_features(enriched_posts(spark, sf_dir)).select("id", *_LOGS), _LOGS)


@register("social_index", SOCIAL + f"select id, {_r('SocialIndex')} as SocialIndex from silver")
def q_social_index(spark, sf_dir):
    df = P.social_index(P.log_features(enriched_posts(spark, sf_dir)))
    return round6(df.select("id", "SocialIndex"), ["SocialIndex"])


@register("full_scores", SOCIAL + f"select id, {_r('SocialIndex * VaderScore')} as VaderFullScore, "
          f"{_r('SocialIndex * TextblobScore')} as TextblobFullScore from silver")
def q_full_scores(spark, sf_dir):
    df = P.full_scores(P.social_index(P.log_features(S.add_scores(enriched_posts(spark, sf_dir)))))
    return round6(df.select("id", "VaderFullScore", "TextblobFullScore"),
                  ["VaderFullScore", "TextblobFullScore"])


@register("sentiment_compound", SOCIAL + "select id, VaderScore from silver")
def q_sentiment_compound(spark, sf_dir):
    """Lexicon compound score over each post's whole text."""
    return S.add_scores(X.posts(spark, sf_dir)).select("id", "VaderScore")


@register("sentiment_polarity", SOCIAL + "select id, TextblobScore from silver")
def q_sentiment_polarity(spark, sf_dir):
    """Mean matched valence over each post's whole text."""
    return S.add_scores(X.posts(spark, sf_dir)).select("id", "TextblobScore")


def large_lexicon() -> dict[str, int]:
    """All two-letter words and the three-letter words that begin with a to g,
    valences by rule."""
    az = [chr(97 + k) for k in range(26)]
    words = [a + b for a in az for b in az] + [a + b + c for a in az[:7] for b in az for c in az]
    return {w: (7 * k) % 81 - 40 for k, w in enumerate(words)}


_LARGE = """lex(word, v) as (
  select chr(97 + (k // 26)::int) || chr(97 + (k % 26)::int), (7 * k) % 81 - 40 from range(676) r(k)
  union all select chr(97 + (k // 676)::int) || chr(97 + ((k // 26) % 26)::int) || chr(97 + (k % 26)::int),
    (7 * (676 + k)) % 81 - 40 from range(4732) r(k))"""


@register("sentiment_large_lexicon", O.with_(O.POSTS, O.AUTHORS, ENRICHED, SENT.replace(_LEX, _LARGE), SCORED)
          + "select id, VaderScore, TextblobScore from silver")
def q_sentiment_large_lexicon(spark, sf_dir):
    """Both scores with a lexicon of 5,408 words."""
    return S.add_scores(X.posts(spark, sf_dir), lexicon=large_lexicon()).select(
        "id", "VaderScore", "TextblobScore")


# The words that the phrase filter's 5,000 phrases are made of.
PHRASE_WORDS = """
the of de and to in a la der is that en it for was on die with que le be as des und by this et er are at re an
from th les un es el nd ha rewh den ou he von orre st thatin ononst ed inoran orantion hehely ti ing or tion ea
nt ly du zu y ble das une los sh wh ther mit""".split()


def phrase_list() -> list[str]:
    """All pairs of 70 words, and a b a for the first ten."""
    few = PHRASE_WORDS[:10]
    return ([f"{a} {b}" for a in PHRASE_WORDS for b in PHRASE_WORDS]
            + [f"{a} {b} {a}" for a in few for b in few])


@register("posts_phrase_filter", O.with_(
    O.POSTS, "w(i, w) as (values " + ", ".join(f"({i}, '{w}')" for i, w in enumerate(PHRASE_WORDS)) + ")",
    """phr as (select a.w || ' ' || b.w as p from w a, w b
  union all select a.w || ' ' || b.w || ' ' || a.w from w a, w b where a.i < 10 and b.i < 10)""",
    """tk as (select id, regexp_extract_all(lower(coalesce(selftext, '')), '(\\p{L}+(?:[''’]\\p{L}+)*)', 1) as t from posts)""",
    """gram as (select id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) as p from tk
  union all select id, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) from tk)""")
    + """select id, count(*) as n_occurrences, count(distinct p) as n_phrases, min(p) as least_phrase
from gram semi join phr using (p) group by id""")
def q_posts_phrase_filter(spark, sf_dir):
    """Posts that hold any of 5,000 phrases of two and three words."""
    tagged = W.with_phrases(X.posts(spark, sf_dir).select("id", "selftext"), "selftext", phrase_list(),
                            count="n_occurrences")
    return tagged.filter("n_occurrences > 0").select(
        "id", F.col("n_occurrences").cast("long").alias("n_occurrences"),
        F.size("phrases").cast("long").alias("n_phrases"), F.get("phrases", F.lit(0)).alias("least_phrase"))


@register("posts_json_array", O.with_(O.POSTS)
          + "select id, author, subreddit, title, score, upvote_ratio, md5(selftext) as body from posts")
def q_posts_json_array(spark, sf_dir):
    """One JSON array file a community, written and read again by splits."""
    posts = X.posts(spark, sf_dir).select("id", "author", "subreddit", "title", "score", "upvote_ratio", "selftext")
    path = scratch_path(spark, "post-arrays")
    write_json_arrays(posts, path, ["subreddit"], ["id"])
    return read_json_array(spark, path, posts.schema).withColumn("body", F.md5("selftext")).drop("selftext")


@register("posts_silver", SOCIAL + SILVER_SELECT)
def q_posts_silver(spark, sf_dir):
    """The post silver table: enrichment, sentiment, engagement, event time."""
    return silver_out(posts_silver(spark, sf_dir))


# --- star, social half --------------------------------------------------------------------

_SILVER_CTE = SOCIAL.rstrip() + ",\nsv as (" + SILVER_SELECT + ")\n"
_FACT_COLS = ["id", "title", "subreddit", "author_fullname", "score", "num_comments", "upvote_ratio",
              "stickied", "VaderScore", "TextblobScore", "SocialIndex", "VaderFullScore",
              "TextblobFullScore", "datetime"]


@register("sentiment_fact", _SILVER_CTE + "select " + ", ".join(_FACT_COLS) + " from sv")
def q_sentiment_fact(spark, sf_dir):
    return P.sentiment_fact(silver_out(posts_silver(spark, sf_dir)))


@register("sentiment_fact_stream_shape", _SILVER_CTE + "select " + ", ".join(T.SENTIMENT_FACT_STREAM_COLUMNS) + " from sv")
def q_sentiment_fact_stream_shape(spark, sf_dir):
    return T.sentiment_fact_stream_shape(silver_out(posts_silver(spark, sf_dir)))


_ADIM = ["author", "author_account_age_days", "author_comment_karma", "author_created_datetime",
         "author_fullname", "author_has_verified_email", "author_is_gold", "author_is_mod",
         "author_link_karma", "author_total_karma", "author_verified"]


@register("author_dim", _SILVER_CTE + "select distinct " + ", ".join(_ADIM) + " from sv")
def q_author_dim(spark, sf_dir):
    return T.author_dim(silver_out(posts_silver(spark, sf_dir)))


@register("author_dim_latest", _SILVER_CTE + "select author, " + ", ".join(
    f"arg_max({c}, (datetime, id)) as {c}" for c in _ADIM if c != "author")
    + " from sv where author is not null group by author")
def q_author_dim_latest(spark, sf_dir):
    return T.author_dim_latest(silver_out(posts_silver(spark, sf_dir)))


@register("platform_dim", O.with_(O.POSTS) + "select distinct subreddit, 'Reddit' as Platform from posts")
def q_platform_dim(spark, sf_dir):
    return T.platform_dim(X.posts(spark, sf_dir))


@register("star_sentiment_by_author", _SILVER_CTE
          + ", ad as (select author_fullname, arg_max(author_verified, (datetime, id)) as author_verified, "
          "arg_max(author_is_gold, (datetime, id)) as author_is_gold from sv where author is not null group by author, author_fullname) "
          "select author_verified, author_is_gold, count(*) as n_posts, " + _r("avg(VaderScore)")
          + " as avg_vader, " + _r("avg(TextblobScore)") + " as avg_textblob, sum(score)::bigint as total_score "
          "from (select sv.VaderScore, sv.TextblobScore, sv.score, ad.author_verified, ad.author_is_gold "
          "from sv left join ad using (author_fullname)) group by all")
def q_star_sentiment_by_author(spark, sf_dir):
    """Sentiment fact joined to the author dimension, by author flags; posts
    without a known author count under null flags. Silver is made once."""
    used = ["id", "author", "author_fullname", "author_verified", "author_is_gold", "datetime",
            "VaderScore", "TextblobScore", "score"]
    silver = materialise(silver_out(posts_silver(spark, sf_dir)).select(*used), "posts-silver")
    return T.sentiment_by_author(P.sentiment_fact(silver), T.author_dim_latest(silver))


# --- counts -------------------------------------------------------------------------------------

@register("distinct_authors", O.with_(O.POSTS)
          + "select distinct author from posts where author is not null and author <> '' "
          "and author not in ('[deleted]', '[removed]', 'AutoModerator')")
def q_distinct_authors(spark, sf_dir):
    return P.real_authors(X.posts(spark, sf_dir)).select("author").distinct()


@register("enrichment_coverage", O.with_(O.POSTS, O.AUTHORS)
          + ", da as (select distinct author from posts where author is not null and author <> '' "
          "and author not in ('[deleted]', '[removed]', 'AutoModerator')) "
          "select count(*) filter (where a.author is not null) as fetched, "
          "count(*) filter (where a.author is null) as failed from da left join authors a using (author)")
def q_enrichment_coverage(spark, sf_dir):
    """Distinct real authors with and without a profile."""
    da = P.real_authors(X.posts(spark, sf_dir)).select("author").distinct()
    a = X.authors(spark, sf_dir).select("author", F.lit(True).alias("_m"))
    j = da.join(a, "author", "left")
    return j.agg(F.count_if(F.col("_m").isNotNull()).alias("fetched"),
                 F.count_if(F.col("_m").isNull()).alias("failed"))


@register("scrape_summary", O.with_(O.POSTS)
          + ", listed(subreddit) as (values " + ", ".join(f"('{s}')" for s in LISTED) + ") "
          "select l.subreddit, coalesce(c.n, 0) as n_posts from listed l left join "
          "(select subreddit, count(*) as n from posts group by subreddit) c using (subreddit) "
          "union all select 'ALL', count(*) from posts where subreddit in (select subreddit from listed)")
def q_scrape_summary(spark, sf_dir):
    """Posts per listed community (zero included) plus the total of the listed."""
    return P.run_summary(X.posts(spark, sf_dir), LISTED)


@register("scrape_summary_range", O.with_(O.POSTS)
          + "select coalesce(l.subreddit, 'ALL') as subreddit, count(p.id) as n_posts from (values "
          + ", ".join(f"('{s}')" for s in LISTED) + ") l(subreddit) left join posts p on p.subreddit = l.subreddit "
          f"and p.created_utc between epoch(timestamp '{RANGE_START}') and epoch(timestamp '{RANGE_END}') "
          "group by grouping sets ((l.subreddit), ())")
def q_scrape_summary_range(spark, sf_dir):
    """The same for the posts of a requested range of time."""
    return P.run_summary(X.posts(spark, sf_dir), LISTED, _epoch(RANGE_START), _epoch(RANGE_END))


@register("community_span", O.with_(O.POSTS)
          + "select subreddit, make_timestamp(min(created_utc) * 1000000) as oldest, "
          "make_timestamp(max(created_utc) * 1000000) as newest, count(*) as n_posts from posts "
          "where not coalesce(stickied, false) and created_utc is not null and created_utc <> 0 group by subreddit")
def q_community_span(spark, sf_dir):
    p = P.valid_posts(X.posts(spark, sf_dir))
    agg = p.groupBy("subreddit").agg(
        F.timestamp_seconds(F.min("created_utc")).alias("oldest"),
        F.timestamp_seconds(F.max("created_utc")).alias("newest"),
        F.count(F.lit(1)).alias("n_posts"))
    return _ntz(agg, ["oldest", "newest"])


_INCOMING = """incoming as (
  select id, subreddit, score, 0 as arrival from posts
  union all select id, subreddit, score + 1, 1 from posts where id::bigint % 7 = 0),
stored as (select id from posts where id::bigint % 3 = 0)"""


@register("insert_new_posts", O.with_(O.POSTS, _INCOMING)
          + "select id, subreddit, score from (select * from incoming qualify row_number() over "
          "(partition by id order by arrival) = 1) n where not exists (select 1 from stored s where s.id = n.id)")
def q_insert_new_posts(spark, sf_dir):
    """Posts an insert-new load would append (key ``id``)."""
    p = X.posts(spark, sf_dir).select("id", "subreddit", "score")
    again = (p.filter(F.col("id").cast("long") % 7 == 0)
             .withColumn("score", F.col("score") + 1).withColumn("arrival", F.lit(1)))
    incoming = p.withColumn("arrival", F.lit(0)).unionByName(again)
    stored = p.filter(F.col("id").cast("long") % 3 == 0)
    return new_rows(incoming, stored, ["id"], ["arrival"]).select("id", "subreddit", "score")


def bronze_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched posts as the ingest layer stores them, with the descriptive
    columns the silver step discards."""
    e = enriched_posts(spark, sf_dir)
    did = F.col("id").cast("long")
    return e.withColumns({
        "permalink": F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("id")),
        "url": F.concat(F.lit("https://example.invalid/"), F.col("id")),
        "over_18": did % 13 == 0, "is_self": F.lit(True), "locked": did % 17 == 0,
        "edited": F.lit(False), "gilded": (did % 5).cast("long"), "spoiler": F.lit(False),
        "archived": did % 11 == 0, "total_awards": (did % 3).cast("long"),
    })


@register("posts_silver_bronze", SOCIAL + SILVER_SELECT)
def q_posts_silver_bronze(spark, sf_dir):
    """Post silver from reference-shaped bronze: descriptive columns dropped."""
    return silver_out(P.score_posts(bronze_posts(spark, sf_dir)))


# --- profile versions, mergeable distinct counts ---------------------------------------------

_SNAPSHOTS = """seen as (select unnest([timestamp '1990-01-01', timestamp '1994-06-01', timestamp '1995-06-17']) as seen_at),
profile as (select 't2_' || c_custkey as author_fullname, seen_at,
  case when c_custkey % 4 = 0 and seen_at = timestamp '1995-06-17' then 'new-' else '' end || c_custkey as profile_name,
  (c_custkey % 3 = 0) <> (c_custkey % 4 = 0 and seen_at = timestamp '1995-06-17') as author_verified,
  c_custkey % 7 = 0 as author_is_gold
  from customer, seen where c_custkey % 10 <> 9)"""


@register("star_sentiment_as_of", O.with_(O.POSTS, _SNAPSHOTS)
          + "select f.author_verified, f.author_is_gold, count(*) as n_posts, count(distinct p.author_fullname) as n_accounts, "
          "count(distinct f.profile_name) as n_names, sum(p.score) as total_score "
          "from (select *, to_timestamp(created_utc)::timestamp as at from posts) p asof left join profile f "
          "on f.author_fullname = p.author_fullname and f.seen_at <= p.at group by 1, 2")
def q_star_sentiment_as_of(spark, sf_dir):
    """Posts by the flags their authors had at the time of the post."""
    cols = ["profile_name", "author_verified", "author_is_gold"]
    history = V.versions(X.author_snapshots(spark, sf_dir), "author_fullname", "seen_at", cols)
    posts = X.posts(spark, sf_dir).withColumn("at", F.timestamp_seconds("created_utc"))
    found = V.as_of(posts.select("id", "author_fullname", "score", "at"), history, "author_fullname", "at", cols)
    return found.groupBy("author_verified", "author_is_gold").agg(
        F.count(F.lit(1)).alias("n_posts"), F.countDistinct("author_fullname").alias("n_accounts"),
        F.countDistinct("profile_name").alias("n_names"), F.sum("score").alias("total_score"))


@register("author_versions", O.with_(_SNAPSHOTS)
          + "select author_fullname, profile_name, author_verified, author_is_gold, min(seen_at) as valid_from, "
          "case when author_fullname[4:]::bigint % 4 = 0 and profile_name not like 'new-%' then timestamp '1995-06-17' end "
          "as valid_to from profile group by all")
def q_author_versions(spark, sf_dir):
    """Validity intervals of author profiles."""
    cols = ["profile_name", "author_verified", "author_is_gold"]
    history = V.versions(X.author_snapshots(spark, sf_dir), "author_fullname", "seen_at", cols)
    return _ntz(history, ["valid_from", "valid_to"])


@register("distinct_authors_sketch", O.with_(O.POSTS)
          + "select subreddit, count(distinct author) as n_authors, true as within from posts where author is not null "
          "group by 1 union all select null, count(distinct author), true from posts where author is not null")
def q_distinct_authors_sketch(spark, sf_dir):
    """Authors by community and in all, exactly, and whether the union of stored
    daily sketches is within four standard errors of it."""
    posts = X.posts(spark, sf_dir).withColumn("at", F.timestamp_seconds("created_utc")).filter("author is not null")
    stored = materialise(K.daily(posts, ["subreddit"], "author", "at"), "author-sketches")
    by = K.exact(posts, ["subreddit"], "author").join(K.estimated(stored, ["subreddit"], "about"), "subreddit", "left")
    total = posts.select(F.lit(None).cast("string").alias("subreddit"), "author")
    whole = K.exact(total, ["subreddit"], "author").withColumn("about", K.estimated(stored, (), "about").scalar())
    near = F.abs(F.col("about") - F.col("n")) <= F.greatest(F.lit(1.0), 4 * K.error() * F.col("n"))
    return by.unionByName(whole).select("subreddit", F.col("n").alias("n_authors"), near.alias("within"))
