"""SQL (DuckDB dialect) twins of the fixture derivations and operators.

These are deliberately written as plain SQL over the raw tables, independent
of the DataFrame code, so a query and its oracle only agree when both
implement the documented semantics.
"""

from __future__ import annotations

from collections.abc import Sequence

TICKS = """ticks as (
  select event_type as ticker, ts as datetime, event_id as tie_key,
         value::decimal(18,2) as price, cast(json_extract(props, '$.k') as bigint) as volume
  from events)"""

TICKS_WIDE = """ticks_wide as (
  select l_suppkey as ticker, l_shipdate as datetime, l_orderkey, l_linenumber, l_partkey,
         l_extendedprice::decimal(18,2) as price, l_quantity::bigint as volume
  from lineitem)"""


def bars_cte(name: str = "bars_1h", every: str = "1 hour", source: str = "ticks") -> str:
    return f"""{name} as (
  select ticker, time_bucket(interval '{every}', datetime) + interval '{every}' as datetime,
         arg_min(price, (datetime, tie_key)) as open, max(price) as high, min(price) as low,
         arg_max(price, (datetime, tie_key)) as close, sum(volume)::bigint as volume
  from {source} group by 1, 2)"""


BARS_1H = bars_cte()

TICKS_DUP = """ticks_dup as (
  select ticker, datetime, tie_key, price, volume, 0 as arrival from ticks
  union all
  select ticker, datetime, tie_key, (price + 1)::decimal(18,2), volume, 1 from ticks where tie_key % 7 = 0)"""

TICKS_DUP_NULL = """ticks_dup_null as (
  select ticker, datetime, tie_key, price, volume,
         case when not (arrival = 0 and tie_key % 5 = 0) then arrival end as arrival from ticks_dup)"""

STORED_TICKS = """stored_ticks as (select * from ticks where tie_key % 2 = 0)"""

AUTHORS = """authors as (
  select case when c_custkey % 10 <> 9 then c_custkey::varchar end as author, floor(c_acctbal)::bigint as author_total_karma,
         floor(c_acctbal / 2)::bigint as author_comment_karma,
         floor(c_acctbal / 4)::bigint as author_link_karma,
         case when c_custkey % 50 = 0 then 0 else 1100000000 + c_custkey * 3600 end::bigint as author_created_utc,
         c_custkey % 3 = 0 as author_verified, c_custkey % 7 = 0 as author_is_gold
  from customer)"""

POSTS = """posts as (
  select d.doc_id::varchar as id,
         split_part(coalesce(d.text, ''), chr(10), 1) as title,
         d.text as selftext, d.source as subreddit,
         case when d.doc_id % 25 = 0 then '[deleted]' when d.doc_id % 40 = 1 then 'AutoModerator'
              else o.o_custkey::varchar end as author,
         case when d.doc_id % 25 = 0 or d.doc_id % 40 = 1 then null
              else 't2_' || o.o_custkey::varchar end as author_fullname,
         floor(o.o_totalprice / 1000)::bigint as score, (d.n_chars % 300) as num_comments,
         (d.doc_id % 101) / 100.0::double as upvote_ratio,
         case when d.doc_id % 200 = 3 then 0 else epoch(o.o_orderdate)::bigint end as created_utc,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') as created_datetime,
         d.doc_id % 60 = 5 as stickied
  from documents d left join orders o on o.o_orderkey = d.doc_id)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _over(partition: Sequence[str], order: Sequence[str], n: int | None = None) -> str:
    p = f"partition by {', '.join(partition)} " if partition else ""
    frame = f" rows between {n - 1} preceding and current row" if n else ""
    return f"over ({p}order by {', '.join(order)}{frame})"


def mean_sql(x: str, partition, order, n: int) -> str:
    o = _over(partition, order, n)
    return f"(sum({x}) {o})::double / nullif(count({x}) {o}, 0)"


def silver_sql(source: str, partition: Sequence[str], order: Sequence[str],
               keep: Sequence[str]) -> str:
    """Select list producing the market silver columns from ``source``."""
    lag = f"lag(close) {_over(partition, order)}"
    base = f"""s0 as (select *, {lag} as prev from {source}),
s1 as (select *, close - prev as change,
              case when close - prev > 0 then close - prev else 0 end as gain,
              case when close - prev < 0 then prev - close else 0 end as loss,
              greatest(high - low, abs(high - prev), abs(low - prev)) as tr
       from s0),
s2 as (select *,
  ((close - prev)::double / nullif(prev::double, 0)) * 100 as PrctChange,
  {mean_sql('close', partition, order, 20)} as SMA20,
  {mean_sql('close', partition, order, 50)} as SMA50,
  {mean_sql('close', partition, order, 200)} as SMA200,
  {mean_sql('gain', partition, order, 14)} as avg_gain,
  {mean_sql('loss', partition, order, 14)} as avg_loss,
  {mean_sql('tr', partition, order, 14)} as ATR,
  {mean_sql('close', partition, order, 12)} - {mean_sql('close', partition, order, 26)} as MACD
  from s1)"""
    cols = ", ".join(keep)
    final = f"""select {cols}, PrctChange,
  case when PrctChange > 0 then 'Up' when PrctChange < 0 then 'Down' else 'No Change' end as Direction,
  SMA20, SMA50, SMA200, 100 - 100 / (1 + avg_gain / nullif(avg_loss, 0)) as RSI, ATR, MACD
from s2"""
    return base, final
