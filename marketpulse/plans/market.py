"""Market queries: bars, indicators (silver) and the market half of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.operators import bars as B
from marketpulse.operators import indicators as I
from marketpulse.plans import oracle as O
from marketpulse.plans.catalog import register
from marketpulse.sources import fixtures as X

PRICES = ["open", "high", "low", "close"]


def as_double(df: DataFrame, cols=PRICES) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.ohlcv_bars(X.ticks(spark, sf_dir), "1 hour")


_BARS_OUT = "select ticker, datetime, open::double as open, high::double as high, low::double as low, close::double as close, volume from "


@register("bars_1h", O.with_(O.TICKS, O.BARS_1H) + _BARS_OUT + "bars_1h")
def q_bars_1h(spark, sf_dir):
    return as_double(bars_1h(spark, sf_dir))


@register("bars_5min", O.with_(O.TICKS, O.bars_cte("bars_5m", "5 minutes")) + _BARS_OUT + "bars_5m")
def q_bars_5min(spark, sf_dir):
    return as_double(B.ohlcv_bars(X.ticks(spark, sf_dir), "5 minutes"))


def _silver_oracle(source_ctes, source, partition, order, keep):
    base, final = O.silver_sql(source, partition, order, keep)
    return O.with_(*source_ctes, base) + final


_BAR_KEEP = ["ticker", "datetime", "open::double as open", "high::double as high",
             "low::double as low", "close::double as close", "volume"]


@register("market_silver", _silver_oracle([O.TICKS, O.BARS_1H], "bars_1h", ["ticker"],
                                          ["datetime"], _BAR_KEEP))
def q_market_silver(spark, sf_dir):
    """Flagship: ticks -> hourly OHLCV bars -> all indicators per ticker."""
    # Hourly bars per ticker are bounded by the calendar (<= 8,784 a year), so
    # one window partition per ticker is safe without measuring.
    silver = I.with_indicators(bars_1h(spark, sf_dir), ["ticker"], ["datetime"], strategy="partition")
    return as_double(silver)


# --- single indicators over hourly bars ---------------------------------------

def _bars_sql_base(extra_select: str, extra_ctes: str = "") -> str:
    return (O.with_(O.TICKS, O.BARS_1H, "s0 as (select *, lag(close) over (partition by ticker order by datetime) as prev from bars_1h)" + extra_ctes)
            + extra_select)


def _ind(fn_cols, spark, sf_dir, add):
    df = add(bars_1h(spark, sf_dir), ["ticker"], ["datetime"])
    return df.select("ticker", "datetime", *fn_cols)


@register("pct_change", _bars_sql_base(
    "select ticker, datetime, ((close - prev)::double / nullif(prev::double, 0)) * 100 as PrctChange from s0"))
def q_pct_change(spark, sf_dir):
    return _ind(["PrctChange"], spark, sf_dir, I.add_pct_change)


@register("direction", _bars_sql_base(
    "select ticker, datetime, case when close > prev then 'Up' when close < prev then 'Down' "
    "else 'No Change' end as Direction from s0"))
def q_direction(spark, sf_dir):
    return _ind(["Direction"], spark, sf_dir, I.add_pct_change)


_W = ["ticker"], ["datetime"]


@register("sma", O.with_(O.TICKS, O.BARS_1H) + "select ticker, datetime, "
          + ", ".join(f"{O.mean_sql('close', *_W, n)} as SMA{n}" for n in I.SMA_PERIODS)
          + " from bars_1h")
def q_sma(spark, sf_dir):
    return _ind([f"SMA{n}" for n in I.SMA_PERIODS], spark, sf_dir, I.add_sma)


_GAIN = ", s1 as (select *, close - prev as change, case when close - prev > 0 then close - prev else 0 end as gain, case when close - prev < 0 then prev - close else 0 end as loss from s0)"


@register("gain_loss", _bars_sql_base(
    "select ticker, datetime, change::double as change, gain::double as gain, loss::double as loss from s1", _GAIN))
def q_gain_loss(spark, sf_dir):
    df = I.add_gain_loss(bars_1h(spark, sf_dir), ["ticker"], ["datetime"])
    return as_double(df.select("ticker", "datetime", "change", "gain", "loss"), ["change", "gain", "loss"])


@register("rsi", _bars_sql_base(
    f"select ticker, datetime, 100 - 100 / (1 + ({O.mean_sql('gain', *_W, 14)}) / nullif({O.mean_sql('loss', *_W, 14)}, 0)) as RSI from s1",
    _GAIN))
def q_rsi(spark, sf_dir):
    return _ind(["RSI"], spark, sf_dir, I.add_rsi)


_TR = ", s1 as (select *, greatest(high - low, abs(high - prev), abs(low - prev)) as tr from s0)"


@register("true_range", _bars_sql_base(
    "select ticker, datetime, prev::double as prev_close, tr::double as TR from s1", _TR))
def q_true_range(spark, sf_dir):
    df = I.add_true_range(bars_1h(spark, sf_dir), ["ticker"], ["datetime"])
    return as_double(df.select("ticker", "datetime", "prev_close", "TR"), ["prev_close", "TR"])


@register("atr", _bars_sql_base(
    f"select ticker, datetime, {O.mean_sql('tr', *_W, 14)} as ATR from s1", _TR))
def q_atr(spark, sf_dir):
    return _ind(["ATR"], spark, sf_dir, I.add_atr)


@register("macd", O.with_(O.TICKS, O.BARS_1H) + "select ticker, datetime, "
          + f"{O.mean_sql('close', *_W, 12)} - {O.mean_sql('close', *_W, 26)} as MACD from bars_1h")
def q_macd(spark, sf_dir):
    return _ind(["MACD"], spark, sf_dir, I.add_macd)


# --- the silver job at other shapes -------------------------------------------

_WIDE_ORDER = list(X.WIDE_ORDER)
_WIDE_KEEP = ["ticker", "datetime", "l_orderkey", "l_linenumber", "l_partkey",
              "price::double as price", "volume"]


def _wide_silver_sql():
    src = ("wide_bars as (select ticker, datetime, l_orderkey, l_linenumber, l_partkey, price, volume, "
           "price as open, price as high, price as low, price as close from ticks_wide)")
    base, final = O.silver_sql("wide_bars", ["ticker"], _WIDE_ORDER, _WIDE_KEEP)
    return O.with_(O.TICKS_WIDE, src, base) + final


def wide_ticks_as_bars(spark, sf_dir):
    t = X.ticks_wide(spark, sf_dir)
    return t.withColumns({"open": F.col("price"), "high": F.col("price"),
                          "low": F.col("price"), "close": F.col("price")})


def _wide_out(df):
    return df.drop("open", "high", "low", "close").withColumn("price", F.col("price").cast("double"))


@register("market_silver_wide", _wide_silver_sql())
def q_market_silver_wide(spark, sf_dir):
    """Indicators over many tickers (each supplier's line items as ticks)."""
    df = I.with_indicators(wide_ticks_as_bars(spark, sf_dir), ["ticker"], _WIDE_ORDER)
    return _wide_out(df)


def _long_silver_sql():
    src = ("one as (select 'ALL' as ticker, datetime, tie_key, price, volume, price as open, "
           "price as high, price as low, price as close from ticks)")
    base, final = O.silver_sql("one", [], ["datetime", "tie_key"],
                               ["ticker", "datetime", "tie_key", "price::double as price", "volume"])
    return O.with_(O.TICKS, src, base) + final


@register("market_silver_long", _long_silver_sql())
def q_market_silver_long(spark, sf_dir):
    """One long series (every event as one ticker): halo-chunked windows."""
    t = X.ticks(spark, sf_dir).withColumn("ticker", F.lit("ALL"))
    t = t.withColumns({"open": F.col("price"), "high": F.col("price"),
                       "low": F.col("price"), "close": F.col("price")})
    df = I.with_indicators(t, [], ["datetime", "tie_key"], strategy="chunked")
    return _wide_out(df)


def bronze_bars(spark, sf_dir) -> DataFrame:
    """Daily bars stored the way the ingest layer writes them: text time,
    2-decimal prices, integer volume, constant metadata."""
    from marketpulse.operators.ingest import BAR_TIME_FORMAT, with_metadata
    d = B.ohlcv_bars(X.ticks(spark, sf_dir), "1 day", label="start")
    d = as_double(d).withColumn("datetime", F.date_format("datetime", BAR_TIME_FORMAT))
    return with_metadata(d, {"scraped_at": "2025-12-28T16:43:10", "interval": "1d"})


_DAILY_START = O.bars_cte("bars_1d", "1 day").replace(
    "time_bucket(interval '1 day', datetime) + interval '1 day'", "time_bucket(interval '1 day', datetime)")


@register("market_silver_bronze", _silver_oracle([O.TICKS, _DAILY_START], "bars_1d", ["ticker"],
                                                 ["datetime"], _BAR_KEEP))
def q_market_silver_bronze(spark, sf_dir):
    """The reference's silver job shape: bronze daily bars (text time,
    metadata) -> parsed, metadata dropped, all indicators per ticker."""
    silver = I.market_silver_from_bronze(bronze_bars(spark, sf_dir), strategy="partition")
    return as_double(silver).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


# --- dirty input: null times, keys and prices; fine prices ---------------------

_TICK_ORDER = ["datetime nulls first", "tie_key"]
_TICK_KEEP = ["ticker", "datetime", "tie_key", "close::double as price", "volume"]


def _dirty_sql(cte: str, name: str):
    base, final = O.silver_sql(name, ["ticker"], _TICK_ORDER, _TICK_KEEP)
    return O.with_(O.TICKS, cte, base) + final


def _tick_silver(ticks, **options):
    bars = ticks.withColumns({c: F.col("price") for c in PRICES})
    df = I.with_indicators(bars, ["ticker"], ["datetime", "tie_key"], **options)
    return _wide_out(df)


_LOOSE = """loose as (select case when tie_key % 60 = 11 then null else ticker end as ticker,
  case when tie_key % 50 = 7 then null else datetime end as datetime, tie_key, volume,
  price as open, price as high, price as low, price as close from ticks)"""


@register("market_silver_auto", _dirty_sql(_LOOSE, "loose"))
def q_market_silver_auto(spark, sf_dir):
    """Ticks with null times and tickers, past the limit for one task a series:
    ``auto`` takes the chunks, and every row comes out."""
    k = F.col("tie_key")
    t = X.ticks(spark, sf_dir).withColumns({
        "ticker": F.when(k % 60 != 11, F.col("ticker")), "datetime": F.when(k % 50 != 7, F.col("datetime"))})
    return _tick_silver(t, strategy="auto", series_task_limit=100, chunk_rows=512)


_GAPS = """gaps as (select ticker, datetime, tie_key, volume, p as open, p as high, p as low, p as close
  from (select *, case when (tie_key // 150) % 4 = 0 then null else price end as p from ticks))"""


@register("market_silver_nulls", _dirty_sql(_GAPS, "gaps"))
def q_market_silver_nulls(spark, sf_dir):
    """Leading and long runs of ticks without a price."""
    gap = F.floor(F.col("tie_key") / 150) % 4 == 0
    t = X.ticks(spark, sf_dir).withColumn("price", F.when(~gap, F.col("price")))
    return _tick_silver(t, strategy="partition")


_FINE = """fine as (select ticker, datetime, tie_key, volume, p as open, p as high, p as low, p as close
  from (select *, (price * 0.0001::decimal(5,4))::decimal(18,6) as p from ticks))"""


@register("market_silver_fine", _dirty_sql(_FINE, "fine"))
def q_market_silver_fine(spark, sf_dir):
    """Prices of six decimal places keep them."""
    small = (F.col("price") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,6)")
    return _tick_silver(X.ticks(spark, sf_dir).withColumn("price", small), strategy="partition")
