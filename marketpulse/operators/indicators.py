"""Technical indicators over price series (the market silver layer).

Every indicator is a window function over ``partitionBy(series keys)
.orderBy(time, tie breakers)``. All of them are written against one window
specification, so Catalyst plans a single Exchange + Sort for the whole set;
indicators that depend on another (RSI on gain/loss) only add Window nodes
within the same partitioning, never another shuffle.

Two physical strategies give the same rows:

* ``partition``: one window partition per series. Many series spread over
  many tasks.
* ``chunked``: one very long series (or one hot ticker holding a large share
  of all rows) is cut into chunks of an equal number of rows; the last
  ``lookback`` rows of each chunk are copied into the next one as read-only
  context (a halo). Indicators are then computed per (series, chunk) and halo
  rows dropped. Exact because no indicator looks further back than
  ``lookback`` rows. Where a row stands in its series comes from a range
  partitioning by (series, order), so the times' distribution is of no matter.

``strategy="auto"`` measures the largest series (one aggregate) and chooses.
Both keep every row, with a null time or key too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.functions.windowing import (add_means, exact, price_scale, safe_div,
                                             series_window)
from marketpulse.session import materialise

# The indicator periods of the reference's silver job.
SMA_PERIODS = (20, 50, 200)
RSI_PERIOD = 14
ATR_PERIOD = 14
MACD_SHORT, MACD_LONG = 12, 26

SILVER_COLUMNS = ["PrctChange", "Direction", "SMA20", "SMA50", "SMA200", "RSI", "ATR", "MACD"]


def lookback_rows(sma_periods: Sequence[int] = SMA_PERIODS, rsi_period: int = RSI_PERIOD,
                  atr_period: int = ATR_PERIOD, macd: tuple[int, int] = (MACD_SHORT, MACD_LONG)) -> int:
    """Rows before the current one that any indicator can read."""
    return max([n - 1 for n in sma_periods] + [n - 1 for n in macd] + [rsi_period, atr_period, 1])


# --- single indicators (each returns df + new columns) -------------------------

def _pct(c: Column, prev: Column) -> Column:
    return safe_div((c - prev).cast("double"), prev.cast("double")) * F.lit(100.0)


def direction_col(change: Column) -> Column:
    return (F.when(change > 0, F.lit("Up"))
            .when(change < 0, F.lit("Down"))
            .otherwise(F.lit("No Change")))


def add_pct_change(df: DataFrame, partition_cols, order_cols, close: str = "close") -> DataFrame:
    w = series_window(partition_cols, order_cols)
    c = exact(close, price_scale(df, close))
    df = df.withColumn("PrctChange", _pct(c, F.lag(c).over(w)))
    return df.withColumn("Direction", direction_col(F.col("PrctChange")))


def add_sma(df: DataFrame, partition_cols, order_cols, close: str = "close",
            periods: Sequence[int] = SMA_PERIODS) -> DataFrame:
    w = series_window(partition_cols, order_cols)
    scale = price_scale(df, close)
    df = df.withColumn("_close", exact(close, scale))
    return add_means(df, w, [(f"SMA{n}", "_close", n) for n in periods], scale).drop("_close")


def add_gain_loss(df: DataFrame, partition_cols, order_cols, close: str = "close") -> DataFrame:
    """change = close - previous close; gain/loss its positive/negative part.
    The first row has no change, and gain = loss = 0."""
    w = series_window(partition_cols, order_cols)
    c = exact(close, price_scale(df, close))
    df = df.withColumn("change", c - F.lag(c).over(w))
    return df.withColumns(_gain_loss_cols(F.col("change")))


def _gain_loss_cols(change: Column) -> dict:
    zero = F.lit(0)
    return {"gain": F.when(change > 0, change).otherwise(zero),
            "loss": F.when(change < 0, -change).otherwise(zero)}


def _rsi_col(avg_gain: Column, avg_loss: Column, zero_loss: float | None) -> Column:
    rsi = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + safe_div(avg_gain, avg_loss))
    if zero_loss is not None:
        rsi = F.when(avg_loss == 0, F.lit(float(zero_loss))).otherwise(rsi)
    return rsi


def add_rsi(df: DataFrame, partition_cols, order_cols, close: str = "close",
            period: int = RSI_PERIOD, zero_loss: float | None = None) -> DataFrame:
    """Simple-mean RSI: 100 - 100 / (1 + mean gain / mean loss).

    With no loss in the frame RS is undefined: null by default,
    ``zero_loss=100`` gives the textbook value instead."""
    w = series_window(partition_cols, order_cols)
    scale = price_scale(df, close)
    df = add_gain_loss(df, partition_cols, order_cols, close)
    df = add_means(df, w, [("_avg_gain", "gain", period), ("_avg_loss", "loss", period)], scale)
    df = df.withColumns({"RS": safe_div(F.col("_avg_gain"), F.col("_avg_loss")),
                         "RSI": _rsi_col(F.col("_avg_gain"), F.col("_avg_loss"), zero_loss)})
    return df.drop("_avg_gain", "_avg_loss")


def _true_range(high: Column, low: Column, prev: Column) -> Column:
    """greatest(high - low, |high - prev|, |low - prev|); the first row falls
    back to high - low because greatest skips nulls."""
    return F.greatest(high - low, F.abs(high - prev), F.abs(low - prev))


def _bar_scale(df: DataFrame, *columns: str, places: int | None = None) -> int | None:
    scales = [places if (kept := price_scale(df, c)) is None else kept for c in columns]
    return None if None in scales else max(scales)


def add_true_range(df: DataFrame, partition_cols, order_cols, high="high", low="low",
                   close="close") -> DataFrame:
    w = series_window(partition_cols, order_cols)
    scale = _bar_scale(df, high, low, close)
    prev = F.lag(exact(close, scale)).over(w)
    return df.withColumns({"prev_close": prev,
                           "TR": _true_range(exact(high, scale), exact(low, scale), prev)})


def add_atr(df: DataFrame, partition_cols, order_cols, high="high", low="low", close="close",
            period: int = ATR_PERIOD) -> DataFrame:
    w = series_window(partition_cols, order_cols)
    scale = _bar_scale(df, high, low, close)
    df = add_true_range(df, partition_cols, order_cols, high, low, close).drop("prev_close")
    return add_means(df, w, [("ATR", "TR", period)], scale)


def add_macd(df: DataFrame, partition_cols, order_cols, close: str = "close",
             short: int = MACD_SHORT, long: int = MACD_LONG) -> DataFrame:
    """Difference of two simple moving averages (not exponential)."""
    w = series_window(partition_cols, order_cols)
    scale = price_scale(df, close)
    df = df.withColumn("_close", exact(close, scale))
    df = add_means(df, w, [("_ms", "_close", short), ("_ml", "_close", long)], scale)
    return df.withColumn("MACD", F.col("_ms") - F.col("_ml")).drop("_ms", "_ml", "_close")


def add_all(df: DataFrame, partition_cols, order_cols, close="close", high="high", low="low",
            rsi_zero_loss: float | None = None, places: int | None = None) -> DataFrame:
    """The whole silver indicator set in three Window passes over one
    partitioning: previous close; running sums; their lags. Floating prices
    known to have ``places`` decimal places are added exactly, as decimals."""
    w = series_window(partition_cols, order_cols)
    scale = _bar_scale(df, close, high, low, places=places)
    c = exact(close, scale)
    df = df.withColumns({"_close": c, "_prev": F.lag(c).over(w)})
    change = F.col("_close") - F.col("_prev")
    df = df.withColumns({
        "PrctChange": _pct(F.col("_close"), F.col("_prev")),
        "_tr": _true_range(exact(high, scale), exact(low, scale), F.col("_prev")),
        **{k: v for k, v in _gain_loss_cols(change).items()},
    })
    specs = ([(f"SMA{n}", "_close", n) for n in SMA_PERIODS]
             + [("_avg_gain", "gain", RSI_PERIOD), ("_avg_loss", "loss", RSI_PERIOD),
                ("ATR", "_tr", ATR_PERIOD), ("_ms", "_close", MACD_SHORT), ("_ml", "_close", MACD_LONG)])
    df = add_means(df, w, specs, scale)
    df = df.withColumns({
        "Direction": direction_col(F.col("PrctChange")),
        "RSI": _rsi_col(F.col("_avg_gain"), F.col("_avg_loss"), rsi_zero_loss),
        "MACD": F.col("_ms") - F.col("_ml"),
    })
    df = df.drop("_close", "_prev", "_tr", "gain", "loss", "_avg_gain", "_avg_loss", "_ms", "_ml")
    return df.select(*[c for c in df.columns if c not in SILVER_COLUMNS], *SILVER_COLUMNS)


# --- physical strategies -------------------------------------------------------

def largest_series(df: DataFrame, partition_cols: Sequence[str]) -> int:
    """Row count of the biggest series."""
    sizes = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n"))
    return int(sizes.agg(F.max("n")).first()[0] or 0)


def placed(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """``df`` stored in the order of (series, order columns), with ``_part`` (its
    range) and ``_place``, which grows in that order throughout the table.

    The ranges are cut at quantiles of (series, order columns, hash of the row),
    so a long series takes many tasks, whether its rows are years or microseconds
    apart, and rows of equal order too unless they are equal throughout. They
    come from a sample, which only decides how even the ranges are; the table is
    stored, so a task that is run again finds the places as they were."""
    ties = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [*[F.col(c) for c in [*partition_cols, *order_cols]], F.col("_ties")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.withColumn("_ties", ties).repartitionByRange(n, *keys)
            .sortWithinPartitions(*keys).drop("_ties"))
    return materialise(rows.withColumns({"_part": F.spark_partition_id(),
                                         "_place": F.monotonically_increasing_id()}), "placed")


def chunked(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
            compute: Callable[[DataFrame, list[str], list[str]], DataFrame], lookback: int,
            chunk_rows: int = 8192) -> DataFrame:
    """Run ``compute(df, partition_cols, order_cols)`` on halo-extended chunks of
    exactly ``chunk_rows`` rows (the last of a series: what is left).

    1. ``placed`` stores the rows in order. Within a range the rows of a series
       are consecutive, so a row's place less the first one of its (series,
       range) counts the rows before it there;
    2. one aggregate of at most (series + ranges) rows gives the rows of each
       series in each range, and their running sum the offset of the range. With
       it every row knows its position ``p`` in its series;
    3. a row belongs to chunk ``floor(p / C)``, and is also sent to the next one
       when it is among the last ``lookback`` of its chunk;
    4. the rows are shuffled by (series, chunk), ``compute`` runs with the chunk
       as a further key and the place as the last ordering, so that ties come
       alike in both copies, and halo rows are dropped.

    Rows without a time sort first, and rows with a null key are a series of
    their own: none is left out. The offsets are joined without a hint.
    """
    if chunk_rows < lookback:
        raise ValueError("chunk_rows must be at least the lookback")
    pcols = list(partition_cols)
    rows = placed(df, pcols, order_cols)
    before = Window.partitionBy(*pcols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    t = rows.groupBy(*pcols, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    t = t.withColumns({"_off": F.coalesce(F.sum("_n").over(before), F.lit(0)),
                       "_rows": F.sum("_n").over(Window.partitionBy(*pcols))})
    keys = [f"_k{i}" for i in range(len(pcols))]
    right = t.select(*[F.col(c).alias(k) for c, k in zip(pcols, keys)],
                     F.col("_part").alias("_at"), F.col("_off") - F.col("_first"), "_rows"
                     ).toDF(*keys, "_at", "_shift", "_rows")
    same = F.col("_part") == F.col("_at")
    for c, k in zip(pcols, keys):
        same = same & F.col(c).eqNullSafe(F.col(k))
    size = F.lit(chunk_rows)
    j = rows.join(right, same).withColumn("_p", F.col("_place") + F.col("_shift"))
    own = F.floor(F.col("_p") / size)
    halo = (F.col("_p") % size >= size - F.lit(lookback)) & ((own + 1) * size < F.col("_rows"))
    j = j.withColumn("_targets", F.when(halo, F.array(own, own + 1)).otherwise(F.array(own)))
    spread = j.drop(*keys, "_at", "_part", "_shift", "_rows", "_p").select(
        "*", F.posexplode("_targets").alias("_copy", "_chunk")).drop("_targets")
    out = compute(spread, pcols + ["_chunk"], [*order_cols, "_place"])
    return out.filter(F.col("_copy") == 0).drop("_place", "_copy", "_chunk")


def with_indicators(df: DataFrame, partition_cols: Sequence[str] = ("ticker",),
                    order_cols: Sequence[str] = ("datetime",), strategy: str = "auto",
                    chunk_rows: int = 8192, series_task_limit: int = 1_000_000,
                    rsi_zero_loss: float | None = None,
                    close="close", high="high", low="low", places: int | None = None) -> DataFrame:
    """Market silver: the input columns plus PrctChange, Direction, SMA20/50/200,
    RSI, ATR and MACD. Floating prices are added in doubles at any magnitude, or
    exactly where they are known to have ``places`` decimal places."""
    pcols, ocols = list(partition_cols), list(order_cols)

    def compute(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        return add_all(frame, keys, order, close, high, low, rsi_zero_loss, places)

    if strategy == "auto":
        strategy = "chunked" if largest_series(df, pcols) > series_task_limit else "partition"
    if strategy == "partition":
        return compute(df, pcols, ocols)
    if strategy == "chunked":
        return chunked(df, pcols, ocols, compute, lookback_rows(), chunk_rows)
    raise ValueError(f"unknown strategy {strategy!r}")


# Bronze metadata the silver job discards.
BRONZE_ONLY = ["interval", "scraped_at"]


#: Decimal places that the ingest layer rounds prices to.
BRONZE_PLACES = 2


def market_silver_from_bronze(bronze: DataFrame, strategy: str = "auto",
                              places: int | None = BRONZE_PLACES, **kwargs) -> DataFrame:
    """The silver job on bronze bars as the ingest layer stores them: text
    ``datetime`` parsed (malformed text becomes null and sorts first), bronze
    metadata dropped, indicators added per ticker. ``places`` None: bronze whose
    prices were not rounded."""
    from marketpulse.operators.ingest import drop_columns, parse_bar_time
    bars = drop_columns(parse_bar_time(bronze), BRONZE_ONLY)
    return with_indicators(bars, ["ticker"], ["datetime"], strategy=strategy, places=places, **kwargs)
