"""Bronze-layer operators: normalise, route, filter, de-duplicate, union.

All of them are narrow transformations or partially aggregated group-bys:
de-duplication is ``min_by(row, arrival)`` per key, which collapses each key
map-side before the shuffle, so even a key repeated in a third of all rows
ships one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

from marketpulse.functions.picking import pick

# Vendor column names and the bronze names they map to.
VENDOR_RENAMES = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume"}
VENDOR_DROPPED = ["Dividends", "Stock Splits"]
BAR_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"


def find_datetime_column(df: DataFrame) -> str:
    """``Date`` if present, else the first date/time typed column."""
    if "Date" in df.columns:
        return "Date"
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType, DateType)):
            return f.name
    raise ValueError(f"no date or time column among {df.columns}")


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Half-up rounding on the decimal text of a double (0.125 -> 0.13)."""
    return F.round(c, scale)


def normalise_ohlcv(df: DataFrame, metadata: dict | None = None, date_only: bool = False) -> DataFrame:
    """Vendor OHLCV frame -> bronze bar: ``datetime`` text (``date_only``: a day
    in ``date``), prices rounded to 2 decimals, integer volume, vendor-only
    columns dropped, metadata added."""
    ts = find_datetime_column(df)
    text = (F.date_format(F.col(ts), DAY_FORMAT).alias("date") if date_only
            else F.date_format(F.col(ts), BAR_TIME_FORMAT).alias("datetime"))
    cols = []
    for name in df.columns:
        if name == ts:
            cols.append(text)
        elif name in VENDOR_RENAMES:
            dst = VENDOR_RENAMES[name]
            c = F.col(f"`{name}`")
            cols.append((c.cast("long") if dst == "volume" else round_half_up(c, 2)).alias(dst))
        elif name not in VENDOR_DROPPED:
            cols.append(F.col(f"`{name}`"))
    out = df.select(*cols)
    if metadata:
        out = with_metadata(out, metadata)
    return out


def with_metadata(df: DataFrame, metadata: dict) -> DataFrame:
    """Attach constant fields to every record."""
    return df.withColumns({k: F.lit(v) for k, v in metadata.items()})


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop a list of columns, ignoring names that are not present."""
    return df.drop(*[c for c in cols if c in df.columns])


def parse_bar_time(df: DataFrame, col: str = "datetime") -> DataFrame:
    """Bronze text time -> timestamp; malformed text becomes null."""
    return df.withColumn(col, F.try_to_timestamp(F.col(col), F.lit(BAR_TIME_FORMAT)))


def keep_first(df: DataFrame, key: Sequence[str], arrival: Sequence[str],
               drop_empty_key: bool = True) -> DataFrame:
    """First record per key in arrival order (later copies are dropped).

    A ``min_by`` per key (``functions.picking.pick``): partial aggregation
    removes copies before the shuffle, so a key repeated in a large share of
    all rows ships one row per map task."""
    key = list(key)
    if drop_empty_key:
        for k in key:
            df = df.filter(F.col(k).isNotNull())
            if dict(df.dtypes)[k] == "string":
                df = df.filter(F.col(k) != "")
    rest = [c for c in df.columns if c not in key]
    return pick(df, key, list(arrival), rest, last=False).select(*df.columns)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate chunks / per-source lists; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (must be empty for a unique key)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


#: Column that holds the text of a message that does not parse.
CORRUPT = "_corrupt"


def parse_messages(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """``messages`` with ``_m`` (the parsed fields) and ``_bad``: true for null
    and malformed text and for fields of another type; ``{}`` is a message
    without fields."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json(F.col(value), full, {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": CORRUPT})
    with_fields = messages.withColumn("_m", parsed)
    bad = F.col(value).isNull() | F.col("_m").isNull() | F.col(f"_m.{CORRUPT}").isNotNull()
    return with_fields.withColumn("_bad", bad)


def route(messages: DataFrame, schemas: dict[str, StructType], topic: str = "topic",
          value: str = "value") -> dict[str, DataFrame]:
    """Split a topic table into one parsed frame per topic.

    Each frame has the topic's fields plus ``_bad`` (value did not parse)."""
    out = {}
    for name, schema in schemas.items():
        parsed = parse_messages(messages.filter(F.col(topic) == name), schema, value)
        out[name] = parsed.select(*[F.col(f"_m.{f}") for f in schema.fieldNames()], "_bad")
    return out


def rejects(messages: DataFrame, schemas: dict[str, StructType], topic: str = "topic",
            value: str = "value") -> DataFrame:
    """(topic, value) of the messages that no route takes: those that do not
    parse, and those of a topic without a schema."""
    known = F.coalesce(F.col(topic).isin(list(schemas)), F.lit(False))
    out = messages.filter(~known).select(topic, value)
    for name, schema in schemas.items():
        parsed = parse_messages(messages.filter(F.col(topic) == name), schema, value)
        out = out.unionByName(parsed.filter("_bad").select(topic, value))
    return out


def to_message(df: DataFrame, key: str | None, topic: str | None = None,
               fields: Sequence[str] | None = None) -> DataFrame:
    """Rows -> (key, value JSON[, topic]) as a broker sink expects."""
    fields = list(fields or df.columns)
    cols = [F.to_json(F.struct(*fields)).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)
