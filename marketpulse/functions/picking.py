"""First/last row of a group by an ordering, kept hash-aggregatable.

``min_by``/``max_by`` hold their ordering value and result in the
aggregation buffer. A struct there forces a sort-based aggregate, while
fixed-width values (numbers, decimals, dates, timestamps) allow a hash
aggregate. So the ordering is reduced to one fixed-width value where
possible (a single column, or (timestamp, integer tie breaker) packed into a
decimal), and the picked columns are taken one ``min_by``/``max_by`` each
when they are fixed-width. All of those compare the same ordering values in
the same merge order, so they pick their values from one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, IntegralType, MapType, NumericType,
                               TimestampNTZType, TimestampType)

from marketpulse.functions.windowing import packed_order


def fixed_width(dt: DataType) -> bool:
    return isinstance(dt, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))


def order_key(df: DataFrame, order_cols: Sequence[str], last: bool = True) -> Column:
    """One comparable value for the ordering ``order_cols``, never null: a row
    with a null in it loses to every row without, for the last as for the first
    (``last`` says which is wanted)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(order_cols)
    if len(cols) == 1 and isinstance(types[cols[0]], (TimestampType, TimestampNTZType, DateType, IntegralType)):
        return _wide(F.col(cols[0]), types[cols[0]], last)
    if (len(cols) == 2 and isinstance(types[cols[0]], (TimestampType, TimestampNTZType))
            and isinstance(types[cols[1]], IntegralType)):
        edge = -1 if last else 1
        micros = F.coalesce(F.unix_micros(F.col(cols[0]).cast("timestamp")), F.lit(edge * 9 * 10 ** 16))
        return packed_order(F.timestamp_micros(micros), F.coalesce(
            F.col(cols[1]).cast("long"), F.lit(-2 ** 63 if last else 2 ** 63 - 1)))
    known = (lambda c: F.col(c).isNotNull()) if last else (lambda c: F.col(c).isNull())
    return F.struct(*[x for c in cols for x in (known(c).alias(f"_{c}"), F.col(c))])


def _wide(col: Column, kind: DataType, last: bool) -> Column:
    """A whole number as decimal(20,0), null beyond all longs."""
    if isinstance(kind, DateType):
        col = F.unix_date(col)
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        col = F.unix_micros(col.cast("timestamp"))
    return F.coalesce(col.cast("decimal(20,0)"), F.expr(f"cast('{'-' if last else ''}{2 ** 63 + 1}' as decimal(20,0))"))


def pick(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
         value_cols: Sequence[str], last: bool = True) -> DataFrame:
    """Per group, ``value_cols`` of the row that is last (or first) in the
    ordering. Partially aggregated before the shuffle, so a group holding a
    large share of all rows ships one row per map task.

    Nulls in the ordering lose. Of rows that are equal in it, the one whose
    values hash lowest (or highest, for the last) is taken, whatever order they
    are read in."""
    fn = F.max_by if last else F.min_by
    key = order_key(df, order_cols, last)
    types = {f.name: f.dataType for f in df.schema.fields}
    tie = F.xxhash64(*[F.col(c) for c in value_cols if not isinstance(types[c], MapType)])
    kind = df.select(key.alias("k")).schema["k"].dataType
    if isinstance(kind, DecimalType) and kind.precision == 20:   # 64 bits of order, 61 of hash
        key = (key * F.expr(f"cast('{2 ** 61}' as decimal(19,0))")
               + F.shiftrightunsigned(tie, 3).cast("decimal(19,0)")).cast("decimal(38,0)")
    elif not isinstance(kind, DecimalType):
        key = F.struct(key.alias("order"), tie.alias("tie"))
    keyed = df.withColumn("_ord", key)
    if all(fixed_width(types[c]) for c in value_cols) and fixed_width(keyed.schema["_ord"].dataType):
        return keyed.groupBy(*group_cols).agg(*[fn(c, "_ord").alias(c) for c in value_cols])
    agg = keyed.groupBy(*group_cols).agg(fn(F.struct(*value_cols), "_ord").alias("_row"))
    return agg.select(*group_cols, *[F.col(f"_row.{c}").alias(c) for c in value_cols])
