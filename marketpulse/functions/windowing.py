"""Window helpers shared by the indicator operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType


def price_scale(df: DataFrame, column: str) -> int | None:
    """Decimal places of a price column: its type's, 0 for integers, None for
    floating point and text, which are computed in doubles at any magnitude."""
    kind = df.schema[column].dataType
    if isinstance(kind, DecimalType):
        return kind.scale
    return 0 if isinstance(kind, IntegralType) else None


def exact(column: str | Column, scale: int | None) -> Column:
    """A price as a decimal of ``scale`` places, or as a double without one."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("double" if scale is None else f"decimal(28,{scale})")


def series_window(partition_cols: Sequence[str], order_cols: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*partition_cols).orderBy(*order_cols)


def _whole_sums(df: DataFrame, w: WindowSpec, specs, scale: int) -> tuple[DataFrame, dict, list[str]]:
    """Trailing sums as differences of a running sum of whole units."""
    unit = 10 ** scale
    whole = "long" if scale <= 4 else "decimal(38,0)"
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sources = sorted({src for _, src, _ in specs})
    df = df.withColumns({f"_u_{s}": (F.col(s) * F.lit(unit)).cast(whole) for s in sources})
    df = df.withColumns({f"_S_{s}": F.coalesce(F.sum(f"_u_{s}").over(run), F.lit(0)) for s in sources})
    sums = {out: (F.col(f"_S_{src}") - F.lag(f"_S_{src}", n, 0).over(w)).cast("double") / F.lit(float(unit))
            for out, src, n in specs}
    return df, sums, [f"_{k}_{s}" for s in sources for k in "uS"]


def _double_sums(df: DataFrame, w: WindowSpec, specs) -> tuple[DataFrame, dict, list[str]]:
    """Trailing sums of doubles by doubling: the sum of 2^k rows is that of the
    last 2^(k-1) and of as many before them, and a frame of n rows is put
    together from the powers in n. Nothing is subtracted, so no digits cancel,
    and a value outside the frame (NaN too) has no part in it."""
    bits: dict[str, int] = {}
    for _, src, n in specs:
        bits[src] = max(bits.get(src, 0), n.bit_length())
    df = df.withColumns({f"_p0_{s}": F.coalesce(F.col(s).cast("double"), F.lit(0.0)) for s in bits})
    for k in range(1, max(bits.values())):
        half = 1 << (k - 1)
        df = df.withColumns({f"_p{k}_{s}": F.col(f"_p{k - 1}_{s}") + F.lag(f"_p{k - 1}_{s}", half, 0.0).over(w)
                             for s in bits if k < bits[s]})
    sums = {}
    for out, src, n in specs:
        total, back = None, 0
        for k in reversed(range(n.bit_length())):
            if n >> k & 1:
                part = F.lag(f"_p{k}_{src}", back, 0.0).over(w) if back else F.col(f"_p{k}_{src}")
                total = part if total is None else total + part
                back += 1 << k
        sums[out] = total
    return df, sums, [f"_p{k}_{s}" for s in bits for k in range(bits[s])]


def add_means(df: DataFrame, w: WindowSpec, specs: Sequence[tuple[str, str, int]],
              scale: int | None = 2) -> DataFrame:
    """Trailing means ``out = mean(src over the last n rows)`` for every
    ``(out, src, n)``, averaging whatever rows exist during warm-up.

    A ``src`` with ``scale`` decimal places is taken as an integer of its
    smallest unit, a running sum S and running count C are formed once per
    source, and the frame sum is ``S - lag(S, n)``: O(rows) whatever the frame
    length. Only the final division is floating point, so the result equals
    sum(decimal) / count over the frame bit for bit, and it does not depend on
    the order the engine adds a frame up. Doubles (``scale`` None) are added by
    doubling, O(rows x log n), to within rounding of the last place at any
    magnitude. Either way a frame reaches n rows back and no further, so
    halo-chunked evaluation gives the same bits. Null values are skipped; a
    frame of nulls only has no mean."""
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sources = sorted({src for _, src, _ in specs})
    df, sums, used = _double_sums(df, w, specs) if scale is None else _whole_sums(df, w, specs, scale)
    df = df.withColumns({f"_C_{s}": F.count(s).over(run) for s in sources})
    means = {}
    for out, src, n in specs:
        count = F.col(f"_C_{src}") - F.lag(f"_C_{src}", n, 0).over(w)
        means[out] = F.try_divide(sums[out], count.cast("double"))
    df = df.withColumns(means)
    return df.drop(*used, *[f"_C_{s}" for s in sources])


def packed_order(ts: Column, tie: Column) -> Column:
    """Order-preserving single value for (timestamp, signed long tie breaker).

    decimal(38,0) = (epoch micros + 10^17) * 10^20 + (tie + 2^63). Decimals are
    mutable aggregation buffers, so ``min_by``/``max_by`` over this key stay in
    a hash aggregate (a struct key forces a sort-based aggregate). Valid for
    times within about +-3000 years of 1970 and any long tie breaker."""
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    shift_t = F.lit(10 ** 17).cast("decimal(18,0)")
    scale = F.expr("cast('100000000000000000000' as decimal(21,0))")
    shift_k = F.expr("cast('9223372036854775808' as decimal(20,0))")
    return ((micros + shift_t) * scale + (tie.cast("decimal(20,0)") + shift_k)).cast("decimal(38,0)")


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null when b is zero or null (ANSI-safe)."""
    return F.try_divide(a, b)
