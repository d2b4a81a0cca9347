"""Distinct counts that add up: HyperLogLog sketches.

An exact distinct count cannot be put together from the counts of its days.
Sketches can: one for each day and group is stored once, and any range of
days, any set of groups, is a union of sketches of a few kilobytes each. With
``lg_k`` = 12 the relative standard error is about 1.6 % (``error``), and small
counts are exact or nearly so. ``exact`` is the exact form over the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's number of registers.
LG_K = 12


def error(lg_k: int = LG_K) -> float:
    """Relative standard error of a large count."""
    return 1.04 / math.sqrt(2 ** lg_k)


def daily(rows: DataFrame, groups: Sequence[str], value: str, ts: str, lg_k: int = LG_K) -> DataFrame:
    """(day, groups, sketch) of the distinct values; nulls are not counted, rows
    without a time have the day null. Sketches are built task by task and then
    merged, so a group of most rows sends one sketch a task."""
    return (rows.filter(F.col(value).isNotNull()).groupBy(F.to_date(ts).alias("day"), *groups)
            .agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch")))


def merged(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, sketch): the union of stored sketches."""
    return sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, groups: Sequence[str] = (), name: str = "n") -> DataFrame:
    """(groups, n): about how many distinct values the sketches of a group hold."""
    return merged(sketches, groups).select(*groups, F.hll_sketch_estimate("sketch").alias(name))


def exact(rows: DataFrame, groups: Sequence[str], value: str, name: str = "n") -> DataFrame:
    """(groups, n): the exact count, from the rows."""
    return rows.select(*groups, value).distinct().groupBy(*groups).agg(F.count(value).alias(name))
