"""Documents dealt out in id order, without sorting the table in one place.

Buckets are ranges of ids between approximate quantiles. Rows are shuffled by
bucket and sorted within it; bucket number and order within a bucket give the
order of all. Spark's own range partitioning would read the texts a second
time to sample them; the quantiles read only the ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import partitions


def bounds(d: DataFrame) -> list[int]:
    """Ids that cut ``d`` into about four buckets for each shuffle partition."""
    n = 4 * partitions(d.sparkSession)
    found = d.agg(F.percentile_approx("doc_id", F.array(*[F.lit(k / n) for k in range(1, n)]),
                                      F.lit(10 * n))).first()[0]
    return sorted(set(found or []))


def bucket(key: Column, cut: list[int]) -> Column:
    """How many of the bounds lie below the key, found in two steps."""
    if not cut:
        return F.lit(0)
    step = math.isqrt(len(cut)) + 1
    coarse = F.array(*[F.lit(x) for x in cut[step - 1:: step]]).cast("array<bigint>")
    fine = F.array(*[F.lit(x) for x in cut]).cast("array<bigint>")
    whole = F.size(F.filter(coarse, lambda b: b < key)) * step
    return whole + F.size(F.filter(F.slice(fine, whole + 1, F.lit(step)), lambda b: b < key))


def dealt(d: DataFrame, *order: Column | str) -> DataFrame:
    """``d`` (with a column bucket) shuffled by bucket, sorted by it and ``order``."""
    return (d.repartition(partitions(d.sparkSession), "bucket")
            .sortWithinPartitions("bucket", *order))
