"""Helpers that the text operators share.

Documents come as (id, text). An operator looks at one row for each id:
rows that repeat an id are one document, whose text is the greatest of them
in byte order (a null text loses to any text), and a null id is an id of its
own that sorts before all others.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.session import scratch_path

NULL_ID = -(2 ** 63)
#: Removes a finished step's shuffle files at its end, not at a later collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, text), one row for each id; a null id becomes NULL_ID."""
    d = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                    F.col(text).cast("string").alias("text"))
    repeated = d.groupBy("doc_id").count().filter("count > 1")
    if repeated.isEmpty():
        return d
    return d.groupBy("doc_id").agg(F.max("text").alias("text"))


def one_row_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns and one row for each id: the one whose text
    ``keyed`` takes."""
    if docs.groupBy(key).count().filter("count > 1").isEmpty():
        return docs
    row = F.max_by(F.struct(*docs.columns), F.struct(F.col(text).isNotNull(), F.col(text)))
    return docs.groupBy(F.col(key).alias("key")).agg(row.alias("row")).select("row.*")


def unkeyed(df: DataFrame) -> DataFrame:
    """NULL_ID becomes null again."""
    return df.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NULL_ID)))


def text_bytes(d: DataFrame) -> int:
    return d.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a step's rows to the shared folder and reads them again: a lost
    executor costs no earlier step, and that step's shuffle files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def removed(*tables: DataFrame) -> None:
    """Deletes ``stored`` tables whose rows no later step reads: what came of them
    is stored itself."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def again(key: Column) -> Column:
    """A key of equal meaning that Spark deals out anew: the join's input is
    then an exchange of its own, whose hot partitions Spark can split."""
    return F.bitwise_not(key)


def int_array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def tidy(fn: Callable) -> Callable:
    """``mapInArrow`` function that gives freed memory back to the system at its
    end: a worker waits for its next task with little."""
    @functools.wraps(fn)
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
                ctypes.CDLL(None).malloc_trim(0)
    return run
