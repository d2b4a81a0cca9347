"""Batch sinks: overwrite, JSON output, idempotent insert of new keys.

The reference inserts documents after fetching every stored key to the
client. Here "insert only new keys" is a ``left_anti`` join of the
(de-duplicated) incoming rows against the stored key column, with the stored
side pruned to the incoming time range first so that only the overlapping
slice of a large table is scanned (partition pruning when the table is
partitioned by date). The inserted count comes from an ``Observation`` on the
write itself, not from a second job. It stands above every other step, so that
no step above it can be found empty and be left out of the plan together with it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marketpulse.operators.ingest import keep_first


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, written: Observation | None = None, **options) -> None:
    """With ``partition_by`` the rows are brought together by partition first
    (large partitions stay split), so a task does not write into every one.
    ``written`` observes ``n``, the number of rows that go to the writer."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if written is not None:
        df = df.observe(written, F.count(F.lit(1)).alias("n"))
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, by: Sequence[str], order_cols: Sequence[str]) -> None:
    """One JSON array file for each value of ``by``, a record a line, in order.
    A file is written by one task, row by row after a sort that spills, whatever
    its size; ``arrays.read_json_array`` reads it by many."""
    w = Window.partitionBy(*by).orderBy(*order_cols)
    record = F.to_json(F.struct(*df.columns))
    line = F.concat(F.when(F.row_number().over(w) == 1, F.lit("[")).otherwise(F.lit(",")), record,
                    F.when(F.lead(F.lit(1)).over(w).isNull(), F.lit("]")).otherwise(F.lit("")))
    keys = [f"{c}_key" for c in by]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.row_number().over(w).alias("_nth"),
                     line.alias("value"))
    # the order of the writer, so that it does not sort by the keys alone
    rows.sortWithinPartitions(*keys, "_nth").drop("_nth").write.partitionBy(*keys).text(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Asks the path's Hadoop file system (``fs.defaultFS`` for a bare path)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stored_rows(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The table at ``path``; None if there is none, or only an empty folder: a
    partitioned write of no rows leaves no file that tells the columns."""
    if not table_exists(spark, path):
        return None
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def without_key(df: DataFrame, key: Sequence[str]) -> Column:
    """True for rows with a null or empty part in their key."""
    out = F.lit(False)
    for k in key:
        out = out | F.col(k).isNull()
        if isinstance(df.schema[k].dataType, StringType):
            out = out | (F.col(k) == "")
    return out


def new_rows(incoming: DataFrame, existing: DataFrame | None, key: Sequence[str],
             arrival: Sequence[str] | None = None, range_col: str | None = None,
             partition_col: str | None = None) -> DataFrame:
    """Incoming rows whose key is not stored yet, one row per key.

    Duplicates inside the incoming batch are removed first (first arrival
    wins). Rows without a key cannot be told apart and are left out; see
    ``insert_new``, which counts them. ``range_col``, a part of the key, bounds
    the stored side to the incoming min..max. When the stored table is
    partitioned by the calendar date of ``range_col`` (``partition_col``), the
    same bounds prune whole partitions at scan time (scalar subqueries are
    evaluated before the file listing)."""
    key = list(key)
    if range_col and range_col not in key:
        raise ValueError(f"{range_col!r} is not part of the key {key}: a stored row of the same "
                         "key may lie outside the incoming range")
    fresh = keep_first(incoming, key, arrival or key)
    if existing is None:
        return fresh
    stored = existing
    if range_col:
        bounds = incoming.select(F.struct(F.min(range_col).alias("lo"),
                                          F.max(range_col).alias("hi"))).scalar()
        if partition_col:
            stored = stored.filter(F.col(partition_col).between(F.to_date(bounds["lo"]),
                                                                F.to_date(bounds["hi"])))
        stored = stored.filter(F.col(range_col).between(bounds["lo"], bounds["hi"]))
    stored = stored.select(*key)
    # A stored key repeated many times collapses map-side; the aggregate's
    # hash partitioning on the key is reused by the anti-join.
    return fresh.join(stored.distinct(), key, "left_anti")


def insert_new(spark: SparkSession, incoming: DataFrame, path: str, key: Sequence[str],
               arrival: Sequence[str] | None = None, range_col: str | None = None,
               fmt: str = "parquet", partition_by: Sequence[str] | None = None,
               transform: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Appends only rows with unseen keys to the table at ``path``; returns the
    counts ``consumed``, ``inserted`` and ``keyless`` (rows without a key, which
    are not inserted). With a single ``partition_by`` column holding the date
    of ``range_col``, stored partitions outside the incoming range are not
    read. ``transform`` is applied to the new rows before they are written (it
    keeps the key)."""
    existing = stored_rows(spark, path, fmt)
    pcol = partition_by[0] if partition_by and len(partition_by) == 1 and range_col else None
    seen = incoming.agg(F.count(F.lit(1)), F.count_if(without_key(incoming, key))).first()
    done = Observation("inserted")
    rows = new_rows(incoming, existing, key, arrival, range_col, pcol)
    write_table(transform(rows) if transform else rows, path, fmt, "append", partition_by, done)
    return {"consumed": seen[0], "inserted": int(done.get["n"]), "keyless": seen[1]}


def append_new(spark: SparkSession, incoming: DataFrame, path: str, key: Sequence[str],
               arrival: Sequence[str] | None = None, range_col: str | None = None,
               fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> int:
    """``insert_new``; returns the number inserted (0 when all is there)."""
    return insert_new(spark, incoming, path, key, arrival, range_col, fmt, partition_by)["inserted"]


def append_unique(spark: SparkSession, df: DataFrame, path: str, key: Sequence[str], fmt: str = "parquet") -> None:
    """Appends ``df`` with ``key`` enforced: a row without a key, a key twice in
    ``df`` or one that is stored already fails the write, in the job that writes,
    and the table stays as it was (tasks' files become visible only when the
    whole job commits)."""
    key = list(key)
    rows = df.withColumn("_stored", F.lit(0))
    if table_exists(spark, path):
        old = spark.read.format(fmt).load(path).select(*key, F.lit(1).alias("_stored"))
        rows = rows.unionByName(old, allowMissingColumns=True)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("_stored")))
    name = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])
    bad = (F.when(without_key(df, key) & (F.col("_stored") == 0), F.raise_error(F.concat(F.lit("no key: "), name)))
           .when((F.col("_nth") > 1) & (F.col("_stored") == 0), F.raise_error(F.concat(F.lit("key occurs twice: "), name)))
           .otherwise(F.lit(True)))
    checked = rows.withColumn("_nth", nth).filter("_stored = 0").filter(bad).select(*df.columns)
    checked.write.format(fmt).mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "1").save(path)
