"""Batch and streaming scans of stored tables.

The reference reads named document collections; here a table is a directory
of files in some format (Parquet by default). Readers take an explicit schema
whenever one is known so that wide columns are never inferred or read when a
query does not need them (Catalyst prunes columns down to the scan).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_collection(spark: SparkSession, path: str, fmt: str = "parquet",
                    schema: StructType | None = None, **options) -> DataFrame:
    """Batch scan of a stored collection in any format Spark can read.

    ``fmt`` may name a connector (``mongodb``, ``kafka``, ...) when its package
    is deployed; options are passed through unchanged.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_collection_stream(spark: SparkSession, path: str | None, schema: StructType | None = None,
                           fmt: str = "parquet", max_files_per_trigger: int | None = None,
                           **options) -> DataFrame:
    """Streaming scan of a collection; file sources need the schema up front,
    sources with a schema of their own take none."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path) if path else reader.load()


def read_json_documents(spark: SparkSession, path: str, schema: StructType,
                        multiline: bool = True) -> DataFrame:
    """JSON files holding whole documents (an array of posts or a snapshot)."""
    return spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)
