"""Readers and writers: formats as parameters, JSON documents, partitioned round trip."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marketpulse.session import scratch_path
from marketpulse.sources import tables as S
from marketpulse.sources.sinks import write_json, write_table

POST = StructType([StructField("id", StringType()), StructField("author", StringType()),
                   StructField("score", LongType())])


def test_json_array_of_posts(spark):
    """A file holding one JSON array of post objects (the enricher's input)."""
    path = scratch_path(spark, "t-posts-json")
    os.makedirs(path)
    with open(os.path.join(path, "posts.json"), "w") as fh:
        json.dump([{"id": "a", "author": "x", "score": 3, "extra": 1},
                   {"id": "b", "author": None, "score": None}], fh, indent=2)
    df = S.read_json_documents(spark, path, POST)
    assert sorted(tuple(r) for r in df.collect()) == [("a", "x", 3), ("b", None, None)]


def test_collection_round_trip_in_several_formats(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit("u").alias("author"),
                                F.col("id").alias("score"))
    for fmt in ("parquet", "json", "orc"):
        path = scratch_path(spark, f"t-coll-{fmt}")
        write_table(df, path, fmt=fmt, partition_by=["author"])
        back = S.read_collection(spark, path, fmt=fmt, schema=POST)
        assert back.count() == 20 and back.select("score").agg(F.sum("score")).first()[0] == 190


def test_json_sink_and_stream_reader(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit("u").alias("author"),
                               F.col("id").alias("score"))
    path = scratch_path(spark, "t-json-sink")
    write_json(df, path)
    stream = S.read_collection_stream(spark, path, POST, fmt="json", max_files_per_trigger=1)
    assert stream.isStreaming
    out = scratch_path(spark, "t-json-out")
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "t-json-chk"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.schema(POST).parquet(out).count() == 5
