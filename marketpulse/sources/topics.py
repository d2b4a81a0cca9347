"""Message topics as stream source and sink.

The broker's connector brings its own schema (key, value, topic, partition,
offset, timestamp), so a topic stream is read without one; ``value`` goes to
``ingest.parse_messages`` or ``streaming.jobs.ingest_topics``. The functions
that build the options need no broker and are tested as such.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketpulse.operators.ingest import to_message

FORMAT = "kafka"


def source_options(servers: str | Sequence[str], topics: str | Sequence[str], starting: str = "earliest",
                   max_per_trigger: int | None = None, group_prefix: str | None = None,
                   fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of a subscription to some topics (several names, or one pattern
    that begins with ``^``)."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if not names:
        raise ValueError("no topic")
    pattern = len(names) == 1 and names[0].startswith("^")
    out = {"kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
           "subscribePattern" if pattern else "subscribe": ",".join(names),
           "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group_prefix:
        out["groupIdPrefix"] = group_prefix
    return out


def sink_options(servers: str | Sequence[str], topic: str | None = None, acks: str = "all",
                 retries: int = 3) -> dict[str, str]:
    """Options of a topic sink; without ``topic`` the rows name theirs."""
    out = {"kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
           "kafka.acks": acks, "kafka.retries": str(retries)}
    return out | ({"topic": topic} if topic else {})


def read_topics(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """(topic, key, value as text, timestamp) of subscribed topics."""
    reader = spark.readStream if streaming else spark.read
    raw = reader.format(FORMAT).options(**options).load()
    return raw.select("topic", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"), "timestamp")


def publish(df: DataFrame, options: dict[str, str], checkpoint: str, key: str | None = None,
            topic: str | None = None, fields: Sequence[str] | None = None):
    """A stream's rows as messages to a topic (a writer to be started)."""
    rows = to_message(df, key, topic, fields)
    return (rows.writeStream.format(FORMAT).options(**options)
            .option("checkpointLocation", checkpoint).outputMode("append"))


#: Bytes of the largest message (key and value) that a broker takes by default.
LARGEST = 1_000_000


def outcomes(df: DataFrame, key: str, topic: str, fields: Sequence[str] | None = None,
             largest: int = LARGEST) -> DataFrame:
    """``to_message`` rows with ``reason``: null for a message that can be sent,
    else ``no key``, ``not encoded`` (no field has a value) or ``too large``."""
    rows = to_message(df, key, topic, fields)
    size = F.octet_length("value") + F.octet_length(F.coalesce("key", F.lit("")))
    return rows.withColumn("reason", F.when(F.col("key").isNull() | (F.col("key") == ""), "no key")
                           .when(F.col("value").isNull() | (F.col("value") == "{}"), "not encoded")
                           .when(size > largest, "too large"))


def publish_batch(df: DataFrame, dead: str, key: str, topic: str, fields: Sequence[str] | None = None,
                  fmt: str = FORMAT, options: dict[str, str] | None = None, largest: int = LARGEST) -> dict[str, int]:
    """Sends a batch (or micro-batch) to a topic; what cannot be sent is appended to
    the dead-letter table ``dead`` with its reason. Returns the number ``sent``
    and of each reason, observed on the writes themselves. The dead letters are
    written first: a failed send fails the call, and the batch again sends all."""
    rows = outcomes(df, key, topic, fields, largest).persist()
    reasons = ("no key", "not encoded", "too large")
    try:
        rejected, sent = Observation("rejected"), Observation("sent")
        bad = rows.filter("reason is not null").observe(
            rejected, *[F.count_if(F.col("reason") == r).alias(r) for r in reasons])
        bad.write.mode("append").parquet(dead)
        good = rows.filter("reason is null").drop("reason").observe(sent, F.count(F.lit(1)).alias("sent"))
        good.write.format(fmt).options(**(options or {})).mode("append").save()
        return {"sent": int(sent.get["sent"])} | {r: int(rejected.get[r]) for r in reasons}
    finally:
        rows.unpersist()
