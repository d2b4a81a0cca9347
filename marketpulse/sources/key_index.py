"""Unique inserts by a hash-bucketed key index beside the table.

A table with an index is a folder of two:

* ``rows/batch=<token>/``: the rows that a batch inserted;
* ``keys/bits=<b>/bucket=<n>/``: (hash, key columns, token) of every stored key,
  in 2**b buckets by the first bits of the key's hash; each file is sorted by
  hash and carries a Parquet Bloom filter of its hashes.

A batch reads the buckets that its own keys fall in and no others; in them, the
Bloom filters and the hash ranges of row groups rule out most of what is
there. A bucket holds about ``bucket_keys`` keys: when there are more, the index
is written anew with eight times the buckets, which costs every key a constant
number of rewrites per eightfold growth. From ``MANY_BITS`` on, more buckets are
made only when they hold about ``BUCKET_KEYS`` keys however large the table gets,
as opening a file takes longer than reading so many. Buckets of more than
``RUNS`` files are put together on the way. So what a batch reads depends on its
own size, not on the table's. Files are listed by Spark's tasks, many folders a
task, and the folder is read as a whole when a batch has keys in all buckets.

Failures: rows are written before their keys, into the batch's own folder, and
the token of the batch in flight is on record. The same batch again replaces
its rows (keys with its own token do not count as stored); another batch first
finishes what it finds on record: it adds the keys of rows that are whole and
deletes rows that are not. A key may stand in the index twice, which changes
nothing. One writer at a time, as with any micro-batch sink.

Defined cases: rows with a null or empty part in their key are counted and not
inserted; of equal keys in a batch the first by ``arrival`` (nulls last) wins;
an empty batch writes no rows.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.operators.ingest import keep_first
from marketpulse.sources.files import Files
from marketpulse.sources.sinks import without_key

#: Keys in a bucket (about), files in it before they are put together, and
#: bits of the bucket number at first, added at each growth, and from which on
#: a bucket has to hold BUCKET_KEYS keys before there are more.
BUCKET_KEYS, RUNS, FIRST_BITS, MORE_BITS, MANY_BITS = 50_000, 8, 4, 3, 10
#: Largest number of hashes that are handed to the Parquet reader.
PUSHED = 500
_PUSHDOWN = "spark.sql.parquet.pushdown.inFilterThreshold"
#: Tasks that list the folders of the index; by default it is one for each folder.
LISTERS = 64
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _setting(spark: SparkSession, name: str, value: int):
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class IndexedTable:
    """A stored table of unique keys."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], bucket_keys: int = BUCKET_KEYS):
        self.spark, self.key, self.files = spark, list(key), Files(spark)
        self.bucket_keys = bucket_keys
        self.rows, self.keys = f"{path}/rows", f"{path}/keys"
        self._record, self._meta = f"{path}/in-flight", f"{path}/index.json"

    # --- state ---------------------------------------------------------------

    def meta(self) -> dict:
        """Bits of the bucket numbers and (about) the number of keys."""
        return json.loads(self.files.read_safe(self._meta) or json.dumps({"bits": FIRST_BITS, "keys": 0}))

    def read(self, schema=None) -> DataFrame:
        """All stored rows."""
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.option("basePath", self.rows).parquet(self.rows).drop("batch")

    def _hashed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*self.key))

    @staticmethod
    def _bucket(bits: int):
        return F.shiftrightunsigned(F.col("_hash"), 64 - bits)

    def _folder(self, bits: int, bucket: int | None = None) -> str:
        return f"{self.keys}/bits={bits}" + ("" if bucket is None else f"/bucket={bucket}")

    def _load(self, paths: list[str], bits: int) -> DataFrame:
        with _setting(self.spark, _LISTERS, LISTERS):
            return self.spark.read.option("basePath", self._folder(bits)).parquet(*paths)

    def _found(self, bits: int, buckets: list[int]) -> dict[int, dict[str, int]]:
        """Paths and sizes of the files of some buckets. Many buckets are listed by
        Spark, which reads no content here."""
        if len(buckets) <= LISTERS:
            return {b: self.files.sizes(self._folder(bits, b)) for b in buckets}
        found: dict[int, dict[str, int]] = {b: {} for b in buckets}
        if self.files.exists(self._folder(bits)):
            with _setting(self.spark, _LISTERS, LISTERS):
                files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self._folder(bits))
                for r in files.select("bucket", "path", "length").collect() if "bucket" in files.columns else []:
                    if r["bucket"] in found:
                        found[r["bucket"]][r["path"]] = r["length"]
        return found

    # --- writing the index -----------------------------------------------------

    def _put(self, keys: DataFrame, bits: int, n: int) -> None:
        """Appends (hash, key columns, token) of ``n`` keys to the buckets."""
        (keys.withColumn("bucket", self._bucket(bits)).repartition("bucket").sortWithinPartitions("bucket", "_hash")
         .write.mode("append").partitionBy("bucket")
         .option("parquet.bloom.filter.enabled#_hash", "true")
         .option("parquet.bloom.filter.expected.ndv#_hash", str(max(self.bucket_keys, math.ceil(n / 2 ** bits))))
         .parquet(self._folder(bits)))

    def _full(self, bits: int) -> int:
        """Number of keys beyond which 2**bits buckets are too few."""
        return (self.bucket_keys if bits < MANY_BITS else max(self.bucket_keys, BUCKET_KEYS)) * 2 ** bits

    def _grow(self, meta: dict, more: int) -> dict:
        """More buckets where the ones there are would be too full with ``more`` keys."""
        bits = meta["bits"]
        while meta["keys"] + more > self._full(bits):
            bits += MORE_BITS
        if bits != meta["bits"]:
            old = self._folder(meta["bits"])
            self.files.delete(self._folder(bits))      # of a growth that did not end
            if self.files.exists(old):
                self._put(self._load([old], meta["bits"]).drop("bucket"), bits, meta["keys"])
            meta = {"bits": bits, "keys": meta["keys"]}
            self.files.write(self._meta, json.dumps(meta))
            self.files.delete(old)
        return meta

    def _together(self, bits: int, found: dict[int, dict[str, int]], n: int) -> None:
        """Writes buckets of many files as one file each and deletes those; ``n``:
        keys of the whole index."""
        many = [p for files in found.values() if len(files) > RUNS for p in files]
        if many:
            self._put(self._load(many, bits).drop("bucket").distinct(), bits, n)
            for p in many:
                self.files.delete(p)

    def _index(self, token: str, meta: dict, inserted: int | None = None) -> dict:
        """Adds the keys of a batch's stored rows."""
        rows = self.spark.read.parquet(f"{self.rows}/batch={token}")
        keys = self._hashed(rows.select(*self.key)).withColumn("token", F.lit(token))
        n = rows.count() if inserted is None else inserted
        meta = self._grow(meta, n)
        self._put(keys, meta["bits"], n)
        meta = {"bits": meta["bits"], "keys": meta["keys"] + n}
        self.files.write(self._meta, json.dumps(meta))
        return meta

    def _finish(self, token: str, meta: dict) -> dict:
        """What another batch left unfinished."""
        left = self.files.read_safe(self._record)
        if left and left != token:
            rows = f"{self.rows}/batch={left}"
            if self.files.exists(f"{rows}/_SUCCESS"):
                meta = self._index(left, meta)
            else:
                self.files.delete(rows)
            self.files.delete(self._record)
        return meta

    # --- inserting -----------------------------------------------------------------

    def stored(self, fresh: DataFrame, meta: dict, token: str) -> tuple[DataFrame | None, dict]:
        """The stored keys in the buckets of ``fresh`` (with _hash), and what reading
        them takes: buckets, files and bytes."""
        bits = meta["bits"]
        some = fresh.select(self._bucket(bits).alias("b")).distinct().collect()   # at most 2**bits numbers
        found = self._found(bits, [r["b"] for r in some])
        if any(len(f) > RUNS for f in found.values()):
            self._together(bits, found, meta["keys"])
            found = self._found(bits, list(found))
        files = {p: n for sizes in found.values() for p, n in sizes.items()}
        cost = {"buckets": len(found), "index_files": len(files), "index_bytes": sum(files.values())}
        if not files:
            return None, cost
        paths = [self._folder(bits)] if len(found) == 2 ** bits else sorted(files)
        return self._load(paths, bits).filter(F.col("token") != token), cost

    def insert(self, batch: DataFrame, arrival: Sequence[str] | None = None, token: str | None = None,
               transform: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
        """Inserts the rows whose key is not stored; returns ``consumed``,
        ``inserted``, ``keyless``, ``buckets``, ``index_files`` and ``index_bytes``
        (what of the index the batch looks at). ``token`` names the batch: the
        same batch again, after a failure, replaces what it wrote."""
        token = token or uuid.uuid4().hex
        meta = self._finish(token, self.meta())
        batch = batch.persist()
        try:
            seen = batch.agg(F.count(F.lit(1)), F.count_if(without_key(batch, self.key))).first()
            out = {"consumed": seen[0], "inserted": 0, "keyless": seen[1], "buckets": 0, "index_files": 0, "index_bytes": 0}
            if seen[0] == seen[1]:
                return out
            fresh = self._hashed(keep_first(batch, self.key, arrival or self.key))
            known, cost = self.stored(fresh, meta, token)
            out |= cost
            if known is not None:
                fresh = self._new(fresh, known)
            fresh = fresh.drop("_hash")
            target = f"{self.rows}/batch={token}"
            self.files.write(self._record, token)
            self._write(transform(fresh) if transform else fresh, target)
            out["inserted"] = self.spark.read.parquet(target).count()
            if out["inserted"]:
                self._index(token, meta, out["inserted"])
            else:
                self.files.delete(target)
            self.files.delete(self._record)
            return out
        finally:
            batch.unpersist()

    @staticmethod
    def _write(rows: DataFrame, target: str) -> None:
        # longer lists of values would be handed over as a range
        with _setting(rows.sparkSession, _PUSHDOWN, PUSHED):
            rows.write.mode("overwrite").parquet(target)

    def _new(self, fresh: DataFrame, known: DataFrame) -> DataFrame:
        """Rows of ``fresh`` that are not ``known``. The hashes of a small batch go
        to the Parquet reader, which skips what its Bloom filters rule out."""
        few = fresh.select("_hash").limit(PUSHED + 1).collect()
        if len(few) <= PUSHED:
            known = known.filter(F.col("_hash").isin([r[0] for r in few]))
        return fresh.join(known.select("_hash", *self.key).distinct(), ["_hash", *self.key], "left_anti")


def insert_indexed_stream(spark: SparkSession, stream: DataFrame, table: IndexedTable, checkpoint: str,
                          arrival: Sequence[str] | None = None, counts: list | None = None,
                          transform: Callable[[DataFrame], DataFrame] | None = None, **trigger):
    """``table.insert`` for every micro-batch. A batch's token holds the query's
    id, which its checkpoint keeps: a replay replaces, and a new checkpoint (its
    numbers start at 0 again) never takes another query's batch for its own."""
    from marketpulse.streaming.jobs import query_id, run

    def write_batch(batch: DataFrame, n: int) -> None:
        done = table.insert(batch, arrival, f"{query_id(spark, checkpoint)}-{n}", transform)
        if counts is not None:
            counts.append(done)

    return run(stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), **trigger)
