"""Large JSON array files, read by many tasks.

``multiLine`` JSON gives a whole file to one task, which parses it in memory.
Here the text source cuts the file wherever a ``}`` stands (its line separator),
so a large file is split like any text file, and what is needed to put records
together is found in two rounds:

1. each piece is described twice, as if it began outside and inside a string:
   quotes, opening braces, whether its ``}`` closes anything. Per split these add
   up to one row, and a running sum over the splits of a file (one row each)
   tells in which state every split begins;
2. with that, each piece knows the braces open before it. A record is what lies
   between depth 0 and depth 0 again. Records within a split are put together
   there; only the two at a split's borders meet across splits.

All steps are DataFrame functions; the text is shuffled once, by split.

Defined cases: elements that are not objects are ignored, as are text before
the first and after the last object; a file may also hold a single object, or
objects one after another; an object cut off by the end of the file is left
out; an object that does not fit the schema is a row of nulls as in
``from_json``; an empty file or array has no rows; compressed files are read by
one task. Files of split size and less are one split each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Regular expressions over one piece without its escapes.
_ESCAPE = r"(?s)\\."
_STRING = r'(?s)"[^"]*("|$)'
_REST_OF_STRING = r'(?s)^[^"]*("|$)'


def _count(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _split, _at, piece): the text before each ``}``, ordered by _at
    within a split, with ``_odd`` (an odd number of quotes) and for a beginning
    outside (0) and inside (1) a string the braces opened and the depth gained."""
    raw = spark.read.option("lineSep", "}").text(path)
    p = raw.select(F.col("_metadata.file_path").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_split"),
                   F.monotonically_increasing_id().alias("_at"), F.col("value").alias("piece"))
    bare = F.regexp_replace("piece", _ESCAPE, "")
    p = p.withColumn("_bare", bare).withColumn("_odd", _count(F.col("_bare"), '"') % 2)
    out = {}
    for began in (0, 1):
        seen = F.regexp_replace("_bare", _REST_OF_STRING, "") if began else F.col("_bare")
        opened = _count(F.regexp_replace(seen, _STRING, ""), "{")
        closes = (F.col("_odd") == began).cast("long")      # the "}" stands outside a string
        out[f"_open{began}"], out[f"_gain{began}"] = opened, opened - closes
    return p.withColumns(out).drop("_bare")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _record, json): the text of every object, in the file's order."""
    p = pieces(spark, path)
    within = Window.partitionBy("_file", "_split").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(c: Column, w=within) -> Column:
        return F.coalesce(F.sum(c).over(w), F.lit(0))

    # each piece's start under both beginnings of its split
    p = p.withColumn("_flip", so_far(F.col("_odd")) % 2)
    p = p.withColumns({f"{k}{b}": F.when(F.col("_flip") == b, F.col(f"{k[:-1]}0")).otherwise(F.col(f"{k[:-1]}1"))
                       for b in (0, 1) for k in ("_openx", "_gainx")})
    splits = p.groupBy("_file", "_split").agg(
        (F.sum("_odd") % 2).alias("_odd"), F.sum("_gainx0").alias("_g0"), F.sum("_gainx1").alias("_g1"))
    ahead = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_in", so_far(F.col("_odd"), ahead) % 2)
    splits = splits.withColumn("_g", F.when(F.col("_in") == 0, F.col("_g0")).otherwise(F.col("_g1")))
    splits = splits.withColumn("_depth", so_far(F.col("_g"), ahead)).select(
        F.col("_file").alias("_f"), F.col("_split").alias("_s"), "_in", "_depth")

    j = p.join(splits, (F.col("_file") == F.col("_f")) & (F.col("_split") == F.col("_s")))
    j = j.withColumns({k: F.when(F.col("_in") == 0, F.col(f"{k}x0")).otherwise(F.col(f"{k}x1"))
                       for k in ("_open", "_gain")})
    j = j.withColumn("_before", F.col("_depth") + so_far(F.col("_gain")))
    j = j.withColumn("_ends", (F.col("_before") + F.col("_open") > 0) & (F.col("_before") + F.col("_gain") == 0)
                     & (F.col("_gain") < F.col("_open")))
    # pieces outside of any record go; the others count the ends before them
    j = j.filter(F.col("_before") + F.col("_open") > 0).withColumn("_nth", so_far(F.col("_ends").cast("long")))
    first = F.col("_before") == 0
    text = F.concat(F.when(first, F.regexp_replace("piece", r"(?s)^[^{]*", "")).otherwise(F.col("piece")), F.lit("}"))
    j = j.withColumns({"_text": text, "_starts": first})
    parts = j.groupBy("_file", "_split", "_nth").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_text"))),
                                 lambda x: x["_text"]), "").alias("json"),
        F.max("_starts").alias("_starts"), F.max("_ends").alias("_ends"))
    whole = parts.filter("_starts and _ends").select("_file", F.struct("_split", "_nth").alias("_record"), "json")
    # a record that goes on into later splits: all parts from its start to its end
    broken = parts.filter("not (_starts and _ends)")
    order = Window.partitionBy("_file").orderBy("_split", "_nth").rowsBetween(Window.unboundedPreceding, 0)
    broken = broken.withColumn("_n", F.sum(F.col("_starts").cast("long")).over(order))
    joined = broken.groupBy("_file", "_n").agg(
        F.array_sort(F.collect_list(F.struct("_split", "_nth", "json"))).alias("_parts"), F.max("_ends").alias("_ends"))
    joined = joined.filter("_ends").select(
        "_file", F.struct(F.col("_parts")[0]["_split"].alias("_split"), F.col("_parts")[0]["_nth"].alias("_nth")).alias("_record"),
        F.array_join(F.transform("_parts", lambda x: x["json"]), "").alias("json"))
    return whole.unionByName(joined)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The objects of JSON array files with the given schema."""
    return records(spark, path).select(F.from_json("json", schema).alias("r")).select("r.*")
