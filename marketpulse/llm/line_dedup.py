"""Line de-duplication by winnowing over line hashes, in DataFrame functions.

A document's lines that are not blank are hashed (surrounding spaces aside).
Of every ``run`` consecutive line hashes the least one (the last of equals) is
a fingerprint, so two documents that share a run of that many lines share a
fingerprint, whatever surrounds it. Positions with a fingerprint in common are
joined and each is extended both ways by the lines around it: every window of
``run`` lines that chose the fingerprint is compared whole with the earliest
window of equal lines, and neighbouring matches on one diagonal (same source
document, same distance) make one maximal run. Lines under a run that starts
earlier elsewhere (smaller id, or earlier in the document) are deleted.

So the lines deleted are exactly those in some ``run`` consecutive lines that
occurred before, judged on the input. Lines are known by 64 bits of hash and
windows by 64 more of another.

Fingerprints and windows are counted before anything is joined (a hot line
sends one row a task), and the joins that follow deal hot keys out anew.

Defined cases: null text has no lines and stays null-free, as the empty text;
blank lines are kept and never part of a run; documents of fewer lines than
``run`` are kept whole; an empty table gives an empty result; other columns
are not read; for repeated and null ids see ``common``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import (NULL_ID, again, free_name, keyed, one_row_each, stored,
                                    unkeyed)

RUN = 3


def _lines(d: DataFrame) -> DataFrame:
    """(doc_id, pos, h): numbers and hashes of the lines that are not blank."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(x))
    numbered = F.transform(trimmed, lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    full = F.filter(numbered, lambda x: x["line"] != "")
    return (d.select("doc_id", full.alias("full"))
            .select("doc_id", F.col("full.pos").alias("pos"),
                    F.transform("full.line", lambda x: F.xxhash64(x)).alias("h")))


def _window(h: Column, i: Column, run: int) -> list[Column]:
    return [F.get(h, i + k) for k in range(run)]


def fingerprints(d: DataFrame, run: int) -> DataFrame:
    """(doc_id, fingerprint, first, around): each chosen line with the first of
    the windows that chose it and the hashes of those windows' lines."""
    h = F.col("h")

    def chosen(i: Column) -> Column:
        best = F.struct(F.get(h, i).alias("v"), (-i).alias("at"))
        for k in range(1, run):
            best = F.least(best, F.struct(F.get(h, i + k).alias("v"), (-(i + k)).alias("at")))
        return F.struct(i.alias("i"), best["v"].alias("v"), (-best["at"]).alias("at"))

    starts = F.when(F.size("h") >= run, F.sequence(F.lit(0), F.size("h") - run)).otherwise(
        F.array().cast("array<int>"))
    picks = d.select("doc_id", "h", F.transform(starts, chosen).alias("w"))
    # windows that chose one line are neighbours: keep the first of each such run
    leads = F.filter(F.transform("w", lambda x, k: F.struct(
        x["i"].alias("i"), x["v"].alias("v"), x["at"].alias("at"),
        F.coalesce(F.get("w", k - 1)["at"], F.lit(-1)).alias("before"))),
        lambda x: x["at"] != x["before"])
    firsts = picks.select("doc_id", "h", leads.alias("leads"))
    each = firsts.select("doc_id", "h", F.explode(F.transform("leads", lambda x, k: F.struct(
        x["v"].alias("v"), x["i"].alias("i"),
        F.coalesce(F.get("leads", k + 1)["i"], F.size("h") - run + 1).alias("stop")))).alias("x"))
    return each.select("doc_id", F.col("x.v").alias("fingerprint"), F.col("x.i").alias("first"),
                       F.slice("h", F.col("x.i") + 1, F.col("x.stop") - F.col("x.i") + run - 1)
                       .alias("around"))


def repeats(d: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, start, from_doc, from_start): every window of ``run`` lines,
    counted in lines that are not blank, with the earliest equal one."""
    picked = stored(fingerprints(_lines(d), run), "line-prints")
    shared = (picked.groupBy("fingerprint").count().filter("count > 1")
              .select(again(F.col("fingerprint")).alias("key")))
    near = picked.join(shared, again(F.col("fingerprint")) == F.col("key"), "left_semi")
    starts = F.sequence(F.lit(0), F.size("around") - run)
    around = F.col("around")
    windows = near.select("doc_id", F.explode(F.transform(starts, lambda k: F.struct(
        (F.col("first") + k).alias("start"),
        F.xxhash64(*_window(around, k, run)).alias("key"),
        F.xxhash64(F.lit(1), *_window(around, k, run)[::-1]).alias("check")))).alias("w"))
    windows = stored(windows.select("doc_id", "w.*"), "line-windows")
    first = (windows.groupBy("key", "check")
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start")).alias("source"))
             .filter("n > 1").select(again(F.col("key")).alias("k"), F.col("check").alias("c"), "source"))
    met = windows.join(first, (again(F.col("key")) == F.col("k")) & (F.col("check") == F.col("c")))
    return (met.filter(F.struct("doc_id", "start") != F.col("source"))
            .select("doc_id", "start", F.col("source.doc_id").alias("from_doc"),
                    F.col("source.start").alias("from_start")))


def runs(matches: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, runs): each document's matches extended to maximal runs: arrays
    of (start, stop, from_doc, from_start), stop being one past the last line."""
    diagonal = Window.partitionBy("doc_id", "from_doc", "off").orderBy("start")
    on = matches.withColumn("off", F.col("from_start") - F.col("start"))
    gap = F.coalesce(F.col("start") - F.lag("start").over(diagonal) >= run, F.lit(True))
    numbered = on.withColumn("gap", gap.cast("int"))
    numbered = numbered.withColumn("island", F.sum("gap").over(diagonal))
    merged = numbered.groupBy("doc_id", "from_doc", "off", "island").agg(
        F.min("start").alias("start"), (F.max("start") + run).alias("stop"))
    return merged.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(
        "start", "stop", "from_doc", (F.col("start") + F.col("off")).alias("from_start"))))
        .alias("runs"))


def _kept(text: Column, runs_: Column) -> tuple[Column, Column, Column]:
    """(number of lines, numbers of the deleted ones, text that is left)."""
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    full = F.filter(numbered, lambda x: F.trim(x["line"]) != "")["pos"]
    marked = F.array_distinct(F.flatten(F.transform(
        runs_, lambda r: F.sequence(r["start"], r["stop"] - 1))))
    # from numbers among the lines that are not blank to numbers among all
    gone = F.when(runs_.isNull(), F.array().cast("array<int>")).otherwise(
        F.transform(marked, lambda k: F.get(full, k)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.when(runs_.isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return F.size(lines), gone, kept


def dedup_lines(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, n_lines, n_removed, runs, kept): each document's lines, how many
    were deleted, the runs they lie in, and the text that is left."""
    d = keyed(docs).withColumn("text", F.coalesce("text", F.lit("")))
    found = runs(repeats(d, run), run).withColumnRenamed("doc_id", "marked")
    both = d.join(found, d.doc_id == found.marked, "left").select("doc_id", "text", "runs")
    n, gone, kept = _kept(F.col("text"), F.col("runs"))
    return unkeyed(both.select("doc_id", n.cast("long").alias("n_lines"),
                               F.size(gone).cast("long").alias("n_removed"), "runs",
                               kept.alias("kept")))


def without_repeats(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs``, one row for each id, with all its columns; the text is what is
    left of it, and ``n_chars``, if there, its length. Documents of which only
    blank lines are left go; a text without repeats stays as it is, null too."""
    rows = one_row_each(docs)
    d = keyed(rows).withColumn("text", F.coalesce("text", F.lit("")))
    marked, found_runs = free_name(rows, "marked"), free_name(rows, "runs")
    found = runs(repeats(d, run), run).toDF(marked, found_runs)
    both = rows.join(found, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) == F.col(marked), "left")
    text = F.when(F.col(found_runs).isNull(), F.col("text")).otherwise(
        _kept(F.col("text"), F.col(found_runs))[2])
    both = both.withColumn("text", text).filter(
        F.col(found_runs).isNull() | F.rlike("text", F.lit("[^ \\n]")))
    if "n_chars" in rows.columns:
        both = both.withColumn("n_chars", F.when(F.col(found_runs).isNull(), F.col("n_chars"))
                               .otherwise(F.char_length("text").cast(rows.schema["n_chars"].dataType)))
    return both.select(*rows.columns)
