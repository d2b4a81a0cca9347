"""Substring de-duplication: Rabin-Karp hashes of every fixed-length window.

Every window of ``size`` consecutive words of every document is hashed, the
windows are brought together by hash, and all but the earliest occurrence of
a window (smallest document id, then smallest start) are marked. The words
under marked windows, merged into maximal intervals, are removed.

Hashes travel in blocks, one for each input slice and hash range: of a window
that repeats within a slice only the first goes, so a passage that a third of
all documents share sends one entry for each slice. Ranges are so many that
one holds about ``GROUP`` windows. A window is known by 64 bits of hash.

Defined cases: a null or empty text has no words and keeps nothing; documents
shorter than a window are kept whole; an empty table gives an empty result;
other columns are not looked at; for repeated and null ids see ``common``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import int_array, keyed, partitions, stored, text_bytes, tidy, unkeyed

GROUP = 1 << 20
#: Windows that one slice gathers before it cuts them into blocks.
SLICE_WINDOWS = 1 << 19

_BLOCK = pa.schema([("range", pa.int32()), ("hash", pa.binary()), ("doc", pa.binary()),
                    ("start", pa.binary()), ("ids", pa.binary())])
_BLOCK_SQL = "range int, hash binary, doc binary, start binary, ids binary"
_MARK = pa.schema([("doc_id", pa.int64()), ("start", pa.int32())])


def _marks(doc, start) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int32())],
                                      schema=_MARK)


def _windows(batches, size: int):
    """(hash, id, start) of the windows, in slices of SLICE_WINDOWS and a bit."""
    held, n = [], 0
    for batch in batches:
        ids = int_array(batch.column(0))
        offsets, data = rolling.texts(batch.column(1))
        for i, j in rolling.ranges(offsets):
            w = rolling.words(offsets, data, i, j)
            at, h = w.windows(size)
            row = w.rows()[at]
            held.append((h, ids[i:j][row], (at - w.first[row]).astype(np.int32)))
            n += len(h)
            if n >= SLICE_WINDOWS:
                yield [np.concatenate(x) for x in zip(*held)]
                held, n = [], 0
    if n:
        yield [np.concatenate(x) for x in zip(*held)]


def _first_of_each(h, doc, start):
    """Order by (hash, id, start), and which of the ordered are a hash's first."""
    order = np.lexsort((start, doc, h))
    first = np.ones(len(h), bool)
    first[1:] = h[order][1:] != h[order][:-1]
    return order, first


def _blocks(size: int, n_ranges: int):
    """mapInArrow: blocks of each slice's distinct windows; windows that the
    slice itself has earlier come as a block with range -1."""
    def run(batches):
        for h, doc, start in _windows(batches, size):
            order, first = _first_of_each(h, doc, start)
            later = order[~first]
            rows = {k: [] for k in _BLOCK.names}

            def put(r, at, hashes):
                ids, local = np.unique(doc[at], return_inverse=True)
                kind = np.uint16 if len(ids) < 1 << 16 else np.uint32
                for k, v in zip(_BLOCK.names, (r, hashes.tobytes(), local.astype(kind).tobytes(),
                                               start[at].tobytes(), ids.tobytes())):
                    rows[k].append(v)

            if len(later):
                put(-1, later[np.argsort(doc[later], kind="stable")], np.zeros(0, np.uint64))
            own = order[first]
            cut = ((h[own] >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)
            edge = np.flatnonzero(np.diff(cut, prepend=-1, append=n_ranges))
            for a, b in zip(edge[:-1], edge[1:]):
                at = np.sort(own[a:b])  # near one another in the text: the ids compress
                put(int(cut[a]), at, h[at])
            yield pa.RecordBatch.from_pydict(rows, schema=_BLOCK)
    return run


def _unpack(table: pa.Table):
    hashes, docs, starts = [], [], []
    for h, d, s, ids in zip(*(table.column(k).to_pylist() for k in ("hash", "doc", "start", "ids"))):
        ids, start = np.frombuffer(ids, np.int64), np.frombuffer(s, np.int32)
        local = np.frombuffer(d, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        hashes.append(np.frombuffer(h, np.uint64))
        docs.append(ids[local])
        starts.append(start)
    return [np.concatenate(x) for x in (hashes, docs, starts)]


def _later(table: pa.Table) -> pa.Table:
    """A hash range's windows that are not the first of their hash."""
    h, doc, start = _unpack(table)
    order, first = _first_of_each(h, doc, start)
    later = order[~first]
    later = later[np.lexsort((start[later], doc[later]))]
    return pa.Table.from_batches([_marks(doc[later], start[later])])


def _own_marks(batches):
    for batch in batches:
        for d, s, ids in zip(*(batch.column(k).to_pylist() for k in ("doc", "start", "ids"))):
            ids = np.frombuffer(ids, np.int64)
            local = np.frombuffer(d, np.uint16 if len(ids) < 1 << 16 else np.uint32)
            yield _marks(ids[local], np.frombuffer(s, np.int32))


def repeated_windows(docs: DataFrame, size: int = 20) -> DataFrame:
    """(doc_id, start) of every window of ``size`` words that occurs earlier
    too; ``docs`` as ``keyed`` gives it. The rows are in a stored table."""
    spark = docs.sparkSession
    n_ranges = max(4 * partitions(spark), text_bytes(docs) // (5 * GROUP))
    blocks = docs.mapInArrow(tidy(_blocks(size, n_ranges)), _BLOCK_SQL)
    # the slice's own repeats go on beside the ranges, dealt out evenly
    own = F.when(F.col("range") < 0, -1 - F.pmod(F.xxhash64("ids"), F.lit(n_ranges)))
    dealt = blocks.withColumn("g", F.coalesce(own, F.col("range").cast("long")))

    def group(table: pa.Table) -> pa.Table:
        if table.column("range")[0].as_py() >= 0:
            return _later(table)
        parts = [b for b in _own_marks(table.to_batches())]
        return pa.Table.from_batches(parts, schema=_MARK)

    return stored(dealt.groupBy("g").applyInArrow(group, "doc_id long, start int"), "windows")


def covered(starts, size: int, n: int) -> np.ndarray:
    """Which of n words lie under windows with those starts."""
    edge = np.zeros(n + 1, np.int64)
    starts = np.asarray(starts, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0


def intervals(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of set entries, as (first, one past the last)."""
    edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("removed", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
                   ("kept", pa.string())])
_KEPT_SQL = ("doc_id long, n_words long, n_removed long, "
             "removed array<struct<from: int, to: int>>, kept string")


def _cut(size: int):
    def run(batches):
        for batch in batches:
            rows = {k: [] for k in _KEPT.names}
            for doc_id, text, starts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                w = (text or "").encode().split()  # bytes.split() knows ASCII white space only
                removed = []
                if starts:
                    mask = covered(starts, size, len(w))
                    removed = intervals(mask)
                    kept = [x for x, gone in zip(w, mask.tolist()) if not gone]
                else:
                    kept = w
                for k, v in zip(_KEPT.names, (doc_id, len(w), len(w) - len(kept),
                                              [{"from": a, "to": b} for a, b in removed],
                                              b" ".join(kept).decode())):
                    rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=_KEPT)
    return run


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept): each document's number of
    words, the maximal intervals of words that were removed, and the rest
    joined by single spaces."""
    d = keyed(docs)
    starts = (repeated_windows(d, size).groupBy("doc_id")
              .agg(F.collect_list("start").alias("starts"))
              .withColumnRenamed("doc_id", "marked"))
    joined = d.join(starts, d.doc_id == starts.marked, "left").select("doc_id", "text", "starts")
    return unkeyed(joined.mapInArrow(tidy(_cut(size)), _KEPT_SQL))

