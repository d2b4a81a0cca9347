"""Hard negatives by a vertical scan of vectors (BOND).

Components become integers, floor(256 * x), so scores are exact inner
products. Rows are packed into blocks that hold one array for each dimension.
For an anchor, a block's dimensions are read in descending magnitude of the
anchor's components; after some of them, what the rest can add lies between
bounds from each dimension's smallest and largest value in the block, and rows
that can no longer be among those asked for leave the candidate bitmap. The
rows left at the end have exact scores.

Two scans follow each other: the first finds each anchor's positives (the best
rows of its label), the second the best rows of other labels in each
positive's window of scores. Bounds from rows seen before are kept per task,
so blocks read later shrink sooner.

The anchors are a stated query set against all rows. They are packed into
chunks of about ``CHUNK`` anchors, and ``PASS`` chunks (a fixed number, so a
fixed size) are broadcast at a time; more anchors take more passes over the
blocks. No row is grouped by its label, so a label that holds most rows makes
no large group. A task hands on at most 5 rows an anchor (or window).

Defined cases: rows with a null label, a null vector or any null or non-finite
component take no part; a null id is an id of its own, sorts first and is no
anchor; of rows that repeat an id the one with the greatest (label, vector)
counts; vectors of different lengths count as if filled up with zeros, and
empty ones score 0; an empty table gives an empty result; other columns are
not read. Components whose scaled value leaves the range of a long are the
nearest long, and a returned score beyond it is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import NULL_ID, stored, tidy

#: Rows in a block, anchors in a chunk (about), chunks broadcast at a time.
BLOCK, CHUNK, PASS = 8192, 1024, 32
#: Dimensions read between two looks at the bounds.
STEP = 4
#: Positives of an anchor and negatives of a positive.
POSITIVES, NEGATIVES = 5, 5
#: Least and largest score of a negative, in hundredths of the positive's.
LEAST, MOST = 80, 100


def scaled(rows: DataFrame, key: str, vector: str, label: str | Column) -> DataFrame:
    """(id, label, v): rows that take part, with integer components; one row an id."""
    value = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    d = rows.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"), label.cast("long").alias("label"),
                    F.when(fine, F.transform(value, lambda x: F.floor(x * 256).cast("long"))).alias("v"))
    d = d.filter("label is not null and v is not null")
    if d.groupBy("id").count().filter("count > 1").isEmpty():
        return d
    return (d.groupBy("id").agg(F.max(F.struct("label", "v")).alias("row"))
            .select("id", "row.label", "row.v"))


_BLOCK = pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()),
                    ("dims", pa.list_(pa.binary()))])
_BLOCK_SQL = "ids binary, labels binary, kind string, dims array<binary>"


def _matrix(column: pa.Array) -> np.ndarray:
    """One row for each vector, shorter ones filled up with zeros."""
    edge = column.offsets.to_numpy()
    flat, size = column.flatten().to_numpy(), np.diff(edge)
    out = np.zeros((len(column), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(flat)) - np.repeat(edge[:-1] - edge[0], size)] = flat
    return out


def _block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches).combine_chunks()
    m = _matrix(t.column(2).chunk(0)) if len(t) else np.zeros((0, 0), np.int64)
    kind = next(k for k in ("<i2", "<i4", "<i8")
                if k == "<i8" or np.iinfo(k).min <= m.min(initial=0) and m.max(initial=0) <= np.iinfo(k).max)
    dims = [np.ascontiguousarray(m[:, k]).astype(kind).tobytes() for k in range(m.shape[1])]
    return pa.RecordBatch.from_arrays(
        [pa.array([t.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
         pa.array([t.column(1).to_numpy().astype("<i8").tobytes()], pa.binary()),
         pa.array([kind]), pa.array([dims], pa.list_(pa.binary()))], schema=_BLOCK)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= BLOCK:
            yield _block(held)
            held, n = [], 0
    if n:
        yield _block(held)


def blocks(d: DataFrame) -> DataFrame:
    """``scaled`` rows as stored blocks, one array for each dimension."""
    return stored(d.mapInArrow(tidy(_pack), _BLOCK_SQL), "dimensions")


def chunks(anchors: DataFrame, n: int, *more: str) -> DataFrame:
    """(chunk, anchors): ``n`` anchors in groups of about CHUNK."""
    many = -(-n // CHUNK)
    return (anchors.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(many)).cast("int"))
            .groupBy("chunk").agg(F.collect_list(F.struct("id", "label", "v", *more)).alias("anchors")))


class Block:
    """A block's arrays and the bounds of its dimensions."""

    def __init__(self, ids: bytes, labels: bytes, kind: str, dims: list[bytes]):
        self.id, self.label = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.dims = [np.frombuffer(x, kind) for x in dims]
        self.least = np.array([x.min() for x in self.dims], np.int64)
        self.most = np.array([x.max() for x in self.dims], np.int64)
        self.largest = max((abs(int(x)) for x in (*self.least, *self.most)), default=0)

    def scan(self, q: np.ndarray, at: np.ndarray, low: int | None, high: int | None,
             keep: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Those of the rows ``at`` with scores from ``low`` to ``high`` (None: no
        bound) and their scores. With ``keep``, rows that are surely not among
        the best so many may be missing."""
        many = min(len(q), len(self.dims))
        largest = max((abs(int(x)) for x in q), default=0)
        exact = np.int64 if largest * self.largest * max(many, 1) < 1 << 62 else object
        q = q[:many].astype(exact)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * self.least[:many].astype(exact), q * self.most[:many].astype(exact)])[:, order]
        rest = [np.append(np.cumsum(f(ends, axis=0)[::-1])[::-1], 0) for f in (np.max, np.min)]
        part = np.zeros(len(at), exact)
        for k in range(0, many + 1, STEP):
            for d in order[k - STEP: k] if k else ():
                part += q[d] * self.dims[d][at].astype(exact)
            at, part, low = self._fewer(at, part, int(rest[0][k]), int(rest[1][k]), low, high, keep)
        for d in order[many - many % STEP:]:
            part += q[d] * self.dims[d][at].astype(exact)
        at, part, _ = self._fewer(at, part, 0, 0, low, high, keep)
        return at, part

    @staticmethod
    def _fewer(at, part, more: int, less: int, low, high, keep):
        """Drops the rows that the bounds rule out; with ``keep``, the keep-th
        best lower bound becomes a bound for all."""
        if keep and len(part) > keep:
            kth = int(np.partition(part, len(part) - keep)[len(part) - keep]) + less
            low = kth if low is None else max(low, kth)
        alive = np.ones(len(part), bool)
        if low is not None:
            alive &= part >= low - more
        if high is not None:
            alive &= part <= high - less
        if alive.all():
            return at, part, low
        return at[alive], part[alive], low


class Best:
    """The best ``n`` (score, id) pairs so far; of equal scores the smaller id."""

    def __init__(self, n: int):
        self.n, self.pairs = n, []

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score) > 4 * self.n:
            cut = np.partition(score, len(score) - self.n)[len(score) - self.n]
            score, ids = score[score >= cut], ids[score >= cut]
        self.pairs = sorted([*self.pairs, *((-int(s), int(i)) for s, i in zip(score, ids))])[: self.n]

    def least(self, floor: int | None = None) -> int | None:
        """A score below it cannot enter (None: any can)."""
        if len(self.pairs) < self.n:
            return floor
        worst = -self.pairs[-1][0]
        return worst if floor is None else max(floor, worst)


_PAIR = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("bound", pa.int64()), ("id", pa.int64()),
                   ("score", pa.int64())])
_PAIR_SQL = "anchor long, positive long, bound long, id long, score long"


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PAIR)


def _met(batches):
    """(block, anchors) of each row; a block that follows itself is read once."""
    last, block = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["ids"] != last:
                last, block = row["ids"], Block(row["ids"], row["labels"], row["kind"], row["dims"])
            yield block, row["anchors"]


def _find_positives(n: int):
    def run(batches):
        best: dict[int, Best] = {}
        for block, anchors in _met(batches):
            rows = {int(x): np.flatnonzero(block.label == x) for x in np.unique(block.label)}
            for a in anchors:
                mine = best.setdefault(a["id"], Best(n))
                at = rows.get(a["label"])
                if at is None:
                    continue
                at = at[block.id[at] != a["id"]]
                at, score = block.scan(np.array(a["v"], np.int64), at, mine.least(), None, n)
                mine.add(score, block.id[at])
        yield _pairs([(a, None, None, i, -s) for a, b in best.items() for s, i in b.pairs])
    return run


def _find_negatives(n: int, least: int, most: int):
    def run(batches):
        best: dict[tuple[int, int], Best] = {}
        bound: dict[tuple[int, int], int] = {}
        for block, anchors in _met(batches):
            rows = {int(x): np.flatnonzero(block.label != x) for x in {a["label"] for a in anchors}}
            for a in anchors:
                windows = []
                for p in a["positives"]:
                    low, high = -(-least * p["score"] // 100), most * p["score"] // 100
                    if low <= high:
                        key = a["id"], p["id"]
                        bound[key] = p["score"]
                        windows.append((best.setdefault(key, Best(n)), low, high))
                if not windows:
                    continue
                at, score = block.scan(np.array(a["v"], np.int64), rows[a["label"]],
                                       min(b.least(low) for b, low, _ in windows), max(h for *_, h in windows))
                for mine, low, high in windows:
                    inside = (score >= mine.least(low)) & (score <= high)
                    mine.add(score[inside], block.id[at[inside]])
        yield _pairs([(*key, bound[key], i, -s) for key, b in best.items() for s, i in b.pairs])
    return run


def _scan(stored_blocks: DataFrame, queries: DataFrame, many: int, run, name: str) -> DataFrame:
    """``run`` over every block with every chunk of anchors, PASS chunks at a time."""
    found = None
    for first in range(0, many, PASS):
        last = min(first + PASS, many) - 1
        some = queries.filter(F.col("chunk").between(first, last))
        met = (stored_blocks.withColumn("chunk", F.explode(F.sequence(F.lit(first), F.lit(last))))
               .join(F.broadcast(some), "chunk").drop("chunk"))
        part = stored(met.mapInArrow(tidy(run), _PAIR_SQL), name)
        found = part if found is None else found.union(part)
    return found


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
         anchors: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         least: int = LEAST, most: int = MOST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). ``anchors`` is a condition on ``key``; all rows without it."""
    d = stored(scaled(rows, key, vector, label), "vectors")
    chosen = d.filter(F.col("id") != NULL_ID)
    if anchors is not None:
        chosen = chosen.withColumnRenamed("id", key).filter(anchors).withColumnRenamed(key, "id")
    chosen = stored(chosen, "anchors")
    n = chosen.count()
    many = -(-n // CHUNK)
    empty = d.sparkSession.createDataFrame([], _PAIR_SQL)
    packed = blocks(d)
    near = _scan(packed, chunks(chosen, n), many, _find_positives(positives), "near") if n else empty
    order = [F.desc("score"), F.asc("id")]
    nth = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    taken = stored(near.withColumn("nth", nth).filter(F.col("nth") <= positives)
                   .groupBy(F.col("anchor").alias("id"))
                   .agg(F.collect_list(F.struct("id", "score")).alias("positives")), "positives")
    queries = chunks(chosen.join(taken, "id"), n, "positives") if n else empty
    far = _scan(packed, queries, many, _find_negatives(negatives, least, most), "far") if n else empty
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))

    def shown(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(NULL_ID))

    return (far.withColumn("rank", rank).filter(F.col("rank") <= negatives)
            .select(F.col("anchor").alias("anchor_id"), shown("positive").alias("positive_id"), "rank",
                    shown("id").alias("negative_id"), F.col("bound").alias("positive_score"),
                    F.col("score").alias("negative_score")))
