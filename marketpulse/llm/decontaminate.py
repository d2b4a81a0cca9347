"""Benchmark decontamination with suffix arrays of the training text.

Each shard (a slice of the documents, as one task reads them) gets a suffix
array over its words. Every suffix of every benchmark item is searched in it
by bisection, several words a step, for places where at least ``size`` words
agree (an item of fewer words: all of them). Hits on one diagonal are merged
into longest verbatim matches with their locations.

Words are numbered by the benchmark's vocabulary; any other word is 0, which
no item holds, so suffixes that begin with it are left out of the array.
Nothing is shuffled. The benchmark goes to the tasks in blocks of items of at
most ``block_bytes`` each, one pass over the documents for each block, so
what is broadcast is bounded whatever the benchmark's size.

Defined cases: null and empty texts have no words, hits or items; an item
without words or with null text has no windows; repeated item ids count once;
a null item id is written ``null``; an empty benchmark hits nothing; for
repeated and null document ids see ``common``; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import int_array, keyed, tidy, unkeyed

BLOCK_BYTES = 16 << 20
SHARD_BYTES = 1 << 20


class SuffixArray:
    """Suffixes of a sequence of word numbers, in order by their first ``depth``
    words; suffixes that begin with 0 are left out. ``bits`` hold a number."""

    def __init__(self, seq: np.ndarray, bits: int, depth: int):
        self.per = 63 // bits
        self.bits = np.uint64(bits)
        n = len(seq)
        wide = np.concatenate([seq.astype(np.uint64), np.zeros(self.per, np.uint64)])
        self.key = np.zeros(n + 1, np.uint64)  # of the next ``per`` words
        for k in range(self.per):
            self.key[:n] = (self.key[:n] << self.bits) | wide[k: k + n]
        at = np.flatnonzero(seq)
        order = np.argsort(self.key[at], kind="stable")
        self.at = at[order]
        group = np.cumsum(np.diff(self.key[self.at], prepend=np.uint64(0)) != 0)
        for done in range(self.per, depth, self.per):
            size = np.bincount(group)
            tied = np.flatnonzero(size[group] > 1)
            if not len(tied):
                break
            key = self.key[np.minimum(self.at[tied] + done, n)]
            order = np.lexsort((key, group[tied]))
            self.at[tied] = self.at[tied][order]
            key, g = key[order], group[tied]
            new = np.zeros(len(group), np.int64)
            new[tied[1:]] = (np.diff(key) != 0) & (np.diff(g) == 0)
            group = np.cumsum(new + np.diff(group, prepend=group[0]))
        self.first = self.key[self.at]
        self.n = n

    def _bounds(self, words: np.ndarray) -> tuple[int, int]:
        low = 0
        for w in words.tolist():
            low = low << int(self.bits) | w
        rest = int(self.bits) * (self.per - len(words))
        return low << rest, ((low + 1) << rest) - 1

    def find(self, queries: list[np.ndarray]) -> list[np.ndarray]:
        """For each query (not empty) the places where all of it occurs."""
        heads = [self._bounds(q[: self.per]) for q in queries]
        lo = np.searchsorted(self.first, np.array([a for a, _ in heads], np.uint64), "left")
        hi = np.searchsorted(self.first, np.array([b for _, b in heads], np.uint64), "right")
        out = [np.zeros(0, np.int64)] * len(queries)
        for k in np.flatnonzero(hi > lo).tolist():
            a, b = int(lo[k]), int(hi[k])
            for done in range(self.per, len(queries[k]), self.per):
                low, high = self._bounds(queries[k][done: done + self.per])
                key = self.key[np.minimum(self.at[a:b] + done, self.n)]
                b = a + int(np.searchsorted(key, np.uint64(high), "right"))
                a = a + int(np.searchsorted(key, np.uint64(low), "left"))
                if a >= b:
                    break
            if a < b:
                out[k] = self.at[a:b]
        return out


@dataclass
class Block:
    """Some benchmark items: each window's words as numbers of the vocabulary."""
    vocabulary: np.ndarray
    item: list[str]      # of each query
    offset: list[int]    # of each query within its item
    queries: list[np.ndarray]
    depth: int

    @classmethod
    def of(cls, ids: list[str], texts: list[str | None], size: int) -> Block:
        offsets, data = rolling.texts(pa.array(texts, pa.large_string()))
        w = rolling.words(offsets, data, 0, len(texts), rolling.ALNUM, lower=True)
        vocabulary = np.unique(w.hash)
        number = np.searchsorted(vocabulary, w.hash) + 1
        item, offset, queries = [], [], []
        for k, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            for at in range(a, max(a + 1, b - size + 1)) if b > a else ():
                item.append(ids[k])
                offset.append(at - a)
                queries.append(number[at: min(at + size, b)])
        return cls(vocabulary, item, offset, queries, size)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def blocks(benchmark: DataFrame, size: int, block_bytes: int, item: str = "item_id",
           text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of bounded size."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")),
                            F.col(text).cast("string"))
    ids, texts, held = [], [], 0
    for i, t in rows.toLocalIterator():
        ids.append(i)
        texts.append(t)
        held += len(t or "") * 4 + 100
        if held >= block_bytes:
            yield Block.of(ids, texts, size)
            ids, texts, held = [], [], 0
    if ids:
        yield Block.of(ids, texts, size)


_FOUND_SQL = ("doc_id long, n_words long, matches array<struct<item_id: string, item_start: int, "
              "start: int, n_words: int>>")
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()),
                                    ("start", pa.int32()), ("n_words", pa.int32())])))])


def _search(block, w: rolling.Words) -> dict[int, list[dict]]:
    """Longest matches by row of the shard. A 0 after each row keeps rows apart."""
    seq = np.zeros(len(w.hash) + len(w.first) - 1, np.int64)
    seq[np.arange(len(w.hash)) + w.rows()] = block.number(w.hash)
    first = w.first[:-1] + np.arange(len(w.first) - 1)  # of each row, in seq
    array = SuffixArray(seq, max(1, len(block.vocabulary).bit_length()), block.depth)
    found: dict[int, list[dict]] = {}
    open_: dict[tuple[str, int], dict] = {}  # the last match on each item's diagonals
    for k, places in enumerate(array.find(block.queries)):
        for p in places.tolist():
            item, offset, n = block.item[k], block.offset[k], len(block.queries[k])
            last = open_.get((item, p - offset))
            if last and last["item_start"] + last["n_words"] == offset + n - 1:
                last["n_words"] += 1
                continue
            row = int(np.searchsorted(first, p, "right")) - 1
            m = {"item_id": item, "item_start": offset, "start": p - int(first[row]), "n_words": n}
            open_[(item, p - offset)] = m
            found.setdefault(row, []).append(m)
    return found


def _shards(block_var, shard_bytes: int):
    def run(batches):
        block = block_var.value
        for batch in batches:
            ids = int_array(batch.column(0))
            offsets, data = rolling.texts(batch.column(1))
            for i, j in rolling.ranges(offsets, shard_bytes):
                w = rolling.words(offsets, data, i, j, rolling.ALNUM, lower=True)
                found = _search(block, w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j], pa.int64()), pa.array(w.counts, pa.int64()),
                     pa.array([found.get(k, []) for k in range(j - i)], _FOUND.field(2).type)],
                    schema=_FOUND)
    return run


def _block_vars(docs: DataFrame, benchmark: DataFrame, size: int, block_bytes: int) -> list:
    """The benchmark's blocks as broadcast variables; one empty block at least."""
    sc = docs.sparkSession.sparkContext
    return ([sc.broadcast(b) for b in blocks(benchmark, size, block_bytes)]
            or [sc.broadcast(Block.of([], [], size))])


def _all_matches(d: DataFrame, block_vars: list, shard_bytes: int) -> DataFrame:
    parts = [d.mapInArrow(tidy(_shards(b, shard_bytes)), _FOUND_SQL) for b in block_vars]
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches"))


def longest_matches(docs: DataFrame, benchmark: DataFrame, size: int = 10,
                    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, matches): for each document its longest verbatim
    matches with benchmark items (item, word offsets, length)."""
    return unkeyed(_all_matches(keyed(docs), _block_vars(docs, benchmark, size, block_bytes), shard_bytes))


_HITS_SQL = "doc_id long, n_words long, n_hit long, n_items long, item_ids array<string>"
_HITS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                   ("n_items", pa.int64()), ("item_ids", pa.list_(pa.string()))])


def _count(batches):
    for batch in batches:
        hit, items = [], []
        for n, matches in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            end = n_hit = 0
            for a, b in sorted((m["start"], m["start"] + m["n_words"]) for m in matches):
                n_hit += max(0, b - max(a, end))
                end = max(end, b)
            hit.append(n_hit)
            items.append(sorted({m["item_id"] for m in matches}))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hit, pa.int64()),
             pa.array([len(x) for x in items], pa.int64()), pa.array(items, pa.list_(pa.string()))],
            schema=_HITS)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10,
                  block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids) of each document: how many
    of its words lie in a match, and the items matched, sorted as strings."""
    d, block_vars = keyed(docs), _block_vars(docs, benchmark, size, block_bytes)
    if len(block_vars) == 1:  # counted where they are found
        search = _shards(block_vars[0], shard_bytes)
        return unkeyed(d.mapInArrow(tidy(lambda batches: _count(search(batches))), _HITS_SQL))
    return unkeyed(_all_matches(d, block_vars, shard_bytes).mapInArrow(tidy(_count), _HITS_SQL))
