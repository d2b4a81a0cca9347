"""N-gram Jaccard self-join: size-aware, heavy and light.

A document's set holds the hashes of its distinct word shingles. Two sets are
linked if ``den`` * intersection >= ``num`` * union. Equal sets are one class
first, whose smallest id stands for it.

* Small sets enumerate fixed-size subsets. Sets of a and b shingles are linked
  if and only if they share as many shingles as ``overlap(a, b)`` says, so each
  small set emits its subsets of each such size, and a subset in common is a
  link.
* Large sets scan inverted lists. In any one order of all shingles, linked
  sets share one among the first ``prefix(n)`` of each; the order is by document
  frequency, rarest first. Pairs that a list's sizes and positions leave
  possible are verified on the whole sets.
* The boundary between the two is the size up to which enumerating costs fewer
  entries than scanning (``boundary``), from the measured length of lists.

Lists of shingles in more than ``DENSE`` documents (a passage, a group of near
copies) are never paired among themselves: each set is compared with one centre
of its list and size bin, and components are formed. Sets outside their list's
largest component then meet a few pivots of it, one a round, and what is still
outside is compared with all others of the list where the distances to the
centre allow a link (Jaccard distance is a metric). Pairs within a component
need no comparing, so components stay exact.

Defined cases: null and empty texts and texts without words have the empty
set, are linked with nothing, and are components of their own; a text of fewer
words than a shingle has one shingle, all its words; an empty table gives an
empty result; other columns are not read; for repeated and null ids see
``common``. A shingle is known by 64 bits of hash, a set by 128.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import (NULL_ID, again, int_array, keyed, partitions, stored,
                                    text_bytes, tidy, unkeyed)
from marketpulse.llm.graph import components

SHINGLE, NUM, DEN = 4, 85, 100
#: Document frequency from which a shingle's frequency is told to its documents.
COMMON = 3
#: Document frequency above which a list is dense.
DENSE = 16
#: Largest size considered for enumeration.
MOST_SMALL = 24
#: Rounds in which sets outside their list's largest component meet a pivot.
PIVOTS = 3
RANGE_ENTRIES = 1 << 20
SLICE_ENTRIES = 1 << 18


def overlap(a, b, num: int = NUM, den: int = DEN):
    """Least intersection of linked sets of those sizes."""
    return -(-num * (a + b) // (num + den))


def prefix(n, num: int = NUM, den: int = DEN):
    """How many first shingles hold one in common with any linked set."""
    return n + (num * n) // -den + 1


def subset_sizes(n: int, most: int, num: int = NUM, den: int = DEN) -> list[int]:
    """Sizes of the subsets that a set of n emits to meet sets of up to ``most``."""
    low, high = -(-num * n // den), min(most, den * n // num)
    return sorted({overlap(n, m, num, den) for m in range(low, high + 1)})


def boundary(scan: float, num: int = NUM, den: int = DEN) -> int:
    """Greatest size (up to MOST_SMALL) for which enumerating subsets emits no
    more entries than scanning the prefix's lists of mean length ``scan``."""
    size = 0
    for n in range(1, MOST_SMALL + 1):
        if sum(comb(n, c) for c in subset_sizes(n, n, num, den)) <= prefix(n, num, den) * (1 + scan):
            size = n
        else:
            break
    return size


def _shingles(w: rolling.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct shingles, in that order."""
    at, h = w.windows(k)
    row, n = w.rows()[at], w.counts
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        row, h = np.concatenate([row, short]), np.concatenate([h, w.whole(short)])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _signatures(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, ...]:
    """Size and two sums of mixed hashes of each row's set."""
    n = np.bincount(row, minlength=rows)
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(rolling.mix(h ^ np.uint64(salt)))])
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    end = np.cumsum(n)
    return n, *(s[end] - s[end - n] for s in sums)


def _slices(batches, k: int):
    """(ids, row, hash, text rows) of slices of the batches' rows."""
    for batch in batches:
        ids = int_array(batch.column(0))
        offsets, data = rolling.texts(batch.column(1))
        for i, j in rolling.ranges(offsets):
            row, h = _shingles(rolling.words(offsets, data, i, j, lower=True), k)
            yield batch, i, ids[i:j], row, h


_SETS_SQL = "doc_id long, n_shingles long, sig_a long, sig_b long"
_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig_a", pa.int64()),
                   ("sig_b", pa.int64())])


def _sets(k: int):
    def run(batches):
        for _, _, ids, row, h in _slices(batches, k):
            n, a, b = _signatures(row, h, len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (ids, n, a.view(np.int64), b.view(np.int64))],
                schema=_SETS)
    return run


_BLOCK = pa.schema([("range", pa.int32()), ("key", pa.binary()), ("doc", pa.binary()),
                    ("at", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary())])
_BLOCK_SQL = "range int, key binary, doc binary, at binary, ids binary, sizes binary"


def _cut(h: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)


def _pack(ids, sizes, row, h, at, n_ranges: int, key_type, first: int = 0) -> pa.RecordBatch:
    """A block for each hash range: keys, and for each its document and ``at``."""
    cut = _cut(h, n_ranges)
    order = np.argsort(cut, kind="stable")
    edge = np.flatnonzero(np.diff(cut[order], prepend=-1, append=n_ranges))
    rows = {c: [] for c in _BLOCK.names}
    for a, b in zip(edge[:-1], edge[1:]):
        o = order[a:b]
        own, local = np.unique(row[o], return_inverse=True)
        values = (first + int(cut[o[0]]), h[o].astype(key_type).tobytes(),
                  local.astype(np.uint16 if len(own) < 1 << 16 else np.uint32).tobytes(),
                  at[o].astype(np.uint32).tobytes() if at is not None else b"",
                  ids[own].tobytes(), sizes[own].astype(np.uint32).tobytes() if sizes is not None else b"")
        for c, v in zip(_BLOCK.names, values):
            rows[c].append(v)
    return pa.RecordBatch.from_pydict(rows, schema=_BLOCK)


def _unpack(table: pa.Table, key_type):
    key, doc, at, size = [], [], [], []
    for k, d, p, i, s in zip(*(table.column(c).to_pylist() for c in _BLOCK.names[1:])):
        ids = np.frombuffer(i, np.int64)
        local = np.frombuffer(d, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        key.append(np.frombuffer(k, key_type))
        doc.append(ids[local])
        if p:
            at.append(np.frombuffer(p, np.uint32))
            size.append(np.frombuffer(s, np.uint32)[local])
    return [np.concatenate(x).astype(np.int64) if x and x is not key else
            np.concatenate(x) if x else None for x in (key, doc, at, size)]


def _all_shingles(k: int, n_ranges: int):
    """Blocks of all shingles; of equal sets in a slice the smallest id only, as
    the class's representative has to be told its shingles' frequencies."""
    def run(batches):
        held, n = [], 0

        def packed():
            ids, row, h = (np.concatenate([x[c] for x in held]) for c in range(3))
            return _pack(ids, None, row, h, None, n_ranges, np.uint32)

        base = 0
        for _, _, ids, row, h in _slices(batches, k):
            sig = np.stack([x.astype(np.uint64) for x in _signatures(row, h, len(ids))])
            order = np.lexsort((ids, *sig))
            new = np.ones(len(ids), bool)
            new[1:] = (sig[:, order[1:]] != sig[:, order[:-1]]).any(axis=0)
            keep = np.zeros(len(ids), bool)
            keep[order[new]] = True
            held.append((ids, row[keep[row]] + base, h[keep[row]]))
            base += len(ids)
            n += len(held[-1][1])
            if n >= SLICE_ENTRIES:
                yield packed()
                held, n, base = [], 0, 0
        if n:
            yield packed()
    return run


_TOLD_SQL = "doc_id long, shingle long, df int, squares long, entries long"
_TOLD = pa.schema([("doc_id", pa.int64()), ("shingle", pa.int64()), ("df", pa.int32()),
                   ("squares", pa.int64()), ("entries", pa.int64())])


def _frequencies(table: pa.Table) -> pa.Table:
    """Tells documents their shingles of at least COMMON documents. A shingle
    is named by its range and 32 bits; two of one name count as one."""
    key, doc, _, _ = _unpack(table, np.uint32)
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    _, where, df = np.unique(key, return_inverse=True, return_counts=True)
    df = df[where]
    often = np.flatnonzero(df >= COMMON)
    name = (table.column("range")[0].as_py() << 32) | key[often].astype(np.int64)
    light = df[df <= DENSE]
    n = len(often) + 1
    return pa.Table.from_arrays(
        [pa.array([*doc[often].tolist(), None], pa.int64()), pa.array([*name.tolist(), None], pa.int64()),
         pa.array([*df[often].tolist(), None], pa.int32()),
         pa.array([None] * (n - 1) + [int(light.sum())], pa.int64()),
         pa.array([None] * (n - 1) + [len(light)], pa.int64())], schema=_TOLD)


def _ordered(row, h, n, told: list, n_ranges: int):
    """(row, hash, place in its row, frequency) with each row's shingles in the
    common order: by frequency (as told, else below COMMON), then by hash."""
    df = np.ones(len(h), np.int64)
    name = (_cut(h, n_ranges) << 32) | (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
    end = np.cumsum(n)
    for r, pairs in enumerate(told):
        if pairs is None:
            continue
        names, counts = pairs
        own = slice(end[r] - n[r], end[r])
        order = np.argsort(names)
        at = np.minimum(np.searchsorted(names[order], name[own]), len(names) - 1)
        hit = names[order][at] == name[own]
        df[own] = np.where(hit, counts[order][at], 1)
    order = np.lexsort((h, df, row))
    place = np.arange(len(h)) - np.repeat(end - n, n)
    return row, h[order], place, df[order]


_KEYS_SQL = _BLOCK_SQL + ", list long, doc_id long, size int, place int"
_KEYS = pa.schema([*_BLOCK, ("list", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()),
                   ("place", pa.int32())])


def _with_nulls(batch: pa.RecordBatch | None, dense) -> pa.RecordBatch:
    if batch is not None:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.nulls(len(batch), f.type) for f in list(_KEYS)[-4:])], schema=_KEYS)
    n = len(dense[0])
    return pa.RecordBatch.from_arrays(
        [*(pa.nulls(n, f.type) for f in _BLOCK),
         *(pa.array(x, f.type) for x, f in zip(dense, list(_KEYS)[-4:]))], schema=_KEYS)


def _keys(k: int, n_ranges: int, small: int, num: int, den: int):
    """Prefix entries of the sets as blocks (light lists) and as rows (dense
    lists); subsets of the small sets as blocks of the ranges from n_ranges."""
    least_met = -(-num * (small + 1) // den)  # smaller sets meet no large one

    def run(batches):
        for batch, i, ids, row, h in _slices(batches, k):
            n = np.bincount(row, minlength=len(ids))
            told = []
            for x in batch.column(2)[i: i + len(ids)]:
                told.append((x.values.field("shingle").to_numpy(), x.values.field("df").to_numpy())
                            if x.is_valid and len(x.values) else None)
            row, h, place, df = _ordered(row, h, n, told, n_ranges)
            size = n[row]
            head = (place < prefix(size, num, den)) & (size >= least_met)
            thin, thick = head & (df <= DENSE), head & (df > DENSE)
            if thin.any():
                yield _with_nulls(_pack(ids, n, row[thin], h[thin], place[thin], n_ranges, np.uint64), None)
            if thick.any():
                yield _with_nulls(None, (h[thick].view(np.int64), ids[row[thick]],
                                         size[thick].astype(np.int32), place[thick].astype(np.int32)))
            rows, keys, sizes = [], [], []
            end = np.cumsum(n)
            for r in np.flatnonzero((n > 0) & (n <= small)).tolist():
                own = np.sort(rolling.mix(h[end[r] - n[r]: end[r]]))
                for c in subset_sizes(int(n[r]), small, num, den):
                    for part in combinations(range(int(n[r])), c):
                        rows.append(r)
                        keys.append(own[list(part)].sum(dtype=np.uint64) + np.uint64(c))
                        sizes.append(c)
            if rows:
                yield _with_nulls(_pack(ids, n, np.array(rows), rolling.mix(np.array(keys, np.uint64)),
                                        np.array(sizes), n_ranges, np.uint64, n_ranges), None)
    return run


_PAIR_SQL = "a long, b long, sure boolean"
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_())])


def _pairs(n_ranges: int, num: int, den: int):
    """Pairs of a range's lists that sizes and places leave possible; pairs
    with a subset of the size they need in common are sure."""
    def run(table: pa.Table) -> pa.Table:
        sure = table.column("range")[0].as_py() >= n_ranges
        key, doc, at, size = _unpack(table, np.uint64)
        order = np.lexsort((doc, size, key))
        key, doc, at, size = key[order], doc[order], at[order], size[order]
        a, b, shift = [], [], 1
        if sure:  # sets linked to one another are linked to the smallest of them
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            x, y = np.flatnonzero(new)[np.cumsum(new) - 1], np.arange(len(key))
            good = (x != y) & (at >= overlap(size[x], size[y], num, den))
            a.append(np.minimum(doc[x], doc[y])[good])
            b.append(np.maximum(doc[x], doc[y])[good])
        while not sure and shift < len(key):  # lists are of DENSE entries at most
            x = np.flatnonzero(key[shift:] == key[:-shift])
            if not len(x):
                break
            y = x + shift
            left = np.minimum(size[x] - at[x], size[y] - at[y])
            good = (den * size[x] >= num * size[y]) & (left >= overlap(size[x], size[y], num, den))
            a.append(np.minimum(doc[x], doc[y])[good])
            b.append(np.maximum(doc[x], doc[y])[good])
            shift += 1
        none = np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate([none, *a]), np.concatenate([none, *b])], axis=1), axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                                     pa.array(np.full(len(pairs), sure))], schema=_PAIR)
    return run


_TOKENS = pa.schema([("doc_id", pa.int64()), ("set", pa.binary())])


def _whole_sets(k: int):
    def run(batches):
        for _, _, ids, row, h in _slices(batches, k):
            end = np.cumsum(np.bincount(row, minlength=len(ids)))
            sets = [h[x:y].tobytes() for x, y in zip([0, *end[:-1].tolist()], end.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())],
                                             schema=_TOKENS)
    return run


_LINK_SQL = "a long, b long, jaccard double, linked boolean"
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("jaccard", pa.float64()),
                   ("linked", pa.bool_())])


def _compare(num: int, den: int):
    def run(batches):
        for batch in batches:
            jaccard, linked = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                met = int(np.count_nonzero(x[at] == y))
                union = len(x) + len(y) - met
                jaccard.append(met / union)
                linked.append(den * met >= num * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(jaccard, pa.float64()),
                                              pa.array(linked, pa.bool_())], schema=_LINK)
    return run


def whole_sets(d: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Stored (doc_id, set) of the documents in ``ids`` (id, distinct)."""
    chosen = d.join(ids, again(F.col("doc_id")) == again(F.col("id")), "left_semi")
    return stored(chosen.mapInArrow(tidy(_whole_sets(k)), "doc_id long, set binary"), "sets")


def verified(sets: DataFrame, pairs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Stored (a, b, jaccard, linked) of the pairs, on whole sets."""
    one = sets.select(again(F.col("doc_id")).alias("ka"), F.col("set").alias("x"))
    two = sets.select(again(F.col("doc_id")).alias("kb"), F.col("set").alias("y"))
    rows = (pairs.join(one, again(F.col("a")) == F.col("ka"))
            .join(two, again(F.col("b")) == F.col("kb")).select("a", "b", "x", "y"))
    return stored(rows.mapInArrow(tidy(_compare(num, den)), _LINK_SQL), "verified")


def _bins(dense: DataFrame, num: int, den: int) -> DataFrame:
    """Size bins so wide that linked sets lie in the same or the next one."""
    return dense.withColumn("bin", F.floor(F.log("size") / F.log(F.lit(den / num))).cast("int"))


def centre_pairs(dense: DataFrame, num: int = NUM, den: int = DEN) -> tuple[DataFrame, DataFrame]:
    """Pairs of each set of a dense list with the centres (smallest ids) of its
    bin and the one below; and the list's entries with the own bin's centre."""
    binned = _bins(dense, num, den)
    centre = (binned.groupBy("list", "bin").agg(F.min("doc_id").alias("centre"))
              .select(again(F.col("list")).alias("k"), F.col("bin").alias("of"), "centre"))
    two = binned.withColumn("of_bin", F.explode(F.array(F.col("bin"), F.col("bin") - 1)))
    met = two.join(centre, (again(F.col("list")) == F.col("k")) & (F.col("of_bin") == F.col("of")))
    pairs = met.filter("doc_id <> centre").select(
        F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct()
    own = met.filter("of_bin = bin").select("list", "doc_id", "size", "place", "bin", "centre")
    return pairs, own


def open_entries(own: DataFrame, known: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored entries of the dense lists that hold several components, with
    each set's component, distance to its centre (``far``), and the list's
    largest component (``most``)."""
    lab = labels.select(again(F.col("id")).alias("kl"), "component")
    x = own.join(lab, again(F.col("doc_id")) == F.col("kl"), "left").select(
        own["*"], F.coalesce("component", "doc_id").alias("component"))
    near = known.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("jaccard").alias("nj"))
    x = x.join(near, (again(F.least("doc_id", "centre")) == again(F.col("na")))
               & (F.greatest("doc_id", "centre") == F.col("nb")), "left")
    x = x.select("list", "doc_id", "size", "place", "centre", "component",
                 F.when(F.col("doc_id") == F.col("centre"), 0.0).otherwise(1 - F.col("nj")).alias("far"))
    x = stored(x, "dense")
    parts = x.groupBy("list", "component").count()
    most = (parts.groupBy("list").agg(F.max_by("component", F.struct("count", "component")).alias("most"),
                                      F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select(again(F.col("list")).alias("k"), "most"))
    return stored(x.join(most, again(F.col("list")) == F.col("k")).drop("k"), "open")


def _fresh(pairs: DataFrame, known: DataFrame) -> DataFrame:
    return stored(pairs.distinct().join(known.select("a", "b"), ["a", "b"], "left_anti"), "candidates")


def pivot_pairs(open_: DataFrame, known: DataFrame, turn: int) -> DataFrame:
    """Sets outside their list's largest component, each with one pivot of it:
    a set near the centre, another one each turn. Sets that were only far from
    the centre find their component so, a pair for each."""
    order = F.struct(F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(4)), "far", "doc_id")
    pivot = (open_.filter("component = most and far is not null").groupBy("list")
             .agg(F.min_by("doc_id", order).alias("pivot")).select(again(F.col("list")).alias("k"), "pivot"))
    met = open_.filter("component <> most").join(pivot, again(F.col("list")) == F.col("k"))
    return _fresh(met.select(F.least("doc_id", "pivot").alias("a"),
                             F.greatest("doc_id", "pivot").alias("b")), known)


def cross_pairs(open_: DataFrame, known: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """All pairs that are still open: different components, at least one set
    outside its list's largest component, and sizes, places and distances to a
    common centre that allow a link. Not yet compared ones."""
    out = open_.filter("component <> most").select(*[F.col(c).alias(f"o_{c}") for c in open_.columns])
    may = ((F.col("list") == F.col("o_list")) & (F.col("component") != F.col("o_component"))
           & (num * F.greatest("size", "o_size") <= den * F.least("size", "o_size"))
           & ((num + den) * F.least(F.col("size") - F.col("place"), F.col("o_size") - F.col("o_place"))
              >= num * (F.col("size") + F.col("o_size")))
           & ((F.col("centre") != F.col("o_centre")) | F.col("far").isNull() | F.col("o_far").isNull()
              | (F.abs(F.col("far") - F.col("o_far")) <= 1 - num / den + 1e-9)))
    return _fresh(open_.join(out, may).select(F.least("doc_id", "o_doc_id").alias("a"),
                                              F.greatest("doc_id", "o_doc_id").alias("b")), known)


def links(docs: DataFrame, k: int = SHINGLE, num: int = NUM,
          den: int = DEN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, labels) of keyed ``docs``: every document's set, the
    classes of equal sets with their smallest id, and the components of those
    ids (ids without a link have no label)."""
    spark = docs.sparkSession
    sets = stored(docs.mapInArrow(tidy(_sets(k)), _SETS_SQL), "set-sizes")
    classes = stored(sets.filter("n_shingles > 0").groupBy("n_shingles", "sig_a", "sig_b")
                     .agg(F.min("doc_id").alias("rep")), "classes")
    n_ranges = max(4 * partitions(spark), text_bytes(docs) // (6 * RANGE_ENTRIES))
    told = stored(docs.mapInArrow(tidy(_all_shingles(k, n_ranges)), _BLOCK_SQL)
                  .groupBy("range").applyInArrow(_frequencies, _TOLD_SQL), "frequencies")
    squares, entries = told.filter("doc_id is null").agg(F.sum("squares"), F.sum("entries")).first()
    scan = (squares or 0) / (entries or 1)
    small = boundary(scan) if (num, den) == (NUM, DEN) else boundary(scan, num, den)
    own = (told.filter("doc_id is not null").groupBy("doc_id")
           .agg(F.collect_list(F.struct("shingle", "df")).alias("told"))
           .withColumnRenamed("doc_id", "rep"))
    chosen = (docs.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")
              .join(own, F.col("doc_id") == F.col("rep"), "left").select("doc_id", "text", "told"))
    keys = stored(chosen.mapInArrow(tidy(_keys(k, n_ranges, small, num, den)), _KEYS_SQL), "keys")
    found = stored(keys.filter("range is not null").select(*_BLOCK.names).groupBy("range")
                   .applyInArrow(_pairs(n_ranges, num, den), _PAIR_SQL), "pairs")
    dense = keys.filter("list is not null").select("list", "doc_id", "size", "place")
    centred, entries_ = centre_pairs(dense, num, den)
    candidates = stored(found.filter("not sure").select("a", "b").union(centred).distinct(), "candidates")
    ids = (candidates.select(F.explode(F.array("a", "b")).alias("id"))
           .union(dense.select("doc_id")).distinct())
    whole = whole_sets(docs, ids, k)
    known = verified(whole, candidates, num, den)
    linked = known.filter("linked").select("a", "b").union(found.filter("sure").select("a", "b"))
    labels = components(linked)
    for turn in range(PIVOTS + 1):
        open_ = open_entries(entries_, known, labels)
        if open_.isEmpty():
            break
        rest = pivot_pairs(open_, known, turn) if turn < PIVOTS else cross_pairs(open_, known, num, den)
        if rest.isEmpty():
            continue
        more = verified(whole, rest, num, den)
        known = known.union(more)
        if not more.filter("linked").isEmpty():
            linked = linked.union(more.filter("linked").select("a", "b"))
            labels = components(linked)
    return sets, classes, labels


def near_duplicates(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document."""
    sets, classes, labels = links(keyed(docs), k, num, den)
    named = classes.join(labels, F.col("rep") == F.col("id"), "left").select(
        again(F.col("sig_a")).alias("ka"), F.col("sig_b").alias("kb"), F.col("n_shingles").alias("kn"),
        F.coalesce("component", "rep").alias("component_id"))
    out = sets.join(named, (again(F.col("sig_a")) == F.col("ka")) & (F.col("sig_b") == F.col("kb"))
                    & (F.col("n_shingles") == F.col("kn")), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return unkeyed(out).withColumn("component_id", F.nullif("component_id", F.lit(NULL_ID)))
