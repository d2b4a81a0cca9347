"""SentencePiece encoding and decoding as a relational lattice.

A text is escaped as SentencePiece does: a space goes before it, and spaces
are U+2581 to the pieces. It is cut into words wherever no piece can reach
over the cut: before a run of spaces, around line ends, and between two ASCII
characters that stand side by side in no piece (a letter and a comma, say). The
best path of a text is that of its words in turn. Distinct words are encoded
once:

1. each explodes into its substrings of up to the longest piece's length,
2. which are joined to the piece table by equality; characters that no piece
   covers alone become byte pieces;
3. the edges are grouped by word, and
4. folded from left to right, for many words at a time: of the edges that end
   at a place the best by summed score stays (of equals the longest piece).

Words of more than ``MOST`` characters (unspaced texts, encoded data) take
the same path over the same pieces, place by place in ``_long_words``: what the
fold holds would grow with the square of their length.

The piece table is the model's, so its size is fixed and it is broadcast.
Words are known by 64 bits of hash, and texts are put together from their
words' ids by hash. The ``hot`` most frequent words, a fixed number, go to all
tasks as packed arrays of about 20 bytes a word. All other words reach their
documents by a join of (document, hash), once for each document that holds
them, so none that is frequent travels and no word is left out.

Decoding maps ids to pieces, joins them, puts byte pieces together as UTF-8
and takes the escapes back. A text with U+2581 comes back with spaces for it,
any other exactly.

Defined cases: null and empty texts have no ids and decode to the empty text;
an empty table gives an empty result; extra columns are not read; for repeated
and null ids see ``common``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import int_array, keyed, partitions, removed, stored, tidy, unkeyed

SPACE = "\u2581"
#: Characters of the longest word whose lattice is made of rows.
MOST = 1024
#: Most frequent words that are sent to every task.
HOT = 500_000
#: Bytes of text whose words a task counts together.
COUNTED = 16 << 20
#: Words in a partition of lattices.
LATTICES = 1 << 15
#: Edges that a task folds together.
EDGES = 1 << 19
_WORD = re.compile(r" +[^ \n]*|[^ \n]+|\n")
#: Groups that are gathered in memory before Spark sorts instead.
GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


@dataclass
class Model:
    """A piece table. Its spaces are plain spaces here."""
    pieces: list[tuple[str, int, float]]   # the ordinary ones: text, id, score
    byte_ids: list[int]                    # of the 256 bytes
    raw: list[bytes]                       # what each id stands for
    unknown: float                         # score of a character by bytes

    @classmethod
    def load(cls, path: str) -> Model:
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        plain, byte_ids, raw = [], [m.unk_id()] * 256, [b""] * m.vocab_size()
        for i in range(m.vocab_size()):
            text = m.id_to_piece(i)
            if m.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
                raw[i] = bytes([int(text[3:5], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                plain.append((text.replace(SPACE, " "), i, m.get_score(i)))
                raw[i] = plain[-1][0].encode()
        return cls(plain, byte_ids, raw, min(s for _, _, s in plain) - 10)

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    def useful(self) -> list[tuple[str, int, float]]:
        """The pieces that a best path can hold: those whose own score is not
        beaten by smaller pieces of the same text."""
        score = {p: s for p, _, s in self.pieces}
        out = []
        for piece in self.pieces:
            text, best = piece[0], [0.0]
            for end in range(1, len(text) + 1):
                best.append(max((best[a] + score[text[a:end]] for a in range(end)
                                 if (a or end < len(text)) and text[a:end] in score), default=-np.inf))
            if best[-1] <= piece[2] + 1e-9 * abs(piece[2]):
                out.append(piece)
        return out

    def joins(self) -> np.ndarray:
        """For two bytes (256 * first + second), whether a piece may hold them side
        by side; for bytes that are not ASCII always true."""
        out = np.zeros((256, 256), bool)
        out[128:], out[:, 128:] = True, True
        for text, _, _ in self.pieces:
            for a, b in zip(text, text[1:]):
                if ord(a) < 128 and ord(b) < 128:
                    out[ord(a), ord(b)] = True
        return out.ravel()

    def ids(self, codes: list[int]) -> list[int]:
        """Ids for a path's codes, characters without a piece by their bytes."""
        out: list[int] = []
        for c in codes:
            out += [c] if c < BYTES else [self.byte_ids[b] for b in chr(c - BYTES).encode()]
        return out


def words(text: str) -> list[str]:
    """The words of one text as spaces and line ends cut it."""
    return _WORD.findall(" " + text.replace(SPACE, " ")) if text else []


@dataclass
class _Split:
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray   # index of each row's first word, one more for the end


def _split(offsets: np.ndarray, data: np.ndarray, i: int, j: int, joins: np.ndarray) -> _Split:
    edges = offsets[i: j + 1] - offsets[i]
    full = np.flatnonzero(np.diff(edges))
    b = np.insert(data[offsets[i]: offsets[j]], edges[full], 32)  # a space before each text
    begin = edges[full] + np.arange(len(full))
    n = len(b)
    space, line = b == 32, b == 10
    starts = line.copy()
    starts[1:] |= line[:-1] | (space[1:] & ~space[:-1]) | ~joins[b[:-1].astype(np.uint16) << 8 | b[1:]]
    starts[begin] = True
    at = np.flatnonzero(starts)
    end = np.append(at[1:], n) if n else at
    rows = np.zeros(j - i + 1, np.int64)
    rows[full + 1] = np.diff(np.append(np.searchsorted(at, begin), len(at)))
    return _Split(b, at, end, rolling.hash_ranges(b, at, end), np.cumsum(rows))


def _column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if pc.any(pc.match_substring(column, SPACE)).as_py():
        column = pc.replace_substring(column, SPACE, " ")
    return rolling.texts(column)


_COUNT = pa.schema([("hash", pa.int64()), ("word", pa.string()), ("n", pa.int64())])


def _count_words(model_var):
    """The distinct words of every COUNTED bytes of text and their counts."""
    def told(held):
        value = np.concatenate([v for v, *_ in held])
        value, first, back = np.unique(value, return_index=True, return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([x[1] for x in held])).astype(np.int64)
        edge = np.cumsum([0, *(len(x[0]) for x in held)])
        order = np.argsort(first)
        cut = np.searchsorted(first[order], edge)
        out = []
        for k, (_, _, raw, start, end) in enumerate(held):
            at = first[order[cut[k]: cut[k + 1]]] - edge[k]
            out += [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(value[order].view(np.int64)), pa.array(out, pa.binary()).cast(pa.string()),
             pa.array(n[order], pa.int64())], schema=_COUNT)

    def run(batches):
        joins, held, size = model_var.value.joins(), [], 0
        for batch in batches:
            offsets, data = _column(batch.column(0))
            for i, j in rolling.ranges(offsets, 2 * rolling.SLICE_BYTES):
                s = _split(offsets, data, i, j, joins)
                value, at, n = np.unique(s.hash, return_index=True, return_counts=True)
                held.append((value, n, s.data.tobytes(), s.start[at].astype(np.int32), s.end[at].astype(np.int32)))
                size += len(s.data)
                if size >= COUNTED:
                    yield told(held)
                    held, size = [], 0
        if held:
            yield told(held)
    return run


def vocabulary(d: DataFrame, model_var) -> DataFrame:
    """(hash, word, n): the distinct words of the texts and how often they occur."""
    return (d.select("text").mapInArrow(tidy(_count_words(model_var)), "hash long, word string, n long")
            .groupBy("hash", "word").agg(F.sum("n").alias("n")))


#: An edge is one number: end << PLACE + CODE | start << CODE | code; the code is
#: a piece's id, or BYTES + a character's code point.
BYTES = 1 << 24
CODE, PLACE = 25, 19


def edges(vocab: DataFrame, model: Model) -> DataFrame:
    """(hash, edge): the lattice of each word."""
    spark = vocab.sparkSession
    pieces = model.useful()
    longest = max(len(p) for p, _, _ in pieces)
    table = spark.createDataFrame([(p, i) for p, i, _ in pieces], "piece string, id int")
    size = F.char_length("word")
    cut = (vocab.select("hash", "word", F.explode(F.sequence(F.lit(1), size)).alias("at"))
           .select("hash", "at", F.substring(F.col("word"), F.col("at"), F.lit(longest)).alias("rest"))
           .select("hash", "at", "rest", F.explode(F.sequence(F.lit(1), F.char_length("rest"))).alias("long"))
           .withColumn("part", F.substring("rest", F.lit(1), F.col("long"))))
    met = cut.join(F.broadcast(table), F.col("part") == F.col("piece"), "left")
    met = met.filter("id is not null or long = 1")
    end, start = F.col("at") + F.col("long") - 1, F.col("at") - 1
    code = F.coalesce("id", F.ascii("part") + BYTES)
    edge = (F.shiftleft(end.cast("long"), PLACE + CODE).bitwiseOR(F.shiftleft(start.cast("long"), CODE))
            .bitwiseOR(code.cast("long")))
    return met.select("hash", edge.alias("edge"))


def _paths(model: Model):
    """(hash, codes) of lattices: place by place, for many words at a time."""
    score_of = np.zeros(len(model.raw))
    for _, i, s in model.pieces:
        score_of[i] = s
    unknown = model.unknown

    def best(lattices: list[pa.RecordBatch]) -> pa.RecordBatch:
        hashes = np.concatenate([int_array(x.column(0)) for x in lattices])
        size = np.concatenate([np.diff(x.column(1).offsets.to_numpy()) for x in lattices])
        edge = np.concatenate([x.column(1).flatten().to_numpy() for x in lattices])
        end, start = edge >> PLACE + CODE, edge >> CODE & (1 << PLACE) - 1
        length = np.maximum.reduceat(end, np.cumsum(size) - size)
        base = np.cumsum(length + 1) - length - 1   # a word's place 0 among those of all words
        word = np.repeat(np.arange(len(size)), size)
        order = np.argsort(end << PLACE + CODE | word << PLACE | start)
        code, end = (edge & (1 << CODE) - 1)[order], end[order]
        before, after = (base[word] + start)[order], base[word[order]] + end
        gain = np.where(code < BYTES, score_of[np.minimum(code, len(score_of) - 1)], unknown)
        score = np.zeros(int(length.sum()) + len(size))
        last = np.zeros(len(score), np.int64)   # the best edge that ends at a place
        cuts = np.searchsorted(end, np.arange(1, int(length.max()) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            total, place = score[before[a:b]] + gain[a:b], after[a:b]
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            score[place[first]] = np.maximum.reduceat(total, first)
            top = np.flatnonzero(total == score[place])
            top = top[np.append(True, place[top[1:]] != place[top[:-1]])]   # of equals the longest piece
            last[place[top]] = a + top
        # back from the words' ends, a piece at a time
        live, at, found = np.arange(len(size)), base + length, []
        while len(live):
            found.append((live, code[last[at]]))
            at = before[last[at]]
            more = at > base[live]
            live, at = live[more], at[more]
        n = np.bincount(np.concatenate([w for w, _ in found]), minlength=len(size))
        edges_at, out = np.append(0, np.cumsum(n)), np.zeros(int(n.sum()), np.int32)
        for k, (w, c) in enumerate(found, 1):
            out[edges_at[w + 1] - k] = c
        lists = pa.ListArray.from_arrays(pa.array(edges_at, pa.int32()), pa.array(out, pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), lists], names=["hash", "codes"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += len(batch.column(1).flatten())
            if n >= EDGES:
                yield best(held)
                held, n = [], 0
        if held:
            yield best(held)
    return run


def fold(lattice: DataFrame, model: Model) -> DataFrame:
    """(hash, codes): the best path through each word's lattice."""
    group = lattice.groupBy("hash").agg(F.collect_list("edge").alias("edges"))
    return group.mapInArrow(tidy(_paths(model)), "hash long, codes array<int>")


def _long_words(model: Model):
    """(hash, codes) of long words: the best path as ``fold`` finds it."""
    score_of = {i: s for _, i, s in model.pieces}
    pieces = {p: (i, score_of[i]) for p, i, _ in model.useful()}
    longest, unknown = max(map(len, pieces), default=1), model.unknown

    def path(word: str) -> list[int]:
        best, back = [0.0], [(0, 0)]
        for end in range(1, len(word) + 1):
            top = None
            for start in range(max(0, end - longest), end):
                found = pieces.get(word[start:end])
                if found is None:
                    if end - start > 1:
                        continue
                    found = BYTES + ord(word[start]), unknown
                score = best[start] + found[1]
                if top is None or score > top:
                    top, last = score, (start, found[0])
            best.append(top)
            back.append(last)
        codes, end = [], len(word)
        while end:
            end, code = back[end]
            codes.append(code)
        return codes[::-1]

    def run(batches):
        for batch in batches:
            found = [path(w) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))],
                                             names=["hash", "codes"])
    return run


def piece_ids(codes: Column, model: Model) -> Column:
    """Ids for a path's codes, characters without a piece by their UTF-8 bytes."""
    table = F.array(*[F.lit(i) for i in model.byte_ids])

    def of(c: Column) -> Column:
        u = c - BYTES
        tail = [F.shiftright(u, 6 * k).bitwiseAND(63) + 128 for k in range(3)]
        utf8 = (F.when(u < 0x80, F.array(u)).when(u < 0x800, F.array(F.shiftright(u, 6) + 0xC0, tail[0]))
                .when(u < 0x10000, F.array(F.shiftright(u, 12) + 0xE0, tail[1], tail[0]))
                .otherwise(F.array(F.shiftright(u, 18) + 0xF0, tail[2], tail[1], tail[0])))
        return F.when(c < BYTES, F.array(c)).otherwise(F.transform(utf8, lambda b: F.get(table, b)))

    return F.when(F.exists(codes, lambda c: c >= BYTES), F.flatten(F.transform(codes, of))).otherwise(codes)


def encoded_words(vocab: DataFrame, model: Model, size: int) -> DataFrame:
    """(hash, ids) of a vocabulary of about ``size`` words, as a stored table.
    Words are dealt out before they explode, so their edges are grouped where
    they arise."""
    spark = vocab.sparkSession
    wide = F.char_length("word") > MOST
    apart = vocab.filter(wide).select("hash", "word").repartition(partitions(spark), "hash")
    dealt = vocab.filter(~wide).select("hash", "word").repartition(max(partitions(spark), size // LATTICES), "hash")
    both = fold(edges(dealt, model), model).union(
        apart.mapInArrow(tidy(_long_words(model)), "hash long, codes array<int>"))
    before = spark.conf.get(GROUPS, None)
    spark.conf.set(GROUPS, str(4 * LATTICES))
    try:
        return stored(both.select("hash", piece_ids(F.col("codes"), model).alias("ids")), "word-ids")
    finally:
        if before is None:
            spark.conf.unset(GROUPS)
        else:
            spark.conf.set(GROUPS, before)


_PACK = pa.schema([("hash", pa.binary()), ("size", pa.binary()), ("ids", pa.binary())])


def _pack(batches):
    """Each batch of (hash, ids) as one row of arrays."""
    for batch in batches:
        size = np.diff(batch.column(1).offsets.to_numpy()).astype(np.uint32)
        flat = batch.column(1).flatten().to_numpy().astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
            int_array(batch.column(0)), size, flat)], schema=_PACK)


@dataclass
class Table:
    """Ids by a word's hash (in order): size[k] of them from ids[start[k]]."""
    hash: np.ndarray
    start: np.ndarray
    size: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, packs: Iterable[tuple[bytes, bytes, bytes]], n_ids: int) -> Table:
        kind = np.uint16 if n_ids <= 1 << 16 else np.uint32
        h, size, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, kind)]
        for a, b, c in packs:
            h.append(np.frombuffer(a, np.uint64))
            wide = np.frombuffer(b, np.uint32)
            size.append(wide.astype(np.uint16) if wide.max(initial=0) < 1 << 16 else wide)
            ids.append(np.frombuffer(c, np.uint32).astype(kind))
        h, size, ids = (np.concatenate(x) for x in (h, size, ids))
        order = np.argsort(h)
        start = np.cumsum(size, dtype=np.uint32 if len(ids) < 1 << 32 else np.uint64)
        start -= size
        return cls(h[order], start[order], size[order], ids)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        if not len(self.hash):
            return np.full(len(h), -1)
        k = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[k] == h, k, -1)

    def starts(self, place: np.ndarray) -> np.ndarray:
        """Where the ids at each place begin (0 for -1)."""
        return np.array([0], np.int64)[place] if not len(self.hash) else np.where(
            place < 0, 0, self.start[place]).astype(np.int64)

    def sizes(self, place: np.ndarray) -> np.ndarray:
        return np.array([0], np.int64)[place] if not len(self.hash) else np.where(
            place < 0, 0, self.size[place]).astype(np.int64)


_RARE = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64())])


def _rare_words(table_var, model_var):
    """(doc_id, hash) of each document's distinct words that are not hot."""
    def run(batches):
        table, joins = table_var.value, model_var.value.joins()
        for batch in batches:
            ids = int_array(batch.column(0))
            offsets, data = _column(batch.column(1))
            for i, j in rolling.ranges(offsets):
                s = _split(offsets, data, i, j, joins)
                row, h = np.repeat(np.arange(j - i), np.diff(s.first)), s.hash
                rare = table.find(h) < 0
                order = np.lexsort((h[rare], row[rare]))
                row, h = row[rare][order], h[rare][order]
                new = np.ones(len(h), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j][row[new]], pa.int64()), pa.array(h[new].view(np.int64))], schema=_RARE)
    return run


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])
_IDS_SQL = "doc_id long, ids array<int>, round_trip boolean"


def _small(batches):
    """Texts on their way to their rare words, compressed."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [None if t is None else pack(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"])


def _large(column: pa.Array) -> pa.Array:
    if not pa.types.is_binary(column.type):
        return column
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([None if t is None else unpack(t) for t in column.to_pylist()], pa.large_binary()).cast(pa.large_string())


def _assemble(table_var, model_var):
    """Documents' ids from the hot table and (third column, if any) the rare
    words; and whether decoding them gives the text."""
    def run(batches):
        table, model = table_var.value, model_var.value
        joins = model.joins()
        raw = np.frombuffer(b"".join(model.raw), np.uint8)
        size = np.array([len(x) for x in model.raw], np.int64)
        start = np.cumsum(size) - size
        for batch in batches:
            ids = int_array(batch.column(0))
            offsets, data = _column(_large(batch.column(1)))
            if batch.num_columns > 2:
                rare = batch.column(2)
            for i, j in rolling.ranges(offsets):
                s = _split(offsets, data, i, j, joins)
                value, back = np.unique(s.hash, return_inverse=True)
                place = table.find(value)
                lost = place < 0
                begin, length, pool = table.starts(place), table.sizes(place), table.ids
                if batch.num_columns > 2 and lost.any():
                    found = rare.slice(i, j - i).flatten()
                    lists = found.field("ids")
                    more = Table.of([(int_array(found.field("hash")).tobytes(),
                                      np.diff(lists.offsets.to_numpy()).astype(np.uint32).tobytes(),
                                      lists.flatten().to_numpy().astype(np.uint32).tobytes())], len(model.raw))
                    k = more.find(value[lost])
                    begin[lost], length[lost] = len(pool) + more.starts(k), more.sizes(k)
                    lost[np.flatnonzero(lost)[k >= 0]] = False
                    pool = np.concatenate([pool, more.ids])
                if lost.any():
                    raise ValueError("a word without ids")
                n = length[back]
                flat = pool[rolling.places(begin[back], n)].astype(np.int64)
                edge = np.append(0, np.cumsum(n))[s.first]
                back_again = raw[rolling.places(start[flat], size[flat])]
                cut = np.append(0, np.cumsum(size[flat]))[edge]
                texts = [back_again[a + 1: b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                same = [t == data[a:b].tobytes() for t, a, b in
                        zip(texts, offsets[i:j].tolist(), offsets[i + 1: j + 1].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j], pa.int64()), lists,
                                                  pa.array(same, pa.bool_())], schema=_IDS)
    return run


def encode(docs: DataFrame, model_path: str, hot: int = HOT) -> DataFrame:
    """(doc_id, ids, round_trip) of each document."""
    spark, d = docs.sparkSession, keyed(docs)
    sc, model = spark.sparkContext, Model.load(model_path)
    model_var = sc.broadcast(model)
    vocab = stored(vocabulary(d, model_var), "words")
    # the least count with which a word is hot, from how many words have each count
    size, least, n_hot = vocab.count(), 1, 0
    for n, many in vocab.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        if n_hot + many > hot:
            least = n + 1
            break
        n_hot += many
    coded = encoded_words(vocab, model, size)
    often = coded.join(vocab.filter(F.col("n") >= least).select("hash"), "hash", "left_semi") if least > 1 else coded
    packs = often.mapInArrow(tidy(_pack), "hash binary, size binary, ids binary").toLocalIterator()
    table = sc.broadcast(Table.of(packs, len(model.raw)))
    removed(vocab)
    if n_hot == size:
        removed(coded)
        return unkeyed(d.mapInArrow(tidy(_assemble(table, model_var)), _IDS_SQL))
    held = d.mapInArrow(tidy(_rare_words(table, model_var)), "doc_id long, hash long")
    met = held.join(coded, "hash").groupBy(F.col("doc_id").alias("marked")).agg(
        F.collect_list(F.struct("hash", "ids")).alias("rare"))
    rare = stored(met, "rare-words")
    removed(coded)
    both = d.mapInArrow(tidy(_small), "doc_id long, text binary").join(rare, F.col("doc_id") == F.col("marked"), "left")
    words = F.coalesce("rare", F.array().cast("array<struct<hash: bigint, ids: array<int>>>"))
    return unkeyed(both.select("doc_id", "text", words.alias("rare")).mapInArrow(tidy(_assemble(table, model_var)), _IDS_SQL))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``, the text of its ids."""
    raw = encoded.sparkSession.sparkContext.broadcast(Model.load(model_path).raw)

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(lambda x: b"".join([raw.value[k] for k in x])[1:].decode("utf-8", "replace"))

    return encoded.withColumn("decoded", text(F.col(ids)))
