"""Token ids in binary files: Arrow streams of fixed-size-list batches.

Documents are encoded and laid end to end in id order, an end id after each.
Every bucket of ids (see ``ordered``) becomes one file, an Arrow stream with
the columns

    ids   fixed-size list of ``seq_len`` unsigned integers (16 bits where the
          vocabulary allows), equal-length sequences without gaps
    mask  fixed-size list of ``seq_len`` booleans; false on the padding that
          fills a file's last sequence

and ``BATCH`` sequences a record batch. A sequence lies at a fixed place of a
memory-mapped file, so any can be read without copying or parsing
(``Sequences``). The manifest says which documents a file holds. A task writes a name of its own
and only names that reach the manifest count, so a repeated or speculative
attempt does no harm.

Defined cases: a null or empty text is its end id alone; an empty table makes
no files; extra columns are not read; for repeated and null ids see
``common``.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import NULL_ID, keyed, partitions, stored, tidy
from marketpulse.llm.ordered import bounds, bucket, dealt
from marketpulse.session import scratch_path

SEQ_LEN = 2048
BATCH = 64
#: Bytes of an Arrow stream's end mark.
_END_MARK = 8
#: Words whose ids a worker remembers.
KNOWN_WORDS = 1_000_000

class Encoder:
    """Ids of whole texts, as the tokenizer gives them. Its pre-tokenizer never
    joins what white space parts and it puts texts in lower case, so a slice's
    distinct words are encoded once, many in one text, and the first
    KNOWN_WORDS of a worker are remembered by their hash. Texts with a special
    token's name are encoded as they are."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        [self.zero] = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.known: dict[int, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of each word, many to a text. A zero stands between two: it is a
        token of its own, which no other word without a zero contains."""
        out = [self.whole(w).tobytes() if "0" in w else b"" for w in words]
        plain = [k for k, w in enumerate(words) if "0" not in w]
        parts = [plain[k: k + 1000] for k in range(0, len(plain), 1000)]
        for part, coded in zip(parts, self.tokenizer.encode_batch_fast(
                [" 0 ".join([words[k] for k in p]) for p in parts], add_special_tokens=False)):
            ids = np.array(coded.ids, self.kind)
            cut = np.flatnonzero(ids == self.zero).tolist()
            for k, a, b in zip(part, [0, *(c + 1 for c in cut)], [*cut, len(ids)]):
                out[k] = ids[a:b].tobytes()
        return out

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row of a string column."""
        offsets, data = rolling.texts(column)
        named = np.zeros(len(column), bool)
        for s in self.special:
            named |= pc.fill_null(pc.match_substring(column, s, ignore_case=True), False).to_numpy(
                zero_copy_only=False)
        for i, j in rolling.ranges(offsets, 2 * rolling.SLICE_BYTES):
            w = rolling.words(offsets, data, i, j, lower=True)
            value, at, back = np.unique(w.hash, return_index=True, return_inverse=True)
            keys = value.tolist()
            ids = list(map(self.known.get, keys))
            new = [k for k, x in enumerate(ids) if x is None]
            raw = w.data.tobytes()
            found = self.learn([raw[w.start[k]: w.end[k]].decode() for k in at[new].tolist()])
            for k, x in zip(new, found):
                ids[k] = x
            room = max(0, KNOWN_WORDS - len(self.known))
            self.known.update((keys[k], x) for k, x in zip(new[:room], found))
            size = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
            pool, n = np.frombuffer(b"".join(ids), self.kind), size[back]
            flat = pool[rolling.places((np.cumsum(size) - size)[back], n)]
            edge = np.append(0, np.cumsum(n))[w.first].tolist()
            for row, (a, b) in enumerate(zip(edge, edge[1:]), i):
                yield self.whole(column[row].as_py()) if named[row] else flat[a:b]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder; what it has learnt serves all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _open(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


class _Writer:
    """One file, opened with its first document; takes ids a document at a time."""

    def __init__(self, root: str, number: int, kind: np.dtype, seq_len: int):
        self.path = f"{root}/part-{number:06d}-{uuid.uuid4().hex[:12]}.arrows"
        self.seq_len, self.kind = seq_len, kind
        value = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("ids", pa.list_(value, seq_len)),
                                 ("mask", pa.list_(pa.bool_(), seq_len))])
        fs, name = _open(self.path)
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(name)
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.held, self.n = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= BATCH * self.seq_len:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, self.kind), *self.held])
        row, full = self.seq_len, BATCH * self.seq_len
        while len(ids) >= full or last and len(ids):
            part, ids = ids[:full], ids[full:]
            fill = -len(part) % row
            mask = np.arange(len(part) + fill) < len(part)
            part = np.concatenate([part, np.zeros(fill, self.kind)])
            self.stream.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(part), row),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask), row)], schema=self.schema))
        self.held, self.n = [ids], len(ids)

    def close(self) -> None:
        self._write(True)
        self.stream.close()
        self.out.close()


MANIFEST_SQL = "bucket int, path string, n_ids long, doc_ids array<bigint>, lengths array<bigint>"
_MANIFEST = pa.schema([("bucket", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])


def _write_buckets(tokenizer: str, root: str, end_id: int, seq_len: int):
    def run(batches):
        own, writer, at, docs, lengths = encoder(tokenizer), None, None, [], []

        def closed():
            writer.close()
            return pa.RecordBatch.from_pydict(
                {"bucket": [at], "path": [writer.path], "n_ids": [sum(lengths)],
                 "doc_ids": [docs], "lengths": [lengths]}, schema=_MANIFEST)

        end = np.array([end_id], own.kind)
        for batch in batches:
            for b, doc_id, ids in zip(batch.column(2).to_pylist(), batch.column(0).to_pylist(),
                                      own.encode(batch.column(1))):
                if b != at:
                    if writer:
                        yield closed()
                    writer, at, docs, lengths = _Writer(root, b, own.kind, seq_len), b, [], []
                writer.add(ids)
                writer.add(end)
                docs.append(doc_id)
                lengths.append(len(ids) + 1)
        if writer:
            yield closed()
    return run


def _uri(spark: SparkSession, path: str) -> str:
    """``path`` as the cluster's file system names it, in full."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub("^file:/+", "file:///", full)


def write(docs: DataFrame, tokenizer: str, end_id: int = 1, seq_len: int = SEQ_LEN,
          root: str | None = None) -> DataFrame:
    """Encodes and writes ``docs``; returns the stored manifest, a row for each
    file: (bucket, path, n_ids, doc_ids, lengths). ``root`` is a URI all tasks
    can write; by default a new folder in the shared one."""
    spark, d = docs.sparkSession, keyed(docs)
    root = _uri(spark, root or scratch_path(spark, "tokens"))
    d = d.withColumn("bucket", bucket(F.col("doc_id"), bounds(d.select("doc_id"))))
    return stored(dealt(d, "doc_id").mapInArrow(tidy(_write_buckets(tokenizer, root, end_id, seq_len)),
                                      MANIFEST_SQL), "manifest")


def read_sequences(path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A file's batches as (ids, mask), each with a row for each sequence; a
    local file is mapped and its ids are not copied."""
    fs, name = _open(path)
    source = pa.memory_map(name) if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_stream(name)
    with source, pa.ipc.open_stream(source) as stream:
        width = stream.schema.field("ids").type.list_size
        for batch in stream:
            ids, mask = (batch.column(k).values for k in range(2))
            yield (ids.to_numpy().reshape(-1, width),
                   mask.to_numpy(zero_copy_only=False).reshape(-1, width))


class Sequences:
    """Random access to a file's sequences. All batches but the last take the
    same number of bytes, so sequence ``k`` is found by its number, without
    reading what stands before it: ``file[k]`` gives its ids as an array and its
    mask as an Arrow boolean array. Of a local file both are views of the mapped
    pages, nothing is copied; elsewhere one batch is read."""

    def __init__(self, path: str):
        fs, name = _open(path)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else fs.open_input_file(name)
        self.schema = pa.ipc.read_schema(self.source)
        self.width = self.schema.field("ids").type.list_size
        self.first = self.source.tell()
        self.held: dict[int, pa.RecordBatch] = {}
        self.per = self._batch(0).num_rows
        self.step = self.source.tell() - self.first
        # what follows the whole steps: a smaller batch, or the stream's end mark alone
        whole, rest = divmod(self.source.size() - self.first, self.step)
        last = self._batch(whole).num_rows if rest > _END_MARK else 0
        self.n = whole * self.per + last

    def _batch(self, number: int) -> pa.RecordBatch:
        if number not in self.held:
            self.source.seek(self.first + number * self.step if number else self.first)
            batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
            self.held = {number: batch}
        return self.held[number]

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= k < self.n:
            raise IndexError(k)
        number, row = divmod(k, self.per)
        batch = self._batch(number)
        ids, mask = (batch.column(c).values.slice(row * self.width, self.width) for c in range(2))
        return ids.to_numpy(), mask

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the file on, as those of one document."""
        if not 0 <= start <= start + n <= self.n * self.width:
            raise IndexError((start, n))
        if not n:
            return np.zeros(0, self.schema.field("ids").type.value_type.to_pandas_dtype())
        k, skip = divmod(start, self.width)
        parts = [self[j][0] for j in range(k, (start + n - 1) // self.width + 1)]
        return (parts[0] if len(parts) == 1 else np.concatenate(parts))[skip: skip + n]

    def close(self) -> None:
        self.held = {}
        self.source.close()


_DOCS_SQL = "doc_id long, start long, n_tokens long, ids_crc32 long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])


def _read_docs(base_of):
    def run(batches):
        base = base_of.value
        for batch in batches:
            for at, path, doc_ids, lengths in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4))):
                ids, rows, place = np.zeros(0, "<u4"), [], base[at]
                parts = read_sequences(path)
                for doc_id, n in zip(doc_ids, lengths):
                    while len(ids) < n:
                        part, mask = next(parts)
                        ids = np.concatenate([ids, part[mask].astype("<u4")])
                    rows.append((None if doc_id == NULL_ID else doc_id, place, n,
                                 zlib.crc32(ids[:n].tobytes())))
                    ids, place = ids[n:], place + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*rows), _DOCS)], schema=_DOCS)
    return run


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""
    spark = manifest.sparkSession
    sizes = manifest.select("bucket", "n_ids").orderBy("bucket").collect()  # one row a file
    base, total = {}, 0
    for b, n in sizes:
        base[b] = total
        total += n
    spread = manifest.repartition(partitions(spark))
    return spread.mapInArrow(tidy(_read_docs(spark.sparkContext.broadcast(base))), _DOCS_SQL)
