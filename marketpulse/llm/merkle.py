"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A text is cut into paragraphs (lines, with their line ends), paragraphs into
leaves (up to ``LEAF_WORDS`` words, ending with a sentence), and sections end
at blank lines or after a paragraph that its own hash picks, so that an edit
moves no later cut. Words of more than ``PART`` characters (unspaced scripts,
encoded data, runs of white space) are cut into parts where the characters
before a place pick it, and a part counts as a word. Every cut keeps all
characters: a text is the leaves joined. A leaf's digest is that of its bytes, an inner node's that of its
children's digests, so equal roots mean equal texts.

A fingerprint is the root and the leaves' short digests with the tree's shape:

    <32 hex digits of the root>:<section>/<section>...
    section = <paragraph>.<paragraph>...     paragraph = 8 hex digits a leaf,
    of which the last two are its length in bytes (at most 240)

From two fingerprints alone, ``likeness`` is the share of text in common and
``differences`` walks down the differing branches to the edited paragraphs.

Defined cases: a null text is the empty text, which has no leaves; two empty
texts are alike (1), an empty and another are not (0); an empty table gives an
empty result; a single document follows itself; for repeated and null ids see
``common``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import NULL_ID, keyed, tidy, unkeyed
from marketpulse.llm.ordered import bounds, bucket, dealt

LEAF_WORDS = 4
#: The longest part of a word, in characters: a leaf has at most LEAF_WORDS of
#: them, of up to 4 bytes a character, and its length fits two hex digits.
PART = 15
#: The shortest part but the last, and the characters that pick a cut (one in 8).
LEAST_PART, PICKS = 4, 3
#: A paragraph whose digest begins with a byte below this ends its section.
SECTION_BYTE = 32

_WORD = re.compile(r"\s*\S+\s*|\s+")
_ENDS = re.compile(r"[.!?]\s*$")


def _parts(word: str) -> Iterator[str]:
    """A long word's parts: cut after PICKS characters whose hash says so, at
    least LEAST_PART and at most PART characters apart."""
    start = 0
    for at in range(LEAST_PART, len(word)):
        n = at - start
        if n == PART or n >= LEAST_PART and not zlib.crc32(word[at - PICKS: at].encode()) & 7:
            yield word[start:at]
            start = at
    yield word[start:]


def words(paragraph: str) -> Iterator[str]:
    for word in _WORD.findall(paragraph):
        if len(word) > PART:
            yield from _parts(word)
        else:
            yield word


def leaves(paragraph: str) -> list[str]:
    """Up to LEAF_WORDS words each, ending early with a sentence."""
    out, held, n = [], [], 0
    for word in words(paragraph):
        held.append(word)
        n += 1
        if n == LEAF_WORDS or _ENDS.search(word):
            out.append("".join(held))
            held, n = [], 0
    if held:
        out.append("".join(held))
    return out


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str) -> str:
    sections: list[list[str]] = [[]]
    sums: list[list[bytes]] = [[]]
    for paragraph in text.splitlines(keepends=True) if text else ():
        parts = [x.encode() for x in leaves(paragraph)]
        digests = [_hash(x) for x in parts]
        own = _hash(b"p" + b"".join(digests))
        sums[-1].append(own)
        sections[-1].append("".join(f"{d.hex()[:6]}{len(x):02x}"
                                    for d, x in zip(digests, parts)))
        if own[0] < SECTION_BYTE or not paragraph.strip():
            sections.append([])
            sums.append([])
    if not sums[-1]:
        sections.pop()
        sums.pop()
    root = _hash(b"d" + b"".join(_hash(b"s" + b"".join(x)) for x in sums))
    return root.hex() + ":" + "/".join(".".join(x) for x in sections)


def _leaf_counts(print_: str) -> Counter:
    body = print_[33:].replace("/", "").replace(".", "")
    return Counter(body[k: k + 8] for k in range(0, len(body), 8))


def likeness(a: str, b: str) -> float:
    """Bytes in leaves in common over the bytes of the longer text."""
    if a[:32] == b[:32]:
        return 1.0
    x, y = _leaf_counts(a), _leaf_counts(b)

    def size(c: Counter) -> int:
        return sum(n * int(leaf[6:], 16) for leaf, n in c.items())

    return size(x & y) / max(size(x), size(y), 1)


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a`` whose branch has no equal in ``b``; equal
    roots or sections are not walked into."""
    if a[:32] == b[:32]:
        return []
    there = Counter(b[33:].split("/"))
    parts = Counter(p for s in there for p in s.split("."))
    out = []
    for i, section in enumerate(a[33:].split("/") if len(a) > 33 else ()):
        if there[section]:
            there[section] -= 1
            continue
        out += [(i, j) for j, p in enumerate(section.split(".")) if not parts[p]]
    return out


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bucket, last) so that within a bucket, in order, each row
    but those marked ``last`` is followed by the document of the next smaller
    id; the smallest is followed by the greatest. Copies one row a bucket."""
    cut = bounds(docs.select("doc_id"))
    d = docs.withColumn("bucket", bucket(F.col("doc_id"), cut))
    heads = sorted(d.groupBy("bucket").agg(F.max("doc_id")).collect())  # one row a bucket
    to = [b for b, _ in heads]
    target = [(h, to[(k + 1) % len(to)]) for k, (_, h) in enumerate(heads)]
    marks = docs.sparkSession.createDataFrame(target, "head_id long, target int")
    both = d.join(F.broadcast(marks), d.doc_id == marks.head_id, "left")
    places = F.array(F.struct("bucket", F.lit(False).alias("last")),
                     F.struct(F.col("target").alias("bucket"), F.lit(True).alias("last")))
    rows = both.select("doc_id", "text", F.explode(places).alias("at"))
    rows = rows.select("doc_id", "text", "at.*").filter("bucket is not null")
    return dealt(rows, "last", F.col("doc_id").desc())


_PRINT_SQL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
_PRINT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _edit_all(batches):
    held = None  # the row before, while it waits for its next
    for batch in batches:
        rows = []
        for doc_id, text, _, last in zip(*(batch.column(k).to_pylist() for k in range(4))):
            text = text or ""
            own = fingerprint(text)
            if held:
                old_id, old, old_print = held
                n = len(old)
                edited = old[: n - n // 3] + text[: n // 3]
                new = fingerprint(edited)
                rows.append((None if old_id == NULL_ID else old_id, n,
                             hashlib.sha256(edited.encode()).hexdigest(), old_print, new,
                             likeness(old_print, new), likeness(old_print, own)))
            held = None if last else (doc_id, text, own)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _PRINT)],
                                             schema=_PRINT)


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last third
    replaced by the beginning of the next document), and their likenesses."""
    d = keyed(docs)
    if d.isEmpty():
        return docs.sparkSession.createDataFrame([], _PRINT_SQL)
    return with_next(d).mapInArrow(tidy(_edit_all), _PRINT_SQL)


_OWN_SQL = "doc_id long, fingerprint string"
_OWN = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])


def _own(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([fingerprint(t or "") for t in batch.column(1).to_pylist()],
                                       pa.string())], schema=_OWN)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of each document."""
    return unkeyed(keyed(docs).mapInArrow(tidy(_own), _OWN_SQL))
