"""Spelling variants of a corpus's words, found by PartEnum signatures.

Two words are near if one inserted, deleted or replaced character makes one of
the other. A word's letters are a multiset, that is a binary vector with a
place for each (letter, how many of it came before). An inserted letter changes
one place of it, a replaced one two, so near words have Hamming distance 1 or
2. The places are cut into ``parts`` parts by a hash; as at most d parts
differ, near words agree on all of some choice of parts - d parts. Each such
choice gives a signature, the hash of what the vector holds there
(partition and enumerate; exact, no pair is missed):

* words of equal length: d = 2;
* a word and one longer by a letter: d = 1, in two roles (shorter, longer).

A signature also holds the word's length and the half of the word that the
edit leaves alone, its start or its end: every pair shares one of the two, and
words made of the same syllables in another order no longer meet. Signatures
are joined by equality, pairs that meet are verified by edit distance, and
each pair is counted once.

A word's form is its most frequent near word if that is at least twice as
frequent; its root is found by doubling the forms' pointers, in as many rounds
as the logarithm of the longest chain, which is itself at most the logarithm of
the largest frequency. All tables grow with the vocabulary, not with the text;
every step is a stored table. All joins sort and merge: Spark goes by the size
of a stored table's compressed files, also for the signatures made of its rows,
and would broadcast what the driver cannot hold.

Defined cases: null and empty texts have no words; an empty table gives an
empty result; a repeated id is one document (see ``common``); a null id is the
text "null" in the hash that plants deletions; extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import NULL_ID, keyed, stored, tidy

#: What words are made of: the longest runs of these.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Least length and number of occurrences of a word that is looked at.
LENGTH, OCCURRENCES = 5, 3
#: A form is at least so many times as frequent as its word.
TIMES = 2
#: Parts of the letters' places, for words of equal length and of others.
PARTS, PARTS_LONGER = 5, 4
#: One in so many words of a document loses a letter (0: none does).
DAMAGE = 97

_REPLACED, _SHORTER, _LONGER = 0, 1, 2


def vocabulary(docs: DataFrame, damage: int = DAMAGE, length: int = LENGTH,
               occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the words of the texts and their numbers of occurrences. With
    ``damage``, a word loses a character in the documents where the crc32 of
    ``<doc_id>:<word>`` is a multiple of it."""
    d = keyed(docs)
    runs = F.expr(f"explode(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{LETTERS}', 0))")
    words = d.select(F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), runs.alias("word"))
    if damage:
        name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("word"))
        words = words.withColumn("h", F.crc32(name.cast("binary")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.char_length("word")))
        words = words.withColumn("word", F.when(F.col("h") % damage == 0, less).otherwise(F.col("word")))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter((F.char_length("word") >= length) & (F.col("n") >= occurrences)))


class Letters:
    """The characters of some words, their prefix hashes and places."""

    def __init__(self, column: pa.Array):
        words = column.to_pylist()
        self.size = np.array([len(w) for w in words], np.int64)
        self.edge = np.append(0, np.cumsum(self.size))
        char = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        power, self._inverse = rolling._WORD_POWERS.upto(len(char) + 1)
        self._sums = np.zeros(len(char) + 1, np.uint64)
        np.cumsum(rolling.mix(char) * power[: len(char)], out=self._sums[1:])
        # a character's place: which one of its kind it is in its word
        row = np.repeat(np.arange(len(words), dtype=np.uint64), self.size)
        order = np.sort(row << np.uint64(21) | char)
        new = np.ones(len(order), bool)
        new[1:] = order[1:] != order[:-1]
        at = np.arange(len(order))
        nth = at - np.maximum.accumulate(np.where(new, at, 0))
        self._row = (order >> np.uint64(21)).astype(np.int64)
        self._place = rolling.mix((order & np.uint64((1 << 21) - 1)) << np.uint64(32) | nth.astype(np.uint64))

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the characters from each start to its end."""
        return rolling.mix((self._sums[end] - self._sums[start]) * self._inverse[start])

    def halves(self, half: np.ndarray) -> list[np.ndarray]:
        """Hashes of the first and of the last ``half`` characters."""
        a, b = self.edge[:-1], self.edge[1:]
        return [rolling.mix(self.part(a, a + half) + np.uint64(1)), rolling.mix(self.part(b - half, b) + np.uint64(2))]

    def projections(self, parts: int, differ: int) -> list[np.ndarray]:
        """For each choice of ``parts - differ`` parts, a hash of the places there."""
        of = (self._place % np.uint64(parts)).astype(np.int64)
        value = rolling.mix(self._place + np.uint64(parts))
        held = np.zeros((parts, len(self.size)), np.uint64)
        np.add.at(held, (of, self._row), value)
        return [rolling.mix(held[list(kept)].sum(axis=0, dtype=np.uint64) + np.uint64(k))
                for k, kept in enumerate(combinations(range(parts), parts - differ))]


_SIGNED = pa.schema([("role", pa.int8()), ("key", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
_SIGNED_SQL = "role byte, key long, word string, n long"


def _sign(parts: int, parts_longer: int):
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = Letters(batch.column(0))
            one, two = x.projections(parts_longer, 1), x.projections(parts, 2)
            for role, size, sides in ((_REPLACED, x.size, two), (_SHORTER, x.size, one), (_LONGER, x.size - 1, one)):
                length = rolling.mix(size.astype(np.uint64))
                for half in x.halves(size // 2):
                    for side in sides:
                        key = rolling.mix(side + half + length).astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(batch), role, np.int8)), pa.array(key), batch.column(0),
                             batch.column(1)], schema=_SIGNED)
    return run


def near_words(words: DataFrame, parts: int = PARTS, parts_longer: int = PARTS_LONGER) -> DataFrame:
    """(a, an, b, bn): each pair of words of ``words`` (word, n) at edit distance
    one, once, with their frequencies."""
    signed = words.select("word", "n").mapInArrow(tidy(_sign(parts, parts_longer)), _SIGNED_SQL)

    def side(role: int, word: str, n: str) -> DataFrame:
        return signed.filter(F.col("role") == role).select("key", F.col("word").alias(word), F.col("n").alias(n))

    def meet(left: DataFrame, right: DataFrame, more: Column) -> DataFrame:
        return left.join(right.hint("merge"), "key").filter(more & (F.levenshtein("a", "b", 1) == 1)).drop("key")

    equal = meet(side(_REPLACED, "a", "an"), side(_REPLACED, "b", "bn"), F.col("a") < F.col("b"))
    longer = meet(side(_SHORTER, "a", "an"), side(_LONGER, "b", "bn"), F.lit(True))
    return equal.union(longer).dropDuplicates(["a", "b"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following the forms ends."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("via"), F.col("root").alias("top"))
        step = stored(now.join(up.hint("merge"), F.col("root") == F.col("via"), "left")
                      .select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")),
                      "roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, times: int = TIMES, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``words`` (word, n)."""
    pairs = stored(near_words(words, **options), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("other"), F.col("bn").alias("m"))
    both = both.union(pairs.select("b", "bn", "a", "an"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), "other")).alias("best"),
                                    F.first("n").alias("own"))
    enough = -F.col("best.col1") >= times * F.col("own")
    found = stored(best.select("word", "n_near", F.when(enough, F.col("best.other")).alias("form"),
                               F.when(enough, -F.col("best.col1")).alias("form_n")), "forms")
    out = (words.select("word", "n").join(found.hint("merge"), "word", "left")
           .join(roots(found.filter("form is not null")).hint("merge"), "word", "left"))
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def group(docs: DataFrame, damage: int = DAMAGE, length: int = LENGTH, occurrences: int = OCCURRENCES,
          **options) -> DataFrame:
    """``variants`` of the words of ``docs`` (doc_id, text)."""
    return variants(stored(vocabulary(docs, damage, length, occurrences), "vocabulary"), **options)
