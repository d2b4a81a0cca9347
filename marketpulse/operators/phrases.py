"""Filters and tags by thousands of phrases of one or more words.

The phrases become one trie over words, built once and shipped with the task.
Texts are cut into tokens in the JVM (``sentiment.tokens``: letters, with
apostrophes inside, lower case). Within an Arrow batch all tokens are looked up
in the phrases' vocabulary at once, and the trie is walked from every position
at the same time, a word a step: a step keeps the positions that are still on a
path, so the cost is that of the tokens, not of the phrases, and a walk is at
most as long as the longest phrase.

What a task holds is the trie (some 100 bytes a phrase word) and one batch. The
phrases are a parameter of the caller, at most ``MOST_WORDS`` words in all;
beyond that the list is data, and belongs in a join.

Defined cases: a null or empty text has no match; no phrases match nothing;
repeated phrases, and phrases alike but for case or spacing, are one; a phrase
that has no token is an error; overlapping and nested occurrences all count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.operators import sentiment as S

MOST_WORDS = 2_000_000

_HITS_SQL = "array<struct<phrase:int,at:int>>"


@dataclass(frozen=True)
class Trie:
    """Edges of state 0 by word; the others as sorted ``state * words + word``."""
    words: pa.Array
    first: np.ndarray      # word -> state, 0: none
    edges: np.ndarray      # sorted keys
    to: np.ndarray         # state of each edge
    ends: np.ndarray       # state -> phrase number, -1: none
    depth: int


def phrase_words(phrases: Sequence[str]) -> list[tuple[str, ...]]:
    """The phrases as token tuples, distinct, in the order given."""
    out: dict[tuple[str, ...], None] = {}
    for p in phrases:
        words = tuple(S._TOKEN.findall(p.lower()))
        if not words:
            raise ValueError(f"a phrase without a word: {p!r}")
        out[words] = None
    if sum(map(len, out)) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words of phrases: join them as a table")
    return list(out)


def build(phrases: Sequence[tuple[str, ...]]) -> Trie:
    words: dict[str, int] = {}
    edges: dict[tuple[int, int], int] = {}
    ends = [-1]
    for number, phrase in enumerate(phrases):
        state = 0
        for word in phrase:
            step = state, words.setdefault(word, len(words))
            if step not in edges:
                edges[step] = len(ends)
                ends.append(-1)
            state = edges[step]
        ends[state] = number
    first = np.zeros(max(len(words), 1), np.int64)
    later = []
    for (state, word), to in edges.items():
        if state:
            later.append((state * len(words) + word, to))
        else:
            first[word] = to
    table = np.array(sorted(later), np.int64).reshape(-1, 2)
    return Trie(pa.array(list(words), pa.string()), first, table[:, 0].copy(), table[:, 1].copy(),
                np.array(ends, np.int64), max(map(len, phrases), default=0))


def walk(trie: Trie, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, phrase) of every occurrence in a batch of token lists."""
    flat = tokens.flatten()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0))
    row = np.repeat(np.arange(len(tokens)), lengths)
    start = np.cumsum(lengths) - lengths
    word = np.asarray(pc.fill_null(pc.index_in(flat, value_set=trie.words), -1)).astype(np.int64)
    at = np.flatnonzero(word >= 0)
    state = trie.first[word[at]]
    at, state = at[state > 0], state[state > 0]
    found = []
    for step in range(1, trie.depth + 1):
        whole = trie.ends[state] >= 0
        found.append((at[whole], trie.ends[state[whole]]))
        on = at + step
        ok = on < len(word)
        ok[ok] = (row[on[ok]] == row[at[ok]]) & (word[on[ok]] >= 0)
        at, state, on = at[ok], state[ok], on[ok]
        if not len(at) or not len(trie.edges):
            break
        key = state * len(trie.words) + word[on]
        spot = np.minimum(np.searchsorted(trie.edges, key), len(trie.edges) - 1)
        ok = trie.edges[spot] == key
        at, state = at[ok], trie.to[spot[ok]]
    at, phrase = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    order = np.lexsort((phrase, at))
    at, phrase = at[order], phrase[order]
    return row[at], at - start[row[at]], phrase


def _matcher(trie: Trie):
    kind = pa.struct([("phrase", pa.int32()), ("at", pa.int32())])

    @F.arrow_udf(_HITS_SQL)
    def hits(tokens: pa.Array) -> pa.Array:
        row, at, phrase = walk(trie, tokens)
        ends = np.searchsorted(row, np.arange(len(tokens) + 1))
        values = pa.StructArray.from_arrays([pa.array(phrase.astype(np.int32)), pa.array(at.astype(np.int32))],
                                            fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)

    return hits


def occurrences(text: Column, phrases: Sequence[str]) -> Column:
    """Every occurrence as (phrase, at): the phrase's number among the distinct
    phrases and its first token's (both from 0), ordered by at, then phrase."""
    listed = phrase_words(phrases)
    if not listed:
        return F.from_json(F.lit("[]"), _HITS_SQL)
    return _matcher(build(listed))(S.tokens(text))


def with_phrases(df: DataFrame, text: str, phrases: Sequence[str], out: str = "phrases",
                 count: str | None = None) -> DataFrame:
    """Adds the distinct phrases that occur in ``text`` (lower case, words joined
    by a space), sorted; and with ``count`` the number of occurrences."""
    listed = phrase_words(phrases)
    names = F.array(*[]) if not listed else F.from_json(
        F.lit(_json([" ".join(p) for p in listed])), "array<string>")
    df = df.withColumn("_hits", occurrences(F.col(text), phrases))
    ids = F.array_distinct(F.transform("_hits", lambda h: h["phrase"]))
    cols = {out: F.array_sort(F.transform(ids, lambda k: F.get(names, k))).cast("array<string>")}
    if count:
        cols[count] = F.size("_hits")
    return df.withColumns(cols).drop("_hits")


def _json(values: list[str]) -> str:
    import json
    return json.dumps(values)


def matching(df: DataFrame, text: str, phrases: Sequence[str]) -> DataFrame:
    """The rows whose ``text`` holds any of ``phrases``."""
    return df.withColumn("_hits", occurrences(F.col(text), phrases)).filter(F.size("_hits") > 0).drop("_hits")
