"""Language identification by nearest centroid.

A text becomes a vector of hashed letter n-grams (one to three letters, word
ends included): counts damped by a square root, times inverse document
frequency, at unit length. Each language has several centroids, found by
spherical k-means over a sample of its training rows. A text gets the
language of the centroid with the greatest cosine. It is rejected when it has
no letters, or when its cosine is less than ``NEAREST`` of what all but a
``TAIL`` of the language's training texts of its length reach. Lengths are
counts of n-grams; the cosines of the starts of the sample's texts, of
``STARTS`` characters, tell what a length reaches, so short texts of a
language stay while other languages and gibberish of some length go.

Document frequencies come from all training rows. The centroids come from
about ``sample`` rows of each language, chosen by a hash of the id, so what
the driver collects is bounded by languages x sample. Whole texts are counted.

Defined cases: a null text or one without letters gets ``und``, score 0, and
is rejected; rows with null lang teach nothing; without any training rows
every text gets ``und``; extra columns are not read; for repeated and null
ids see ``common`` (``classified`` instead keeps each row as it is).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import keyed, stored, tidy, unkeyed

DIMS = 4096
SAMPLE = 300
CENTROIDS = 4
NEAREST = 0.48
TAIL = 0.05
#: Characters of the starts of training texts whose cosines are taken.
STARTS = (10, 20, 40, 80, 160, 320, 640, 1280)
UNKNOWN = "und"
SLICE_CHARS = 1 << 17


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


_TABLE: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letters())
    out = _TABLE[0][np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        out[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    return out


def _count_slice(texts: list[str]) -> np.ndarray:
    # two blanks between texts: an n-gram with two blanks in a row is none
    joined = "  ".join(["", *texts, ""]).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t.lower()) + 2 for t in texts])
    codes = np.where(_is_letter(codes), codes, 0).astype(np.uint64)
    row = np.minimum(np.searchsorted(ends, np.arange(len(codes)), "right"), len(texts) - 1)
    blank = codes == 0
    keep = ~blank  # of several blanks in a text one counts
    keep[1:] |= blank[1:] & ~blank[:-1]
    codes, row = codes[keep], row[keep]
    n, out = len(codes), np.zeros(len(texts) * DIMS, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(3):
        m = n - k
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[k:] + np.uint64(1)
        same = row[:m] == row[k:] if k else codes > 0
        x = h ^ (h >> np.uint64(29))
        x = (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(52)
        out += np.bincount(row[:m][same] * DIMS + x[same].astype(np.int64), minlength=len(out))
    return out.reshape(len(texts), DIMS)


def counts(texts: list[str]) -> Iterator[np.ndarray]:
    """n-gram counts, rows x DIMS, of the texts in slices."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= SLICE_CHARS or len(held) >= 128:
            yield _count_slice(held)
            held, n = [], 0
    if held:
        yield _count_slice(held)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    language: list[str]     # of each centroid
    least: dict[str, tuple[np.ndarray, np.ndarray]]  # of a language: log n-gram counts, least cosines

    def vectors(self, count: np.ndarray) -> np.ndarray:
        x = np.sqrt(count).astype(np.float32) * self.idf
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, size, out=np.zeros_like(x), where=size > 0)

    def far(self, count: np.ndarray, best: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Whether each row's cosine is too small for its language and length."""
        size, out = np.log(np.maximum(count.sum(axis=1), 1)), np.zeros(len(count), bool)
        for name, (at, least) in self.least.items():
            own = np.array([self.language[k] == name for k in best.tolist()], bool)
            out[own] = near[own] < np.interp(size[own], at, least)
        return out

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        lang, score, rejected = [], [], []
        for count in counts([t or "" for t in texts]):
            known = count.any(axis=1)
            if not len(self.language):
                known[:] = False
                best, near = np.zeros(len(count), int), np.zeros(len(count))
            else:
                cosine = self.vectors(count) @ self.centroids.T
                best, near = cosine.argmax(axis=1), np.clip(cosine.max(axis=1), 0, 1)
                far = self.far(count, best, near)
            for k, some in enumerate(known.tolist()):
                lang.append(self.language[best[k]] if some else UNKNOWN)
                score.append(float(near[k]) if some else 0.0)
                rejected.append(bool(far[k]) if some else True)
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})


def _centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts at the row nearest the mean, then the farthest rows."""
    def unit(c):
        return c / np.maximum(np.linalg.norm(c, axis=-1, keepdims=True), 1e-12)

    c = [x[np.argmax(x @ unit(x.mean(axis=0)))]]
    while len(c) < min(k, len(x)):
        c.append(x[np.argmin(np.max(x @ np.stack(c).T, axis=1))])
    c = np.stack(c)
    for _ in range(rounds):
        of = np.argmax(x @ c.T, axis=1)
        c = np.stack([unit(x[of == j].sum(axis=0)) if (of == j).any() else c[j] for j in range(len(c))])
    return c


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_TAUGHT_SQL = "lang string, vector binary, start string, dim int, n long"
_TAUGHT = pa.schema([("lang", pa.string()), ("vector", pa.binary()), ("start", pa.string()), ("dim", pa.int32()),
                     ("n", pa.int64())])


def _teach(batches):
    """The sample rows' counts and starts, and each task's document frequencies."""
    frequency = np.zeros(DIMS, np.int64)
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        langs, chosen, at = batch.column(1).to_pylist(), batch.column(2).to_pylist(), 0
        for count in counts(texts):
            frequency += (count > 0).sum(axis=0)
            rows = [(langs[at + k], count[k].astype("<i4").tobytes(), texts[at + k][:STARTS[-1]]) for k in range(len(count))
                    if chosen[at + k] and count[k].any()]
            at += len(count)
            if rows:
                yield pa.RecordBatch.from_pydict(
                    {"lang": [r[0] for r in rows], "vector": [r[1] for r in rows], "start": [r[2] for r in rows],
                     "dim": [None] * len(rows), "n": [None] * len(rows)}, schema=_TAUGHT)
    yield pa.RecordBatch.from_pydict({"lang": [None] * DIMS, "vector": [None] * DIMS, "start": [None] * DIMS,
                                      "dim": list(range(DIMS)), "n": frequency.tolist()},
                                     schema=_TAUGHT)


def _least(model: Model, c: np.ndarray, starts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log n-gram counts, and the least cosine of a text of so many."""
    at, least = [], []
    for size in STARTS:
        texts = [t[:size] for t in starts if len(t) >= size] or (starts if size == STARTS[0] else [])
        count = np.concatenate([*counts(texts)]) if texts else np.zeros((0, DIMS))
        count = count[count.any(axis=1)]
        if len(count):
            at.append(float(np.log(np.median(count.sum(axis=1)))))
            least.append(NEAREST * float(np.quantile(np.max(model.vectors(count) @ c.T, axis=1), TAIL)))
    order = np.argsort(at)
    return np.array(at)[order], np.array(least)[order]


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learns from the rows of ``docs`` with a language (the caller leaves out
    held-out rows)."""
    rows = docs.filter(F.col(lang).isNotNull())
    sizes = dict(rows.groupBy(F.col(lang).alias("lang")).count().collect())  # a row a language
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, F.lit(min(1.0, sample / n))).otherwise(share)
    spot = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    taught = stored(rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
                                (spot < share).alias("chosen")).mapInArrow(tidy(_teach), _TAUGHT_SQL), "languages")
    frequency = np.zeros(DIMS)
    for dim, n in taught.filter("dim is not null").groupBy("dim").agg(F.sum("n")).collect():
        frequency[dim] = n
    total = sum(sizes.values())
    idf = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)
    model = Model(idf, np.zeros((0, DIMS), np.float32), [], {})
    found = taught.filter("vector is not null").select("lang", "vector", "start").collect()
    for name in sorted({r[0] for r in found}):
        own = sorted((bytes(r[1]), r[2]) for r in found if r[0] == name)  # in any order of arrival
        x = model.vectors(np.stack([np.frombuffer(v, "<i4") for v, _ in own]))
        c = _centroids(x, centroids)
        model.centroids = np.concatenate([model.centroids, c.astype(np.float32)])
        model.language += [name] * len(c)
        model.least[name] = _least(model, c, [t for _, t in own])
    return model


def predictor(docs: DataFrame, model: Model):
    """Column function: text -> struct(lang_pred, score, rejected)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield held.value.predict([t if isinstance(t, str) else None for t in part])

    return F.pandas_udf(run, "lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of each document; learns
    from the rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang")
    model = train(rows.filter(~is_held_out(F.col("doc_id"))), **options)
    d = unkeyed(keyed(rows))
    named = d.withColumn("p", predictor(docs, model)("text"))
    return named.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "p.*")
