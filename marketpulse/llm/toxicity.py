"""Toxicity: misspelled terms by Levenshtein automata over a lexicon's trie, and
scores of the places where they stand.

* **Lexicon.** Learned from labelled documents: words, and beginnings of words
  (stems) of 4 letters and more, that toxic documents hold far more often than
  clean ones. Near copies of a training document count once.
* **Automaton.** The lexicon is a trie; its intersection with the Levenshtein
  automaton (insertions, deletions, replacements and swaps of neighbours) is
  made deterministic state by state, as texts need them, and kept by the worker.
  All words of a slice of texts go through it at once, letter by letter. Words
  of 4 letters and more may differ by one edit, of 9 and more by two; stems
  must match exactly.
* **Context.** A term's strength is its log odds, for misspelled ones from
  how often such words stand in toxic and in clean training documents (so that
  common words that look like a term do not count). Quotation marks around it,
  words of reporting before it, and learned words in the window around it lower
  or raise it.
* **Score.** A logistic regression over the strengths of a document's terms,
  their number and their density. In training, a document does not count
  towards its own terms' odds.

Training takes a bounded sample, ``SAMPLE`` documents of each label at most
(chosen by a hash of the id), and at most ``LEXICON`` entries; both are
parameters. So the model has a fixed size and is broadcast. Every document is
scored row by row, whole; nothing is shuffled but the labels' ids.

Defined cases: null and empty texts score as texts without terms; without
toxic or without clean training rows the score is 0 for all; a repeated id is
one document (see ``common``), its label the largest of its labels; null ids
and null labels teach nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm import rolling
from marketpulse.llm.common import int_array, keyed, stored, tidy, unkeyed

#: Training documents of each label, entries of the lexicon, other learned words.
SAMPLE, LEXICON, LEARNED = 8000, 600, 4000
#: An entry stands in so many toxic training documents at least, with so large
#: log odds, so many standard errors from none.
SUPPORT, ODDS, ERRORS = 3, math.log(3), 3.5
#: Letters of the shortest and longest stem.
STEMS = range(4, 11)
#: Words on either side of a term that are its context, and characters in
#: which its quotation marks and line ends are looked for.
WINDOW, NEAR = 5, 300
#: Score from which a document is predicted to be toxic.
TOXIC = 0.3
#: What a quotation and a word of reporting take from a term's strength.
QUOTED, REPORTED = 0.5, 0.7

# Pairs of quotation marks; words of reporting (en, de, fr, es).
QUOTES = [("“", "”"), ("„", "“"), ("«", "»"), ("‘", "’"), ("‹", "›")]
REPORTING = {"said", "says", "wrote", "writes", "quote", "quoted", "called", "term", "word", "sagte", "schrieb",
             "zitat", "wort", "dit", "écrit", "citation", "mot", "dijo", "escribió", "cita", "palabra"}
#: Signs that stand for letters inside a word.
SIGNS = "@$*013457"

_KIND = np.zeros(1 << 16, np.uint8)   # 1: letter, 2: sign
_LOWER = np.arange(1 << 16, dtype=np.uint32)


def _tables() -> None:
    if not _KIND.any():
        for c in range(1 << 16):
            s = chr(c)
            _KIND[c] = 1 if s.isalpha() else 2 if s in SIGNS else 0
            low = s.lower()
            _LOWER[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c


def edits(size: int) -> int:
    """Edits that a term of so many letters may differ by."""
    return 0 if size < 4 else 1 if size < 9 else 2


class Automaton:
    """The lexicon's trie with its Levenshtein automata, made deterministic as needed.

    A state is a set of (node, edits) and of swaps begun (node, edits, letter
    still to come). Entries that end in ``*`` are stems."""

    def __init__(self, entries: list[str]):
        _tables()
        self.entries = entries
        self.letter = {c: k + 1 for k, c in enumerate(sorted({c for e in entries for c in e.rstrip("*")}))}
        self.classes = np.zeros(1 << 16, np.int64)
        for c, k in self.letter.items():
            if ord(c) < 1 << 16:
                self.classes[ord(c)] = k
        self.child: list[dict[int, int]] = [{}]
        self.most = [0]            # edits that some word below the node allows
        self.whole: list[int] = [-1]
        self.stem: list[int] = [-1]
        for k, entry in enumerate(entries):
            text, allowed = entry.rstrip("*"), 0 if entry.endswith("*") else edits(len(entry))
            at = 0
            for c in text:
                self.most[at] = max(self.most[at], allowed)
                nxt = self.child[at].get(self.letter[c])
                if nxt is None:
                    nxt = self.child[at][self.letter[c]] = len(self.child)
                    self.child.append({})
                    self.most.append(0)
                    self.whole.append(-1)
                    self.stem.append(-1)
                at = nxt
            self.most[at] = max(self.most[at], allowed)
            (self.stem if entry.endswith("*") else self.whole)[at] = k
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.found: list[tuple[int, int, int]] = []
        self.next = np.full((256, len(self.letter) + 1), -1, np.int32)
        self._state(frozenset())                    # 0: no entry can follow
        self.start = self._state(self._closed({(0, 0, 0)}))

    def _closed(self, some: set) -> frozenset:
        """With letters of the term left out, and without what is worse."""
        best: dict[int, int] = {}
        swaps, todo = set(), list(some)
        while todo:
            node, e, wait = todo.pop()
            if e > self.most[node]:
                continue
            if wait:
                swaps.add((node, e, wait))
            elif e < best.get(node, 9):
                best[node] = e
                todo += [(x, e + 1, 0) for x in self.child[node].values()]
        return frozenset([(n, e, 0) for n, e in best.items()]) | frozenset(swaps)

    def _state(self, some: frozenset) -> int:
        k = self.number.get(some)
        if k is None:
            k = self.number[some] = len(self.sets)
            self.sets.append(some)
            word = min(((e, self.whole[n]) for n, e, wait in some if not wait and self.whole[n] >= 0
                        and e <= edits(len(self.entries[self.whole[n]]))), default=(0, -1))
            stem = next((self.stem[n] for n, e, wait in some if not wait and not e and self.stem[n] >= 0), -1)
            self.found.append((word[1], word[0], stem))
            if k >= len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
        return k

    def _step(self, state: int, c: int) -> int:
        out = set()
        for node, e, wait in self.sets[state]:
            if wait:
                if wait == c:
                    out.add((node, e, 0))
                continue
            for letter, x in self.child[node].items():
                out.add((x, e if letter == c else e + 1, 0))
                if letter != c and c in self.child[x]:
                    out.add((self.child[x][c], e + 1, letter))
            out.add((node, e + 1, 0))
        return self._state(self._closed(out))

    def match(self, code: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry (or -1) and edits of each word: an exact word before a stem
        (the longest), a stem before a misspelled word."""
        n = len(start)
        entry, off, stem = np.full(n, -1, np.int32), np.zeros(n, np.int8), np.full(n, -1, np.int32)
        kind = self.classes[code]
        live, state, j = np.arange(n), np.full(n, self.start, np.int32), 0
        while len(live):
            ends = size[live] == j
            if ends.any():
                known = np.array(self.found, np.int32)[state[ends]]
                entry[live[ends]], off[live[ends]] = known[:, 0], known[:, 1]
                live, state = live[~ends], state[~ends]
            c = kind[start[live] + j]
            nxt = self.next[state, c]
            if (nxt < 0).any():
                pairs = np.unique(np.stack([state[nxt < 0], c[nxt < 0]], axis=1), axis=0)
                for s, x in pairs.tolist():
                    to = self._step(s, x)
                    self.next[s, x] = to
                nxt = self.next[state, c]
            state = nxt
            on = state > 0
            live, state = live[on], state[on]
            at = np.array([x[2] for x in self.found], np.int32)[state]
            stem[live[at >= 0]] = at[at >= 0]
            j += 1
        use = (stem >= 0) & ((entry < 0) | (off > 0))
        entry[use], off[use] = stem[use], 0
        return entry, off


@dataclass
class Slice:
    """Texts as one array of characters, and their words."""
    text: str
    code: np.ndarray
    start: np.ndarray
    size: np.ndarray
    first: np.ndarray     # each text's first word, one more for the end

    @classmethod
    def of(cls, texts: list[str]) -> Slice:
        _tables()
        text = "\n".join(texts) + "\n"
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        high = raw >= 1 << 16
        low = np.where(high, 0, raw)
        code, kind = _LOWER[low], np.where(high, 1, _KIND[low])
        letter = kind == 1
        sign = kind == 2
        sign[0], sign[-1] = False, False
        sign[1:-1] &= letter[:-2] & letter[2:]
        inside = letter | sign
        edge = np.diff(inside.astype(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return cls(text, code, start, end - start, np.searchsorted(start, begin))

    def word(self, k: int) -> str:
        a = int(self.start[k])
        return "".join(map(chr, self.code[a: a + int(self.size[k])].tolist()))


def slices(texts: list[str | None], limit: int = 1 << 18):
    """(index of the first text, Slice) of parts of about ``limit`` characters."""
    first, held, size = 0, [], 0
    for k, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= limit or k == len(texts) - 1:
            yield first, Slice.of(held)
            first, held, size = k + 1, [], 0


def quoted(text: str, at: int, end: int) -> bool:
    """Whether marks of quotation stand around a place, in its line."""
    before = text[max(0, at - NEAR): at].rsplit("\n", 1)[-1]
    after = text[end: end + NEAR].split("\n", 1)[0]
    if before.count('"') % 2 and '"' in after:
        return True
    return any(before.rfind(a) > before.rfind(b) and b in after for a, b in QUOTES)


@dataclass
class Hit:
    entry: int
    edits: int
    word: str
    quoted: bool
    reported: bool
    near: list[str]


def hits(part: Slice, automaton: Automaton):
    """(text, number of words, its hits) of each text of a slice."""
    entry, off = automaton.match(part.code, part.start, part.size)
    at = np.flatnonzero(entry >= 0)
    cut = np.searchsorted(at, part.first)
    for k in range(len(part.first) - 1):
        first, last = int(part.first[k]), int(part.first[k + 1])
        found = []
        for w in at[cut[k]: cut[k + 1]].tolist():
            a = int(part.start[w])
            before = [part.word(x) for x in range(max(first, w - WINDOW), w)]
            after = [part.word(x) for x in range(w + 1, min(last, w + WINDOW + 1))]
            found.append(Hit(int(entry[w]), int(off[w]), part.word(w), quoted(part.text, a, a + int(part.size[w])),
                             not REPORTING.isdisjoint(before), before + after))
        yield k, last - first, found


@dataclass
class Model:
    entries: list[str]
    counts: list[tuple[float, float]]                      # toxic and clean documents with an entry
    total: tuple[float, float]
    misspelled: dict[int, tuple[float, float]] = field(default_factory=dict)   # by entry
    words: dict[str, tuple[float, float]] = field(default_factory=dict)        # by misspelled word
    context: dict[str, float] = field(default_factory=dict)
    weights: list[float] | None = None

    def odds(self, toxic: float, clean: float, prior: tuple[float, float], size: float) -> float:
        p, n = self.total
        return (math.log((toxic + size * prior[0]) / (p + size)) - math.log((clean + size * prior[1]) / (n + size)))

    def share(self, k: int) -> tuple[float, float]:
        (a, b), (p, n) = self.counts[k], self.total
        return (a + 0.5) / (p + 1), (b + 0.5) / (n + 1)

    def strength(self, h: Hit, label: int | None = None) -> float:
        """Log odds of a hit in its context; ``label`` of a training document
        takes it out of the counts."""
        own = (1.0, 0.0) if label == 1 else (0.0, 1.0) if label == 0 else (0.0, 0.0)
        if h.edits == 0:
            a, b = self.counts[h.entry]
            if a - own[0] < 1:
                return 0.0
            w = self.odds(max(a - own[0], 0), max(b - own[1], 0), (0.5, 0.5), 1)
        elif h.word in self.words and sum(self.words[h.word]) - sum(own) >= 2:
            a, b = self.words[h.word]
            w = self.odds(max(a - own[0], 0), max(b - own[1], 0), (0.5, 0.5), 1)
        else:
            a, b = self.misspelled.get(h.entry, (0.0, 0.0))
            w = self.odds(max(a - own[0], 0), max(b - own[1], 0), self.share(h.entry), 2)
        around = sum(self.context.get(x, 0.0) for x in h.near)
        w *= 1 + 0.25 * max(-1.0, min(1.0, around))
        return max(0.0, w) * (1 - QUOTED * h.quoted) * (1 - (1 - REPORTED) * h.reported)

    def features(self, n_words: int, found: list[Hit], label: int | None = None) -> list[float]:
        w = [self.strength(h, label) for h in found]
        w = [x for x in w if x > 0]
        each = {h.word for h in found if self.strength(h, label) > 0}
        return [1.0, math.log1p(sum(w)), max(w, default=0.0), math.log1p(len(each)),
                math.log1p(100 * sum(w) / max(n_words, 20))]

    def score(self, x: list[float]) -> float:
        if self.weights is None:
            return 0.0
        z = sum(a * b for a, b in zip(self.weights, x))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Logistic regression by Newton's method; strengths never lower a score."""
    def solve(use: list[int]) -> np.ndarray:
        b = np.zeros(x.shape[1])
        keep = np.diag([0.01 if k == 0 else ridge for k in use])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            part = x[:, use]
            grad = part.T @ (weight * (y - p)) - keep @ b[use]
            step = np.linalg.solve((part * (weight * p * (1 - p))[:, None]).T @ part + keep, grad)
            b[use] += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break
        return b

    use = list(range(x.shape[1]))
    while True:
        b = solve(use)
        worst = min(use[1:], key=lambda k: b[k], default=None)
        if worst is None or b[worst] >= 0:
            return b.tolist()
        use.remove(worst)


# --- training ------------------------------------------------------------------

def _family(texts: list[str]) -> list[int]:
    """Least hash of each text's four-word shingles: near copies mostly share it."""
    out = []
    for t in texts:
        offsets, data = rolling.texts(pa.array([t]))
        w = rolling.words(offsets, data, 0, 1, lower=True)
        _, h = w.windows(min(4, max(1, len(w.hash))))
        out.append(int(h.min().astype(np.int64)) if len(h) else 0)
    return out


_FAMILY = pa.schema([("doc_id", pa.int64()), ("family", pa.int64())])


def _families(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_family([t or "" for t in batch.column(1).to_pylist()]), pa.int64())],
            schema=_FAMILY)


_SEEN = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_SEEN_SQL = "entry string, toxic long, clean long"


def _entries(batches):
    """Words and stems with the numbers of toxic and clean texts of the task that hold them."""
    count: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        label = batch.column(1).to_pylist()
        for first, part in slices(batch.column(0).to_pylist()):
            for k in range(len(part.first) - 1):
                words = {part.word(w) for w in range(int(part.first[k]), int(part.first[k + 1]))}
                some = {w[:n] + "*" for w in words for n in STEMS if len(w) > n} | {w for w in words if len(w) > 2}
                for e in some:
                    count[e][0 if label[first + k] else 1] += 1
    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), *(
        pa.array([c[k] for c in count.values()], pa.int64()) for k in (0, 1))], schema=_SEEN)


def lexicon(rows: list[tuple[str, int, int, float]], most: int = LEXICON) -> list[tuple[str, int, int]]:
    """The entries to keep of (entry, toxic, clean, log odds), best first: of equal
    counts the longest, and none whose stem says nearly as much."""
    odds = {e: o for e, _, _, o in rows}
    count = {e: (a, b) for e, a, b, _ in rows}

    def stems(e: str) -> list[str]:
        return [e[:n] + "*" for n in STEMS if n < len(e.rstrip("*"))]

    for e in sorted(count, key=lambda e: (len(e.rstrip("*")), not e.endswith("*"), e)):
        for s in stems(e) + ([e + "*"] if not e.endswith("*") else []):
            if s in odds and count[s] == count[e]:
                del odds[s]
    kept = []
    for e, a, b, o in rows:
        if e in odds and not any(s in odds and odds[s] >= o - 1 for s in stems(e)):
            kept.append((e, a, b))
    return kept[:most]


_FOUND = pa.schema([("kind", pa.string()), ("name", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])


def _surroundings(model_var):
    """For each text, what stands there once: misspelled words, entries met by
    misspelled words, words around hits."""
    def run(batches):
        model = model_var.value
        automaton = automaton_of(model.entries)
        seen: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            label = batch.column(1).to_pylist()
            for first, part in slices(batch.column(0).to_pylist()):
                for k, _, found in hits(part, automaton):
                    names = {("word", h.word) for h in found if h.edits}
                    names |= {("entry", str(h.entry)) for h in found if h.edits}
                    names |= {("near", w) for h in found for w in h.near}
                    for x in names:
                        seen[x][0 if label[first + k] else 1] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.string()),
             *(pa.array([seen[x][j] for x in keys], pa.int64()) for j in (0, 1))], schema=_FOUND)
    return run


def _described(model_var):
    """Features of the training texts."""
    def run(batches):
        model = model_var.value
        automaton = automaton_of(model.entries)
        for batch in batches:
            label, out = batch.column(1).to_pylist(), []
            for first, part in slices(batch.column(0).to_pylist()):
                out += [model.features(n, found, label[first + k]) for k, n, found in hits(part, automaton)]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(out, pa.list_(pa.float64()))],
                                             names=["label", "x"])
    return run


_KEPT: dict[tuple, Automaton] = {}


def automaton_of(entries: list[str]) -> Automaton:
    """The worker's automaton for these entries."""
    key = tuple(entries)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Automaton(entries)
    return _KEPT[key]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = LEXICON) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1)."""
    spark = docs.sparkSession
    taught = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    many = dict(taught.groupBy("label").count().collect())
    spot = F.pmod(F.xxhash64(F.lit(11), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    share = {k: min(1.0, sample / n) for k, n in many.items() if k in (0, 1)}
    near = " or ".join(f"(label = {k} and spot < {v})" for k, v in share.items()) or "false"
    wanted = taught.withColumn("spot", spot).filter(near)
    chosen = wanted.select(F.col("doc_id").alias("taught"), "label")  # at most about 2 * sample rows
    rows = stored(docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("taught"))
                  .select("doc_id", "text", "label"), "labelled")
    family = rows.select("doc_id", "text").mapInArrow(tidy(_families), "doc_id long, family long")
    one = (rows.select("doc_id", "label").join(family, "doc_id").groupBy("family", "label")
           .agg(F.min("doc_id").alias("one")).select("one"))
    rows = stored(rows.join(F.broadcast(one), F.col("doc_id") == F.col("one")).select("text", "label"), "families")
    size = dict(rows.groupBy("label").count().collect())
    p, n = size.get(1, 0), size.get(0, 0)
    if not p or not n:
        return Model([], [], (float(p), float(n)))
    seen = rows.mapInArrow(tidy(_entries), _SEEN_SQL).groupBy("entry").agg(F.sum("toxic").alias("toxic"),
                                                                         F.sum("clean").alias("clean"))
    odds = (F.log((F.col("toxic") + 0.5) / (p + 1.0)) - F.log((F.col("clean") + 0.5) / (n + 1.0)))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    strong = (seen.filter(F.col("toxic") >= SUPPORT).withColumn("odds", odds).withColumn("z", F.col("odds") / error)
              .filter((F.col("odds") >= ODDS) & (F.col("z") >= ERRORS))
              .orderBy(F.desc("z"), "entry").limit(20 * most))
    kept = lexicon([(r["entry"], r["toxic"], r["clean"], r["odds"]) for r in strong.collect()], most)
    model = Model([e for e, _, _ in kept], [(float(a), float(b)) for _, a, b in kept], (float(p), float(n)))
    held = spark.sparkContext.broadcast(model)
    found = stored(rows.mapInArrow(tidy(_surroundings(held)), "kind string, name string, toxic long, clean long")
                   .groupBy("kind", "name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "surroundings")
    total = F.col("toxic") + F.col("clean")
    for kind, least in (("entry", 1), ("word", 2), ("near", 20)):
        some = found.filter((F.col("kind") == kind) & (total >= least)).orderBy(F.desc(total), "name").limit(LEARNED).collect()
        if kind == "entry":
            model.misspelled = {int(r["name"]): (float(r["toxic"]), float(r["clean"])) for r in some}
        elif kind == "word":
            model.words = {r["name"]: (float(r["toxic"]), float(r["clean"])) for r in some}
        else:  # against the share of all context words, so that only the difference counts
            a, b = sum(r["toxic"] for r in some) + 1, sum(r["clean"] for r in some) + 1
            if b > 20 * 20:
                at = {r["name"]: math.log((r["toxic"] + 1) / (a + 1)) - math.log((r["clean"] + 1) / (b + 1)) for r in some}
                model.context = {w: round(max(-1.0, min(1.0, v)), 3) for w, v in at.items() if abs(v) > 0.7}
    held = spark.sparkContext.broadcast(model)
    told = rows.mapInArrow(tidy(_described(held)), "label int, x array<double>").collect()
    told = sorted((r["label"], r["x"]) for r in told)   # in any order of arrival
    y = np.array([t[0] for t in told], float)
    weight = np.array([1 / share[int(k)] for k in y])
    model.weights = fit(np.array([t[1] for t in told]), y, weight / weight.mean())
    return model


# --- scoring -------------------------------------------------------------------

_SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("terms", pa.list_(pa.string()))])
_SCORE_SQL = "doc_id long, score double, terms array<string>"


def _scored(model_var):
    def run(batches):
        model = model_var.value
        automaton = automaton_of(model.entries)
        for batch in batches:
            score, terms = [], []
            for _, part in slices(batch.column(1).to_pylist()):
                for _, n, found in hits(part, automaton):
                    score.append(model.score(model.features(n, found)))
                    terms.append(sorted({h.word for h in found if model.strength(h) > 0}))
            yield pa.RecordBatch.from_arrays([pa.array(int_array(batch.column(0)), pa.int64()), pa.array(score, pa.float64()),
                                              pa.array(terms, pa.list_(pa.string()))], schema=_SCORE)
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, terms) of each document: the score and the distinct words
    that count."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return unkeyed(keyed(docs).mapInArrow(tidy(_scored(held)), _SCORE_SQL))


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, label: str = "toxic", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted, terms) of each document; learns from
    the labels of documents that are not held out."""
    taught = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    model = train(keyed(docs), taught.filter(~is_held_out(F.col("doc_id"))), **options)
    found = score(docs, model)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"), "terms")
