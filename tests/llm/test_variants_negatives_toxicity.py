"""Spelling variants, hard negatives and toxicity against plain Python versions."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketpulse.llm import hard_negatives, spelling_variants, toxicity
from marketpulse.llm.queries import QUERIES

from conftest_paths import SF_SMALL

LOWER = {k: k + 32 for k in range(65, 91)}


# --- spelling variants ------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute_variants(docs, damage=97, length=5, occurrences=3):
    count, texts = {}, {}
    for key, text in docs:
        texts[key] = max(texts.get(key) or "", text or "")
    for key, text in texts.items():
        for w in re.findall("[A-Za-zÀ-ÿ]+", text):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'null' if key is None else key}:{w}".encode())
            if damage and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            count[w] = count.get(w, 0) + 1
    count = {w: n for w, n in count.items() if len(w) >= length and n >= occurrences}
    near = {w: [x for x in count if one_edit(w, x)] for w in count}
    best = {w: min(near[w], key=lambda x: (-count[x], x), default=None) for w in count}
    form = {w: b if b is not None and count[b] >= 2 * count[w] else None for w, b in best.items()}
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out)


def got_variants(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.fixture(scope="module")
def misspelled():
    rng, docs = random.Random(5), []
    base = ["receive", "separate", "naïveté", "levels", "aaaaa", "ababab", "stressed", "desserts"]
    for k in range(120):
        words = []
        for _ in range(rng.randrange(40)):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("aeé") + w[i:], w[:i] + rng.choice("aeé") + w[i + 1:]])
            words.append(w.upper() if rng.random() < 0.2 else w)
        docs.append((k, " ".join(words)))
    return docs


def test_variants_as_brute_force(spark, misspelled, pairs):
    docs = misspelled + [(1000 + (k or 0) if k is not None else None, t) for k, t in pairs]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, word string, n int")
    want = brute_variants(docs)
    assert sum(f is not None for _, f, *_ in want) > 50
    assert got_variants(spelling_variants.group(df)) == want
    assert got_variants(spelling_variants.group(df, damage=0, parts=7, parts_longer=3)) == brute_variants(docs, 0)


def test_variants_of_nothing(spark, empty):
    assert spelling_variants.group(empty).count() == 0
    few = spark.createDataFrame([(1, None), (2, ""), (3, "abcd " * 9), (4, "abcde abcde")], "doc_id long, text string")
    assert spelling_variants.group(few, damage=0).count() == 0


def test_long_chains_of_forms(spark):
    rows = [("a" * (5 + k), 3 * 2 ** k) for k in range(20)]
    out = {r["word"]: r for r in spelling_variants.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert all(r["root"] == rows[-1][0] for r in out.values())
    assert out["aaaaa"]["form"] == "aaaaaa" and out["aaaaaa"]["n_near"] == 2


def test_variants_broadcast_no_table(spark, misspelled, monkeypatch):
    """Spark sizes a step's table by its small files; what the joins make of it may not fit the driver."""
    steps, keep = [], spelling_variants.stored

    def seen(df, name):
        steps.append(df)
        return keep(df, name)

    monkeypatch.setattr(spelling_variants, "stored", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        out = spelling_variants.group(spark.createDataFrame(misspelled, "doc_id long, text string"))
        assert got_variants(out) == brute_variants(misspelled)
        for df in (*steps, out):
            df.collect()  # the plan then shows the joins as planned and as run
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (*steps, out)]
    assert sum("SortMergeJoin" in p for p in plans) >= 3  # near words, a round of roots, the result
    assert not any("Broadcast" in p for p in plans)


# --- hard negatives ---------------------------------------------------------------

def brute_negatives(rows, every=100, positives=5, negatives=5):
    best = {}
    for key, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if key is not None and key % 7 == 0 else label
        row = label, [int(np.floor(256 * float(np.float32(x)))) for x in v]
        best[key] = max(best[key], row) if key in best else row

    def first(rows, n):
        return sorted(rows, key=lambda r: (-r[1], r[0] is not None, r[0] or 0))[:n]

    out = []
    for a, (label, q) in best.items():
        if a is None or a % every:
            continue
        met = [(k, sum(x * y for x, y in zip(q, v)), lab) for k, (lab, v) in best.items() if k != a]
        for p, score, _ in first([m for m in met if m[2] == label], positives):
            window = [m for m in met if m[2] != label and 80 * score <= 100 * m[1] <= 100 * score]
            out += [(a, p, i + 1, k, score, s) for i, (k, s, _) in enumerate(first(window, negatives))]
    return sorted(out, key=str)


def got_negatives(spark, rows, every=100, **options):
    key, label = F.col("vec_id"), F.col("label")
    df = spark.createDataFrame([(*r, 7, "x") for r in rows],
                               "vec_id long, embedding array<float>, label int, score int, anchors string").repartition(3)
    out = hard_negatives.mine(df, label=F.when(key % 7 == 0, (label + 1) % 10).otherwise(label),
                              anchors=key % every == 0, **options)
    return sorted((tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                "negative_score").collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(3, 12))
    rows = [(k, (centre[k % 3] + rng.normal(size=12) * 0.6).tolist(), k % 4 if k % 5 else 1) for k in range(400)]
    rows += [(1000 + k, rows[k % 40][1], 1 + k % 3) for k in range(60)]           # ties
    rows += [(2000, None, 1), (2100, [1.0] * 12, None), (2200, [float("nan")] + [0.0] * 11, 1),
             (2300, [float("inf")] * 12, 2), (2400, [None] + [1.0] * 11, 2), (2500, [], 1), (2600, [0.0] * 12, 1),
             (2700, [1.0, 2.0], 2), (None, centre[0].tolist(), 1), (None, centre[1].tolist(), 1),
             (100, rows[3][1], 1), (100, rows[3][1], 3), (2800, [3e6] * 12, 1)]
    return rows


def test_negatives_as_brute_force(spark, vectors, monkeypatch):
    want = brute_negatives(vectors, 20)
    assert len(want) > 100
    assert got_negatives(spark, vectors, 20) == want


def test_negatives_over_many_blocks_and_chunks(spark, vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", 4)
    monkeypatch.setattr(hard_negatives, "PASS", 2)
    assert got_negatives(spark, vectors, 20) == brute_negatives(vectors, 20)


def test_scan_of_a_block_is_exact():
    rng = np.random.default_rng(1)
    m = rng.integers(-300, 300, (500, 10))
    b = hard_negatives.Block(np.arange(500).astype("<i8").tobytes(), np.zeros(500, "<i8").tobytes(), "<i2",
                             [m[:, k].astype("<i2").tobytes() for k in range(10)])
    for q in (rng.integers(-300, 300, 10), np.full(10, 1 << 60), rng.integers(-300, 300, 7)):
        score = [sum(int(x) * int(y) for x, y in zip(q, row)) for row in m]
        low, high = sorted(score)[300], sorted(score)[450]
        at, s = b.scan(q, np.arange(500), low, high)
        assert dict(zip(at.tolist(), map(int, s))) == {k: v for k, v in enumerate(score) if low <= v <= high}
        at, s = b.scan(q, np.arange(500), None, None, 5)
        assert sorted(map(int, s))[-5:] == sorted(score)[-5:]


def test_negatives_of_nothing(spark):
    assert got_negatives(spark, []) == []
    assert got_negatives(spark, [(100, [1.0], 1)]) == []


# --- toxicity ---------------------------------------------------------------------

def within(a, b, most):
    """Edits with swaps of neighbours, each letter touched once, or None."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1] if d[-1][-1] <= most else None


def brute_match(entries, word):
    exact = [e for e in entries if e == word]
    stems = [e for e in entries if e.endswith("*") and word.startswith(e[:-1])]
    if exact:
        return exact[0], 0
    if stems:
        return max(stems, key=len), 0
    far = [(n, k) for k, e in enumerate(entries) if not e.endswith("*")
           and (n := within(e, word, toxicity.edits(len(e)))) is not None]
    return (entries[min(far)[1]], min(far)[0]) if far else (None, 0)


def test_automaton_as_brute_force():
    rng = random.Random(2)
    entries = ["idiot", "idol", "worthless", "scum", "über*", "wort*", "disgusting", "ass"]
    words = []
    for _ in range(3000):
        w = rng.choice([e.rstrip("*") for e in entries])
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            c = rng.choice("idotsuwxé")
            w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:],
                            w[:max(0, i - 1)] + w[max(0, i - 1): i + 1][::-1] + w[i + 1:]]) or "x"
        words.append(w)
    part = toxicity.Slice.of([" ".join(words)])
    entry, off = toxicity.Automaton(entries).match(part.code, part.start, part.size)
    assert len(entry) == len(words)
    for w, e, n in zip(words, entry.tolist(), off.tolist()):
        assert (entries[e] if e >= 0 else None, n) == brute_match(entries, w), w


def test_words_and_context():
    part = toxicity.Slice.of(["", "An Id1ot, id$$ 5 de$$$", None or "", 'He said "you clown" twice', "𝐱 a"])
    words = [part.word(k) for k in range(len(part.start))]
    assert words[:4] == ["an", "id1ot", "id", "de"]
    assert part.first.tolist() == [0, 0, 4, 4, 9, len(words)]
    found = {k: h for k, _, h in toxicity.hits(part, toxicity.Automaton(["idiot", "clown"]))}
    assert [(h.word, h.edits) for h in found[1]] == [("id1ot", 1)]
    assert found[3][0].quoted and found[3][0].reported
    assert toxicity.quoted("ein „Idiot“ hier", 5, 10) and not toxicity.quoted("„ja“ Idiot „nein“", 5, 10)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    neutral = [f"{a}{b}" for a in "bcdfgklmnprstv" for b in ("ara", "elo", "imun", "opet", "ula")]
    bad = ["grublin", "snarfle", "worzeling"]
    docs, labels = [], []
    for k in range(900):
        words, toxic = rng.choices(neutral, k=rng.randrange(5, 60)), k % 5 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic), 1))
    docs += [(5000, None), (5001, ""), (5002, "snafrle bara grubln delo wozreling"), (5003, "bara delo"), (5003, "bara delo"),
             (5004, "bara elo. " * 20000 + "snarfle grublin worzeling"), (None, "x"), (5005, "snarfle"), (5006, '"snarfle"')]
    labels += [(5003, None, 1), (None, 1, 1), (0, 0, 0)]
    d = spark.createDataFrame([(*x, 0.5, "y") for x in docs], "doc_id long, text string, score double, label string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    return {r["doc_id"]: r for r in toxicity.judge(d, lab).collect()}, len(set(k for k, _ in docs))


def test_toxic_documents_of_the_held_out_fold(judged):
    rows, n = judged
    assert len(rows) == n
    held = [r for k, r in rows.items() if k is not None and k < 900 and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows.values() if r["doc_id"])
    assert held and all(r["predicted"] == int(r["doc_id"] % 5 == 0) == int(r["score"] >= 0.3) for r in held)


def test_toxic_cases(judged):
    rows, _ = judged
    assert rows[5002]["predicted"] == 1 and len(rows[5002]["terms"]) == 3    # each misspelled
    assert [rows[k]["predicted"] for k in (5000, 5001, 5003, None)] == [0] * 4
    assert rows[5000]["score"] == rows[5001]["score"]
    assert rows[5004]["terms"] and rows[5006]["score"] < rows[5005]["score"]   # a quotation


def test_toxicity_without_labels(spark, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [r["score"] for r in toxicity.judge(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.judge(empty.select("doc_id", "text"), none).count() == 0


def test_toxicity_of_the_tables(spark):
    out = QUERIES["op11_toxicity"](spark, SF_SMALL)
    assert out.count() == out.select("doc_id").distinct().count() == 200
    assert out.filter("score between 0 and 1").count() == 200
