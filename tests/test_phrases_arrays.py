"""Phrase filters against a plain search; JSON arrays cut into many splits."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from marketpulse.operators import phrases as P
from marketpulse.operators import sentiment as S
from marketpulse.session import scratch_path
from marketpulse.sources import arrays as A
from marketpulse.sources.sinks import write_json_arrays


def _texts(rnd, n):
    words = ["a", "b", "c", "d", "it's", "\u00e9t\u00e9", "x1", "zz"]
    out = ["".join(rnd.choice(words) + rnd.choice([" ", "  ", ", ", "\n"]) for _ in range(rnd.randrange(0, 60)))
           for _ in range(n)]
    return [None, "", "...", "A B C", *out]


def test_occurrences_equal_a_plain_search(spark):
    rnd = random.Random(4)
    texts = _texts(rnd, 200)
    phrases = ["a", "a b", "A  b c", "b c", "it's a", "\u00e9t\u00e9", "d d d d", "a b c d a", "never seen", "a b"]
    listed = [p.lower().split() for p in dict.fromkeys(" ".join(p.lower().split()) for p in phrases)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(5)
    got = {r["k"]: [(h["phrase"], h["at"]) for h in r["hits"]]
           for r in df.select("k", P.occurrences(F.col("text"), phrases).alias("hits")).collect()}
    tagged = {r["k"]: r for r in P.with_phrases(df, "text", phrases, count="n").collect()}
    kept = {r["k"] for r in P.matching(df, "text", phrases).collect()}
    for k, text in enumerate(texts):
        tokens = S._TOKEN.findall((text or "").lower())
        want = [(n, i) for i in range(len(tokens)) for n, p in enumerate(listed) if tokens[i: i + len(p)] == p]
        assert got[k] == want
        assert tagged[k]["n"] == len(want) and (k in kept) == bool(want)
        assert tagged[k]["phrases"] == sorted({" ".join(listed[n]) for n, _ in want})


def test_phrase_edges(spark):
    df = spark.createDataFrame([("a b",), (None,)], "text string")
    assert P.matching(df, "text", []).count() == 0
    assert [r["phrases"] for r in P.with_phrases(df, "text", []).collect()] == [[], []]
    assert P.matching(df.limit(0), "text", ["a"]).count() == 0
    assert P.matching(df, "text", ["b"]).count() == 1            # no phrase has a second word
    with pytest.raises(ValueError):
        P.matching(df, "text", ["..."])


def test_many_phrases_one_trie(spark):
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiou"]
    phrases = [f"{a} {b}" for a in words for b in words]
    trie = P.build(P.phrase_words(phrases))
    assert len(trie.words) == 50 and trie.depth == 2 and (trie.ends >= 0).sum() == 2500


RECORD = StructType([
    StructField("id", StringType()), StructField("t", StringType()),
    StructField("n", StructType([StructField("a", ArrayType(StructType([StructField("x", LongType())])))]))])


def _records(rnd, n):
    chars = 'ab{}[]"\\,\n :' + "\u00e9\u65e5\U0001f600"
    return [{"id": str(i), "t": "".join(rnd.choice(chars) for _ in range(rnd.randrange(0, 40))) if i % 7 else None,
             "n": {"a": [{"x": k} for k in range(rnd.randrange(0, 4))]}} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "16"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_array_files_in_many_splits_equal_multiline(spark, small_splits):
    rnd = random.Random(3)
    path = scratch_path(spark, "t-arrays")
    os.makedirs(path)
    rows = _records(rnd, 300)
    files = {"a": json.dumps(rows, indent=1, ensure_ascii=False), "b": json.dumps(rows[:40]),
             "c": json.dumps(rows[3]), "d": "[]", "e": ""}
    for name, text in files.items():
        with open(os.path.join(path, f"{name}.json"), "w", encoding="utf-8") as fh:
            fh.write(text)
    want = spark.read.schema(RECORD).option("multiLine", "true").json(path).filter("id is not null")
    got = A.read_json_array(spark, path, RECORD)
    assert A.pieces(spark, path).filter("_file like '%a.json'").select("_split").distinct().count() > 10
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == 341


def test_a_record_longer_than_several_splits(spark, small_splits):
    path = scratch_path(spark, "t-long-record")
    os.makedirs(path)
    rows = [{"id": "0", "t": "x{" * 3000}, {"id": "1", "t": '}"' * 2000}, {"id": "2", "t": "plain"}]
    with open(os.path.join(path, "a.json"), "w") as fh:
        fh.write(json.dumps(rows) + "\n")
    with open(os.path.join(path, "cut.json"), "w") as fh:
        fh.write('[{"id": "3", "t": "whole"}, {"id": "4", "t": {"no end')
    got = {r["id"]: r["t"] for r in A.read_json_array(spark, path, RECORD).collect()}
    assert got == {**{r["id"]: r["t"] for r in rows}, "3": "whole"}


def test_arrays_written_by_group(spark, small_splits):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit('}{"').alias("t"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("g"))
    path = scratch_path(spark, "t-written")
    write_json_arrays(df, path, ["g"], ["id"])
    found = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".txt")]
    assert len(found) == 4 and sum(len(json.load(open(f))) for f in found) == 500
    back = A.read_json_array(spark, path, df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
