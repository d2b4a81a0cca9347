"""The pipeline's stages against plain Python, each on its own input."""

import brute
import corpus_pipeline
import pytest
from conftest_paths import SF_SMALL
from pyspark.sql import functions as F

from marketpulse.llm import sentence_pieces
from marketpulse.llm.common import stored


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and result on the smallest tables, with some trouble."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first()
    near = first.text.split(" ")
    extra = [(90001, first.text, "en", "s", 1), (90002, None, "en", "s", 0), (90003, "", None, None, None),
             (90004, "0123 !!", "en", "s", 7), (90005, " ".join([*near[:-1], "changed"]), "en", "s", 1),
             (90006, f"some words before {item.text} and some after", "en", "s", 1),
             (90007, "the of and that was with for this", None, "s", 1), (90007, "the of and that was with for this", None, "s", 1)]
    d = docs.union(spark.createDataFrame(extra, docs.schema)).withColumn("word", F.lit("clash"))
    out = []
    for name, fn in corpus_pipeline.STAGES:
        result = stored(fn(spark, d, SF_SMALL), name)
        out.append((name, d, result))
        d = result
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_language_drops_what_has_no_letters(stages):
    _, before, after = stages[0]
    gone = set(rows(before)) - set(rows(after))
    assert {i for i, _ in gone} == {90002, 90003, 90004}


def test_lines(stages):
    _, before, after = stages[1]
    want = {i: kept for i, (_, n, kept) in brute.line_dedup(rows(before), 3).items()
            if not n or kept.strip(" \n")}
    assert dict(rows(after)) == want and after.count() == len(want)
    assert after.filter("n_chars <> char_length(text) and n_chars is not null").join(
        before.select("doc_id", F.col("text").alias("t")), "doc_id").filter("t <> text").count() == 0


def test_near_duplicates(stages):
    _, before, after = stages[2]
    groups = brute.components(rows(before))
    assert sorted(i for i, _ in rows(after)) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_near_duplicates_of_five_words(spark):
    """A copy with 20 % of text appended is a near duplicate."""
    core = [f"w{k}" for k in range(104)]
    d = spark.createDataFrame([(1, " ".join(core)), (2, " ".join(core + [f"x{k}" for k in range(20)])),
                               (3, "another text")], "doc_id long, text string")
    assert sorted(i for i, _ in rows(corpus_pipeline.dedup_documents(spark, d, SF_SMALL))) == [1, 3]


def test_benchmark(spark, stages):
    _, before, after = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination(rows(before), items)
    assert sorted(i for i, _ in rows(after)) == sorted(i for i, (_, n, _) in hits.items() if not n)
    assert 90006 not in dict(rows(after))


def test_encoding(stages):
    import public_tokenizers
    _, before, after = stages[4]
    model = sentence_pieces.Model.load(public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.ids for r in after.collect()}
    texts = dict(rows(before))
    assert set(got) == set(texts)
    for i, ids in got.items():
        assert b"".join(model.raw[k] for k in ids)[1:].decode() == texts[i]


def test_run_and_entry(spark, stages):
    import __spark_entry__ as entry
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near", "benchmark", "encode"]
    out = entry.queries()["pipeline"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_ids", "ids"] and out.filter("n_ids <> size(ids)").count() == 0
    assert "pipeline" not in entry.oracle_sql()
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, fn in corpus_pipeline.STAGES:
        empty = stored(fn(spark, empty, SF_SMALL), "empty")
    assert empty.count() == 0
