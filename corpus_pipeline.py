"""Corpus pipeline: from raw documents to token ids.

Each stage works on all that the one before kept: documents in no known
language go, repeated runs of lines are deleted, one of each group of near
duplicates stays (the smallest id), documents with benchmark passages go, and
what is left is encoded. A stage's result is a stored table, the next one's
input, so a lost executor costs at most one stage.

Defined cases: documents with null or empty text have no language and go in
the first stage; a repeated id is one document from the second stage on; an
empty table gives an empty result; further columns pass through to the last
stage, whose result is (doc_id, n_ids, ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.llm import decontaminate, jaccard_join, language_id, line_dedup, sentence_pieces
from marketpulse.llm.common import free_name, one_row_each, stored
from marketpulse.session import apply_runtime_defaults, ship_package
from marketpulse.sources.tables import read_table

#: Near duplicates: words in a shingle and least similarity (80 of 100).
NEAR = 5, 80, 100


def _ready(spark: SparkSession) -> None:
    apply_runtime_defaults(spark)
    ship_package(spark)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification rejects."""
    _ready(spark)
    found = free_name(docs, "found")
    named = language_id.predictor(docs, language_id.train(docs))
    return (docs.withColumn(found, named(F.col("text").cast("string")))
            .filter(~F.col(f"{found}.rejected")).drop(found))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes runs of lines that occurred before, and documents of nothing else."""
    _ready(spark)
    return line_dedup.without_repeats(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates."""
    _ready(spark)
    rows = one_row_each(docs)
    groups = jaccard_join.near_duplicates(rows, *NEAR)
    go = (groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
          .select(F.col("doc_id").alias(free_name(rows, "copy"))))
    return rows.join(go, F.col("doc_id").eqNullSafe(F.col(go.columns[0])), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    _ready(spark)
    hits = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    go = hits.filter("n_hit > 0").select(F.col("doc_id").alias(free_name(docs, "hit")))
    return docs.join(go, F.col("doc_id").eqNullSafe(F.col(go.columns[0])), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    import public_tokenizers
    _ready(spark)
    coded = sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [("language", identify_language), ("lines", dedup_lines), ("near", dedup_documents),
          ("benchmark", drop_contaminated), ("encode", encode)]

#: The first and last stage have no SQL form; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
