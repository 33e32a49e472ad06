"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. quality classifier: documents whose probability of the top grade is under 0.5 go;
2. exact dedup: of texts equal but for white space, the longest (smallest doc_id) stays;
3. MinHash near-dedup: the smallest doc_id of every linked group stays;
4. benchmark decontamination: documents that hold a window of a benchmark item go;
5. SentencePiece encoding and decoding: n_tokens, ids and decoded join the columns.

Every stage sees all that the one before it kept. Stages 1 to 4 return the columns of
``documents`` unchanged, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import common, decontaminate, exact_dedup, near_dedup, ordinal_quality, pieces, queries


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal_quality.selected(docs, ordinal_quality.rated(common.read_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, common.read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, queries.piece_model())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: No SQL: the classifier is fitted and near-duplicates are linked transitively.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = common.stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
