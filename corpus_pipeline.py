"""A pipeline over ``documents``: filter, deduplicate, decontaminate and encode.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes each
result to the shared folder and reads it again as the next stage's documents. All stages but the last return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontamination, language_id, queries, sentencepieces, simhash, toxicity
from tidemark.llm.common import prepare, table, with_row_keys, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity reaches the limit go; a NULL text, or one that tells nothing, is not toxic."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), queries.severity_grade())
    return docs.where(~toxicity.verdict(model)(F.col("text"))["toxic"])


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the languages go, each judged as a row of its own whatever its doc_id.

    A NULL or empty text, and one without letters, is in none.
    """
    prepare(spark)
    rows, row = with_row_keys(docs)
    # Row keys depend on how the rows are dealt out, so which of them teach goes by what they hold.
    judged = language_id.identify(language_id.document_evidence(rows, also=(row,)), [row], sample_by=["id", "text"])
    rejected = judged.where("NOT kept").select(row)
    return rows.join(rejected, row, "left_anti").drop(row)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicate rows the smallest doc_id stays, or one without a doc_id if none has any.

    Texts without words are one group.
    """
    prepare(spark)
    rows, row = with_row_keys(docs)
    found = simhash.near_duplicates(rows, queries.SHINGLE, queries.MAX_DISTANCE, id_col=row)
    return simhash.one_of_each(rows, row, written(found, "components"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; NULL and empty texts hold none and stay."""
    prepare(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of what is left and of the decoded texts; a NULL text is encoded as an empty one."""
    prepare(spark)
    return sentencepieces.digests(sentencepieces.encode_documents(docs, queries.model_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_identified),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("SentencePiece encoding and decoding", encode),
]

# Trained models and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
