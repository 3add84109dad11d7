"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that it
keeps, with their columns as they were (the PII stage rewrites ``text`` and
``n_chars``); the last returns token ids.  Every stage's result is written as
Parquet in the shared folder and read again, so a lost executor costs no
earlier stage.  Nulls, empty and repeated rows: see each operator's module.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkngram.llm import bpe, decontaminate, neardup, pii, toxicity
from sparkngram.llm.common import documents
from sparkngram.session import ensure_checkpoint_dir

# Near duplicates: word shingles of five words, similarity of 0.8 or more.
WORDS, NUMERATOR, DENOMINATOR = 5, 80, 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the lexicon model predicts as toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group stays."""
    return neardup.keep_one(docs, WORDS, NUMERATOR, DENOMINATOR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: spans of personal data give way to their kind."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token ids, and the digest of what they decode to."""
    return bpe.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", encode),
]

# Learnt models and a rank-file tokenizer have no SQL; tests compare the
# pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last stage's rows."""
    docs = documents(spark, sf_dir)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
