"""The corpus pipeline: documents in, encoded training mix out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``. Every stage works on all rows that its predecessor kept.

Nulls and edge cases are those of the operators: a row with a null text counts as an empty text, is scored
by the model's base score, is no near duplicate, stays null under redaction, has 0 words and no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, neardup, quality, secrets
from tidemark.llm.common import Scratch, table

WEIGHTS = [3, 1, 2]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the classifier rejects (score below 0.7) go."""
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.withColumnRenamed("score", "_score"), model,
                           ["_score" if c == "score" else c for c in docs.columns])
    return scored.where(F.col("score") >= quality.THRESHOLD).drop("score").withColumnRenamed("_score", "score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near duplicates (five-word shingles, similarity 0.8) one document stays."""
    return neardup.deduplicated(docs, words=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: secrets in the texts are masked; every document stays."""
    return secrets.redact(docs, secrets.train(secrets.labelled_samples(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the mix of sources takes it."""
    return mixing.repeated(docs, WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: doc_id, n_tokens, ids, decoded_sha256."""
    return bpe.encoded(docs, bpe.vocabulary_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL cannot express hashed sampling, trained models and the tokenizer; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
