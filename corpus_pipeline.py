"""From raw documents to token ids: quality, near-duplicates, benchmark passages, secrets, encoding.

``run`` applies :data:`STAGES` to the documents. Each stage works on what the one before kept, which is written
and read again. All but the last keep the columns of ``documents``. Null and empty texts, repeated rows and
empty tables behave as the operators say; a filter keeps a row unless its decision speaks against it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import decontaminate, nbsvm, order_minhash, prefix_bpe, secrets
from pagemill.llm.common import row_bucket, table, written
from pagemill.llm.queries import BYTE_RANKS

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model is that of the quality query."""
    known = row_bucket(F.col("doc_id"), 5) != 0
    model = nbsvm.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), known)
    return docs.where(nbsvm.score_udf(docs, model)("text") >= nbsvm.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest id; rows without an id stay."""
    dropped = order_minhash.classes(docs).where(~F.col("kept") & F.col("doc_id").isNotNull())
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    clean = F.size(F.col("hits")) == 0
    found = decontaminate.with_hits(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(clean).select(*COLUMNS)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; lengths follow the text."""
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    encoded = prefix_bpe.with_tokens(docs, BYTE_RANKS, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_redaction),
    ("byte-level BPE", tokens),
]

# The stages hold trained models and a vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{number}")
    return docs
