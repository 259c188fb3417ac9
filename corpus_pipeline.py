"""Stages from raw documents to packed sequences.

Each stage takes (spark, docs, folder of the tables) and returns what goes on; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.llm import catalog, decontaminate, packing, parity_join, secret_scan, toxicity
from loadshift.llm.shared import stored, table
from loadshift.session import scratch_dir

#: Kernels, signatures, verified windows and packing have no SQL counterpart; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the texts that the model, trained on labelled documents, scores 0.5 or more."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 hold together, the one with the smallest doc_id stays."""
    return parity_join.one_of_each(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; n_chars follows the new text."""
    masked = secret_scan.redact(docs, f"{scratch_dir(spark)}/ledger")
    return masked.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids, sequence_id and offset of each piece."""
    return packing.pack(docs, catalog.BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("decontamination", drop_leaked),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
