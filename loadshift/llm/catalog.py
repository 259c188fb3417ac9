"""The operators as queries over the given tables: name -> function of (spark, folder of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.llm import decontaminate, filter_audit, hard_negatives, packing, parity_join, quality_rules, secret_scan, simhash_cover, substring_dedup
from loadshift.llm import token_counts, token_files, toxicity, url_rules
from loadshift.llm.shared import stored, table
from loadshift.session import scratch_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_RANKS)
    return counted.withColumn("score", F.round("score", 6))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "item_id", "start", "length", "similarity")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_BPE)
    return packing.assign(stored(pieces, "pieces"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.token_files(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_BPE)
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of(spans: str, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = secret_scan.with_spans(docs, f"{scratch_dir(spark)}/ledger")
    kinds = [r.kind for r in secret_scan.BASE]
    counts = [F.size(_of("spans", [k])).cast("bigint").alias(f"n_{k}") for k in kinds]
    base = _of("spans", kinds)
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.link(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op12_simhash_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash_cover.link(table(spark, sf_dir, "documents", "doc_id", "text"))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), "embedding")
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = rows.select(F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.steps("embedding", 256).alias("vector"))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_token_counts,
        op3_decontamination,
        op4_packing,
        op5_quality_rules,
        op6_token_files,
        op7_url_rules,
        op8_toxicity,
        op9_secret_scan,
        op10_ngram_join,
        op11_filter_audit,
        op12_simhash_cover,
        op13_hard_negatives,
    )
}
