"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.llm import (
    decontaminate,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    phrases,
    pii_tagger,
    quality_cnn,
    quality_rules,
    secret_scan,
    topk,
    url_filter,
    warc,
)
from covisit_spark.llm.common import read

# First labels of hosts whose pages make up the list of blocked URLs.
LISTED_HOSTS = ["spam-farm", "adult-x", "free-bets"]


def listed_urls(pages: DataFrame) -> DataFrame:
    """The canonical URLs of pages on the listed kinds of hosts."""
    bad = F.substring_index(url_filter.host(F.col("url")), ".", 1).isin(LISTED_HOSTS)
    return pages.where(bad).select(url_filter.canonical(F.col("url")).alias("canonical")).distinct()


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document holds: one row per document and item."""
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and blocked-Bloom list lookup over every page's url."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, listed_urls(pages))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and draw of every document under raked source, language and topic shares."""
    docs = read(spark, sf_dir, "documents")
    return mixing.mix(docs, ["doc_id", "source", "lang"])


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level convolutional quality score of every document."""
    return quality_cnn.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: patterns and BiLSTM-CRF spans."""
    return pii_tagger.scan(read(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to monolithic archives, normalised, and read back."""
    return warc.archive_round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and the learned decision list for every document."""
    judged = quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: patterns and Markov-model spans."""
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{name}")  # noqa: B023 - used at once
        for k, name in enumerate(secret_scan.KINDS[:3])
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.concat("base", "extra")).alias("spans"),
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, with the root folded from the tampered row."""
    return merkle.manifest(read(spark, sf_dir, "documents"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors, by integer inner product, of every hundredth."""
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [
        op1_line_dedup,
        op2_decontamination,
        op3_url_filter,
        op4_mixing,
        op5_quality_cnn,
        op6_dart_minhash,
        op7_pii,
        op8_warc,
        op9_quality_rules,
        op10_secrets,
        op11_phrases,
        op12_merkle,
        op13_topk,
    ]
    return {f.__name__: f for f in made}
