"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, lexical_search, license_scan, line_dedup, mixing, page_text, quality_divergence, secret_ledger,
               simhash_dedup, source_divergence, token_counts, toxicity_fm, url_rules)
from .common import ensure_checkpoint_dir, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {"op7_url_rules": url_rules.ORACLE, "op11_line_runs": line_dedup.ORACLE,
                              "op12_lexical_search": lexical_search.ORACLE, "op13_source_divergence": source_divergence.ORACLE}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for a table in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


@_query
def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    domains = mixing.quality_domains(docs, read_table(spark, sf_dir, "labels"))
    return (mixing.mix(docs, domains, mixing.TARGETS)
            .select(F.col("id").alias("doc_id"), "n_tokens", "domain", "posterior", "rate", "copies"))


@_query
def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.scan_versions(read_table(spark, sf_dir, "documents"), new_folder(spark, "ledger"), ["doc_id"])
    return secret_ledger.span_digest(found, ["doc_id"])


@_query
def op3_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(read_table(spark, sf_dir, "documents"))


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    found = decontaminate.leaked_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return (found.groupBy(F.col("id").alias("doc_id"), "item_id")
            .agg(F.max(F.struct("similarity", "start_word", "n_words", "distance")).alias("b"))
            .select("doc_id", "item_id", "b.*"))


@_query
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), new_folder(spark, "tokens"))


@_query
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"))


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op9_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_divergence.quality_rules(read_table(spark, sf_dir, "documents"))


@_query
def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(read_table(spark, sf_dir, "pages"))


@_query
def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), new_folder(spark, "lines"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(read_table(spark, sf_dir, "documents"))
