"""The corpus pipeline: five stages from ``documents`` to a mixed training set.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and reads it again as the next stage's ``docs``, so a lost executor costs a
re-read.  All stages but the last return the columns of ``docs``.

* toxicity: documents the factorization machine rejects go.
* near_dedup: one document of each SimHash component stays.
* decontaminate: documents that hold a benchmark passage go.
* secrets: every secret found is replaced in the text; documents stay.
* mix: adds ``rate`` and ``copies``, in place of own columns of these names; documents
  without a copy go.

Null texts count as empty; empty input gives empty output; extra columns are
carried.  Where each operator decides on ties and repeated rows is in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.llm import decontaminate, mixing, secret_ledger, simhash_dedup, toxicity_fm
from riskgrid.llm.catalog import new_folder
from riskgrid.llm.common import free_names, read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_fm.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    blob, findings = free_names(docs, "blob", "findings")
    found = secret_ledger.scan_versions(docs, new_folder(spark, "ledger"), docs.columns, blob=blob, findings=findings)
    clean = secret_ledger.redact(found, blob=blob, findings=findings)
    if "n_chars" in docs.columns:  # keeps its type and follows the text
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                                 .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    domains = mixing.quality_domains(docs, read_table(spark, sf_dir, "labels"))
    return mixing.mixed_documents(docs, domains, mixing.TARGETS)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontamination),
          ("secrets", secrets), ("mix", mix)]

#: No SQL: trained scores, components and the gradient fit; tests/llm holds the
#: rows against a brute-force run of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
