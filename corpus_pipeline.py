"""Corpus pipeline: five stages, each written as Parquet and read again.

Every stage works on all that its predecessor kept. All but the last return the
columns of ``documents``; the last adds ``copy`` and ``place``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldkpi.llm import decontaminate, mixing, near_dup, quality, secrets
from fieldkpi.llm.common import documents, stored
from fieldkpi.llm.queries import quality_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: the document with the smallest id of each group stays."""
    return near_dup.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: live-looking secrets are replaced in the texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents are repeated to the target weights and shuffled."""
    return mixing.mix(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: SQL can express neither the classifier nor the signatures; tests/llm holds the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
