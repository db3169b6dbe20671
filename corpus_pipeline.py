"""From documents to packed training sequences: quality rules, near-duplicates, decontamination, personal data, packing.

Each stage takes what its predecessor kept. All but the last return the columns of documents; the last returns the pieces of the
sequences. Stages drop rows (rules, duplicates, contaminated documents) or change texts (personal data).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, packing, pii, quality, simhash
from tessera.llm.common import shared_folder
from tessera.llm.queries import surrogate_secret


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_in(docs, surrogate_secret(spark))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, *packing.public_files("byte_bpe_50k"), capacity=1024, end=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, surrogates and token ids are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def remove(spark: SparkSession, path: str) -> None:
    """Drop a stage's rows once the next one's are written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that documents end in. Each stage's rows are written to the shared folder and read again."""
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        if k:
            remove(spark, f"{base}/{k - 1}")
    return docs
