"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import centroids, decontam, importance, langid, license_scan, packing, pii, prefix_trie, quality, simhash, substring, toxicity, url_filter


#: The session setting that holds the secret of surrogates.
SECRET = "spark.tessera.surrogate.secret"


def surrogate_secret(spark: SparkSession) -> str:
    """The session's secret. Where it has none, surrogates of this run can be told by no later one."""
    return spark.conf.get(SECRET, None) or secrets.token_hex(32)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a table of fewer parts than there are cores (one small file) is dealt out over them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken_rule")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir), surrogate_secret(spark))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(documents(spark, sf_dir), size=13)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("row_key")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), *packing.public_files("byte_bpe_50k"), capacity=1024, end=2)


def op9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("spans")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_substring": op5_substring,
    "op6_langid": op6_langid,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_importance": op9_importance,
    "op10_license_scan": op10_license_scan,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_url_filter": op12_url_filter,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {"op11_centroid_clustering": centroids.sql(), "op13_prefix_trie": prefix_trie.sql()}
