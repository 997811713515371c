"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lettings.llm import (
    centroids,
    common,
    contamination,
    language,
    packing,
    pii,
    quality,
    repeats,
    resampling,
    secret_scan,
    simhash,
    sql,
    token_counts,
    url_filter,
    vectors,
)

Query = Callable[[SparkSession, str], DataFrame]


def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return token_counts.counted(common.table(spark, sf_dir, "documents"))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    )


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(common.table(spark, sf_dir, "documents"))


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(common.table(spark, sf_dir, "documents"))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(common.table(spark, sf_dir, "documents"))


def contamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.judged(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    )


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.clusters(common.table(spark, sf_dir, "documents"))


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(common.table(spark, sf_dir, "documents"))


def repeats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(common.table(spark, sf_dir, "documents"))


def vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.kept_and_linked(common.table(spark, sf_dir, "embeddings"))


def resampling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    )


def centroids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(common.table(spark, sf_dir, "embeddings"))


def urls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(common.table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": token_count_query,
    "op2_quality": quality_query,
    "op3_language": language_query,
    "op4_pii": pii_query,
    "op5_packing": packing_query,
    "op6_contamination": contamination_query,
    "op7_simhash": simhash_query,
    "op8_secrets": secrets_query,
    "op9_repeats": repeats_query,
    "op10_vectors": vectors_query,
    "op11_resampling": resampling_query,
    "op12_centroids": centroids_query,
    "op13_urls": urls_query,
}

#: Only queries that DuckDB can express over whole tables.
SQL: dict[str, str] = {
    "op6_contamination": sql.CONTAMINATION,
    "op11_resampling": sql.RESAMPLING,
    "op12_centroids": sql.CENTROIDS,
    "op13_urls": sql.URLS,
}
