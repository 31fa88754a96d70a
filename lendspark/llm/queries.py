"""One query per operator over the given tables, under names that start with the operator's number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendspark.llm import bpe, embeddings, exact_dedup, importance, licenses, mixing, partitions, ppm, quality, simhash, spelling, suffixes, urls
from lendspark.llm.common import documents, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(documents(spark, sf_dir)))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the urls that were fetched for more than one page."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.repeated_urls(pages))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), *bpe.public_tokenizer(spark))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("draws")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(documents(spark, sf_dir))


def op9_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(documents(spark, sf_dir))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).drop("recall")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(documents(spark, sf_dir)))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.nearest(table(spark, sf_dir, "embeddings")).drop("recall")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_quality_classifier, op3_simhash_near_dedup, op4_url_filter, op5_byte_bpe, op6_source_mixing,
        op7_exact_dedup, op8_repeated_passages, op9_ppm_score, op10_embedding_near_dedup, op11_spelling_variants,
        op12_importance_resampling, op13_nearest_neighbours,
    )
}
