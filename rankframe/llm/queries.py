"""One query per corpus operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.llm import bit_planes, decontaminate, filter_audit, jaccard, language, lengths, line_rules, packing, secrets, sharding, simhash, url_filter, warc
from rankframe.llm.common import read_table, scratch


def op1_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents")).drop("ids")


def op2_set_relation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), count_links=True).select("doc_id", "n_shingles", "component_id", "n_links")


def op3_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op4_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.describe_records(warc.read_archive(spark, path))


def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.context_limits(lengths.length_histogram(read_table(spark, sf_dir, "documents")))


def op6_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents")).drop("redacted")


def op7_language_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit_language_model(documents.where("not held_out"))
    return language.identify(documents, model, ["doc_id", "held_out"])


def op8_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_documents(read_table(spark, sf_dir, "documents")).drop("text")


def op11_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.cluster_vectors(read_table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op13_filter_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_hierarchical_packing, op2_set_relation_join, op3_label_propagation, op4_content_archive, op5_length_histogram, op6_trigram_secrets, op7_language_ftrl, op8_boosted_urls, op9_benchmark_leaks, op10_line_frequency, op11_bit_plane_clusters, op12_deletion_variants, op13_filter_potential)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_content_archive": warc.WARC_SQL,
        "op10_line_frequency": line_rules.LINE_RULES_SQL,
        "op11_bit_plane_clusters": bit_planes.clusters_sql(),
        "op13_filter_potential": filter_audit.AUDIT_SQL,
    }
