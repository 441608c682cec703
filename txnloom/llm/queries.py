"""One query for each operator, over its whole table, and the SQL it equals where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, host_quality, jaccard, line_dedup, merkle, multiset_hash, nbsvm, packing, pii
from . import repeats, toxicity, variants, warc
from .common import table


def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.host_quality(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_bytes(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.drop_repeated_lines(docs.select("doc_id", "text"), "n_lines", "n_removed")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return nbsvm.score(docs, *nbsvm.train(docs, table(spark, sf_dir, "labels")))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


def op12_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_quality": op1_host_quality,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_repeats": op4_repeats,
    "op5_personal_data": op5_personal_data,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_similar_documents": op7_similar_documents,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_pack": op10_pack,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_multiset_fingerprints": op12_multiset_fingerprints,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op1_host_quality": host_quality.SQL,
    "op6_warc_revisits": warc.SQL,
    "op7_similar_documents": jaccard.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op11_merkle_manifest": merkle.SQL,
}
