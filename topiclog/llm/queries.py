"""The queries of this package: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog.llm import codes, exactdup, infill, language, licenses, mixing, neardup, packing, pieces, quality, sharding, topk, urls
from topiclog.llm.base import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are sharded with their texts; the digests returned are of the texts that come out."""
    def digests() -> list[Column]:
        text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
        return [(F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")]

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", *digests())
    placed = sharding.sharded(docs, 16, key_cols=("doc_id", "text_crc32", "size")).drop("size", "text_crc32")
    return placed.select("doc_id", *digests(), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the addresses that several pages share."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, urls.shared_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences hold their ids; the digests returned are of the ids that come out."""
    return packing.sequences(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(50)) == 0), 5)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests are of the ids and texts that come out."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return pieces.tokenized(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agreed")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests are of the outputs and of the texts restored from them."""
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    back = infill.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_license_scan, op2_quality_classifier, op3_stratified_sharding, op4_url_filter, op5_packing, op6_exact_dedup,
        op7_language_id, op8_exact_topk, op9_minhash_near_dedup, op10_source_mixing, op11_sentencepiece, op12_vector_codes, op13_fill_in_middle,
    )
}
# SQL where it can express the operator.
ORACLE: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op4_url_filter": urls.ORACLE,
    "op6_exact_dedup": exactdup.ORACLE,
    "op8_exact_topk": topk.ORACLE,
    "op12_vector_codes": codes.oracle(),
    "op13_fill_in_middle": infill.ORACLE,
}
