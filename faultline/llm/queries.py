"""One query per training-data operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import (
    bpe, collocations, context_tree, decontaminate, html_extract, language_id, license_scan, line_dedup, merkle, ngram_join, pii, voronoi, warc,
)
from faultline.llm.common import remainder, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocab).drop("ids")


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_texts(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "lines.n_lines",
        "lines.n_dropped",
        F.sha2(F.col("lines.kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(warc.resolve_duplicates(pages), warc.train_dictionary(pages))
    records = warc.read_archives(stored(archives, "warc"), payloads=False)
    return records.select(
        F.expr("try_cast(record_id as bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
        "problem",
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.array_join("licenses", " ").alias("licenses"), F.array_join("sentence_ids", " ").alias("sentence_ids")
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = language_id.learn(docs, ~F.coalesce(held_out, F.lit(False)))
    predicted = language_id.identify(docs, model)
    return predicted.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2(F.col("base").cast("binary"), 256)).drop("base")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = merkle.build(merkle.leaves(docs, remainder(F.col("doc_id"), 5) == 0))
    return merkle.verify(manifest).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_context_tree, op3_line_dedup, op4_decontaminate, op5_html, op6_warc, op7_license_scan, op8_language_id, op9_top_k, op10_ngram_join, op11_collocations, op12_pii, op13_merkle)}
