"""From raw documents to token ids: five stages, each written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.
All but the last return the columns of ``documents``; a row without an id is treated as
the operator's docstring says. A stage never drops a row that its operator has not judged:
rows without an id or sharing one are judged and dropped each by itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import bpe, decontaminate, language_id, line_dedup, ngram_join
from faultline.llm.common import remainder, stored

#: A document is rejected if fewer of its n-grams than this are known in its most likely language.
LEAST_LANGUAGE_SCORE = 0.2
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages learned from the labelled four fifths; others and wordless ones go."""
    training = F.coalesce(remainder(F.col("doc_id"), 5) != 0, F.lit(True))
    model = language_id.learn(docs, training)
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    judged = language_id.identify(whole, model, id_col="row", inside=True)
    kept = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select("row.*")


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has; a document left without any line goes."""
    found = line_dedup.dedup_lines(docs).where("lines.n_dropped < lines.n_lines")
    text = F.when(F.col("lines.n_dropped") == 0, F.col("text")).otherwise(F.col("lines.kept_text"))
    changed = found.withColumns({"text": text, "n_chars": F.length(text).cast("long")})
    return changed.select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns) and ``key``, the row's own number; stored, so that it stays the same."""
    return stored(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("key")), "keyed")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id; NULL counts last, of equal ids the first row's."""
    rows = keyed(docs)
    ordered = F.struct(F.col("row.doc_id").isNull().alias("unnamed"), F.col("row.doc_id").alias("doc_id"), "key")
    found = ngram_join.near_duplicates(rows.select(ordered.alias("place"), "row.text"), id_col="place")
    copies = found.where(F.col("place.key") != F.col("component_id.key")).select("place.key")
    return rows.join(copies, "key", "left_anti").select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = keyed(docs)
    leaks = decontaminate.decontaminate(rows.select("key", "row.text"), benchmark, id_col="key").select("key").distinct()
    return rows.join(leaks, "key", "left_anti").select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit), their number and digest, and the digest of the text decoded from them."""
    return bpe.round_trip(docs, bpe.load_vocabulary(TOKENIZER))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", first_lines),
    ("ngram_join", one_of_each),
    ("decontaminate", without_benchmark),
    ("bpe", token_ids),
]
#: Language identification, BPE and SimHash have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
