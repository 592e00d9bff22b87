"""The registered queries of this subpackage: thin, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlume.llm.decontaminate import contamination
from postlume.llm.hardnegatives import hard_negatives
from postlume.llm.html import extract_main_text
from postlume.llm.language import held_out, identify, learn
from postlume.llm.licenses import license_scan
from postlume.llm.neardup import near_dedup
from postlume.llm.nearest import nearest
from postlume.llm.quality import quality_rules
from postlume.llm.substring import substring_dedup
from postlume.llm.tokens import count_tokens, encode_pieces, ids_folder, read_ids, write_ids
from postlume.llm.vectors import finite
from postlume.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_removed_words", "kept")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    parser = learn(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), parser).select(
        "doc_id", "held_out", "lang_pred", "score")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup(docs).select("doc_id", "class_id", "kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.drop("twin").withColumnRenamed("id", "doc_id")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs).withColumnRenamed("id", "doc_id")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = ids_folder(spark)
    write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_ids(spark, folder)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    scaled = rows.select(
        "vec_id", F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return hard_negatives(scaled, F.col("vec_id") % 100 == 0, by_row=True, limit=(1 << 63) - 1)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, by_row=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_token_ids": op4_token_ids,
    "op5_pieces": op5_pieces,
    "op6_language": op6_language,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_near_dedup": op9_near_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_nearest": op13_nearest,
}
