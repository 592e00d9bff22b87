"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and gives a frame, which is written and read again as the
docs of the next one. All but the last give the columns of ``documents``; where a stage changes a
text, ``n_chars`` follows it if it is there.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlume.llm.decontaminate import decontaminate
from postlume.llm.neardup import near_dedup
from postlume.llm.quality import quality_rules
from postlume.llm.substring import substring_dedup
from postlume.llm.tokens import encode_pieces
from postlume.session import shared_dir


def _as_before(docs: DataFrame, changed: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of docs, the text from column ``text`` of ``changed`` if one is named."""
    columns = []
    for f in docs.schema.fields:
        if text and f.name == "text":
            columns.append(F.col(text).alias("text"))
        elif text and f.name == "n_chars":
            columns.append(F.length(text).cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"`{f.name}`"))
    return changed.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go, and documents that the rules reject."""
    return _as_before(docs, quality_rules(docs).where("kept"), "clean_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays."""
    return _as_before(docs, near_dedup(docs).where("kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows that also start earlier are cut; a document that loses all its words goes."""
    return _as_before(docs, substring_dedup(docs).where("n_removed < n_words or n_words = 0"), "kept_text")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and the digests that show what they decode to."""
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]
#: Sketches and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
