"""The corpus pipeline: five stages from raw documents to encoded and decoded texts.

Every stage reads all that its predecessor kept; stages before the last return the
columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.llm import mixing, near_duplicates, pii, quality_rules, sentencepiece_codec  # noqa: E402
from quayside.llm.queries import MIX_WEIGHTS, domain_of, tokenizer_file  # noqa: E402
from quayside.llm.tables import cut_lineage, ship_package, utf8_sha256  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail."""
    ship_package(spark)
    return quality_rules.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    judged = near_duplicates.near_duplicates(docs)
    dropped = cut_lineage(judged.where("not kept").select("doc_id").distinct())
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, by domain, language and source; each document at most once."""
    mixed = mixing.mix(docs, domain_of(F.col("source")), F.col("lang"), F.col("source"),
                       MIX_WEIGHTS, share_percent=50, max_epochs=1, seed=7)
    return mixed.select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document and the digest of their decoded text."""
    model = tokenizer_file("piece_bpe_32k.model")
    return sentencepiece_codec.encode_and_decode(docs, model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), utf8_sha256(F.col("text")).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]
ORACLE_SQL = None  # SentencePiece has no SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
