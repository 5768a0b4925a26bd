"""Registered queries of the training-data operators, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    embedding_dedup, filter_audit, fingerprints, mixing, near_duplicates, periodic_runs, phrases, pii,
    quality_rules, sentencepiece_codec, sql, suffix_dedup, token_counts, url_filters,
)
from quayside.llm.tables import ship_package, utf8_sha256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MIX_WEIGHTS = {("d0",): 5, ("d1",): 3, ("en",): 4, ("fr",): 2, ("d0", "en", "src0"): 3}
MIX = {"weights": MIX_WEIGHTS, "share_percent": 50, "max_epochs": 2, "seed": 7}


def register(query):
    QUERIES[query.__name__] = query
    return query


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_redirect_equivalence(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    judged = url_filters.url_verdicts(pages, url_filters.rule_table(pages, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", "inherited")


@register
def op2_line_first_cleaning(spark, sf_dir):
    return quality_rules.quality_measures(read(spark, sf_dir, "documents"))


@register
def op3_distinct_chunk_table(spark, sf_dir):
    model = tokenizer_file("piece_bpe_32k.model")
    return sentencepiece_codec.encode_and_decode(read(spark, sf_dir, "documents"), model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), utf8_sha256(F.col("text")).alias("decoded_sha256"))


@register
def op4_length_histogram(spark, sf_dir):
    import public_tokenizers

    lengths = token_counts.token_lengths(
        read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_counts.length_histogram(lengths)


@register
def op5_super_minhash(spark, sf_dir):
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"))


@register
def op8_checked_spans(spark, sf_dir):
    found = pii.pii_spans(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        utf8_sha256(pii.spans_text(F.col("spans"), pii.BASE_KINDS)).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"))


def domain_of(source) -> F.Column:
    """A grouping of the sources, for want of a column: the last character's code modulo four."""
    return F.concat(F.lit("d"), (F.ascii(F.right(source, F.lit(1))) % 4).cast("string"))


@register
def op10_hierarchical_budgeting(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, domain_of(F.col("source")), F.col("lang"), F.col("source"), **MIX)
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source",
                        F.col("mix_tokens").alias("n_tokens"), F.col("mix_quota").alias("leaf_quota"),
                        F.col("mix_epochs").cast("bigint").alias("epochs"))


@register
def op7_scaled_sketches(spark, sf_dir):
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


@register
def op9_phrase_automata(spark, sf_dir):
    return phrases.remove_repeated_phrases(read(spark, sf_dir, "documents"))


@register
def op6_column_wise_suffixes(spark, sf_dir):
    return suffix_dedup.remove_repeated_substrings(read(spark, sf_dir, "documents"))


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """Every tenth text or so, by its id, with its words from a place on replaced by repeats of a few."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.when(crc % 10 == 0, words).alias("w"))
    placed = chosen.withColumn("n", F.size("w").cast("bigint")) \
        .withColumn("a", (F.col("g") % F.nullif("n", F.lit(0))).cast("int"))
    tail = F.col("n") - F.col("a")
    timed = placed.withColumn("p", (1 + F.floor(tail / (3 + F.col("g") % 8))).cast("int")) \
        .withColumn("t", tail.cast("int"))
    unit = F.slice("w", F.col("a") + 1, F.col("p"))
    repeats = F.flatten(F.array_repeat(unit, F.ceil(F.col("t") / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(repeats, F.lit(1), F.col("t"))), " ")
    return timed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@register
def op11_branching_tandems(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_planted_tails(read(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "strongest.start", "strongest.length",
        "strongest.period", F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        utf8_sha256(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")).alias("runs_sha256"),
        utf8_sha256(F.col("text")).alias("collapsed_sha256"))


@register
def op12_radix_text_tries(spark, sf_dir):
    masks = filter_audit.failure_masks(read(spark, sf_dir, "documents"))
    return filter_audit.interactions(masks, read(spark, sf_dir, "labels"))


@register
def op13_pstable_hashing(spark, sf_dir):
    return embedding_dedup.near_embeddings(read(spark, sf_dir, "embeddings"))


ORACLES.update({
    "op1_redirect_equivalence": sql.url_verdicts(URL_RULES, url_filters.TRACKING),
    "op2_line_first_cleaning": sql.quality_measures(quality_rules),
    "op5_super_minhash": sql.NEAR,
    "op9_phrase_automata": sql.PHRASES,
    "op10_hierarchical_budgeting": sql.mixing(**MIX),
    "op12_radix_text_tries": sql.FILTER_AUDIT,
    "op13_pstable_hashing": sql.NEAR_EMBEDDINGS,
})
