"""Token counts from an exact histogram of encoded lengths.

Every text is encoded once. Texts are aggregated by their length in tokens
(combined map-side, so each task sends one row for each length it met), and sums
from the longest length down answer, for any context limit without another pass:
how many texts reach it, how many tokens they hold, what remains when every text is
cut to the limit, and where the quantiles lie.

The sums run in two levels: within blocks of ``BLOCK`` lengths, and over the block
totals, so no task sorts the whole histogram.

Defined results: null and empty texts have 0 tokens; an empty table gives an empty
histogram; repeated rows count each time; extra columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import cut_lineage, documents

BLOCK = 256


def load(ranks_path: str, pattern: str):
    """A byte-level BPE encoder from a file of ranks."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, ranks_path: str, pattern: str,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(ranks_path, pattern)
        for batch in batches:
            lengths = [len(encoder.encode_ordinary(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], schema=schema)

    return documents(docs, id_col, text_col).mapInArrow(count, "doc_id bigint, n_tokens bigint")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row for each length L that occurs, in the table (doc counts and token sums are exact):

    ``docs`` of this length, ``docs_from`` and ``tokens_from`` of this length or more,
    ``docs_to`` of this length or less, and ``truncated_total``: all tokens when each
    text is cut to L.
    """
    counts = cut_lineage(lengths.groupBy(F.col(length_col).alias("n_tokens")).agg(F.count(F.lit(1)).alias("docs")))
    counts = counts.withColumns({"block": F.expr(f"n_tokens div {BLOCK}"),
                                 "tokens": F.col("n_tokens") * F.col("docs")})
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for c, w, n in (
        ("d", after, "docs_after"), ("t", after, "tokens_after"),
        ("d", before, "docs_before"), ("t", before, "tokens_before"))])
    down = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    up = Window.partitionBy("block").orderBy("n_tokens")
    out = counts.join(blocks, "block")
    out = out.select(
        "n_tokens", "docs",
        (F.sum("docs").over(down) + F.col("docs_after")).alias("docs_from"),
        (F.sum("tokens").over(down) + F.col("tokens_after")).alias("tokens_from"),
        (F.sum("docs").over(up) + F.col("docs_before")).alias("docs_to"),
        (F.sum("tokens").over(up) + F.col("tokens_before")).alias("tokens_to"))
    return out.withColumn("truncated_total", F.col("tokens_to") + F.col("n_tokens") * (
        F.col("docs_from") - F.col("docs"))).drop("tokens_to")


def context_report(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For each limit: texts longer than it, tokens kept by cutting to it, and all tokens."""
    limits = sorted({int(x) for x in limits})
    asked = histogram.sparkSession.createDataFrame([(x,) for x in limits], "context bigint")
    totals = [F.sum(F.when(F.col("n_tokens") > x, F.col("docs")).otherwise(0)).alias(f"o{x}") for x in limits]
    kept = [F.sum(F.least(F.col("n_tokens"), F.lit(x)) * F.col("docs")).alias(f"k{x}") for x in limits]
    row = histogram.agg(F.coalesce(F.sum(F.col("n_tokens") * F.col("docs")), F.lit(0)).alias("total"), *totals, *kept)
    pick = lambda p: F.coalesce(F.element_at(F.create_map(
        *[x for limit in limits for x in (F.lit(int(limit)).cast("bigint"), F.col(f"{p}{limit}"))]),
        F.col("context")), F.lit(0))
    return asked.join(row, how="left").select("context", pick("o").alias("docs_over"),
                                              pick("k").alias("tokens_kept"), "total")


def length_quantiles(histogram: DataFrame, percents: Sequence[int]) -> DataFrame:
    """The smallest length that at least each percentage of the texts does not exceed."""
    docs = F.col("docs_to") + F.col("docs_from") - F.col("docs")
    rows = [histogram.where(F.col("docs_to") * 100 >= docs * p).agg(F.min("n_tokens").alias("n_tokens"))
            .select(F.lit(p).alias("percent"), "n_tokens") for p in percents]
    out = rows[0]
    for row in rows[1:]:
        out = out.union(row)
    return out
