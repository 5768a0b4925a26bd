"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

The leaves of the tree domain / language / source hold the documents. A leaf can
give its tokens ``max_epochs`` times; a node as much as its children together.
The budget goes down the tree. At each node it is divided among the children in
proportion to their weights; a child that cannot take its share is filled and the
rest goes to its siblings. As no node gets more than its leaves can hold, a
shortage reaches the parent's siblings only after its own siblings are full.
Shares are whole tokens: rounded down, and the units left over go one each to the
unfilled children in order of name.

A leaf with a quota of q tokens and t of its own gives ``q div t`` whole epochs and,
from the next, a prefix in the order of ``md5(seed:epoch:doc_id)``: the longest one
within the rest of the quota. Rows with equal ids stand and fall together.

A hot leaf is never sorted whole. Its tokens are summed by the first digits of the
order key (4,096 buckets, combined map-side), a running sum over those finds the
bucket where the prefix ends, and only that bucket is sorted. The texts are read
twice and never shuffled; what is joined to them is one row for each leaf.

Defined results: null domain, language or source is the name ``(none)``; null and
empty texts have 0 tokens, and documents without tokens are never selected; an
empty table gives no rows. Tokens are words ``[^\\x20\\x09-\\x0D]+`` unless a
count is given. Extra columns are kept;
those named like the four added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import cut_lineage

LEVELS = ("domain", "language", "leaf")
BUCKET_DIGITS = 3
NO_NAME = "(none)"
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def _name(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(NO_NAME))


def _weight(path: list[str], weights: Mapping[Sequence[str], int]) -> Column:
    """The weight of a node: a bounded parameter, given by the path or its last name; 1 by default."""
    out = F.lit(1)
    for names, value in weights.items():
        if len(names) <= len(path):
            cols = path[len(path) - len(names):]
            hit = F.lit(True)
            for c, n in zip(cols, names):
                hit = hit & (F.col(c) == n)
            out = F.when(hit, F.lit(int(value))).otherwise(out)
    return out.cast("bigint")


def divide(nodes: DataFrame, parent: list[str], name: str, budget: str) -> DataFrame:
    """Adds ``quota``: the parent's ``budget`` divided by ``weight`` under each child's ``cap``.

    Children with no room or no weight get nothing. One window per parent over its children.
    """
    wide = "decimal(38,0)"
    w, cap = F.col("_w").cast(wide), F.col("cap").cast(wide)
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = family.orderBy("_ratio", name).rowsBetween(Window.unboundedPreceding, -1)
    usable = F.when(F.col("cap") > 0, F.col("weight")).otherwise(F.lit(0))
    nodes = nodes.withColumn("_w", usable).withColumn(
        "_ratio", F.when(F.col("_w") > 0, F.expr(f"(cast(cap as {wide}) * 1000000) div _w")))
    before = F.coalesce(F.sum(F.when(F.col("_w") > 0, F.col("cap"))).over(ranked), F.lit(0))
    weight_left = F.sum("_w").over(family) - F.coalesce(F.sum("_w").over(ranked), F.lit(0))
    left = F.greatest(F.col(budget) - before, F.lit(0)).cast(wide)
    nodes = nodes.withColumn("_full", (F.col("_w") > 0) & (cap * weight_left.cast(wide) <= left * w))
    filled = F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(family), F.lit(0))
    nodes = nodes.withColumns({
        "_rest": F.greatest(F.col(budget) - filled, F.lit(0)),
        "_open": F.coalesce(F.sum(F.when(~F.col("_full"), F.col("_w"))).over(family), F.lit(0)),
    })
    nodes = nodes.withColumn("_share", F.when(F.col("_full"), F.col("cap")).when(
        F.col("_w") > 0, F.expr(f"(cast(_rest as {wide}) * cast(_w as {wide})) div _open")).otherwise(F.lit(0)))
    opened = ~F.col("_full") & (F.col("_w") > 0)
    given = F.coalesce(F.sum(F.when(opened, F.col("_share"))).over(family), F.lit(0))
    turn = F.sum(F.when(opened, 1).otherwise(0)).over(
        family.orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    unit = F.when(opened & (turn <= F.col("_rest") - given), F.lit(1)).otherwise(F.lit(0))
    nodes = nodes.withColumn("_unit", unit)
    quota = F.least(F.col("cap"), F.col("_share") + F.col("_unit")).cast("bigint")
    return nodes.withColumn("quota", quota).drop("_w", "_ratio", "_full", "_rest", "_open", "_share", "_unit")


def budgets(
    leaves: DataFrame, weights: Mapping[Sequence[str], int], total: int | None, share_percent: int | None,
) -> DataFrame:
    """The quota of every leaf (domain, language, leaf, tokens, cap).

    ``total`` is a number of tokens; instead, ``share_percent`` takes hundredths of all tokens.
    """
    paths = [list(LEVELS[:i + 1]) for i in range(len(LEVELS))]
    inner = leaves.groupBy(*paths[1]).agg(F.sum("cap").alias("cap"))
    top = inner.groupBy(*paths[0]).agg(F.sum("cap").alias("cap"))
    every = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    asked = F.lit(total).cast("bigint") if total is not None else F.expr(f"(all * {int(share_percent)}) div 100")
    top = top.join(every.select(asked.alias("budget")), how="left")  # one row
    shared = divide(top.withColumn("weight", _weight(paths[0], weights)), [], LEVELS[0], "budget")
    for level, nodes in ((1, inner), (2, leaves)):
        given = shared.select(*paths[level - 1], F.col("quota").alias("budget"))
        nodes = nodes.join(given, paths[level - 1]).withColumn("weight", _weight(paths[level], weights))
        shared = divide(nodes, paths[level - 1], LEVELS[level], "budget")
    return shared.drop("budget", "weight")


def mix(
    docs: DataFrame, domain: Column, language: Column, source: Column,
    weights: Mapping[Sequence[str], int], total: int | None = None, share_percent: int | None = 50,
    max_epochs: int = 1, seed: int = 0, tokens: Column | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """The selected rows of ``docs`` with ``mix_domain``, ``mix_tokens``, ``mix_quota`` and ``mix_epochs``.

    ``mix_epochs`` says how often a row is to be read. ``weights`` maps a path
    (domain, language, source), or its last names, to a whole number.
    """
    tokens = word_count(F.col("text")) if tokens is None else tokens
    path = [_name(domain).alias("domain"), _name(language).alias("language"), _name(source).alias("leaf")]
    number = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = cut_lineage(docs.select(*path, number.alias("id"), tokens.alias("tokens")))
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")).withColumn(
        "cap", F.col("tokens") * max_epochs)
    quotas = cut_lineage(budgets(leaves, weights, total, share_percent).withColumns({
        "whole": F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.lit(0)),
    }).withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens")))

    def order_key(number: Column, whole: str) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col(whole) + 1).cast("string"), number))

    keyed = rows.where("tokens > 0").join(quotas.select(*LEVELS, "whole", "rest"), list(LEVELS)) \
        .where("rest > 0").withColumn("key", order_key(F.col("id"), "whole")) \
        .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("tokens").alias("n"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket")
    sums = sums.withColumn("after", F.sum("n").over(running))
    ends = cut_lineage(sums.where("after > rest").groupBy(*LEVELS).agg(
        F.min_by(F.struct("bucket", (F.col("after") - F.col("n")).alias("before")), "bucket").alias("end"))
        .select(*LEVELS, "end.*"))
    inside = keyed.join(ends, [*LEVELS, "bucket"]).withColumn(
        "upto", F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(
            Window.unboundedPreceding, 0)) + F.col("before"))
    last = inside.where("upto <= rest").groupBy(*LEVELS).agg(F.max("key").alias("last"))
    # No end bucket: the rest equals all tokens, which whole epochs exclude; no row in it: up to its start.
    cuts = cut_lineage(quotas.join(ends, list(LEVELS), "left").join(last, list(LEVELS), "left").select(
        *LEVELS, "quota", "whole", "rest", F.coalesce("last", "bucket").alias("cut")))
    # The input's columns travel as one, so none of theirs can clash with ours.
    made = ("mix_domain", "mix_tokens", "mix_quota", "mix_epochs")
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), number.alias("id"), *path,
                      tokens.alias("n")).where("n > 0").join(cuts, list(LEVELS))
    epochs = F.col("whole") + F.when((F.col("rest") > 0) & (order_key(F.col("id"), "whole") <= F.col("cut")), 1) \
        .otherwise(0)
    return out.withColumn("epochs", epochs).where("epochs > 0").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in made],
        *[F.col(c).alias(n) for c, n in zip(("domain", "n", "quota", "epochs"), made)])
