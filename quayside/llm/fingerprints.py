"""Document fingerprints: threshold-scaled sketches, with DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction (1 / ``SCALE``) of the hash
range. Its size follows the text, so the share of a small text's hashes that a large
text holds is estimated without bias, whatever their sizes. Sketches merge by union.
A text none of whose hashes falls below the fraction keeps its smallest one, which
a merge with any hash below the fraction replaces.

Shingles are five words ``[^\\x20\\x09-\\x0D]+`` of the text as it is, or all words of
a shorter text. The fingerprint is the sketch's sorted hashes in hexadecimal.

The successor of each row in ascending order of the id is found without a global
sort: rows are grouped by id ranges of ``RANGE``, each range gets the first row of the
next range as a guest, and only the ranges' numbers are ordered, in two levels.

Defined results: null text is empty; a text without words has the empty fingerprint,
which is like itself only (likeness 1 to another empty one, 0 to others); equal ids
are ordered by a hash of their texts; rows without an id come before all others; the
successor of the last row is the first, of an only row itself. Extra columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import documents, utf8_sha256

SHINGLE = 5
SCALE = 8
RANGE = 256
SPAN = 1024  # ranges in each group of the upper level
_SPACES = r"[\x20\x09-\x0D]+"


def _limit(scale: int) -> int:
    """The largest hash within the lowest 1 / ``scale`` of the 64-bit range."""
    return -(1 << 63) + (1 << 64) // scale - 1


def with_sketch(df: DataFrame, text_col: str, sketch_col: str, scale: int = SCALE) -> DataFrame:
    """Adds the sketch of a text column: a sorted array of hashes.

    In steps, so that each array is built once for a row.
    """
    limit = _limit(scale)
    df = df.withColumn("_w", F.filter(F.split(F.col(text_col), _SPACES), lambda w: w != ""))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w))).drop("_w")
    h = F.col("_h")
    shingles = F.when(F.size(h) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(h) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))) \
        .when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_s", shingles).drop("_h")
    df = df.withColumn("_k", F.filter("_s", lambda x: x <= limit)).withColumn("_m", F.array_min("_s")).drop("_s")
    kept = F.when((F.size("_k") == 0) & F.col("_m").isNotNull(), F.array("_m")).otherwise(F.col("_k"))
    return df.withColumn(sketch_col, F.array_sort(F.array_distinct(kept))).drop("_k", "_m")


def fingerprint(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two texts: shared over all hashes of their sketches."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` holds; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two collections together."""
    limit = _limit(scale)
    every = F.array_sort(F.array_union(a, b))
    return F.when(F.exists(every, lambda x: x <= limit), F.filter(every, lambda x: x <= limit)) \
        .otherwise(F.slice(every, 1, 1))


def _ranges(ids: DataFrame) -> DataFrame:
    """Rows (range, following) over the occupied ranges; the last is followed by the first."""
    ids = ids.withColumn("upper", F.expr(f"floor(range / {SPAN})"))
    inner = Window.partitionBy("upper").orderBy("range")
    tops = ids.groupBy("upper").agg(F.min("range").alias("head"))
    every = Window.orderBy("upper")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("upper", F.coalesce(F.lead("head").over(every), F.first("head").over(whole)).alias("then"))
    return ids.withColumn("following", F.lead("range").over(inner)).join(
        tops, ids["upper"].eqNullSafe(tops["upper"])) \
        .select("range", F.coalesce("following", "then").alias("following"))


def with_guests(texts: DataFrame) -> DataFrame:
    """Adds ``range``, and to each range a ``guest`` row: the first row of the following range."""
    # Rows without an id form a range of their own before all others.
    rows = texts.withColumn("range", F.coalesce(F.expr(f"floor(doc_id / {RANGE})"), F.lit(-(1 << 62))))
    heads = rows.groupBy("range").agg(F.min_by(
        "text", F.struct(F.coalesce("doc_id", F.lit(0)), F.xxhash64("text"))).alias("text"))
    order = _ranges(rows.select("range").distinct())
    guests = order.join(heads.withColumnRenamed("range", "following"), "following").select(
        F.lit(None).cast("bigint").alias("doc_id"), "text", "range", F.lit(True).alias("guest"))
    return rows.select("doc_id", "text", "range", F.lit(False).alias("guest")).union(guests)


def following(rows: DataFrame, *columns: str) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows in ascending ``doc_id``; guests go."""
    turn = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    out = rows.withColumns({f"next_{c}": F.lead(c).over(turn) for c in columns})
    return out.where("not guest").drop("guest", "range")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they are.

    The edited text has the last half of the code points (rounded down) replaced by as
    many of the first of the following text, or by all of it.
    """
    rows = with_sketch(with_guests(documents(docs, id_col, text_col)), "text", "sketch", scale)
    rows = following(rows, "text", "sketch").withColumn("n_chars", F.length("text").cast("bigint"))
    rows = rows.withColumn("edited", F.expr(
        "concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next_text, 1, int(n_chars div 2)))"))
    rows = with_sketch(rows.drop("text", "next_text"), "edited", "edited_sketch", scale)
    own, other, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", "n_chars", utf8_sha256(F.col("edited")).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"), fingerprint(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"), likeness(own, after).alias("near_next"),
        containment(own, other).alias("contained_in_edited"), containment(own, after).alias("contained_in_next"))
