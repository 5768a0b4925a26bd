"""MinHash near-deduplication with SuperMinHash signatures.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text's set holds its
distinct five-word shingles, or the whole sequence as one shingle when it has
fewer words. Two texts are linked when their sets' intersection is at least
``percent`` hundredths of their union.

1. *Signatures.* In a SuperMinHash every element ranks the slots by a random
   permutation of its own and offers slot p_j the value j + r_j. Slots of one
   element are thus correlated, which lowers the variance of the estimate, and a
   text is finished once no slot can still improve: after one or two ranks for a
   long text.
2. *Banding.* 128 slots in 32 bands of 4: a pair at similarity 0.75 shares no
   band with probability (1 - 0.75^4)^32, about 5 in a million.
3. *Verification* on the full sets, for every pair that can still matter.
   Texts with equal sets are one class and enter once.
4. *Grouping* by union-find. Within a bucket a pair whose ends are already
   connected needs no check. First all members of a bucket are compared with the
   smallest one, so a group of n near copies costs about n checks. Buckets that
   still hold several groups are settled through their members' rarest shingles: in
   an order that puts shingles known to one group only first, and then the rarer
   ones, a text that is linked to another group must share one of its first quarter
   of shingles with it (the prefix filter of set similarity joins, which is exact).
   Texts with a quarter of their shingles to their own group are thus done with. Bit
   maps of the shingles rule out pairs with too many missing bits while they are
   joined, so that few pairs are left to check, whatever many texts have in common.

Shingles are compared by 64-bit hashes within a pair of texts.

Defined results: null text is empty; a text without words is linked with nothing
and has 0 shingles; rows without a doc_id keep null components and are kept; an
id that occurs on several rows is one node. The memory of a task follows a block
of texts (one text at least). Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import kernel as K
from quayside.llm.components import connected_components
from quayside.llm.tables import arrow_schema, cut_lineage, documents

SHINGLE = 5
BANDS, ROWS = 32, 4
PERCENT = 75
MAP_WORDS = 16  # a bit map of 1,024 bits over a text's shingles
U64 = K.U64
_SHEETS = "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>"
_SETS = "doc_id bigint, n bigint, items binary"
_ITEMS = "doc_id bigint, n bigint, g bigint, s bigint"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a block, sorted within it, and their text numbers."""
    start, end, text = K.words(data, offsets)
    hashes = K.span_hash(K.prefix_hash(data, K.LOWER_VALUES), start, end)
    count = K.word_counts(text, len(offsets) - 1)
    shingles, place = K.grams(hashes, text, SHINGLE)
    owner = text[place]
    head = np.cumsum(count) - count
    for size in range(1, SHINGLE):  # whole sequences of short texts
        short = np.flatnonzero(count == size)
        if len(short):
            total = np.full(len(short), size, dtype=U64)
            for j in range(size):
                total = K.mix(total + hashes[head[short] + j])
            shingles, owner = np.concatenate([shingles, total]), np.concatenate([owner, short])
    order = np.argsort(shingles)
    order = order[np.argsort(owner[order], kind="stable")]
    shingles, owner = shingles[order], owner[order]
    fresh = np.ones(len(shingles), dtype=bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[fresh], owner[fresh]


def super_minhash(items: np.ndarray, owner: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """Signatures, one row of ``slots`` values for each text; rows of empty texts stay at the top value.

    All unfinished elements of the block take their j-th rank together. The swap
    tables of the Fisher-Yates shuffles are kept only for those left after rank 0.
    """
    sheet = np.full(texts * slots, np.iinfo(U64).max, dtype=U64)
    swaps, low = None, U64(0xFFFFFFFF)
    for j in range(slots):
        if not len(items):
            break
        draw = K.mix(items + U64((j + 1) * int(K._GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        pick = (j + (((draw >> U64(32)) * U64(slots - j)) >> U64(32))).astype(np.int64)
        if j == 0:
            slot, first_pick = pick, pick
        else:
            rows = np.arange(len(items))
            slot = swaps[rows, pick].astype(np.int64)
            swaps[rows, pick] = swaps[:, j]
        np.minimum.at(sheet, owner * slots + slot, (U64(j) << U64(32)) | (draw & low))
        worst = sheet.reshape(texts, slots).max(axis=1)
        going = (worst >= (U64(j + 1) << U64(32)))[owner]
        if j == 0:
            items, owner, first_pick = items[going], owner[going], first_pick[going]
            swaps = np.tile(np.arange(slots, dtype=np.uint16), (len(items), 1))
            swaps[np.arange(len(items)), first_pick] = 0
        elif not going.all():
            items, owner, swaps = items[going], owner[going], swaps[going]
    return sheet.reshape(texts, slots)


def band_hashes(sheet: np.ndarray, bands: int) -> np.ndarray:
    parts = sheet.reshape(len(sheet), bands, -1)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * K._GOLDEN, parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        total = K.mix(total + parts[:, :, j])
    return total.view(np.int64)


def _signing(bands: int, rows: int):
    schema = arrow_schema(_SHEETS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in K.blocks(batch.column(1)):
                texts = end - first
                items, owner = shingle_sets(data, offsets)
                count = K.word_counts(owner, texts)
                edges = np.concatenate([[0], np.cumsum(count)])
                classes = [hashlib.md5(items[a:b]).digest() for a, b in zip(edges[:-1], edges[1:])]
                values = band_hashes(super_minhash(items, owner, texts, bands * rows), bands)
                lists = pa.ListArray.from_arrays(
                    np.arange(0, texts * bands + 1, bands, dtype=np.int32), values.ravel())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, texts), pa.array(count), pa.array(classes, pa.binary()), lists],
                    schema=schema)
    return sign


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_SETS)
    for batch in batches:
        ids = batch.column(0)
        for first, end, data, offsets in K.blocks(batch.column(1)):
            items, owner = shingle_sets(data, offsets)
            count = K.word_counts(owner, end - first)
            edges = np.concatenate([[0], np.cumsum(count)])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, end - first), pa.array(count),
                 pa.array([items[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())],
                schema=schema)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("a bigint, b bigint, na bigint, nb bigint, both bigint")
    for batch in batches:
        both = []
        for x, y in zip(batch.column("xa"), batch.column("xb")):
            x, y = (np.frombuffer(v.as_buffer(), dtype=U64) for v in (x, y))
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            both.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("a", "b", "na", "nb")] + [pa.array(both, pa.int64())],
            schema=schema)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sizes of both sets and of their intersection for each pair (a, b)."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"),
                                 F.col("items").alias(f"x{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        _shared, "a bigint, b bigint, na bigint, nb bigint, both bigint")


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_ITEMS)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            items = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in part.column("items")]
            place = pa.array(np.repeat(np.arange(len(items)), [len(x) for x in items]))
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(place) for c in ("doc_id", "n", "g")]
                + [pa.array(np.concatenate(items))], schema=schema)


def _close(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow a link."""
    return pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) \
        .select("a", "b").distinct()


def _between_groups(members: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that may be linked, from buckets with several groups."""
    found = connected_components(links, "a", "b").withColumnRenamed("node", "doc_id")
    held = members.join(found, "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("g"))
    split = held.groupBy("bucket").agg(F.min("g").alias("lo"), F.max("g").alias("hi")) \
        .where("lo <> hi").select("bucket")
    left = held.join(split, "bucket", "left_semi").select("doc_id", "g").distinct()
    rows = cut_lineage(sets.join(left, "doc_id")).mapInArrow(_item_rows, _ITEMS)
    common = rows.groupBy("s").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count(F.lit(1)).alias("df")) \
        .where("lo <> hi").select("s", "df")
    # Shingles of one group only come first in every text, then the rarer ones.
    spare = F.floor(F.col("n") * (100 - percent) / 100) + 1 - (F.col("n") - F.size("x"))
    word = F.pmod(F.col("s"), F.lit(MAP_WORDS))
    maps = [F.bit_or(F.when(word == k, F.expr("shiftleft(1L, cast(pmod(shiftright(s, 8), 64) as int))"))
                     .otherwise(F.lit(0).cast("bigint"))).alias(f"m{k}") for k in range(MAP_WORDS)]
    names = [f"m{k}" for k in range(MAP_WORDS)]
    first = rows.join(common, "s").groupBy("doc_id", "n", "g").agg(
        F.array_sort(F.collect_list(F.struct("df", "s"))).alias("x"), *maps) \
        .where(spare > 0).select("doc_id", "n", "g", (F.col("n") - F.size("x")).alias("own"), *names,
                                 F.posexplode(F.slice("x", F.lit(1), spare.cast("int"))).alias("at", "x")) \
        .select("doc_id", "n", "g", "own", (F.col("own") + F.col("at")).alias("at"), *names, F.col("x.s").alias("s"))
    first = cut_lineage(first)
    sizes = first.groupBy("s", "g").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("s").agg(F.max(F.struct("k", "g"))["g"].alias("main"), F.count(F.lit(1)).alias("groups")) \
        .where("groups > 1").select("s", "main")
    side = lambda x: F.struct("doc_id", "n", "own", "at", *names).alias(x)
    outside = first.join(largest, "s").where("g <> main").select("s", "g", side("x"))
    other = first.select("s", F.col("g").alias("h"), side("y"))
    # Of a linked pair's shingles at most ``slack`` are in one text only. The first shared
    # one stands no later than that, and the bits of shared ones cannot be missing.
    need = F.ceil((F.col("x.n") + F.col("y.n")) * percent / (100 + percent))
    missing = lambda x, y: F.col(f"{x}.own") + sum(
        F.bit_count(F.col(f"{x}.{m}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{m}")))) for m in names)
    fits = F.lit(True)
    for x, y in (("x", "y"), ("y", "x")):
        fits = fits & (F.col(f"{x}.n") - F.col(f"{x}.at") >= need) & (F.col(f"{x}.n") - missing(x, y) >= need)
    met = outside.join(other, "s").where((F.col("g") != F.col("h")) & fits)
    return met.select(F.least("x.doc_id", "y.doc_id").alias("a"),
                      F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links that connect exactly the texts that all links of the buckets connect."""
    linked = F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent
    centre = members.groupBy("bucket").agg(F.min(F.struct("doc_id", "n")).alias("c"))
    star = _close(members.join(centre, "bucket").where("doc_id <> c.doc_id").select(
        F.col("c.doc_id").alias("a"), F.col("doc_id").alias("b"),
        F.col("c.n").alias("na"), F.col("n").alias("nb")), percent)
    links = cut_lineage(verified(star, sets).where(linked).select("a", "b"))
    more = verified(_between_groups(members, sets, links, percent), sets)
    return links.union(cut_lineage(more.where(linked).select("a", "b")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``."""
    texts = documents(docs, id_col, text_col)
    sheets = cut_lineage(texts.mapInArrow(_signing(bands, rows), _SHEETS))
    named = sheets.where("doc_id is not null")
    heads = named.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    slots = heads.select("doc_id", "n", F.explode("bands").alias("bucket"))
    shared = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket")
    members = cut_lineage(slots.join(shared, "bucket").select("bucket", "doc_id", "n"))
    wanted = members.select("doc_id").distinct()
    sets = cut_lineage(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_set_rows, _SETS)
                       .dropDuplicates(["doc_id", "items"]))
    links = _links(members, sets, percent)
    # Equal sets link an id to the head of its class; an id on several rows joins its classes.
    ties = named.where("n_shingles > 0").join(
        heads.select("class", F.col("doc_id").alias("b")), "class").where("doc_id <> b") \
        .select(F.col("doc_id").alias("a"), "b")
    found = connected_components(links.union(ties), "a", "b")
    out = sheets.join(found, sheets["doc_id"] == found["node"], "left")
    return out.select(
        sheets["doc_id"], "n_shingles",
        F.coalesce("component", sheets["doc_id"]).alias("component_id"),
        F.coalesce(sheets["doc_id"] == F.coalesce("component", sheets["doc_id"]), F.lit(True)).alias("kept"))
