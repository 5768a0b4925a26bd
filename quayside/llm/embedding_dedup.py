"""Near duplicates among embeddings by Euclidean p-stable hashing.

Vectors of one label are linked when their cosine, in double precision, is at least
``threshold``. For unit vectors that is a Euclidean distance of sqrt(2 - 2 threshold).

1. *Classes.* Vectors of one label with the same direction, component by component, are
   one class (128-bit digests), counted map-side; a vector that a third of all rows
   repeat enters the search once.
2. *Hashing.* A projection a.v on a Gaussian vector a is 2-stable: for two vectors it
   differs by a normal variable as wide as their distance. It is shifted at random and cut
   into cells of ``WIDTH`` such distances. A table's key joins ``PROJECTIONS`` cells and
   the label; there are ``TABLES`` tables. A pair at the threshold shares a cell
   with probability 0.92, hence a key with 0.19 and no key at all with 0.0012; closer pairs
   are lost less often. Unrelated vectors share a key less than once in a million.
3. *Checks.* Keys of one class only are done with. A larger bucket is cut into chunks of
   about ``BLOCK`` classes, and every pair of chunks is one block: a matrix
   product gives exact cosines. A pair counts in the first table that it shares, so no
   list of pairs is ever made: a block returns, for each class, how many vectors it
   found and the smallest class that it is connected to there.
4. *Grouping* by union-find over those connections.

Tables are worked off in rounds of ``ROUND``, so keys and copies of vectors on disk
follow a round and not all tables. Pairs of one bucket are all compared (in blocks that
spread over tasks); that is what exact link counts of a large near group cost.

Defined results: vectors that are null, zero, empty or hold null or non-finite components
link with nothing, and so do rows with a null label; vectors of different lengths do
not link. Rows without an id link with nothing and are kept with a null component; rows
with equal ids are judged each by its own vector. An empty table gives no rows. Extra
columns are not read. The memory of a task follows a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import connected_components
from quayside.llm.tables import arrow_schema, cut_lineage, free_shuffles, ship_package

THRESHOLD = 0.98
PROJECTIONS, TABLES, ROUND = 20, 32, 8
WIDTH = 10.0  # cells, in distances at the threshold
BLOCK = 1024
SEED = 20_011
_SLICE = 512  # vectors that are projected at a time
_KEYS = "class binary, place int, key bigint"
_FOUND = "class binary, links bigint, root binary"


def unit_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: rows and their unit vectors; rows without a direction are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for n in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == n)
        found = flat[start[rows][:, None] + np.arange(n)]
        scale = np.abs(found).max(axis=1)
        good = np.isfinite(found).all(axis=1) & (scale > 0)
        found = found[good] / scale[good, None] + 0.0
        yield rows[good], found / np.sqrt(np.einsum("ij,ij->i", found, found))[:, None]


@lru_cache(maxsize=8)
def _family(length: int, distance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projections in units of a cell, shifts, and odd factors that join a table's cells."""
    draw = np.random.default_rng([SEED, length])
    lines = draw.standard_normal((length, TABLES * PROJECTIONS)) / (WIDTH * distance)
    shifts = draw.random(TABLES * PROJECTIONS)
    factors = draw.integers(1, 1 << 63, size=(TABLES, PROJECTIONS), dtype=np.int64) | 1
    return lines, shifts, factors


def table_keys(units: np.ndarray, first: int, end: int, distance: float) -> np.ndarray:
    """Keys of the tables from ``first`` to ``end``: a row for each vector."""
    lines, shifts, factors = _family(units.shape[1], distance)
    at = slice(first * PROJECTIONS, end * PROJECTIONS)
    out = np.empty((len(units), end - first), dtype=np.int64)
    for k in range(0, len(units), _SLICE):
        cells = np.floor(units[k:k + _SLICE] @ lines[:, at] + shifts[at]).astype(np.int64)
        cells = cells.reshape(len(cells), end - first, PROJECTIONS)
        out[k:k + _SLICE] = np.einsum("ijk,jk->ij", cells, factors[first:end])
    return out


def _labels(column: pa.Array) -> np.ndarray:
    """64 bits for each label; nulls are not asked for."""
    coded = column.dictionary_encode()
    each = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True)
                     for x in coded.dictionary.to_pylist()] or [0], dtype=np.int64)
    return each[pc.fill_null(coded.indices, 0).to_numpy(zero_copy_only=False)]


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the class of each vector: a digest of its label and direction; null where it can't link."""
    for batch in batches:
        label = batch.column("label").to_pylist()
        known = pc.is_valid(batch.column("vec_id")).to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(label)
        for rows, units in unit_vectors(batch.column("vector")):
            for row, unit in zip(rows.tolist(), units):
                if known[row] and label[row] is not None:
                    name = label[row].encode()
                    out[row] = hashlib.blake2b(b"%d:%s" % (len(name), name) + unit.tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                         [*batch.schema.names, "class"])


def _hash(first: int, end: int, distance: float):
    schema = arrow_schema(_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = _labels(batch.column("label"))
            for rows, units in unit_vectors(batch.column("vector")):
                keys = table_keys(units, first, end, distance)
                keys = (keys ^ label[rows][:, None]) * np.int64(0x1E3779B97F4A7C15) + np.arange(first, end)
                who = pa.array(np.repeat(rows, end - first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class").take(who), pa.array(np.tile(np.arange(first, end, dtype=np.int32), len(rows))),
                     pa.array(keys.ravel())], schema=schema)
    return run


def _smallest(pairs: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """For each of ``n`` places the smallest that it is connected to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[pairs[0]], root[pairs[1]])
        new = root.copy()
        np.minimum.at(new, pairs[0], low)
        np.minimum.at(new, pairs[1], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block(units, label, chunk, place, sides, threshold, distance):
    """Pairs of one block that reach the threshold and share no earlier table."""
    if sides[0] == sides[1]:
        close = np.triu(units @ units.T >= threshold, 1)
        i, j = np.nonzero(close)
    else:
        left, right = np.flatnonzero(chunk == sides[0]), np.flatnonzero(chunk == sides[1])
        i, j = np.nonzero(units[left] @ units[right].T >= threshold)
        i, j = left[i], right[j]
    same = label[i] == label[j]
    i, j = i[same], j[same]
    if place and len(i):
        keys = table_keys(units, 0, place, distance)
        fresh = np.ones(len(i), dtype=bool)
        for t in range(place):
            fresh &= keys[i, t] != keys[j, t]
        i, j = i[fresh], j[fresh]
    return i, j


def _check(threshold: float, distance: float):
    """Judges blocks, whose rows follow each other in key, lo, hi order."""
    schema = arrow_schema(_FOUND)

    def judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        cols = {c: table.column(c).to_numpy() for c in ("key", "lo", "hi", "chunk", "place", "n")}
        label = _labels(table.column("label").combine_chunks())
        names = table.column("class").combine_chunks()
        for rows, units in unit_vectors(table.column("vector")):
            key, lo, hi, chunk, place, n = (cols[c][rows] for c in ("key", "lo", "hi", "chunk", "place", "n"))
            new = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if b - a < 2:
                    continue
                i, j = _block(units[a:b], label[rows[a:b]], chunk[a:b], int(place[a]), (lo[a], hi[a]),
                              threshold, distance)
                if not len(i):
                    continue
                links = np.bincount(i, weights=n[a:b][j], minlength=b - a) \
                    + np.bincount(j, weights=n[a:b][i], minlength=b - a)
                hit = np.flatnonzero(links)
                root = _smallest((i, j), b - a)[hit]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(rows[a + hit])), pa.array(links[hit].astype(np.int64)),
                     names.take(pa.array(rows[a + root]))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            lo, hi, key = (table.column(c).to_numpy() for c in ("lo", "hi", "key"))
            same = (key == key[-1]) & (lo == lo[-1]) & (hi == hi[-1])
            cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
            yield from judged(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from judged(pa.Table.from_batches(held))
    return run


def _round(classes: DataFrame, first: int, end: int, threshold: float, distance: float) -> DataFrame:
    """What the tables from ``first`` to ``end`` find: (class, links, root), written."""
    keyed = classes.select("class", "label", "vector").mapInArrow(_hash(first, end, distance), _KEYS)
    buckets = cut_lineage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    chunks = F.ceil(F.col("m") / BLOCK)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("other")
    mates = keyed.join(buckets, "key").join(classes.select("class", "label", "n", "vector"), "class")
    blocks = mates.select("*", F.pmod(F.xxhash64("class"), chunks).alias("chunk")).select("*", other) \
        .select("class", "label", "n", "vector", "place", "key", "chunk",
                F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    dealt = blocks.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return cut_lineage(dealt.mapInArrow(_check(threshold, distance), _FOUND))


def near_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``df``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest
    id reachable, ``kept`` whether it is the row's own.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    ship_package(df.sparkSession)
    distance = float(np.sqrt(2 - 2 * threshold))
    vector = F.col(f"`{vector_col}`")
    kind = df.select(vector).dtypes[0][1]
    if kind not in ("array<float>", "array<double>"):
        vector = vector.cast("array<double>")
        kind = "array<double>"
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
                     F.col(f"`{label_col}`").cast("string").alias("label"), vector.alias("vector"))
    shaped = rows.mapInArrow(_classes, f"vec_id bigint, label string, vector {kind}, class binary")
    classes = cut_lineage(
        shaped.where("class is not null").groupBy("class")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"),
             F.first(F.struct("label", "vector")).alias("v"))
        .select("class", "rep", "n", "v.label", "v.vector"))
    found = None
    for first in range(0, TABLES, ROUND):
        part = _round(classes, first, min(first + ROUND, TABLES), threshold, distance)
        free_shuffles(df.sparkSession)
        found = part if found is None else found.union(part)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = cut_lineage(connected_components(found, "class", "root"))
    reps = classes.select("class", "rep", "n")
    least = groups.join(reps.withColumnRenamed("class", "node"), "node") \
        .groupBy("component").agg(F.min("rep").alias("least"))
    joined = groups.join(least, "component").select(F.col("node").alias("class"), "least")
    facts = cut_lineage(
        reps.join(links, "class", "left").join(joined, "class", "left").where("n > 1 or links is not null")
        .select("class", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("least", "rep").alias("least")))
    component = F.coalesce("least", "vec_id")
    return shaped.select("vec_id", "class").join(facts, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
