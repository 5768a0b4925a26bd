"""Clustering features: Ward linkage and the Euclidean silhouette over all rows.

A clustering feature is the count, the coordinate sums and the square sum of a set of
weighted points. Features of disjoint sets add up, so they are built map-side in every
partition and merged by the shuffle. The sets are cells of a tree: the box around all points
is halved in every dimension, again and again, and a cell's address is the string of its
choices, so any row finds its cell by itself and the tree does not depend on how rows are
partitioned.

``cell_tree`` keeps the leaves that a common limit on their inertia leaves over, at most
``leaves`` of them. What works on leaves is exact where every leaf holds one distinct point;
else the inertia inside leaves, which is returned, is all that it cannot see.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import cut_lineage, send_package

LEAVES = 1024
SILHOUETTE_LEAVES = 256
DEPTH = 24
STEP = 2  # levels that a round opens
_BLOCK = 1 << 20  # distances that are held at a time


@dataclass
class CellTree:
    """Cells of a box, from the whole to the finest that were opened, and the chosen leaves."""

    columns: list[str]
    box: list[tuple[float, float]]
    cells: DataFrame  # path, n, points, sums, sse, above, opened
    limit: float
    leaves: DataFrame  # path, n, points, sums, sse
    lengths: list[int]

    def path(self) -> Column:
        """The finest address of a row."""
        return _path(self.columns, self.box)

    def at(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        """``rows`` with what ``table`` says of their leaf (keyed by ``path``), null outside all leaves.

        The leaves of a tree are bounded by its ``leaves``, so they are broadcast whatever
        the session's limit. A row looks up its address at each length that leaves have;
        one of them is there for all rows that the tree was built on.
        """
        out = rows.withColumn("_path", self.path())
        for n in self.lengths:
            part = table.where(F.length("path") == n).select(
                F.col("path").alias(f"_path{n}"), F.struct(*table.columns).alias(f"_leaf{n}"))
            out = out.join(F.broadcast(part), F.substring("_path", 1, n) == F.col(f"_path{n}"), "left")
        return out.withColumn("_leaf", F.coalesce(*[F.col(f"_leaf{n}") for n in self.lengths])) \
            .select(*rows.columns, "_leaf.*")


def _path(columns: Sequence[str], box: Sequence[tuple[float, float]]) -> Column:
    spots = []
    for name, (low, high) in zip(columns, box):
        share = (F.col(name) - low) / (high - low) if high > low else F.lit(0.0)
        inside = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
        spots.append(F.least(F.floor(inside * float(1 << DEPTH)), F.lit((1 << DEPTH) - 1)).cast("bigint"))
    digits = []
    for level in range(DEPTH):
        digit = F.lit(ord("0"))
        for d, spot in enumerate(spots):
            bit = F.shiftright(spot, DEPTH - 1 - level).bitwiseAND(F.lit(1)).cast("int")
            digit = digit + F.shiftleft(bit, d)
        digits.append(F.char(digit))
    return F.concat(*digits)


def _weight(points: DataFrame) -> Column:
    return F.col("w") if "w" in points.columns else F.lit(1).cast("bigint")


def _features(columns: Sequence[str]) -> list[Column]:
    norm = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    return [F.sum("w").alias("n"), F.count(F.lit(1)).alias("points"),
            *[F.sum(F.col("w") * F.col(c)).alias(f"sum_{c}") for c in columns],
            F.sum(F.col("w") * norm).alias("ss"),
            *[f(c).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "least"), (F.max, "most"))]]


def _merged(columns: Sequence[str]) -> list[Column]:
    """The feature of a union from those of its disjoint parts."""
    return [*[F.sum(c).alias(c) for c in ("n", "points", *[f"sum_{c}" for c in columns], "ss")],
            *[f(f"{name}_{c}").alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "least"), (F.max, "most"))]]


def inertia(columns: Sequence[str]) -> Column:
    """Inertia of a set from its feature; 0 for one point, free of rounding."""
    spread = sum((F.col(f"sum_{c}") * F.col(f"sum_{c}") for c in columns[1:]),
                 F.col(f"sum_{columns[0]}") * F.col(f"sum_{columns[0]}")) / F.col("n")
    single = F.lit(True)
    for c in columns:
        single = single & (F.col(f"least_{c}") == F.col(f"most_{c}"))
    return F.when(single, 0.0).otherwise(F.greatest(F.col("ss") - spread, F.lit(0.0)))


def _limit(cells: DataFrame, leaves: int, least: float = 0.0) -> float:
    """The smallest limit on a leaf's inertia, from ``least`` on, that leaves at most ``leaves`` leaves.

    A cell is a leaf for limits from its own inertia up to that of the cell above it. Cells that
    were not opened count as one leaf below their inertia too, which is too few at most. The
    cells number some times ``leaves`` for each level, so one task ranks them.
    """
    low = F.when(F.col("opened"), F.col("sse")).otherwise(0.0)
    steps = cells.select(F.inline(F.array(
        F.struct(low.alias("limit"), F.lit(1).alias("change")),
        F.struct(F.col("above").alias("limit"), F.lit(-1).alias("change")))))
    counted = steps.groupBy("limit").agg(F.sum("change").alias("change")) \
        .withColumn("count", F.sum("change").over(Window.orderBy("limit")))
    return counted.where((F.col("count") <= leaves) & (F.col("limit") >= least)).agg(F.min("limit")).first()[0]


def cell_tree(points: DataFrame, columns: Sequence[str], leaves: int = LEAVES) -> CellTree | None:
    """The tree of weighted points (``columns`` and ``w``; without ``w`` each row counts once).

    Runs one aggregate for every ``STEP`` levels, over the rows of cells that can still be divided;
    only bounds and one number for each round reach the driver. Points closer than the box
    over 2 ** ``DEPTH`` share a leaf. Rows with null coordinates are left out; None if no
    rows are left.
    """
    columns = list(columns)
    send_package(points.sparkSession)
    found = points.select(*columns, _weight(points).alias("w")).where(
        " and ".join(f"`{c}` is not null" for c in columns))
    low_high = found.agg(*[f(c) for c in columns for f in (F.min, F.max)]).first()
    if low_high[0] is None:
        return None
    box = [(float(low_high[2 * i]), float(low_high[2 * i + 1])) for i in range(len(columns))]
    rows = cut_lineage(found.withColumn("address", _path(columns, box)))
    root = rows.agg(*_features(columns)).select(
        F.lit("").alias("path"), "*", F.lit(float("inf")).alias("above"), F.lit(False).alias("opened"))
    cells = cut_lineage(root.withColumn("sse", inertia(columns)))
    limit = _limit(cells, leaves)
    for level in range(0, DEPTH, STEP):
        opened = cells.where((F.col("sse") > limit) & ~F.col("opened")).select(
            F.col("path").alias("cell"), F.col("sse").alias("above"))
        if opened.isEmpty():
            break
        cells = cut_lineage(_opened(rows, cells, opened, columns, level).where(F.col("above") > limit))
        limit = _limit(cells, leaves, limit)  # below the old one, cells are missing by now
    return _cut(columns, box, cells, limit)


def _opened(rows: DataFrame, cells: DataFrame, opened: DataFrame, columns: Sequence[str], level: int) -> DataFrame:
    """All cells, with those of the next ``STEP`` levels below the opened ones."""
    inside = rows.join(F.broadcast(opened), F.substring("address", 1, level) == F.col("cell"), "left_semi")
    layers = [inside.groupBy(F.substring("address", 1, level + STEP).alias("path")).agg(*_features(columns))]
    for n in range(level + STEP - 1, level, -1):
        layers.append(layers[-1].groupBy(F.substring("path", 1, n).alias("path")).agg(*_merged(columns)))
    known = cells.join(F.broadcast(opened.select(F.col("cell").alias("path"), F.lit(True).alias("_now"))), "path", "left") \
        .withColumn("opened", F.col("opened") | F.coalesce("_now", F.lit(False))).drop("_now")
    above = opened
    for n, layer in zip(range(level + 1, level + STEP + 1), reversed(layers)):
        layer = layer.join(F.broadcast(above), F.substring("path", 1, n - 1) == F.col("cell")).drop("cell") \
            .withColumn("sse", F.least(inertia(columns), "above")).withColumn("opened", F.lit(n < level + STEP))
        above = layer.select(F.col("path").alias("cell"), F.col("sse").alias("above"))
        known = known.unionByName(layer)
    return known


def _cut(columns, box, cells: DataFrame, limit: float) -> CellTree:
    low = F.when(F.col("opened"), F.col("sse")).otherwise(0.0)
    leaves = cut_lineage(cells.where((low <= limit) & (F.col("above") > limit)).drop("above", "opened", "ss"))
    lengths = sorted(r[0] for r in leaves.select(F.length("path")).distinct().collect())
    return CellTree(list(columns), box, cells, limit, leaves, lengths)


def coarser(tree: CellTree, leaves: int) -> CellTree:
    """The same tree with fewer leaves."""
    return _cut(tree.columns, tree.box, tree.cells, _limit(tree.cells, leaves, tree.limit))


# --- Ward linkage ---------------------------------------------------------------

def linkage(n: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Ward's merges of weighted points by chains of nearest neighbours, lowest first.

    Rows (left, right, height, size): points are numbered from 0, merges on from there. The
    height is the root of twice the growth of inertia, the distance for two single points.
    """
    m = len(n)
    n, centre = n.astype(float).copy(), centre.astype(float).copy()
    alive, name = np.ones(m, dtype=bool), np.arange(m)
    merges: list[tuple[int, int, float, float]] = []
    chain: list[int] = []
    while len(merges) < m - 1:
        if not chain:
            chain = [int(np.argmax(alive))]
        while True:
            a = chain[-1]
            gap = centre - centre[a]
            growth = n[a] * n / (n[a] + n) * np.einsum("ij,ij->i", gap, gap)
            growth[~alive] = np.inf
            growth[a] = np.inf
            b = int(np.argmin(growth))
            if len(chain) > 1 and growth[chain[-2]] <= growth[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        both = n[a] + n[b]
        merges.append((int(name[a]), int(name[b]), float(np.sqrt(2 * growth[b])), both))
        centre[b] = (n[a] * centre[a] + n[b] * centre[b]) / both
        n[b], alive[a], name[b] = both, False, m + len(merges) - 1
    return _in_order(merges, m)


def _in_order(merges: list[tuple[int, int, float, float]], m: int) -> np.ndarray:
    """Merges by height; chains find them in another order, so they are numbered anew."""
    out = np.zeros((len(merges), 4))
    order = sorted(range(len(merges)), key=lambda i: merges[i][2])
    new = {m + i: m + rank for rank, i in enumerate(order)}
    for rank, i in enumerate(order):
        a, b, height, size = merges[i]
        left, right = sorted((new.get(a, a), new.get(b, b)))
        out[rank] = left, right, height, size
    return out


def cut(merges: np.ndarray, m: int, k: int) -> np.ndarray:
    """Cluster of each point when ``k`` are left, numbered by their first points."""
    root = np.arange(2 * m - 1)
    for step in range(max(m - k, 0)):
        root[merges[step, :2].astype(int)] = m + step
    for node in range(2 * m - 2, -1, -1):
        root[node] = root[root[node]]
    _, first, label = np.unique(root[:m], return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[label]


def _in_one_task(columns: Sequence[str], ks: Sequence[int], merges_only: bool):
    """Linkage over all leaves; they are bounded by the tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found or not sum(b.num_rows for b in found):
            return
        table = pa.Table.from_batches(found).sort_by("path")
        n = table.column("n").to_numpy().astype(float)
        centre = np.stack([table.column(f"sum_{c}").to_numpy() / n for c in columns], axis=1)
        merges = linkage(n, centre)
        if merges_only:
            yield pa.RecordBatch.from_pydict({
                "step": np.arange(1, len(merges) + 1), "left": merges[:, 0].astype(np.int64),
                "right": merges[:, 1].astype(np.int64), "height": merges[:, 2], "n": merges[:, 3].astype(np.int64)})
        else:
            labels = np.stack([cut(merges, len(n), k) for k in ks], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [table.column("path").combine_chunks(), pa.array(labels.tolist(), pa.list_(pa.int32()))],
                ["path", "labels"])
    return run


def ward_merges(tree: CellTree) -> DataFrame:
    """The dendrogram over the leaves: (step, left, right, height, n), lowest first."""
    return tree.leaves.coalesce(1).mapInArrow(
        _in_one_task(tree.columns, (), True), "step bigint, left bigint, right bigint, height double, n bigint")


def ward_labels(tree: CellTree, ks: Sequence[int]) -> DataFrame:
    """For each leaf (``path``) the array ``labels`` of its cluster for every ``ks``."""
    return tree.leaves.coalesce(1).mapInArrow(_in_one_task(tree.columns, tuple(ks), False),
                                              "path string, labels array<int>")


def ward_heights(tree: CellTree, ks: Sequence[int]) -> DataFrame:
    """For each k: ``cut_height``, at which k clusters become fewer, and the inertia of all rows.

    ``leaf_inertia`` is the part that lies inside leaves: 0 where linkage is exact.
    """
    whole = tree.leaves.agg(F.sum("sse").alias("leaf_inertia"), F.count(F.lit(1)).alias("leaves"))
    steps = ward_merges(tree).withColumns({
        "k": F.lit(1) + F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) - F.col("step") + 1,
        "grown": F.sum(F.col("height") * F.col("height") / 2).over(
            Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1))})  # at most the bound on leaves
    facts = whole.select(F.struct("leaf_inertia", "leaves")).scalar()
    return steps.where(F.col("k").isin([int(k) for k in ks])).withColumn("_f", facts).select(
        F.col("k").cast("int").alias("k"), F.col("height").alias("cut_height"),
        (F.col("_f.leaf_inertia") + F.coalesce("grown", F.lit(0.0))).alias("inertia"),
        F.col("_f.leaf_inertia").alias("leaf_inertia"), F.col("_f.leaves").alias("leaves"))


@dataclass
class WardModel:
    """One cut of a tree's dendrogram."""

    tree: CellTree
    table: DataFrame  # path, labels
    index: int
    centres: list[list[float]]

    def clusterCenters(self) -> list[list[float]]:  # noqa: N802 - as the fitted models of pyspark.ml have it
        return self.centres


def fit_ward(points: DataFrame, columns: Sequence[str], ks: Sequence[int], leaves: int = LEAVES) -> dict[int, WardModel]:
    """Ward's clusters of all weighted points for every ``ks``, from one tree."""
    tree = cell_tree(points, columns, leaves)
    if tree is None:
        return {}
    table = cut_lineage(ward_labels(tree, ks))
    sums = tree.leaves.join(table, "path").select("*", F.posexplode("labels").alias("i", "cluster")) \
        .groupBy("i", "cluster").agg(F.sum("n").alias("n"), *[F.sum(f"sum_{c}").alias(c) for c in columns])
    centres: dict[int, list] = {}
    for row in sums.orderBy("i", "cluster").collect():  # one row for each cluster of each k
        centres.setdefault(row["i"], []).append([row[c] / row["n"] for c in columns])
    return {k: WardModel(tree, table, i, centres[i]) for i, k in enumerate(ks)}


# --- Euclidean silhouette ---------------------------------------------------------

def _judge(columns: Sequence[str], models: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
    """Sums of the scores' bounds of a block of points for every model."""
    def bounds(x, own, n, centre, sse, cluster, size):
        low = np.zeros((len(x), len(size)))
        high = np.zeros_like(low)
        width = max(1, _BLOCK // max(len(x), 1))
        for first in range(0, len(n), width):
            part = slice(first, first + width)
            square = np.zeros((len(x), len(n[part])))
            for d in range(x.shape[1]):
                square += (x[:, d, None] - centre[None, part, d]) ** 2
            member = np.zeros((len(n[part]), len(size)))
            member[np.arange(len(member)), cluster[part]] = n[part]
            low += np.sqrt(square) @ member
            high += np.sqrt(square + (sse / n)[None, part]) @ member
        rows = np.arange(len(x))
        others = np.tile(size > 0, (len(x), 1))
        others[rows, own] = False
        rest = np.maximum(size[own] - 1, 1)
        a = low[rows, own] / rest, high[rows, own] / rest
        b = [np.where(others, total / np.maximum(size, 1), np.inf).min(axis=1) for total in (low, high)]
        alone = (size[own] <= 1) | ~others.any(axis=1)

        def score(within, beyond):
            most = np.maximum(within, beyond)
            plain = ~alone & (most > 0)
            return np.where(plain, (np.where(plain, beyond, 0) - within) / np.where(plain, most, 1), 0.0)
        return score(a[1], b[0]), score(a[0], b[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), 3))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
            w = batch.column("w").to_numpy().astype(float)
            labels = np.array(batch.column("labels").to_pylist(), dtype=np.int64).reshape(len(w), len(models))
            for first in range(0, len(w), 4096):
                part = slice(first, first + 4096)
                for i, (n, centre, sse, cluster) in enumerate(models):
                    size = np.bincount(cluster, weights=n)
                    low, high = bounds(x[part], labels[part, i], n, centre, sse, cluster, size)
                    total[i] += (w[part] * low).sum(), (w[part] * high).sum(), w[part].sum()
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(models)), "low": total[:, 0], "high": total[:, 1],
                                          "w": total[:, 2]})
    return run


def euclidean_silhouettes(points: DataFrame, labels: Sequence[str], columns: Sequence[str], tree: CellTree) -> DataFrame:
    """Silhouette of all rows for each of the ``labels`` columns: (label, silhouette, silhouette_bound).

    The distances of a point x to the n rows of a cell with mean m and inertia s add up to at
    least n |x - m|, because the distance is convex, and to at most n sqrt(|x - m|^2 + s / n), the
    root of the mean square. Sums over the cells of a cluster bound a row's mean distances, and
    these its score. ``silhouette`` is the middle and no further from the true mean than
    ``silhouette_bound``: 0 where every leaf holds one distinct point. A row costs as many
    distances as there are leaves, divided by clusters, for each model; these moments, which
    the tree bounds, go to the tasks. Labels number clusters from 0, each with rows.
    """
    weighted = points.withColumn("w", _weight(points))
    placed = cut_lineage(tree.at(weighted.select(*columns, "w", *labels), tree.leaves.select("path")))
    long = placed.select(*columns, "w", "path", F.posexplode(F.array(*labels)).alias("i", "cluster"))
    moments = long.groupBy("i", "cluster", "path").agg(*_features(columns)).withColumn("sse", inertia(columns))
    table = moments.orderBy("i", "cluster", "path").toArrow()  # leaves times clusters at most, for each model
    which, n = table.column("i").to_numpy(), table.column("n").to_numpy().astype(float)
    centre = np.stack([table.column(f"sum_{c}").to_numpy() / n for c in columns], axis=1)
    models = [(n[which == i], centre[which == i], table.column("sse").to_numpy()[which == i],
               table.column("cluster").to_numpy()[which == i]) for i in range(len(labels))]
    judged = placed.select(*columns, "w", F.array(*labels).alias("labels")).mapInArrow(
        _judge(list(columns), models), "i bigint, low double, high double, w double")
    low, high = F.sum("low") / F.sum("w"), F.sum("high") / F.sum("w")
    names = F.array(*[F.lit(x) for x in labels])
    return judged.groupBy("i").agg(low.alias("low"), high.alias("high")).select(
        F.get(names, F.col("i").cast("int")).alias("label"), ((F.col("low") + F.col("high")) / 2).alias("silhouette"),
        ((F.col("high") - F.col("low")) / 2).alias("silhouette_bound"))
