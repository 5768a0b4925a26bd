"""k-means for many numbers of clusters and restarts, all in shared passes over the points.

A model needs its centres only, so a pass carries the centres of every model that still moves
and returns weights and coordinate sums by centre, merged by the shuffle. The number of jobs is
that of the slowest model's steps, not the sum over models. Only centres and candidates for
them, whose number does not depend on the rows, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import send_package

TOLERANCE = 1e-4  # a model has settled when no centre moves further
INIT_ROUNDS = 2  # of oversampling, each with twice as many candidates as clusters
LOCAL_STEPS = 30
_BLOCK = 1 << 21  # distances that are held at a time


@dataclass
class KMeansModel:
    """Centres, and the sum of squared distances to the nearest one over all rows."""

    centres: list[list[float]]
    cost: float = float("nan")

    def clusterCenters(self) -> list[list[float]]:  # noqa: N802 - as the fitted models of pyspark.ml have it
        return self.centres


# --- one block of points ----------------------------------------------------------

def _labels(x: np.ndarray, models: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """For each model the number of the nearest centre of every row."""
    stacked = np.concatenate(models)
    score = (stacked * stacked).sum(axis=1)[:, None] - 2 * (stacked @ x.T)
    ends = np.cumsum([len(m) for m in models])
    for m, end in zip(models, ends):
        yield score[end - len(m):end].argmin(axis=0)


def _square(x: np.ndarray, centres: np.ndarray, label: np.ndarray) -> np.ndarray:
    gap = x - centres[label]
    return (gap * gap).sum(axis=1)


def _sums(x: np.ndarray, w: np.ndarray, models: Sequence[np.ndarray]) -> np.ndarray:
    """Weight, coordinate sums and inertia by centre, the centres of all models one after another."""
    found, weighted = [], (x * w[:, None]).T
    for centres, label in zip(models, _labels(x, models)):
        total = lambda v: np.bincount(label, weights=v, minlength=len(centres))  # noqa: B023, E731
        found.append(np.stack([total(w), *map(total, weighted), total(w * _square(x, centres, label))], axis=1))
    return np.concatenate(found)


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1] that a row's hash and the salt fix, however rows are partitioned."""
    z = h.view(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0 ** -54


def _blocks(batches: Iterator[pa.RecordBatch], columns: Sequence[str], width: int):
    step = max(256, _BLOCK // max(width, 1))
    for batch in batches:
        x = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
        w, h = batch.column("w").to_numpy().astype(float), batch.column("h").to_numpy()
        for first in range(0, len(w), step):
            part = slice(first, first + step)
            yield x[part], w[part], h[part]


# --- passes over all points -------------------------------------------------------

def _pass(points: DataFrame, columns: Sequence[str], models: Sequence[np.ndarray]) -> list[np.ndarray]:
    """``_sums`` over all points, split by model."""
    width = sum(len(m) for m in models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((width, len(columns) + 2))
        for x, w, _ in _blocks(batches, columns, width):
            found += _sums(x, w, models)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), *[pa.array(v) for v in found.T]], ["centre", *names])

    names = ["n", *[f"s{d}" for d in range(len(columns))], "cost"]
    rows = points.mapInArrow(run, "centre bigint, " + ", ".join(f"{c} double" for c in names)) \
        .groupBy("centre").agg(*[F.sum(c).alias(c) for c in names]).toArrow().sort_by("centre")
    whole = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
    return np.split(whole, np.cumsum([len(m) for m in models])[:-1])


def _drawn(points: DataFrame, columns: Sequence[str], models: Sequence[np.ndarray], wanted: Sequence[int],
           salts: Sequence[int]) -> list[np.ndarray]:
    """For each model that many points, drawn without replacement by weight times squared distance to its centres.

    Points with the smallest exponential times are such a draw, so tasks keep their smallest and
    one pass is enough. A model without centres draws by weight.
    """
    width = sum(len(m) for m in models)
    placed = [i for i, m in enumerate(models) if len(m)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0), np.zeros((0, len(columns)))) for _ in models]
        for x, w, h in _blocks(batches, columns, width):
            label = dict(zip(placed, _labels(x, [models[i] for i in placed]))) if placed else {}
            for i, (time, at) in enumerate(kept):
                share = w * _square(x, models[i], label[i]) if i in label else w
                some = share > 0
                time = np.concatenate([time, -np.log(_uniform(h[some], salts[i])) / share[some]])
                at = np.concatenate([at, x[some]])
                least = np.argsort(time, kind="stable")[:wanted[i]]
                kept[i] = time[least], at[least]
        for i, (time, at) in enumerate(kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(time), v)) for v in (i, wanted[i])] + [pa.array(v) for v in (time, *at.T)],
                ["model", "wanted", "time", *names])

    names = [f"s{d}" for d in range(len(columns))]
    order = Window.partitionBy("model").orderBy("time", *names)
    rows = points.mapInArrow(run, "model bigint, wanted bigint, " + ", ".join(f"{c} double" for c in ("time", *names))) \
        .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= F.col("wanted")) \
        .orderBy("model", "_n").toArrow()
    which = rows.column("model").to_numpy()
    at = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
    return [at[which == i] for i in range(len(models))]


# --- fitting ----------------------------------------------------------------------

def _moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The means of the rows of each centre; one without rows stays."""
    n = sums[:, :1]
    return np.where(n > 0, sums[:, 1:-1] / np.where(n > 0, n, 1), centres)


def _settled(before: np.ndarray, after: np.ndarray) -> bool:
    return not (((after - before) ** 2).sum(axis=1) > TOLERANCE ** 2).any()


def _chosen(candidates: np.ndarray, w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the weighted candidates by k-means++, moved by a few steps over the candidates."""
    if len(candidates) <= k:
        return candidates
    rng = np.random.default_rng(seed)
    centres = candidates[rng.choice(len(w), p=w / w.sum())][None]
    for _ in range(k - 1):
        square = ((candidates[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        share = w * square if (w * square).sum() > 0 else square
        centres = np.vstack([centres, candidates[rng.choice(len(w), p=share / share.sum())]])
    for _ in range(LOCAL_STEPS):
        before, centres = centres, _moved(centres, _sums(candidates, w, [centres]))
        if _settled(before, centres):
            break
    return centres


def _starts(points: DataFrame, columns: Sequence[str], ks: Sequence[int], seeds: Sequence[int]) -> list[np.ndarray]:
    """Centres to start from: oversampled candidates (k-means||), weighed by their rows and thinned out."""
    found = [np.zeros((0, len(columns)))] * len(ks)
    for part in range(INIT_ROUNDS + 1):
        drawn = _drawn(points, columns, found, [2 * k if part else 1 for k in ks],
                       [(seed * 1_000 + k) * 10 + part for k, seed in zip(ks, seeds)])
        found = [np.unique(np.concatenate(pair), axis=0) for pair in zip(found, drawn)]
    if not all(len(m) for m in found):
        raise ValueError("there are no points to fit centres to")
    weights = _pass(points, columns, found)
    return [_chosen(m, sums[:, 0], k, seed) for m, sums, k, seed in zip(found, weights, ks, seeds)]


def fit(points: DataFrame, columns: Sequence[str], ks: Sequence[int], n_init: int, seed: int,
        max_iter: int = 300) -> dict[int, KMeansModel]:
    """For every k the best of ``n_init`` restarts by inertia, over points weighted by ``w``.

    The points are read once for each step of the slowest model, so they should be stored; equal
    points should be merged, as a draw of candidates takes them together.
    """
    columns = list(columns)
    send_package(points.sparkSession)
    runs = [(k, seed + i) for k in ks for i in range(n_init)]
    rows = points.select(*[F.col(c).cast("double").alias(c) for c in columns], "w", F.xxhash64(*columns).alias("h"))
    centres = _starts(rows, columns, [k for k, _ in runs], [s for _, s in runs])
    moving = list(range(len(runs)))
    for _ in range(max_iter):
        sums = _pass(rows, columns, [centres[i] for i in moving])
        after = [_moved(centres[i], s) for i, s in zip(moving, sums)]
        still = [i for i, c in zip(moving, after) if not _settled(centres[i], c)]
        for i, c in zip(moving, after):
            centres[i] = c
        moving = still
        if not moving:
            break
    best: dict[int, KMeansModel] = {}
    for (k, _), c, sums in zip(runs, centres, _pass(rows, columns, centres)):
        model = KMeansModel(c.tolist(), float(sums[:, -1].sum()))
        if k not in best or model.cost < best[k].cost:
            best[k] = model
    return best
