"""Clustering features, Ward linkage and the bounded silhouette against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import cells

COLUMNS = ["x", "y", "z"]


def brute_ward(n, centre):
    """Heights of Ward's merges by looking at all pairs each time, and the members of each merge."""
    parts = [(float(w), np.array(c, dtype=float), {i}) for i, (w, c) in enumerate(zip(n, centre))]
    out = []
    while len(parts) > 1:
        best = min(((a[0] * b[0] / (a[0] + b[0]) * ((a[1] - b[1]) ** 2).sum(), i, j)
                    for i, a in enumerate(parts) for j, b in enumerate(parts[:i])))
        grown, i, j = best
        a, b = parts[i], parts[j]
        merged = (a[0] + b[0], (a[0] * a[1] + b[0] * b[1]) / (a[0] + b[0]), a[2] | b[2])
        parts = [p for k, p in enumerate(parts) if k not in (i, j)] + [merged]
        out.append((np.sqrt(2 * grown), [p[2] for p in parts]))
    return out


def brute_silhouette(x, w, label):
    x, label = np.repeat(x, w, axis=0), np.repeat(label, w)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i, own in enumerate(label):
        same = label == own
        if same.sum() == 1 or len(set(label)) == 1:
            scores.append(0.0)
            continue
        a, b = d[i, same].sum() / (same.sum() - 1), min(d[i, label == c].mean() for c in set(label) if c != own)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(scores)


def cloud(seed, n=60):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.4, size=(n // 3, 3)) for c in ((0, 0, 0), (3, 1, 0), (0, 4, -2))])
    return x, rng.integers(1, 5, size=len(x))


def frame(spark, x, w, **more):
    rows = [(*map(float, p), int(k), *(int(v[i]) for v in more.values())) for i, (p, k) in enumerate(zip(x, w))]
    return spark.createDataFrame(rows, "x double, y double, z double, w long" + "".join(f", {c} int" for c in more))


@pytest.mark.parametrize("seed", range(2))
def test_linkage_equals_all_pairs(seed):
    x, n = cloud(seed)
    merges, want = cells.linkage(n, x), brute_ward(n, x)
    assert merges[:, 2] == pytest.approx([h for h, _ in want], rel=1e-9)
    for k in (2, 3, 5, 9):
        label = cells.cut(merges, len(x), k)
        found = {frozenset(np.flatnonzero(label == c).tolist()) for c in range(k)}
        assert found == {frozenset(p) for p in want[len(x) - k - 1][1]}
        assert [int(np.flatnonzero(label == c)[0]) for c in range(k)] == sorted(
            int(np.flatnonzero(label == c)[0]) for c in range(k))


def test_heights_are_exact_with_a_leaf_for_each_point(spark):
    x, n = cloud(7)
    tree = cells.cell_tree(frame(spark, x, n), COLUMNS, leaves=len(x))
    assert tree.leaves.count() == len(x) and tree.leaves.agg(F.sum("sse")).first()[0] == 0
    want = brute_ward(n, x)
    rows = {r.k: r for r in cells.ward_heights(tree, range(2, 9)).collect()}
    whole = np.repeat(x, n, axis=0)
    for k in range(2, 9):
        assert rows[k].cut_height == pytest.approx(want[len(x) - k][0], rel=1e-9)
        parts = want[len(x) - k - 1][1]
        inertia = sum((n[list(p), None] * (x[list(p)] - np.average(x[list(p)], axis=0, weights=n[list(p)])) ** 2).sum()
                      for p in parts)
        assert rows[k].inertia == pytest.approx(inertia, rel=1e-9)
        assert rows[k].leaf_inertia == 0
    assert len(whole) == tree.leaves.agg(F.sum("n")).first()[0]


@pytest.mark.parametrize("leaves", [1, 5, 40])
def test_few_leaves_keep_their_bound_and_the_inertia(spark, leaves):
    x, n = cloud(8)
    points = frame(spark, x, n)
    tree = cells.cell_tree(points, COLUMNS, leaves)
    found = tree.leaves.toPandas()
    assert 1 <= len(found) <= leaves and found.n.sum() == n.sum() and found.points.sum() == len(x)
    placed = tree.at(points, tree.leaves.select("path")).toPandas()
    assert len(placed) == len(x) and placed.path.notna().all()
    inside = sum((g.w.to_numpy()[:, None] * (g[COLUMNS].to_numpy() - np.average(
        g[COLUMNS], axis=0, weights=g.w)) ** 2).sum() for _, g in placed.groupby("path"))
    assert found.sse.sum() == pytest.approx(inside, abs=1e-9)
    for r in cells.ward_heights(tree, range(1, 6)).collect():
        assert r.inertia >= r.leaf_inertia == pytest.approx(inside, abs=1e-9)


def test_the_tree_does_not_depend_on_partitions(spark):
    x, n = cloud(9)
    points = frame(spark, x, n)
    both = [cells.cell_tree(p, COLUMNS, 20).leaves.select("path", "n").orderBy("path").collect()
            for p in (points.coalesce(1), points.repartition(7))]
    assert both[0] == both[1]


def test_ward_models_label_their_rows_and_others(spark):
    x, n = cloud(10)
    points = frame(spark, x, n)
    models = cells.fit_ward(points, COLUMNS, [2, 3], leaves=30)
    m = models[3]
    got = m.tree.at(points, m.table).toPandas()
    label = got.labels.map(lambda v: v[m.index]).to_numpy()
    assert sorted(np.bincount(label)) == [20, 20, 20]
    for c in range(3):
        part = got[label == c]
        assert np.average(part[COLUMNS], axis=0, weights=part.w) == pytest.approx(m.clusterCenters()[c])
    outside = spark.createDataFrame([(99.0, 99.0, 99.0, 1)], "x double, y double, z double, w long")
    assert m.tree.at(outside, m.table).count() == 1


@pytest.mark.parametrize("leaves,exact", [(200, True), (6, False)])
def test_silhouette_lies_within_its_bound(spark, leaves, exact):
    x, n = cloud(11)
    good = np.repeat([0, 1, 2], 20)
    bad = np.arange(60) % 2
    lone = np.where(np.arange(60) == 0, 1, 0)
    points = frame(spark, x, np.where(np.arange(60) == 0, 1, n), good=good, bad=bad, lone=lone, one=np.zeros(60))
    tree = cells.cell_tree(points, COLUMNS, leaves)
    names = {"good": good, "bad": bad, "lone": lone, "one": np.zeros(60, dtype=int)}
    for r in cells.euclidean_silhouettes(points, list(names), COLUMNS, tree).collect():
        true = brute_silhouette(x, np.where(np.arange(60) == 0, 1, n), names[r.label])
        assert abs(r.silhouette - true) <= r.silhouette_bound + 1e-9
        assert r.silhouette_bound == pytest.approx(0, abs=1e-12) if exact else r.silhouette_bound >= 0


def test_more_leaves_tighten_the_bound(spark):
    x, n = cloud(12)
    points = frame(spark, x, n, good=np.repeat([0, 1, 2], 20))
    tree = cells.cell_tree(points, COLUMNS, 60)
    bounds = [cells.euclidean_silhouettes(points, ["good"], COLUMNS, cells.coarser(tree, m)).first().silhouette_bound
              for m in (3, 12, 60)]
    assert bounds[0] > bounds[1] > bounds[2] == 0


def test_no_rows_one_point_and_equal_points(spark):
    empty = spark.createDataFrame([], "x double, y double, z double")
    assert cells.cell_tree(empty, COLUMNS) is None and cells.fit_ward(empty, COLUMNS, [2]) == {}
    same = spark.createDataFrame([(0.1, 0.2, 0.3)] * 9 + [(None, 0.0, 0.0)], "x double, y double, z double")
    tree = cells.cell_tree(same, COLUMNS)
    assert [(r.n, r.sse) for r in tree.leaves.collect()] == [(9, 0.0)]
    assert cells.ward_heights(tree, [2]).count() == 0
    models = cells.fit_ward(same.dropna(), COLUMNS, [3])
    assert np.array(models[3].centres) == pytest.approx(np.array([[0.1, 0.2, 0.3]]))


def test_many_points_all_have_a_leaf(spark):
    rng = np.random.default_rng(13)
    x = np.round(rng.normal(size=(1500, 3)), 2)
    points = frame(spark, x, rng.integers(1, 4, size=1500))
    tree = cells.cell_tree(points, COLUMNS, 40)
    found = tree.leaves.toPandas()
    assert 20 <= len(found) <= 40 and found.points.sum() == 1500
    assert found.n.sum() == points.agg(F.sum("w")).first()[0]
    assert tree.at(points, tree.leaves.select("path")).where("path is null").count() == 0
