"""k-means of many models in shared passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import kmeans, segments

KS, N_INIT = (2, 3, 4, 6), 4


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(5)
    middles = np.array([[0, 0, 0, 0], [9, 0, 0, 1], [0, 9, 2, 0], [9, 9, 0, 3]], dtype=float)
    x = (middles[rng.integers(4, size=400)] + rng.normal(0, 0.4, (400, 4))).round(3)
    return x, rng.integers(1, 5, size=400)


@pytest.fixture(scope="module")
def points(spark, arrays):
    x, w = arrays
    return spark.createDataFrame([(*map(float, r), int(n)) for r, n in zip(x, w)],
                                 ", ".join(f"{c} double" for c in segments.Z) + ", w bigint").localCheckpoint()


def test_models_share_their_passes(spark, points, arrays):
    x, w = arrays
    context = spark.sparkContext
    context.setJobGroup("shared-passes", "k-means of all models")
    try:
        models = kmeans.fit(points, segments.Z, KS, N_INIT, seed=1)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("shared-passes")
    assert 0 < len(jobs) < 10 * len(KS) * N_INIT  # a fit of its own takes over ten jobs for each model
    costs = []
    for k, model in models.items():
        centres = np.array(model.clusterCenters())
        square = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        label = square.argmin(axis=1)
        assert len(centres) == k and len(set(label)) == k
        assert model.cost == pytest.approx((w * square.min(axis=1)).sum())
        for c in range(k):
            assert np.average(x[label == c], axis=0, weights=w[label == c]) == pytest.approx(centres[c], abs=1e-3)
        costs.append(model.cost)
    assert costs == sorted(costs, reverse=True) and costs[2] < 0.1 * costs[1]  # four groups are found


def test_partitions_do_not_matter(points):
    one, many = (kmeans.fit(points.repartition(n), segments.Z, [3, 5], 2, seed=7) for n in (1, 9))
    for k in one:
        assert np.array(one[k].centres) == pytest.approx(np.array(many[k].centres), abs=1e-9)


def test_fewer_points_than_clusters_and_none(points):
    few = points.select("w").distinct().withColumns({c: F.col("w").cast("double") for c in segments.Z})  # four points
    found = kmeans.fit(few, segments.Z, [6], 1, seed=3)[6]
    assert sorted(c[0] for c in found.centres) == [1.0, 2.0, 3.0, 4.0] and found.cost == 0
    with pytest.raises(ValueError, match="no points"):
        kmeans.fit(points.where("w < 0"), segments.Z, [2], 1, seed=3)
