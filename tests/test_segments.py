from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import features, segments
from quayside.params import SAMPLE_TARIFF
from tests.conftest import ts

START = ts("2025-01-01 00:00:00")
CENTRES = [(-1.0, 0.0, 0.0, 0.0), (1.0, 0.0, 0.0, 0.0), (0.0, 1.0, 0.5, -1.0)]


@pytest.fixture(scope="module")
def feats(make_visits):
    rng = np.random.default_rng(3)
    rows = [{
        "container_id": f"C{i % 70}", "size_ft": [20, 40][i % 2], "weight_tons": float(5 + i % 20),
        "gate_in_time": START,
        "gate_out_time": START + timedelta(hours=int(rng.choice([20, 60, 100, 900])) + i % 7),
    } for i in range(200)]
    return features.visit_features(make_visits(rows), tariff=SAMPLE_TARIFF)


@pytest.fixture(scope="module")
def labelled(feats):
    return segments.nearest_centroid(segments.scaled_features(feats), CENTRES)


@pytest.fixture(scope="module")
def arrays(labelled):
    pdf = labelled.select(*segments.Z, "cluster").toPandas()
    return pdf[segments.Z].to_numpy(), pdf["cluster"].to_numpy()


def silhouette(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    scores = []
    for i, own in enumerate(labels):
        same = (labels == own)
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != own)
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_scaling_is_population_z_score(arrays):
    x, _ = arrays
    assert x.mean(axis=0) == pytest.approx(np.zeros(4), abs=1e-9)
    assert x.std(axis=0) == pytest.approx(np.ones(4))


def test_constant_feature_stays_zero(feats):
    flat = segments.scaled_features(feats.withColumn("weight_tons", F.lit(7.0)))
    assert {r.z_weight_tons for r in flat.collect()} == {0.0}


def test_metrics_equal_brute_force(labelled, arrays):
    x, labels = arrays
    stats = segments.cluster_stats(labelled)
    row = segments.dispersion_metrics(stats).first()
    means = {c: x[labels == c].mean(axis=0) for c in set(labels)}
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in means.items())
    between = sum((labels == c).sum() * ((m - x.mean(axis=0)) ** 2).sum() for c, m in means.items())
    k, n = len(means), len(x)
    assert row.inertia == pytest.approx(within)
    assert row.calinski_harabasz == pytest.approx(between * (n - k) / (within * (k - 1)))
    s = {c: np.sqrt(((x[labels == c] - m) ** 2).sum(-1)).mean() for c, m in means.items()}
    db = np.mean([max((s[a] + s[b]) / np.linalg.norm(means[a] - means[b]) for b in means if b != a) for a in means])
    assert segments.davies_bouldin(labelled, stats).first().davies_bouldin == pytest.approx(db)
    assert segments.silhouette_squared(labelled, stats).first().silhouette_squared == pytest.approx(
        silhouette(x, labels, 2))
    gaps = np.sqrt(((x[:, None] - np.array(CENTRES)[None]) ** 2).sum(-1))
    own = gaps[np.arange(n), labels]
    gaps[np.arange(n), labels] = np.inf
    other = gaps.min(axis=1)
    assert segments.silhouette_simplified(labelled, CENTRES).first().silhouette == pytest.approx(
        np.mean((other - own) / np.maximum(own, other)))


def test_weighted_points_keep_the_total(feats):
    points = segments.weighted_points(segments.scaled_features(feats))
    assert points.agg(F.sum("w")).first()[0] == 200 and points.count() < 200


def model(algorithm, k, silhouette, low, high):
    return (algorithm, k, float(silhouette), float(low), float(high), 0.5, 0.3)


@pytest.mark.parametrize("models, want", [
    ([model("KMeans", 9, .9, 5, 40), model("KMeans", 3, .4, 5, 40), model("KMeans", 2, .5, 2, 60)], ("KMeans", 3, 1)),
    ([model("KMeans", 6, .9, 1, 40), model("Hierarchical", 3, .3, 2.5, 60), model("KMeans", 4, .5, 1, 70)], ("Hierarchical", 3, 2)),
    ([model("KMeans", 6, .9, 1, 80), model("KMeans", 4, .3, 1, 80), model("Hierarchical", 4, .5, 1, 80)], ("Hierarchical", 4, 3)),
    ([model("KMeans", 6, .2, 1, 80), model("KMeans", 7, .3, 1, 80)], ("KMeans", 7, 4)),
    ([model("Hierarchical", 3, .4, 5, 40), model("KMeans", 3, .4, 5, 40)], ("KMeans", 3, 1)),
])
def test_selection_rules(spark, models, want):
    df = spark.createDataFrame(models, "algorithm string, k int, silhouette double, min_pct double, "
                                       "max_pct double, min_dwell_gap double, max_revenue_share double")
    row = segments.select_best(df).first()
    assert (row.algorithm, row.k, row.rule) == want


def test_near_ties_prefer_fewer_segments(spark):
    df = spark.createDataFrame(
        [model("KMeans", 7, .42, 6, 30), model("KMeans", 4, .41, 6, 30), model("KMeans", 3, .3, 6, 30)],
        "algorithm string, k int, silhouette double, min_pct double, max_pct double, "
        "min_dwell_gap double, max_revenue_share double")
    assert segments.select_best(df, 5, 40, tie_margin=0.02).first().k == 4
    assert segments.select_best(df).first().k == 7


def test_labels_tell_segments_apart(spark):
    rows = [(0, 0.5, 1.0), (1, 2.0, 1.0), (2, 2.5, 2.0), (3, 4.0, 1.0), (4, 5.0, 2.0), (5, 6.0, 2.0), (6, 50.0, 2.0)]
    profile = spark.createDataFrame(rows, "cluster int, mean_dwell_days double, mean_teu double")
    got = {r.cluster: r.label for r in segments.segment_labels(profile).collect()}
    assert got == {
        0: "Fast Movers", 1: "Efficient Operators (20ft)", 2: "Efficient Operators (40ft)",
        3: "Standard Dwellers (20ft)", 4: "Standard Dwellers (40ft, mid-range)",
        5: "Standard Dwellers (40ft, longest dwell)", 6: "Chronic Blockers"}


def test_container_join_equals_a_real_join(feats, labelled):
    direct = feats.select("container_id", "storage_cost_usd").join(
        labelled.select("container_id", "cluster"), "container_id").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("storage_cost_usd").alias("revenue"))
    want = {r.cluster: (r.visits, pytest.approx(r.revenue)) for r in direct.collect()}
    got = {r.cluster: (r.visits, r.revenue)
           for r in segments.revenue_by_container_segment(feats, labelled).collect()}
    assert got == want


def test_profiles_count_and_share(labelled):
    rows = segments.segment_profiles(labelled).collect()
    assert sum(r["count"] for r in rows) == 200
    assert sum(r.teu_share_pct for r in rows) == pytest.approx(100)


def test_sweep_measures_every_model(feats):
    done = segments.sweep(feats, ks=(2, 3), n_init=2)
    rows = done.metrics.collect()
    assert {(r.algorithm, r.k) for r in rows} == {(a, k) for a in ("KMeans", "Hierarchical") for k in (2, 3)}
    inertia = {(r.algorithm, r.k): r.inertia for r in rows}
    assert inertia["KMeans", 3] < inertia["KMeans", 2]
    facts = segments.fit_facts(done).collect()
    assert [r for r in facts if r.algorithm == "KMeans" and not (
        r.nearest and r.falls and r.rows == 200 and r.segments == r.k)] == []
    best = segments.select_best(done.metrics).first()
    assert done.label(best.algorithm, best.k).select("cluster").distinct().count() == best.k


def test_strict_sizes_choose_another_model(spark):
    df = spark.createDataFrame(
        [model("KMeans", 3, .5, 4, 50), model("KMeans", 4, .4, 6, 39)],
        "algorithm string, k int, silhouette double, min_pct double, max_pct double, "
        "min_dwell_gap double, max_revenue_share double")
    assert segments.select_best(df).first().k == 3
    row = segments.select_best(df, strict=True).first()
    assert (row.k, row.rule) == (4, 1)
