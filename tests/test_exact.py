import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.functions.exact import ordered_bits, quantiles, quantiles_wide, sum_days


def test_quantiles_equal_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([np.full(400, 5.25), rng.lognormal(3, 2, 700), -rng.random(100), [0.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.8, 0.95, 1.0]
    got = {r.prob: r.quantile for r in quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_per_group_with_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 10.0), (None, 4.0), (None, 8.0), ("b", None)], "k string, v double")
    got = {r.k: r.m for r in quantiles_wide(df, "v", {"m": 0.5}, ["k"]).collect()}
    assert got == {"a": 2.0, None: 6.0}


def test_sum_of_days_is_exact_beyond_bigint_micros(spark):
    df = spark.range(200_000).select(F.lit(86_400_000_000 * 3650 + 1).cast("bigint").alias("us"))
    total = df.agg(sum_days(F.col("us")).alias("d")).first().d
    assert total == (200_000 * 3650 * 86400 + 0.2) / 86400


def test_ordered_bits_are_those_of_the_doubles(spark):
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 0x7FF0 << 48, size=4000, dtype=np.int64)
    edges = [2.0 ** e for e in range(-1074, 1024)] + [np.nextafter(2.0 ** e, s) for e in range(-1021, 1024) for s in (0, np.inf)]
    some = np.concatenate([raw.view(np.float64), edges, [0.0, 5e-324, 1.7976931348623157e308, np.inf, 1 / 3, 1e9 + 0.1]])
    some = np.concatenate([some, -some])
    got = spark.createDataFrame([(i, float(v)) for i, v in enumerate(some)] + [(-1, float("nan")), (-2, None)],
                                "i long, v double").select("i", ordered_bits(F.col("v")).alias("b")).collect()
    found = {r.i: r.b for r in got}
    want = np.where(some < 0, -np.abs(some).view(np.int64), np.abs(some).view(np.int64))
    assert [found[i] for i in range(len(some))] == want.tolist()
    assert found[-1] is None and found[-2] is None


def test_quantiles_of_values_that_crowd(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([1.75e9 + rng.random(3000) * 1e-3, [np.nextafter(1.0, 2)] * 7 + [1.0] * 5, [-1e300, 1e300]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [0.0, 0.003, 0.3, 0.5, 0.77, 1.0]
    got = {r.prob: r.quantile for r in quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-15)


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    rows = [("a", 1.0), ("a", inf), ("a", 3.0), ("b", -inf), ("b", inf), ("c", inf), ("c", inf), ("d", float("nan")),
            ("d", 4.0), ("e", None), ("f", -inf), ("f", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q, r.m, r.top) for r in quantiles_wide(df, "v", {"q": 0.25, "m": 0.5, "top": 1.0}, ["k"]).collect()}
    assert got == {"a": (2.0, 3.0, inf), "b": (None, None, inf), "c": (inf, inf, inf), "d": (4.0, 4.0, 4.0),
                   "f": (-inf, -inf, 2.0)}
