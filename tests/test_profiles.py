"""Merged states equal profiles of the rows, and stored days can be replaced."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import profiles, quality
from tests.conftest import ts

AS_OF = "2025-01-15"


@pytest.fixture(scope="module")
def dated(make_visits):
    rng, rows = random.Random(3), []
    for i in range(600):
        entry = ts("2025-01-01 00:00:00") + timedelta(hours=rng.randrange(480))
        rows.append({
            "gate_in_time": rng.choice([entry] * 9 + [None]), "gate_out_time": rng.choice([None, entry - timedelta(hours=4)]),
            "weight_tons": rng.choice([None, float("nan"), 41.0, -1.0, rng.gauss(20, 5), rng.expovariate(0.1)]),
            "yard_bay": None, "yard_row": rng.choice([7, 7, None]), "container_type": rng.choice(["dry", "odd", None]),
            "shipping_line": f"L{int(rng.paretovariate(0.4)) % 300}"})
    return make_visits(rows).withColumn("day", F.to_date("gate_in_time")).persist()


def assert_same_profile(got, rows):
    want = {r["column"]: r for r in quality.numeric_profile(rows, places=9).collect()}
    assert set(got) == set(want)
    for column, r in got.items():
        w = want[column]
        assert r["count"] == w["count"] and r["rows"] == rows.count() and r["rows"] - r["nulls"] == r["count"]
        for field in ("min", "max", "mean", "std", "skewness"):
            near = w[field] if w[field] is None else pytest.approx(w[field], abs=1e-6)
            assert r[field] == near, (column, field)


def test_days_merge_to_the_whole(dated):
    daily = profiles.numeric_states(dated, ["day"])
    weeks = profiles.merge_numeric(daily.withColumn("week", F.weekofyear("day")), ["week"])
    for states in (daily, weeks):
        merged = profiles.numeric_profile(profiles.merge_numeric(states)).collect()
        assert_same_profile({r["column"]: r for r in merged}, dated)
    weights = sorted(r[0] for r in dated.where("weight_tons = weight_tons and not isnan(weight_tons)").select("weight_tons").collect())
    median = next(r["median"] for r in merged if r["column"] == "weight_tons")
    assert abs(sum(w < median for w in weights) / len(weights) - 0.5) <= 2 * profiles.RANK_ERROR + 1 / len(weights)


@pytest.mark.parametrize("ends", [(float("inf"),), (float("-inf"),), (float("inf"), float("-inf"))])
def test_infinite_weights(dated, make_visits, ends):
    more = make_visits([{"weight_tons": w} for w in ends]).withColumn("day", F.to_date("gate_in_time"))
    rows = dated.unionByName(more)
    merged = profiles.numeric_profile(profiles.merge_numeric(profiles.numeric_states(rows, ["day"]))).collect()
    assert_same_profile({r["column"]: r for r in merged}, rows)


def test_text_states(dated):
    merged = profiles.merge_text(profiles.text_states(dated, ["day"]))
    want = {r["column"]: r for r in quality.categorical_profile(dated).collect()}
    for r in profiles.text_profile(merged).collect():
        w = want.get(r["column"])
        assert r["count"] == (w["count"] if w else 0)
        assert abs(r["unique"] - (w["unique"] if w else 0)) <= 4 * profiles.DISTINCT_ERROR * r["unique"]
    key = lambda df: sorted(tuple(r) for r in df.select("column", "rank", "value", "rows").collect())
    assert key(profiles.top_values(merged)) == key(quality.top_values(dated))


def test_checks_from_counters(dated):
    plain = dated.drop("day")
    states = profiles.check_states(plain.withColumn("day", F.to_date("gate_in_time")).select(
        plain.columns + ["day"]), ["day"], AS_OF)
    key = lambda df: sorted(map(str, df.collect()))
    want = key(quality.row_checks(dated, AS_OF))
    assert key(profiles.row_checks(states, dated, AS_OF)) == want
    none = dated.limit(0)
    assert key(profiles.row_checks(profiles.check_states(none, ["day"], AS_OF), none, AS_OF)) == key(quality.row_checks(none, AS_OF))


def test_no_rows(dated):
    assert profiles.merge_numeric(profiles.numeric_states(dated.limit(0), ["day"])).isEmpty()
    assert profiles.merge_text(profiles.text_states(dated.limit(0), ["day"])).isEmpty()


def test_a_day_is_replaced(spark, dated, tmp_path):
    path = str(tmp_path)
    early = dated.where(F.col("visit_id") < "v0400")
    profiles.write_states(profiles.numeric_states(early, ["day"]), path, 0)
    late_days = dated.where(F.col("visit_id") >= "v0400").select("day").distinct()
    same = F.col("l.day").eqNullSafe(F.col("day_"))
    again = dated.alias("l").join(late_days.select(F.col("day").alias("day_")), same, "left_semi")
    for _ in range(2):
        profiles.write_states(profiles.numeric_states(again, ["day"]), path, 1)
    merged = profiles.numeric_profile(profiles.merge_numeric(profiles.read_states(spark, path))).collect()
    assert_same_profile({r["column"]: r for r in merged}, dated)
