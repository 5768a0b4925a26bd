"""The maintained yard equals a rebuilt one after any edits."""

import glob
import os
import random
from datetime import timedelta

import pytest

from quayside.operators import change_log, features, occupancy
from quayside.params import AnalysisParams
from tests.conftest import ts

START = ts("2025-01-01 10:00:00")


def some_rows(rng, ids):
    rows = []
    for i in ids:
        entry = START + timedelta(hours=rng.randrange(4000))
        leave = rng.choice([None, entry + timedelta(hours=rng.randrange(900)), entry - timedelta(days=2)])
        rows.append({
            "visit_id": f"n{i:04d}", "gate_in_time": rng.choice([entry, entry, entry, None]), "gate_out_time": leave,
            "yard_block": rng.choice(["A01", "R01", "X9", None]), "size_ft": rng.choice([20, 40, None]),
            "container_type": rng.choice(["dry", "reefer", None]), "yard_tier": rng.choice([None, 1, 4])})
    return rows


def cells(df):
    return sorted((str(tuple(r)) for r in df.select(
        "yard_block", "container_type", "date", *occupancy.MEASURES).collect()))


@pytest.mark.parametrize("teu_45", [2, 2.25])
def test_random_edits_equal_a_rebuild(spark, make_visits, tmp_path, teu_45):
    rng, path = random.Random(5), str(tmp_path / "changes")
    feats = lambda rows: features.visit_features(
        make_visits(rows), AnalysisParams(teu_for_45ft=teu_45))
    current = {r["visit_id"]: r for r in some_rows(rng, range(80))}
    stored = feats(list(current.values()))
    change_log.append_changes(change_log.net_changes(occupancy.visit_changes(stored)), path, 0)
    for batch in range(1, 4):
        edited = some_rows(rng, rng.sample(range(100), 25))  # corrected visits and new ones
        gone = rng.sample(sorted(current), 10)
        edited_feats = feats(edited)
        deleted = spark.createDataFrame([(v,) for v in [*gone, "never there"]], "visit_id string")
        delta = change_log.edit_changes(stored, edited_feats, deleted)
        change_log.append_changes(delta, path, batch)
        if batch == 2:  # a repeated job
            change_log.append_changes(delta, path, batch)
        for v in gone:
            del current[v]
        current.update({r["visit_id"]: r for r in edited})
        stored = feats(list(current.values()))
        got = cells(change_log.occupancy_of_changes(change_log.read_changes(spark, path)))
        assert got == cells(occupancy.occupancy_by_type(stored)) and got
    change_log.compact(spark, path, str(tmp_path / "compact"))
    assert len(glob.glob(f"{tmp_path}/compact/month=*/batch=*")) == len(glob.glob(f"{tmp_path}/compact/month=*"))
    again = change_log.read_changes(spark, str(tmp_path / "compact"))
    assert cells(change_log.occupancy_of_changes(again)) == got


def test_replaced_visits(make_visits):
    old, new = make_visits([{"visit_id": v} for v in "abc"]), make_visits([{"visit_id": "b", "size_ft": 20}, {"visit_id": "d"}])
    kept = change_log.replace_visits(old, new, make_visits([{"visit_id": "a"}, {"visit_id": "b"}]))
    assert sorted((r.visit_id, r.size_ft) for r in kept.collect()) == [("b", 20), ("c", 40), ("d", 40)]


def test_a_late_exit_touches_its_months_only(spark, make_visits, tmp_path):
    path = str(tmp_path)
    rows = [{"visit_id": f"v{m}", "gate_in_time": ts(f"2025-{m:02d}-10 08:00:00"),
             "gate_out_time": ts(f"2025-{m:02d}-12 08:00:00")} for m in range(1, 7)]
    rows[2]["gate_out_time"] = None
    stored = features.visit_features(make_visits(rows))
    change_log.append_changes(change_log.net_changes(occupancy.visit_changes(stored)), path, 0)
    edited = features.visit_features(make_visits([{**rows[2], "gate_out_time": ts("2025-05-02 09:00:00")}]))
    change_log.append_changes(change_log.edit_changes(stored, edited), path, 1)
    touched = {os.path.basename(os.path.dirname(p)) for p in glob.glob(f"{path}/month=*/batch=1")}
    assert touched == {"month=202503", "month=202505"}  # overstay from the entry on, and the exit
    part = change_log.read_changes(spark, path, 202504, 202505)
    assert sorted((r.date.month, r.date.day, r.containers) for r in part.collect()) == [
        (4, 10, 1), (4, 13, -1), (5, 3, -1), (5, 10, 1), (5, 13, -1)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_no_visits_left(spark, make_visits, tmp_path):
    stored = features.visit_features(make_visits([{"gate_out_time": ts("2025-01-03 00:00:00")}]))
    change_log.append_changes(change_log.net_changes(occupancy.visit_changes(stored)), str(tmp_path), 0)
    change_log.append_changes(change_log.edit_changes(stored, stored.limit(0), stored.select("visit_id")), str(tmp_path), 1)
    days = change_log.occupancy_of_changes(change_log.read_changes(spark, str(tmp_path)))
    assert days.isEmpty()
    windows = [line for line in days._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert windows and all("yard_block" in line for line in windows)  # no task holds all groups
