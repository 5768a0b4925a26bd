"""Text files: stable ids, what is absent and what is unreadable, unknown columns, broken files."""

from quayside.operators import occupancy, quality
from quayside.operators.features import visit_features
from quayside.params import SAMPLE_TARIFF
from quayside.plans.validation import validate_files
from quayside.schema import REQUIRED_COLUMNS
from quayside.sources.visits import load_visits

HEAD = ",".join(REQUIRED_COLUMNS) + ",remark"


def write(folder, parts):
    for i, lines in enumerate(parts):
        (folder / f"{i}.csv").write_text("\n".join([HEAD, *lines]) + "\n")
    return str(folder)


def line(i, size="40", out="2025-01-03 00:00:00", remark="x"):
    return f"C{i},{size},dry,10.5,2025-01-01 0{i % 9}:00:00,{out},import,A01,{remark}"


def test_visit_ids_do_not_depend_on_packing(spark, tmp_path):
    path = write(tmp_path, [[line(i + 1000 * part) for i in range(400)] for part in range(3)])

    def ids(**conf):
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            return {r.container_id: r.visit_id for r in load_visits(spark, path).select("container_id", "visit_id").collect()}
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)

    packed = ids(**{"spark.sql.files.maxPartitionBytes": "134217728", "spark.sql.files.openCostInBytes": "1"})
    split = ids(**{"spark.sql.files.maxPartitionBytes": "5000", "spark.sql.files.openCostInBytes": "4194304"})
    assert packed == split and len(set(packed.values())) == 1200


def test_unreadable_values_are_invalid_and_not_absent(spark, tmp_path):
    path = write(tmp_path, [[line(0, "abc"), line(1, "22.5"), line(2, ""), line(3), line(4, remark="")],
                            [line(5, out="never"), line(6, out="")]])
    checks = {(r.check, r.column): r.value for r in quality.row_checks(load_visits(spark, path)).where("metric = 'rows'").collect()}
    assert checks["domain", "size_ft"] == 2 and checks["nulls", "size_ft"] == 1
    assert checks["unreadable", "gate_out_time"] == 1 and checks["nulls", "gate_out_time"] == 1
    assert checks["nulls", "remark"] == 1


def test_exact_copies_compare_unknown_columns(spark, tmp_path):
    path = write(tmp_path, [[line(1), line(1), line(1, remark="other")]])
    row = quality.duplicate_counts(load_visits(spark, path)).first()
    assert (row.exact_duplicates, row.key_duplicates) == (1, 2)


def test_unreadable_file_gives_a_report(spark, tmp_path):
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 is not enough")
    report = validate_files(spark, str(tmp_path / "broken.parquet"), "parquet").report()
    assert report["status"] == "FAIL" and report["errors"][0]["check"] == "unreadable_file" and report["reason"]
    assert validate_files(spark, str(tmp_path / "absent.csv")).report()["status"] == "FAIL"


def test_visits_without_container_type(make_visits):
    features = visit_features(make_visits([{}, {}]).drop("container_type"), tariff=SAMPLE_TARIFF)
    assert {r.iso_container_group for r in features.select("iso_container_group").collect()}
    assert occupancy.occupancy_by_type(features).first().container_type == "unknown"


def test_infinite_values_are_profiled(spark, tmp_path):
    lines = [line(i).replace(",10.5,", f",{w},") for i, w in enumerate(["1.5", "inf", "2.5", "Infinity", "NaN", ""] + ["3.0"] * 200)]
    (tmp_path / "a.csv").write_text("\n".join([HEAD, *lines]) + "\n")
    checked = validate_files(spark, str(tmp_path))
    row = quality.numeric_profile(checked.clean, ["weight_tons"]).first()
    assert (row["count"], row["min"], row["max"], row["median"], row["std"]) == (204, 1.5, float("inf"), 3.0, None)
    assert checked.report() is not None


def test_text_is_parsed_once(spark, tmp_path):
    """Neither the checks nor the clean rows or profiles go back to the text."""
    path = write(tmp_path, [[line(i) for i in range(50)]])
    checked = validate_files(spark, path)
    frames = [checked.checks, checked.clean, quality.row_checks(checked.visits), quality.duplicate_counts(checked.visits),
              quality.coverage(checked.clean), quality.numeric_profile(checked.clean), quality.top_values(checked.clean)]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan csv" not in plan and "FileScan parquet" in plan
