"""What a query wrote or shuffled on its way is deleted when nothing reads it any more."""

import gzip
import os
import time

import pytest

from quayside.operators import quality
from quayside.plans import catalog
from quayside.plans.validation import validate
from quayside.session import SHUFFLE_CLEANUP, checkpoint_folder, cut_lineage, passing_files, scratch_folder
from quayside.sources import sinks
from quayside.sources.visits import load_visits

HEAD = "container_id,size_ft,container_type,weight_tons,gate_in_time,gate_out_time,movement_type,yard_block,remark"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Order lines, some of them twice or without a quantity, and their orders."""
    path = str(tmp_path_factory.mktemp("tables"))
    lines = spark.range(800).selectExpr(
        "id div 4 as l_orderkey", "id * 7 % 90 + 1 as l_partkey", "id * 5 % 30 as l_suppkey",
        "cast(id % 4 + 1 as int) as l_linenumber", "if(id % 50 = 0, null, double(id % 40 + 1)) as l_quantity",
        "double(id * 13 % 997) as l_extendedprice", "element_at(array('N', 'A', 'R'), cast(id % 3 + 1 as int)) as l_returnflag",
        "timestamp_ntz '1998-01-01' + make_dt_interval(cast(id % 300 as int)) as l_shipdate")
    lines.union(lines.where("l_orderkey < 5")).write.parquet(f"{path}/lineitem.parquet")
    spark.range(200).selectExpr("id as o_orderkey", "if(id % 2 = 0, '2-HIGH', '5-LOW') as o_orderpriority").write.parquet(
        f"{path}/orders.parquet")
    return path


@pytest.fixture
def visit_files(tmp_path):
    """Text with exact copies, other visits under one key, and keys without a container or a time."""
    line = lambda c, t, out="2025-03-03 00:00:00", remark="x": f"{c},40,dry,10.5,{t},{out},import,A01,{remark}"
    day = lambda i: f"2025-01-{i % 28 + 1:02d} 0{i % 9}:00:00"
    parts = [[line(f"C{i}", day(i)) for i in range(120)],
             [line("C1", day(1)), line("C2", day(2), remark="other"), line("C3", day(3), "2024-01-01 00:00:00")],
             [line("", day(1)), line("", day(1), remark="other"), line("", ""), line("", ""), line("C4", "never"), line("C4", "")]]
    for i, lines in enumerate(parts):
        (tmp_path / f"{i}.csv.gz").write_bytes(gzip.compress("\n".join([HEAD, *lines]).encode()))
    return str(tmp_path)


def names(spark):
    return set(os.listdir(checkpoint_folder(spark).removeprefix("file:")))


def blocks_shuffled(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return blocks.mkString(" ").count("shuffle_")


def test_stored_visits_keeps_the_clean_rows_only(spark, tables, monkeypatch):
    checkpoint_folder(spark)
    before, at_sink, write = names(spark), set(), sinks.write_clean_visits
    monkeypatch.setattr(sinks, "write_clean_visits", lambda *a: (at_sink.update(names(spark)), write(*a))[1])
    found = catalog.stored_visits(spark, tables)
    assert not [n for n in at_sink - before if n.startswith("dirty-visits")]
    assert [n.split("-")[0] for n in names(spark) - before] == ["clean"]
    assert found.count() == 800
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_text_is_packed_in_short_files(spark, tables, monkeypatch):
    monkeypatch.setattr(catalog, "TEXT_ROWS", 50)
    path = catalog.dirty_files(spark, tables)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files) >= 820 / 50 and all(f.endswith(".csv.gz") for f in files)
    loaded = load_visits(spark, path)
    assert loaded.count() == 820 and loaded.select("source_position").distinct().count() == 820


def test_what_was_shuffled_goes_when_its_query_ends(spark):
    with passing_files(spark):
        before = blocks_shuffled(spark)
        assert cut_lineage(spark.range(1000).repartition(7, "id")).count() == 1000
        until = time.time() + 20
        while blocks_shuffled(spark) > before and time.time() < until:
            time.sleep(0.2)
        assert blocks_shuffled(spark) <= before


def test_only_files_made_within_are_deleted(spark):
    kept = cut_lineage(spark.range(5))
    with pytest.raises(ValueError, match="broken"), passing_files(spark):
        before = names(spark)
        cut_lineage(spark.range(5))
        assert names(spark) > before
        raise ValueError("broken")
    assert names(spark) == before and kept.count() == 5
    assert scratch_folder(spark, "later")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_visits_in_files_are_checked_as_others_are(spark, visit_files, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        loaded = load_visits(spark, visit_files)
        plain = validate(spark, loaded, "2025-06-01")
        before = names(spark)
        checked = validate(spark, loaded, "2025-06-01", from_files=True)
        made = names(spark) - before
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(checked.checks) == rows(plain.checks)
        assert rows(checked.clean) == rows(plain.clean) and checked.clean.schema == plain.clean.schema
        value = {(r.check, r.column): r.value for r in checked.checks.where("metric = 'rows'").collect()}
        assert value["exact_duplicates", "*"] == 3 and value["key_duplicates", "container_id,gate_in_time"] == 6
        # Keys that come more than once and the checks were written, but no visits.
        assert all("visit_id" not in spark.read.parquet(f"{checkpoint_folder(spark)}/{n}").columns for n in made)
        assert ("LeftAnti" in checked.clean._jdf.queryExecution().optimizedPlan().toString()) == (threshold == "10MB")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_visits_under_keys_of_their_own_are_not_shuffled(spark, visit_files):
    checked = validate(spark, load_visits(spark, visit_files), "2025-06-01", from_files=True)
    with_all = quality.clean_visits(checked.visits, "2025-06-01")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(checked.clean) == exchanges(with_all) == 1
    anti = checked.clean._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    assert "LeftAnti" in anti and "Exchange hashpartitioning" not in anti
