"""What the plans look like on a staged table."""

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as f

from checks.trip_frame import legacy_layout
from tests.conftest import plan_of
from tripmetrics.operators import broadcast_if_small
from tripmetrics.plans import metrics
from tripmetrics.plans.jobs import clean, tidy
from tripmetrics.sources import read_months, read_staged, read_zones, write_table, writing
from tripmetrics.sources.writing import _arranged


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from checks.trip_frame import trips, zones

    folder = tmp_path_factory.mktemp("stored")
    write_table(trips(spark, "/root/testdata/sf0.001"), f"{folder}/staged")
    zones(spark, "/root/testdata/sf0.001").write.option("header", True).csv(f"{folder}/zones")
    return folder


@pytest.fixture
def staged(spark, stored):
    return read_staged(spark, f"{stored}/staged")


@pytest.fixture
def dim(spark, stored):
    return broadcast_if_small(read_zones(spark, f"{stored}/zones"))


def test_cleaning_shuffles_nothing_but_the_mean(staged, dim):
    plan = plan_of(clean(staged, dim), final=True)
    assert plan.count("BroadcastHashJoin") >= 2
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_both_roles_share_one_exchange(staged, dim):
    assert "ReusedExchange" in plan_of(clean(staged, dim), final=True)


def test_filters_and_columns_reach_the_scan(staged, dim, capsys):
    clean(staged, dim).explain("formatted")
    plan = capsys.readouterr().out
    pushed = max(re.findall(r"PushedFilters: \[(.*)\]", plan), key=len)
    assert "GreaterThanOrEqual(passenger_count,1)" in pushed
    assert "LessThanOrEqual(trip_distance,200.0)" in pushed
    assert "GreaterThanOrEqual(total_amount,0.0)" in pushed
    assert "store_and_fwd_flag" not in plan


def test_filters_go_below_the_union_of_layouts(spark, make_trips, tmp_path, capsys):
    """Cleaning straight from raw files filters in each layout's scan."""
    legacy_layout(make_trips({})).write.parquet(f"{tmp_path}/old")
    make_trips({}).write.parquet(f"{tmp_path}/new")
    raw = read_months(spark, [f"{tmp_path}/old", f"{tmp_path}/new"])
    tidy(raw).explain("formatted")
    plan = capsys.readouterr().out
    pushed = re.findall(r"PushedFilters: \[(.*trip_distance,200.0.*)\]", plan)
    assert len(pushed) == 2 and all("total_amount,0.0" in p for p in pushed)


def test_the_mean_reads_one_column(staged):
    plan = tidy(staged)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<tip_amount:double>" in plan


def test_metrics_aggregate_before_they_shuffle(staged):
    plan = plan_of(metrics.vendor_summary(tidy(staged)))
    assert "partial_count" in plan and plan.index("Exchange hashpartitioning") < plan.index("partial_count")


def test_top_k_does_not_sort_everything(staged, dim):
    plan = plan_of(metrics.top_pickup_zones(clean(staged, dim)))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_no_python_in_any_plan(staged, dim):
    assert "Python" not in plan_of(clean(staged, dim))


def test_generated_methods_are_small_enough_to_be_compiled(spark, staged, dim, capsys):
    """The JVM does not compile methods above 8000 bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        clean(staged, dim).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_raw_months_move_narrow_and_are_sorted_once(spark, monkeypatch):
    """Only what trips come from is moved and sorted, and the write finds its folders in order."""
    from checks import trip_frame

    taken = []
    monkeypatch.setattr(trip_frame, "once", lambda spark, sf_dir, name, build: build())
    monkeypatch.setattr(trip_frame, "write_table", lambda *args, **how: taken.append((args, how)))
    trip_frame.raw_root(spark, "/root/testdata/sf0.001")
    assert len(taken) == 2
    lineitem = set(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").columns)
    for (moved, _, folders), how in taken:
        assert set(moved.columns) <= lineitem | set(folders)
        plan = plan_of(_arranged(moved, folders, **how))
        assert plan.index("Project") < plan.index("Sort") < plan.index("Exchange")
        assert plan.count("Sort [file_year") == 1


_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def writes(monkeypatch):
    """Of each write to parquet: the plan of its rows and how many files a task keeps open."""
    seen = []
    written = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append((plan_of(self._df), self._df.sparkSession.conf.get(_AT_ONCE, None)))
        return written(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


@pytest.mark.parametrize("at_once", [100, 3])
def test_folders_are_written_without_a_sort(spark, writes, monkeypatch, tmp_path, at_once):
    """Sorted rows of many months spill; more folders than a task may open change no row."""
    monkeypatch.setattr(writing, "OPEN_FOLDERS", at_once)
    rows = spark.range(5000).selectExpr("id", "id % 12 AS month")
    doubled = {"derive": lambda df: df.withColumn("twice", f.col("id") * 2)}
    for how in ({}, doubled):
        path = f"{tmp_path}/{len(how)}"
        assert write_table(rows, path, ["month"], **how) == 5000
        assert len(list(tmp_path.glob(f"{len(how)}/month=*"))) == 12
        found = spark.read.parquet(path).filter("id % 12 = month")
        assert found.select("id").distinct().count() == found.count() == 5000
    assert found.filter("twice = 2 * id").count() == 5000
    assert [open_files for _, open_files in writes] == [str(at_once)] * 2
    assert not any("Sort" in plan for plan, _ in writes)
    assert spark.conf.get(_AT_ONCE, None) is None


def test_a_session_decides_how_many_folders_are_open(spark, writes, tmp_path):
    spark.conf.set(_AT_ONCE, "0")
    try:
        rows = spark.range(50).selectExpr("id", "id % 3 AS part")
        write_table(rows, f"{tmp_path}/sorted", ["part"], derive=lambda df: df)
        assert spark.conf.get(_AT_ONCE) == "0"
    finally:
        spark.conf.unset(_AT_ONCE)
    [(plan, open_files)] = writes
    assert open_files == "0" and plan.count("Sort [part") == 1
    assert spark.read.parquet(f"{tmp_path}/sorted").count() == 50
