import pytest

from tests.conftest import ZONE_ROWS, plan_of
from tripmetrics.plans.jobs import clean
from tripmetrics.schemas import CLEAN, STANDARD
from tripmetrics.sources import (
    copy_parquet,
    load_year,
    month_paths,
    read_months,
    read_table,
    read_zones,
    register_table,
    write_table,
)
from checks.trip_frame import legacy_layout

TEMPLATE = "{root}/{{year}}/trips_{{year}}-{{month:02d}}.parquet"


@pytest.fixture
def raw(make_trips, tmp_path):
    """Three months of one old year and two of a new one; the first trip stands in both."""
    template = TEMPLATE.format(root=tmp_path)
    old = make_trips({}, {"VendorID": None}).drop("cbd_congestion_fee")
    for path in month_paths(template, 2022, 3):
        legacy_layout(old.withColumn("cbd_congestion_fee", old.tip_amount)).write.parquet(path)
    for path in month_paths(template, 2025, 2):
        make_trips({}, {"VendorID": 1}).write.parquet(path)
    return template


def test_month_paths_are_zero_padded():
    paths = month_paths("s3a://raw/{year}/t_{year}-{month:02d}.parquet", 2022, 12)
    assert paths[0] == "s3a://raw/2022/t_2022-01.parquet"
    assert paths[-1] == "s3a://raw/2022/t_2022-12.parquet" and len(paths) == 12


def test_drifting_months_become_one_table(spark, raw):
    paths = month_paths(raw, 2022, 3) + month_paths(raw, 2025, 2)
    table = read_months(spark, paths)
    assert table.schema == STANDARD
    assert table.count() == 10
    assert table.filter("cbd_congestion_fee is null").count() == 6
    assert table.filter("VendorID is null").count() == 3
    assert table.filter("Airport_fee = 0").count() == 10


def test_one_scan_per_layout_not_per_file(spark, raw):
    plan = plan_of(read_months(spark, month_paths(raw, 2022, 3) + month_paths(raw, 2025, 2)))
    assert plan.count("FileScan parquet") == 2


def test_a_year(spark, raw):
    assert load_year(spark, raw, 2022, 2).count() == 4


def test_a_missing_month_is_an_error(spark, raw):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_months(spark, month_paths(raw, 2025, 3))


def test_zones_from_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    lines = ['"LocationID","Borough","Zone","service_zone"']
    lines += [f'{i},"{b}","{z}","{s}"' for i, b, z, s in ZONE_ROWS]
    path.write_text("\n".join(lines))
    assert [tuple(row) for row in read_zones(spark, str(path)).collect()] == ZONE_ROWS


def test_zones_with_another_header_are_refused(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Zone,Borough,service_zone\n1,Bay,Queens,Boro Zone")
    with pytest.raises(Exception, match="(?i)header"):
        read_zones(spark, str(path)).collect()


@pytest.mark.parametrize("partition_by", [None, ["payment_type"]])
def test_write_returns_the_rows_written(spark, make_trips, tmp_path, partition_by):
    path = str(tmp_path / "out")
    trips = make_trips({}, {"payment_type": 2}, {"payment_type": None})
    assert write_table(trips, path, partition_by) == 3
    assert write_table(trips.limit(2), path, partition_by) == 2  # overwrites
    back = spark.read.parquet(path).select(*STANDARD.names)
    assert back.count() == 2


def test_write_of_nothing(spark, make_trips, tmp_path):
    path = str(tmp_path / "out")
    assert write_table(make_trips({}).filter("false"), path) == 0
    assert spark.read.parquet(path).schema == STANDARD


def test_hot_partition_is_spread_over_files(spark, tmp_path):
    """A folder with most rows is written by several tasks."""
    path = str(tmp_path / "out")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "64k")
    try:
        rows = spark.range(0, 200000, 1, 8).selectExpr("id", "if(id % 10 = 0, id % 5, 7) AS k")
        assert write_table(rows, path, ["k"]) == 200000
    finally:
        spark.conf.unset(advisory)
    files = list((tmp_path / "out" / "k=7").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(path).count() == 200000


def test_copy(spark, tmp_path):
    source = "/root/testdata/sf0.001/orders.parquet"
    copied = copy_parquet(spark, source, str(tmp_path / "copy"))
    assert copied == spark.read.parquet(source).count() == spark.read.parquet(str(tmp_path / "copy")).count()


@pytest.mark.parametrize("partition_by", [None, ["payment_type"]])
def test_registered_table_follows_its_files(spark, make_trips, tmp_path, partition_by):
    path = str(tmp_path / "it's here")
    name = "trips_parted" if partition_by else "trips_flat"
    write_table(make_trips({}), path, partition_by)
    register_table(spark, name, path, partition_by, STANDARD)
    assert spark.table(name).count() == 1
    write_table(make_trips({}, {"payment_type": 3}), path, partition_by)
    register_table(spark, name, path, partition_by, STANDARD)
    assert spark.table(name).count() == 2
    assert spark.table(name).filter("payment_type = 3").count() == 1
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(path).count() == 2  # external: the files stay


def test_table_may_be_registered_before_its_files(spark, make_trips, zones, tmp_path):
    path = str(tmp_path / "later")
    register_table(spark, "early", path)
    assert spark.table("early").columns == CLEAN.names
    write_table(clean(make_trips({}), zones), path)
    register_table(spark, "early", path)
    assert spark.table("early").count() == 1
    spark.sql("DROP TABLE early")


def test_a_year_of_the_cleaned_table_reads_only_its_folder(spark, make_trips, zones, tmp_path):
    path = str(tmp_path / "cleaned")
    write_table(clean(make_trips({}), zones), path, ["Year"])
    plan = plan_of(spark.read.parquet(path).filter("Year = 2024"))
    assert "PartitionFilters: [isnotnull(Year" in plan


def files_in(folder):
    return [str(file) for file in sorted(folder.glob("part-*"))]


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a")])
def test_one_folder_of_old_and_new_files(spark, make_trips, tmp_path, order):
    """Old and new files in one folder, whichever comes first by name."""
    old, new = order
    folder = tmp_path / "mixed"
    folder.mkdir()
    legacy_layout(make_trips({"VendorID": None})).coalesce(1).write.parquet(f"{tmp_path}/old")
    make_trips({"cbd_congestion_fee": 0.75}).coalesce(1).write.parquet(f"{tmp_path}/new")
    for name, source in ((old, "old"), (new, "new")):
        for file in files_in(tmp_path / source):
            (folder / f"{name}.parquet").write_bytes(open(file, "rb").read())
    table = read_months(spark, [str(folder)])
    assert table.schema == STANDARD and table.count() == 2
    assert [r.cbd_congestion_fee for r in table.orderBy("cbd_congestion_fee").collect()] == [None, 0.75]
    assert table.filter("Airport_fee = 0").count() == 2


def test_a_column_of_some_files_between_others(spark, make_trips, tmp_path):
    """The first and last file lack the column; so do the types agree, but not the columns."""
    folder = tmp_path / "mixed"
    folder.mkdir()
    for number in range(5):
        trips = make_trips({"cbd_congestion_fee": float(number)})
        if number in (0, 4):
            trips = trips.drop("cbd_congestion_fee")
        if number == 2:
            trips = trips.withColumn("VendorID", trips.VendorID.cast("bigint"))
        trips.coalesce(1).write.parquet(f"{tmp_path}/{number}")
        for file in files_in(tmp_path / str(number)):
            (folder / f"{number}.parquet").write_bytes(open(file, "rb").read())
    table = read_months(spark, [str(folder)])
    assert table.count() == 5 and table.filter("VendorID = 2").count() == 5
    fees = {r.cbd_congestion_fee for r in table.collect()}
    assert fees == {None, 1.0, 2.0, 3.0}
    assert plan_of(table).count("FileScan parquet") == 2


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no files"):
        read_months(spark, [f"{tmp_path}/empty"])


def test_a_bad_zone_id_is_an_error(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1x,Queens,Bay,Boro Zone")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_zones(spark, str(path)).collect()


def test_a_declared_schema_keeps_the_type_of_a_folder_column(spark, make_trips, tmp_path):
    path = str(tmp_path / "out")
    write_table(make_trips({}), path, ["payment_type"])
    kinds = dict(read_table(spark, path, STANDARD).dtypes)
    assert kinds["payment_type"] == "bigint"


@pytest.mark.parametrize("first, second", [(None, ["payment_type"]), (["payment_type"], None)])
def test_a_stale_definition_is_refused_or_replaced(spark, make_trips, tmp_path, first, second):
    path, name = str(tmp_path / "out"), f"stale_{'flat' if first is None else 'parted'}"
    write_table(make_trips({}), path, first)
    register_table(spark, name, path, first, STANDARD)
    write_table(make_trips({}, {}), path, second)
    with pytest.raises(ValueError, match="partitions"):
        register_table(spark, name, path, second, STANDARD)
    register_table(spark, name, path, second, STANDARD, replace=True)
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_a_moved_table_is_refused_or_replaced(spark, make_trips, tmp_path):
    for number in (1, 2):
        write_table(make_trips(*[{}] * number), f"{tmp_path}/{number}")
    register_table(spark, "moved", f"{tmp_path}/1", None, STANDARD)
    with pytest.raises(ValueError, match="location"):
        register_table(spark, "moved", f"{tmp_path}/2", None, STANDARD)
    register_table(spark, "moved", f"{tmp_path}/2", None, STANDARD, replace=True)
    assert spark.table("moved").count() == 2
    with pytest.raises(ValueError, match="columns"):
        register_table(spark, "moved", f"{tmp_path}/2")
    spark.sql("DROP TABLE moved")


def test_intermediate_tables_are_stored_and_deleted(spark):
    from pathlib import Path

    from tripmetrics.sources import cleanup, store
    from tripmetrics.sources.shared import shared_root

    root = shared_root(spark)
    assert store(spark.range(3), "three").count() == 3
    assert any(Path(root).iterdir())
    cleanup(spark)
    assert not Path(root).exists() and shared_root(spark) != root
