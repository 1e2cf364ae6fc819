"""Copies, replaced folders, published tables and single partitions."""

import pytest
from pyspark.sql import functions as f

from checks.trip_frame import legacy_layout
from tests.conftest import ZONE_ROWS
from tests.test_sources import files_in
from tripmetrics import cli
from tripmetrics.plans.jobs import JobConfig, clean, clean_years
from tripmetrics.schemas import CLEAN, STANDARD
from tripmetrics.sources import (
    copy_parquet,
    layouts,
    publish_table,
    read_months,
    read_table,
    register_table,
    write_partitions,
    write_table,
)
from tripmetrics.sources.reading import data_files


def put(frame, folder, name):
    """One file of a frame under a name."""
    frame.coalesce(1).write.parquet(f"{folder}/_{name}")
    (folder / f"{name}.parquet").write_bytes(open(files_in(folder / f"_{name}")[0], "rb").read())


@pytest.fixture
def broken(spark):
    """Trips of which the last cannot be computed."""

    def break_(df):
        return df.withColumn("tip_amount", f.when(f.col("VendorID") == 66, f.raise_error(f.lit("broken"))).otherwise(f.col("tip_amount")))

    return break_


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a")])
def test_copy_of_a_mixed_folder_keeps_all_columns(spark, make_trips, tmp_path, order):
    folder = tmp_path / "mixed folder"
    folder.mkdir()
    put(legacy_layout(make_trips({"VendorID": None}, {})), folder, order[0])
    put(make_trips({"cbd_congestion_fee": 0.75}).withColumn("fee", f.lit(3)), folder, order[1])
    target = f"{tmp_path}/copy"
    assert copy_parquet(spark, str(folder), target) == 3
    table = read_months(spark, [target])
    assert {r.cbd_congestion_fee for r in table.collect()} == {None, 0.75} and table.count() == 3
    found = {file: spark.read.parquet(file).schema for file in files_in(tmp_path / "copy")}
    kinds = sorted((schema["VendorID"].dataType.simpleString(), "fee" in schema.names) for schema in found.values())
    assert kinds == [("bigint", False), ("int", True)]


def test_copy_of_layouts_that_merge(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(spark.range(5).selectExpr("id"), folder, "a")
    put(spark.range(7).selectExpr("id", "id * 2 AS fee"), folder, "b")
    for _ in range(2):  # again over the first copy
        assert copy_parquet(spark, str(folder), f"{tmp_path}/out") == 12
    table = read_table(spark, f"{tmp_path}/out")
    assert table.columns == ["id", "fee"] and table.filter("fee is not null").count() == 7
    with pytest.raises(ValueError, match="input"):
        copy_parquet(spark, str(folder), str(folder))
    assert spark.read.parquet(f"{folder}/a.parquet").count() == 5


def test_copy_keeps_folder_columns(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "id % 3 AS k", "concat('x ', id % 2) AS s")
    rows.write.partitionBy("k").parquet(f"{tmp_path}/in/one")
    rows.write.partitionBy("s").parquet(f"{tmp_path}/in/two")
    rows.drop("s").write.parquet(f"{tmp_path}/in/three")
    assert copy_parquet(spark, f"{tmp_path}/in", f"{tmp_path}/out") == 30
    copied = [spark.read.parquet(file) for file in files_in(tmp_path / "out")]
    found = [r.asDict() for file in copied for r in file.collect()]
    found = sorted(((r["id"], r["k"], r.get("s")) for r in found), key=str)
    whole = [(i, i % 3, f"x {i % 2}") for i in range(10)]
    assert found == sorted([*whole, *whole, *[(i, k, None) for i, k, _ in whole]], key=str)


def test_a_failed_write_leaves_the_old_rows(spark, make_trips, broken, tmp_path):
    path = str(tmp_path / "out")
    write_table(make_trips({}, {}), path)
    with pytest.raises(Exception, match="broken"):
        write_table(broken(make_trips({}, {"VendorID": 66})), path)
    with pytest.raises(Exception, match="broken"):
        write_table(broken(make_trips({}, {"VendorID": 66})), path, ["payment_type"])
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(Exception, match="broken"):
        write_table(broken(make_trips({"VendorID": 66})), f"{tmp_path}/new")
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


@pytest.mark.parametrize("place", ["out", "out/", "out/payment_type=1"])
def test_writing_onto_an_input_is_refused(spark, make_trips, tmp_path, place):
    path = str(tmp_path / "out")
    write_table(make_trips({}, {"payment_type": 2}), path, ["payment_type"])
    own = spark.read.parquet(path)
    for frame in (own, own.join(own.select("VendorID"), "VendorID"), make_trips({}).unionByName(own, True)):
        with pytest.raises(ValueError, match="holds input"):
            write_table(frame, f"{tmp_path}/{place}")
    with pytest.raises(ValueError, match="holds input"):
        write_partitions(own, f"{tmp_path}/{place}", ["payment_type"])
    assert spark.read.parquet(path).count() == 2
    assert write_table(own, f"{tmp_path}/outer") == 2  # another name that begins alike


def test_an_interrupted_change_is_put_back(spark, make_trips, tmp_path):
    path = tmp_path / "out"
    write_table(make_trips({}, {}), str(path))
    path.rename(tmp_path / "_out.0123.old")
    with pytest.raises(Exception, match="holds input|broken|DIVIDE"):
        write_table(make_trips({}).withColumn("x", f.expr("1 / (VendorID - 2)")), str(path))
    assert spark.read.parquet(str(path)).count() == 2


def test_alternating_layouts_take_no_job_each(spark, make_trips, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    put(legacy_layout(make_trips({})), folder, "f000")
    put(make_trips({"cbd_congestion_fee": 1.0}), folder, "f001")
    old, new = ((folder / f"f00{n}.parquet").read_bytes() for n in (0, 1))
    for number in range(2, 200):
        (folder / f"f{number:03d}.parquet").write_bytes(new if number % 2 else old)
    jobs = {}
    for count in (20, 200):
        files = [file for file in data_files(spark, [str(folder)]) if "/_" not in file][:count]
        spark.sparkContext.setJobGroup(f"layouts{count}", "")
        found = layouts(spark, files)
        assert sorted(len(members) for _, members in found) == [count // 2, count // 2]
        jobs[count] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"layouts{count}"))
        by_halves = layouts(spark, files, stretch=8)
        assert sorted(len(members) for _, members in by_halves) == [count // 2, count // 2]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[20] == jobs[200] <= 3
    assert read_months(spark, files).filter("cbd_congestion_fee = 1").count() == 100


def test_published_versions(spark, make_trips, broken, tmp_path):
    root = f"{tmp_path}/it's versions"
    first = publish_table(make_trips({}), "published", root, schema=STANDARD)
    assert first["rows"] == 1 and spark.table("published").count() == 1
    publish_table(spark.table("published").union(make_trips({})), "published", root, schema=STANDARD)
    assert spark.table("published").count() == 2
    with pytest.raises(Exception, match="broken"):
        publish_table(broken(make_trips({"VendorID": 66})), "published", root, schema=STANDARD)
    assert spark.table("published").count() == 2
    last = publish_table(make_trips({}, {}, {}), "published", root, schema=STANDARD)
    assert spark.table("published").count() == 3 and spark.read.parquet(last["version"]).count() == 3
    assert len(list((tmp_path / "it's versions").iterdir())) == 2
    by_type = [{}, {"payment_type": 2}, {"payment_type": None}]
    publish_table(make_trips(*by_type), "published", root, ["payment_type"], STANDARD)
    assert spark.table("published").count() == 3
    publish_table(make_trips({"payment_type": 2}), "published", root, ["payment_type"], STANDARD)
    assert [r.payment_type for r in spark.table("published").collect()] == [2]
    spark.sql("DROP TABLE published")


@pytest.fixture
def cleaned_by_year(spark, make_trips, zones, tmp_path):
    """Staged trips of three years, cleaned into a table with a folder per year."""
    import datetime as dt

    def day(year):
        return {"tpep_pickup_datetime": dt.datetime(year, 3, 5, 18), "tpep_dropoff_datetime": dt.datetime(year, 3, 5, 18, 9)}

    staged = make_trips(*[day(y) for y in (2022, 2023, 2023, 2024)])
    write_table(staged, f"{tmp_path}/staged")
    zones.write.option("header", True).csv(f"{tmp_path}/zones")
    config = JobConfig([], f"{tmp_path}/zones", f"{tmp_path}/staged", f"{tmp_path}/cleaned", "by_year", ["Year"])
    cleaned = clean(staged, zones)
    write_table(cleaned, config.cleaned_path, ["Year"])
    register_table(spark, "by_year", config.cleaned_path, ["Year"])
    yield config, day
    spark.sql("DROP TABLE IF EXISTS by_year")


def stamps(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_rerun_of_one_year_touches_one_partition(spark, make_trips, cleaned_by_year, tmp_path):
    config, day = cleaned_by_year
    write_table(make_trips(*[day(y) for y in (2022, 2023, 2023, 2023)]), f"{tmp_path}/staged")
    before = stamps(tmp_path / "cleaned")
    stray = tmp_path / "cleaned" / "Year=1999"
    stray.mkdir()
    (stray / "part-0.parquet").write_bytes(next(iter(before)).read_bytes())
    assert clean_years(spark, config, [2023]) == {"rows": 3, "years_written": 1, "years_emptied": 0}
    after = stamps(tmp_path / "cleaned")
    changed = {p.parent.name for p in before.keys() ^ (after.keys() - set(stray.iterdir()))}
    assert changed == {"Year=2023"}
    table = spark.table("by_year")
    counts = {r.Year: r["count"] for r in table.groupBy("Year").count().collect()}
    assert counts == {2022: 1, 2023: 3, 2024: 1}  # 2024 was not asked for, and no folder was listed
    assert clean_years(spark, config, [2024, 2023])["years_emptied"] == 1
    assert {r.Year for r in spark.table("by_year").collect()} == {2022, 2023}
    assert not (tmp_path / "cleaned" / "Year=2024").exists()


def test_years_by_the_command_line(spark, cleaned_by_year, tmp_path, capsys):
    config, _ = cleaned_by_year
    spark.sql("DROP TABLE by_year")
    argv = ["update", "--staged", config.staged_path, "--zones", config.zones_path]
    argv += ["--cleaned", config.cleaned_path, "--table", "by_year", "--only-years", "2022", "2023"]
    cli.main(argv, spark)
    assert "'years_written': 2" in capsys.readouterr().out
    assert spark.table("by_year").count() == 4
    with pytest.raises(ValueError, match="folder per year"):
        clean_years(spark, JobConfig([], "", "", "", "by_year"), [2022])


def test_registering_known_partitions_drops_the_others(spark, tmp_path):
    path = str(tmp_path / "odd")
    schema = spark.range(0).selectExpr("id", "'' AS k").schema
    rows = spark.createDataFrame([(1, "a b"), (2, "c/d=e"), (3, None), (4, "it's")], "id bigint, k string")
    from tripmetrics.sources import write_observed

    for frame in (rows, rows.filter("id > 1")):
        written = write_observed(frame, path, ["k"])
        register_table(spark, "odd_names", path, ["k"], schema, partitions=written["partitions"])
        found = sorted(spark.table("odd_names").select("id", "k").collect(), key=str)
        assert found == sorted(frame.collect(), key=str)
    spark.sql("DROP TABLE odd_names")


def test_a_definition_that_differs_is_found_before_writing(spark, make_trips, tmp_path, capsys):
    raw, zones_csv = f"{tmp_path}/raw/{{year}}/{{month:02d}}.parquet", tmp_path / "zones.csv"
    lines = ["LocationID,Borough,Zone,service_zone"] + [",".join(map(str, r)) for r in ZONE_ROWS]
    zones_csv.write_text("\n".join(lines))
    make_trips({}, {}).write.parquet(raw.format(year=2024, month=1))
    argv = ["run", "--months", raw, "--years", "2024:1", "--zones", str(zones_csv), "--table", "differing"]
    argv += ["--staged", f"{tmp_path}/staged", "--cleaned", f"{tmp_path}/cleaned"]
    cli.main(argv, spark)
    before = stamps(tmp_path)
    with pytest.raises(ValueError, match="partitions"):
        cli.main([*argv, "--partition-by", "Year"], spark)
    assert stamps(tmp_path) == before and spark.table("differing").count() == 2
    cli.main([*argv, "--partition-by", "Year", "--replace"], spark)
    assert spark.table("differing").count() == 2
    cli.main([*argv[:-1], f"{tmp_path}/versions", "--versioned"], spark)
    cli.main([*argv[:-1], f"{tmp_path}/versions", "--versioned"], spark)
    assert spark.table("differing").select(*CLEAN.names).count() == 2
    assert len(list((tmp_path / "versions").iterdir())) == 2
    spark.sql("DROP TABLE differing")
