import pytest

from tripmetrics import cli
from tripmetrics.schemas import CLEAN
from tests.conftest import ZONE_ROWS
from tests.test_sources import raw  # noqa: F401


@pytest.fixture
def zones_csv(tmp_path):
    path = tmp_path / "zones.csv"
    lines = ["LocationID,Borough,Zone,service_zone"] + [",".join(map(str, r)) for r in ZONE_ROWS]
    path.write_text("\n".join(lines))
    return str(path)


@pytest.mark.parametrize("partition_by", [[], ["Year"]])
def test_all_jobs(spark, raw, zones_csv, tmp_path, capsys, partition_by):  # noqa: F811
    table = f"cleaned_{len(partition_by)}"
    argv = ["run", "--months", raw, "--years", "2022:3", "2025:2", "--zones", zones_csv]
    argv += ["--staged", f"{tmp_path}/staged", "--cleaned", f"{tmp_path}/cleaned", "--table", table]
    cli.main([*argv, "--partition-by", *partition_by], spark)
    assert "'staged_rows': 10, 'cleaned_rows': 10" in capsys.readouterr().out
    cleaned = spark.table(table)
    assert set(cleaned.columns) == set(CLEAN.names)
    assert cleaned.count() == 10 and cleaned.filter("Pickup_Borough = 'EWR'").count() == 10
    spark.sql(f"DROP TABLE {table}")


def test_jobs_one_by_one_and_again(spark, raw, zones_csv, tmp_path, capsys):  # noqa: F811
    staged, cleaned = f"{tmp_path}/staged", f"{tmp_path}/cleaned"
    for _ in range(2):  # a rerun overwrites and gives the same
        cli.main(["stage", "--months", raw, "--years", "2025:2", "--staged", staged], spark)
        cli.main(["clean", "--staged", staged, "--zones", zones_csv, "--cleaned", cleaned], spark)
        cli.main(["register", "--cleaned", cleaned, "--table", "step_by_step"], spark)
        assert spark.table("step_by_step").count() == 4
    cli.main(["copy", "--source", cleaned, "--target", f"{tmp_path}/copy"], spark)
    said = capsys.readouterr().out
    assert said.count("staged 4 rows") == 2 and said.count("cleaned 4 rows") == 2
    assert "copied 4 rows" in said
    spark.sql("DROP TABLE step_by_step")


def test_a_known_mean_gives_the_same_and_saves_a_scan(spark, make_trips, zones, tmp_path):
    from tests.conftest import plan_of
    from tripmetrics.plans.jobs import clean, stage_observed
    from tripmetrics.sources import read_staged

    make_trips({}, {"tip_amount": None}, {"tip_amount": 5.0}).write.parquet(f"{tmp_path}/raw")
    seen = stage_observed(spark, [f"{tmp_path}/raw"], f"{tmp_path}/staged")
    assert seen == {"rows": 3, "mean_tip": 3.5}
    staged = read_staged(spark, f"{tmp_path}/staged")
    known, unknown = clean(staged, zones, seen["mean_tip"]), clean(staged, zones)
    plan = plan_of(known)
    assert plan.count("FileScan") == 1 and "Subquery" not in plan
    assert sorted(known.collect()) == sorted(unknown.collect())
