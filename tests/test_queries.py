"""Every registered query against its SQL, on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from checks.compare import difference, sql_engine
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return sql_engine(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_the_entry_point_offers_them():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, engine, name):
    assert difference(spark, engine, SF_DIR, name) is None


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"Pickup_Borough", "trip_count", "avg_distance"}


def test_each_rule_is_the_only_reason_for_some_drops(spark):
    from checks.trip_frame import trips
    from pyspark.sql import functions as f
    from tripmetrics.operators import trip_rules
    from tripmetrics.plans.jobs import prepare

    broken = {name: ~f.coalesce(rule, f.lit(False)) for name, rule in trip_rules().items()}
    total = sum(b.cast("int") for b in broken.values())
    counts = (
        prepare(trips(spark, SF_DIR))
        .select(total.alias("broken_rules"), *[b.alias(name) for name, b in broken.items()])
        .filter("broken_rules = 1")
        .agg(*[f.count_if(name).alias(name) for name in broken])
        .first()
    )
    assert len(counts) == 12 and all(counts)


def test_entry_point_without_the_corpus_parts(tmp_path):
    root = Path(entry_point.__file__).parent
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(root, tmp_path / "repo", ignore=left_out)
    code = "import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql()"
    said = subprocess.run(
        [sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True
    )
    assert said.stdout.split() == list(QUERIES), said.stderr


def test_entry_point_without_a_library_of_the_corpus_parts():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql()"
    )
    root = Path(entry_point.__file__).parent
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True)
    assert said.stdout.split() == list(QUERIES), said.stderr
    assert "public_tokenizers" in said.stderr
