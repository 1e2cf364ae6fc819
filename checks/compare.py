"""Run queries next to their SQL: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.registry import QUERIES
from tripmetrics.session import get_session


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


# Spark type -> type of the SQL engine.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark: SparkSession, engine, sf_dir: str, name: str) -> str | None:
    """What differs for one query as a bag of typed rows, or None."""
    return frame_difference(QUERIES[name](spark, sf_dir), engine, ORACLE[name])


def frame_difference(frame: DataFrame, engine, sql: str) -> str | None:
    """What differs between a frame and a SQL text."""
    engine.execute(f"CREATE OR REPLACE TEMP TABLE expected AS {sql}")
    described = engine.execute("SELECT * FROM expected LIMIT 0").description
    expected_types = {column[0]: str(column[1]) for column in described}
    types = {field.name: TYPES[field.dataType.simpleString()] for field in frame.schema}
    if types != expected_types:
        return f"types {sorted(types.items() ^ expected_types.items())}"
    engine.register("found", frame.toArrow())
    columns = ", ".join(sorted(types))
    extra, missing = (
        engine.execute(
            f"SELECT {columns} FROM {one} EXCEPT ALL SELECT {columns} FROM {other}"
        ).fetchall()
        for one, other in (("found", "expected"), ("expected", "found"))
    )
    if extra or missing:
        return f"{len(extra)} extra {extra[:2]}, {len(missing)} missing {missing[:2]}"
    return None


def main(sf_dir: str, *names: str) -> int:
    settings = {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8"}
    settings |= {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = get_session("compare", settings)
    spark.sparkContext.setLogLevel("ERROR")
    engine = sql_engine(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.monotonic()
        problem = difference(spark, engine, sf_dir, name)
        failed += problem is not None
        print(f"{name:26} {time.monotonic() - start:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
