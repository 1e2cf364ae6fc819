"""Stage, clean, register: the jobs in their order, and a rerun of some years."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as f

from tripmetrics.functions import exact_mean
from tripmetrics.operators import (
    apply_rules,
    broadcast_if_small,
    derive,
    enrich,
    fill_defaults,
    impute_mean,
    rename,
    trip_rules,
    with_duration,
)
from tripmetrics.schemas import CLEAN
from tripmetrics.sources import (
    add_partitions,
    check_table,
    delete,
    drop_partitions,
    publish_table,
    read_months,
    read_staged,
    read_zones,
    register_table,
    write_observed,
    write_partitions,
)


def stage(spark: SparkSession, paths: list[str], target: str) -> int:
    """Conform and union raw monthly files into one staged table; returns its row count."""
    return stage_observed(spark, paths, target)["rows"]


def stage_observed(spark: SparkSession, paths: list[str], target: str) -> dict[str, Any]:
    """``stage`` with what the cleaning needs to know of all rows: ``rows``, ``mean_tip``."""
    trips = read_months(spark, paths)
    return write_observed(trips, target, mean_tip=exact_mean("tip_amount"))


def prepare(staged: DataFrame, mean_tip: float | None = None) -> DataFrame:
    """Renamed, with duration, nulls filled; nothing dropped yet.

    The mean tip of all rows, if it is known, saves the scan of that column.
    """
    return impute_mean(fill_defaults(with_duration(rename(staged))), "tip_amount", mean_tip)


def tidy(staged: DataFrame, mean_tip: float | None = None) -> DataFrame:
    """The kept trips with derived columns, before the zone joins.

    Enough for every question that does not ask for a zone.
    """
    return derive(apply_rules(prepare(staged, mean_tip), trip_rules()))


def clean(staged: DataFrame, zones: DataFrame, mean_tip: float | None = None) -> DataFrame:
    """Staged trips to the 32-column cleaned table."""
    return enrich(tidy(staged, mean_tip), zones).select(*CLEAN.names)


@dataclass(frozen=True)
class JobConfig:
    """Where everything lies; all paths are URIs.

    ``replace`` allows to drop a table definition of other columns, place or partitions. With
    ``versioned`` the cleaned path holds a folder per run, and the table points at the last
    complete one; nothing is renamed.
    """

    raw_paths: list[str]
    zones_path: str
    staged_path: str
    cleaned_path: str
    table_name: str
    partition_by: list[str] = field(default_factory=list)
    replace: bool = False
    versioned: bool = False


def _cleaned(spark: SparkSession, config: JobConfig, mean_tip: float | None = None) -> DataFrame:
    zones = broadcast_if_small(read_zones(spark, config.zones_path), key="LocationID")
    return clean(read_staged(spark, config.staged_path), zones, mean_tip)


def clean_staged(
    spark: SparkSession, config: JobConfig, mean_tip: float | None = None
) -> int:
    """Clean the staged table into the cleaned one; returns its row count.

    With the mean tip that staging observed, the staged table is read once.
    """
    cleaned = _cleaned(spark, config, mean_tip)
    return write_observed(cleaned, config.cleaned_path, config.partition_by)["rows"]


def run(spark: SparkSession, config: JobConfig) -> dict[str, int]:
    """All jobs in order; returns the row counts. Each can be rerun from its stored input.

    A table definition that does not fit is found before anything is written.
    """
    name, path, folders = config.table_name, config.cleaned_path, config.partition_by
    if not config.versioned:
        check_table(spark, name, path, folders, replace=config.replace)
    staged = stage_observed(spark, config.raw_paths, config.staged_path)
    cleaned = _cleaned(spark, config, staged["mean_tip"])
    if config.versioned:
        written = publish_table(cleaned, name, path, folders)
    else:
        written = write_observed(cleaned, path, folders)
        register_table(
            spark, name, path, folders, replace=config.replace, partitions=written.get("partitions")
        )
    return {"staged_rows": staged["rows"], "cleaned_rows": written["rows"]}


def clean_years(spark: SparkSession, config: JobConfig, years: list[int]) -> dict[str, int]:
    """Clean some years of the staged table again; returns rows, years written, years emptied.

    The cleaned table has a folder per year. Only the folders and partitions of ``years`` change;
    a year without rows loses its own. The mean tip is that of all staged rows, as in a full run.
    """
    if config.partition_by != ["Year"]:
        raise ValueError("years can be cleaned by themselves in a table with a folder per year")
    check_table(spark, config.table_name, config.cleaned_path, ["Year"])
    cleaned = _cleaned(spark, config).filter(f.col("Year").isin(years))
    written = write_partitions(cleaned, config.cleaned_path, ["Year"])
    found = {spec["Year"] for spec in written["partitions"]}
    empty = [year for year in years if year not in found]
    for year in empty:
        delete(spark, f"{config.cleaned_path}/Year={year}")
    if spark.catalog.tableExists(config.table_name):
        drop_partitions(spark, config.table_name, [{"Year": year} for year in empty])
        add_partitions(spark, config.table_name, written["partitions"])
    else:
        register_table(spark, config.table_name, config.cleaned_path, ["Year"])
    return {"rows": written["rows"], "years_written": len(found), "years_emptied": len(empty)}
