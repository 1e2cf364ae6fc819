"""Command line of the jobs; paths are URIs, credentials come from the Spark configuration."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from tripmetrics.plans.jobs import JobConfig, clean_staged, clean_years, run, stage
from tripmetrics.session import get_session
from tripmetrics.sources import copy_parquet, month_paths, register_table


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="run_trips.py", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *options: str) -> None:
        sub = jobs.add_parser(name, help=about)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        if "months" in options:
            sub.add_argument("--years", nargs="+", required=True, help="YEAR:LAST_MONTH ...")
        if "cleaned" in options:
            sub.add_argument("--partition-by", nargs="*", default=[])
        if "table" in options:
            sub.add_argument("--replace", action="store_true", help="drop a definition that differs")
        if name == "run":
            sub.add_argument("--versioned", action="store_true", help="a folder a run, no renames")
        if name == "update":
            sub.add_argument("--only-years", nargs="+", type=int, required=True, metavar="YEAR")

    job("stage", "conform and union monthly files", "months", "staged")
    job("clean", "clean and enrich the staged table", "staged", "zones", "cleaned")
    job("register", "make the cleaned files a SQL table", "cleaned", "table")
    job("run", "all three in order", "months", "staged", "zones", "cleaned", "table")
    job("update", "clean some years again", "staged", "zones", "cleaned", "table")
    job("copy", "copy a parquet file or folder", "source", "target")
    return root


def _raw_paths(args: argparse.Namespace) -> list[str]:
    last_months = [map(int, item.split(":")) for item in args.years]
    return [p for year, last in last_months for p in month_paths(args.months, year, last)]


def _config(args: argparse.Namespace) -> JobConfig:
    return JobConfig(
        raw_paths=_raw_paths(args) if "months" in args else [],
        zones_path=args.zones,
        staged_path=args.staged,
        cleaned_path=args.cleaned,
        table_name=getattr(args, "table", ""),
        partition_by=args.partition_by,
        replace=getattr(args, "replace", False),
        versioned=getattr(args, "versioned", False),
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or get_session(f"trips-{args.job}")
    if args.job == "stage":
        print(f"staged {stage(spark, _raw_paths(args), args.staged)} rows")
    elif args.job == "clean":
        print(f"cleaned {clean_staged(spark, _config(args))} rows")
    elif args.job == "register":
        register_table(
            spark, args.table, args.cleaned, args.partition_by, replace=args.replace
        )
        print(f"registered {args.table}")
    elif args.job == "run":
        print(run(spark, _config(args)))
    elif args.job == "update":
        print(clean_years(spark, replace(_config(args), partition_by=["Year"]), args.only_years))
    else:
        print(f"copied {copy_parquet(spark, args.source, args.target)} rows")
