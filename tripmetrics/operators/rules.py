"""The quality rules and what is counted with them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.schemas import NON_NEGATIVE, RANGES


def trip_rules() -> dict[str, Column]:
    """The twelve rules a kept trip satisfies, by name.

    They are tried in this order; the duration, which has to be computed, comes last.
    """

    def in_range(name: str) -> Column:
        return f.col(name).between(*RANGES[name])

    return {
        "passenger_count_range": in_range("passenger_count"),
        "trip_distance_range": in_range("trip_distance"),
        "distinct_zones": f.col("Pickup_Location_ID") != f.col("Dropoff_Location_ID"),
        **{f"{name}_not_negative": f.col(name) >= 0 for name in NON_NEGATIVE},
        "trip_duration_min_range": in_range("trip_duration_min"),
    }


def all_hold(rules: dict[str, Column]) -> Column:
    return reduce(and_, rules.values())


def apply_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows for which every rule is true; a null in any tested column drops the row."""
    return df.filter(all_hold(rules))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows ``apply_rules`` drops."""
    return df.filter(~f.coalesce(all_hold(rules), f.lit(False)))


def spot_check(df: DataFrame) -> DataFrame:
    """Rows with no passenger, too far or too long; none should be left after cleaning."""
    return df.filter(
        (f.col("passenger_count") == 0)
        | (f.col("trip_distance") > RANGES["trip_distance"][1])
        | (f.col("trip_duration_min") > RANGES["trip_duration_min"][1])
    )


def cleaning_report(before: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows before, kept and dropped, and the percentage dropped, in one pass."""
    counts = before.agg(
        f.count("*").alias("original_count"),
        f.count_if(all_hold(rules)).alias("kept_count"),
    )
    dropped = f.col("original_count") - f.col("kept_count")
    percent = f.lit(100.0) * dropped / f.nullif(f.col("original_count"), f.lit(0))
    return counts.select(
        "original_count",
        "kept_count",
        dropped.alias("dropped_count"),
        f.round(percent, 2).alias("dropped_pct"),
    )


def rule_rejects(before: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Per rule: rows that fail it, and rows that fail no other; one aggregate for all rules.

    Columns: ``rule, failing, failing_only``. A null in a tested column fails its rule.
    """
    failed = [~f.coalesce(rule, f.lit(False)) for rule in rules.values()]
    flags = before.select(f.array(*failed).alias("failed")).withColumn(
        "failures", f.size(f.filter("failed", lambda flag: flag))
    )
    counts = []
    for place in range(len(rules)):
        fails = f.col("failed")[place]
        counts.append(f.count_if(fails).alias(f"failing_{place}"))
        counts.append(f.count_if(fails & (f.col("failures") == 1)).alias(f"only_{place}"))
    rows = [
        f.struct(
            f.lit(name).alias("rule"),
            f.col(f"failing_{place}").alias("failing"),
            f.col(f"only_{place}").alias("failing_only"),
        )
        for place, name in enumerate(rules)
    ]
    return flags.agg(*counts).select(f.inline(f.array(*rows)))
