"""Connected components of a graph given by its links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as f

from tripmetrics.sources.shared import store


def component_labels(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of ``links`` (a, b).

    Each round points every node to its smallest neighbour or itself and follows the pointers
    to their ends, which are then the nodes of a smaller graph; links inside one of them
    vanish. A hub's neighbours are combined before the exchange (a minimum), and joins on a
    hub can be split. Rounds end when no link is left; each is written, so a lost executor
    repeats a round at most. Null ends and self-links are dropped.
    """
    edges = links.filter("a <> b").select("a", "b")
    rounds: list[DataFrame] = []
    while True:
        both = edges.union(edges.select(f.col("b").alias("a"), f.col("a").alias("b")))
        pointers = store(
            both.groupBy(f.col("a").alias("node")).agg(f.min("b").alias("least"))
            .select("node", f.least("node", "least").alias("to")),
            "pointers",
        )
        if pointers.isEmpty():
            break
        pointers = follow(pointers)
        rounds.append(pointers)
        # each end of a link is replaced in its own join
        first = pointers.select(f.col("node").alias("a"), f.col("to").alias("to_a"))
        second = pointers.select(f.col("node").alias("b"), f.col("to").alias("to_b"))
        edges = store(
            edges.join(first, "a")
            .join(second, "b")
            .filter("to_a <> to_b")
            .select(f.least("to_a", "to_b").alias("a"), f.greatest("to_a", "to_b").alias("b"))
            .distinct(),
            "edges",
        )
    if not rounds:
        return links.select(f.col("a").alias("node"), f.col("a").alias("label")).limit(0)

    def deeper(labels: DataFrame, pointers: DataFrame) -> DataFrame:
        ends = pointers.select(f.col("node").alias("label"), f.col("to").alias("end"))
        return labels.join(ends, "label", "left").select(
            "node", f.coalesce("end", "label").alias("label")
        )

    return reduce(deeper, rounds[1:], rounds[0].withColumnRenamed("to", "label"))


def follow(pointers: DataFrame) -> DataFrame:
    """Every node pointing to the end of its chain; the length of chains halves per round."""
    while True:
        target = pointers.select(f.col("node").alias("to"), f.col("to").alias("end"))
        jumped = store(
            pointers.join(target, "to").select("node", f.col("end").alias("to"), "to").toDF(
                "node", "to", "was"
            ),
            "jumped",
        )
        pointers = jumped.select("node", "to")
        if jumped.filter("to <> was").isEmpty():
            return pointers
