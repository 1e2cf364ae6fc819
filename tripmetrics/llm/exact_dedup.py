"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A normalised text is cut where its own characters say so, so equal passages give equal chunks
wherever they stand. Chunks are deduplicated to identifiers; the identifiers are verified by
counting the different chunks behind each. A document is then the ordered list of its chunk
identifiers, and documents are compared by these lists: the chunks move through one exchange,
once each and combined before it, and no document moves at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.sources.shared import store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A chunk ends, after 384 characters at least, with a line, a clause or a short word before
# certain letters, and after 4096 in any case.
CHUNK = r"(?s).{384,4096}?(?:\n|[.,;:!?] (?=[a-m])|[aeinrst] (?=[b-f]))|.{1,4096}"

Identify = Callable[[Column], Column]


def two_hashes(chunk: Column) -> Column:
    """128 bits, so that no two of the chunks of a very large corpus are likely to share them."""
    return f.struct(f.xxhash64(chunk).alias("a"), f.xxhash64(chunk, f.lit(1)).alias("b"))


def normalised(text: Column | str) -> Column:
    """``text`` with A-Z in lower case and null as empty."""
    text = f.col(text) if isinstance(text, str) else text
    return f.translate(f.coalesce(text, f.lit("")), UPPER, UPPER.lower())


def chunks(text: Column) -> Column:
    """The chunks of ``text``, in order; together they are the text. Empty: none."""
    return f.regexp_extract_all(text, f.lit(CHUNK), f.lit(0))


def ambiguous(texts: DataFrame, identify: Identify) -> DataFrame:
    """Identifiers that stand for more than one chunk of column ``norm``.

    Equal chunks are combined before they move, so a chunk that most documents share costs a
    row per task.
    """
    chunk = texts.select(f.explode(chunks(f.col("norm"))).alias("chunk"))
    distinct = chunk.select(identify(f.col("chunk")).alias("chunk_id"), "chunk").distinct()
    return distinct.groupBy("chunk_id").count().filter("count > 1").select("chunk_id")


def deduplicate(docs: DataFrame, identify: Identify = two_hashes) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 (and ``__row``).

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty
    texts equal each other. The row with the largest doc_id stays (null is the smallest; of
    repeated doc_ids the last row by number), one row a group. ``__row`` is the column of that
    name if ``docs`` has one, else a number given here. Other columns are not read. An empty
    table gives an empty result.

    ``identify`` maps a chunk to a cheap identifier, by default of 128 bits. If any identifier stands for two chunks,
    SHA-256 identifiers are used for all of them instead.
    """
    row_no = "__row" if "__row" in docs.columns else f.monotonically_increasing_id()
    texts = docs.select(
        f.col("doc_id"),
        (f.col(row_no) if isinstance(row_no, str) else row_no).alias("__row"),
        normalised("text").alias("norm"),
    )
    verified = identify
    if not store(ambiguous(texts, identify), "ambiguous").isEmpty():
        verified = lambda chunk: f.sha2(chunk, 256)
    recipes = store(
        texts.select(
            "doc_id",
            "__row",
            f.sha2("norm", 256).alias("text_sha256"),
            f.transform(chunks(f.col("norm")), lambda chunk: verified(chunk)).alias("recipe"),
        ),
        "recipes",
    )
    # Only groups with copies are joined back. A hot group is combined before the exchange;
    # stored, the groups leave the join's document side free to be split.
    groups = store(
        recipes.groupBy("recipe")
        .agg(
            f.max(f.struct(f.col("doc_id"), f.col("__row"))).alias("keep"),
            f.count("*").alias("group_size"),
        )
        .filter("group_size > 1"),
        "groups",
    )
    return recipes.join(groups, "recipe", "left").select(
        "doc_id",
        f.when(f.col("keep").isNull(), f.col("doc_id"))
        .otherwise(f.col("keep.doc_id"))
        .alias("keep_id"),
        f.coalesce("group_size", f.lit(1)).cast("bigint").alias("group_size"),
        (f.col("keep").isNull() | (f.col("keep.__row") == f.col("__row"))).alias("kept"),
        "text_sha256",
        "__row",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay; all its columns."""
    numbered = store(docs.withColumn("__row", f.monotonically_increasing_id()), "numbered")
    kept = deduplicate(numbered).filter("kept").select("__row")
    return numbered.join(kept, "__row", "left_semi").select(*docs.columns)
