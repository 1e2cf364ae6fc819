"""A training corpus from raw documents: five stages, each written and read by the next.

All stages take an empty table (and return one), texts of any length, null ids, repeated rows (each
is a document of its own) and further columns, which pass unchanged until the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as f

from tripmetrics.llm import exact_dedup, language, packing, pii, simhash
from tripmetrics.llm.queries import WORDS
from tripmetrics.sources.shared import store


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model, learned from them, does not reject.

    Texts without a letter, null ones among them, have no language and go."""
    predicted = language.predict(docs, language.fit_documents(docs))
    return predicted.filter(~f.col("rejected")).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id; null and empty texts are equal."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints, the document with the smallest doc_id (null if there is no other)."""
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind, n_chars counted anew (null: null)."""
    redacted = pii.redact(docs, pii.fit(docs))
    return redacted.withColumn("n_chars", f.length("text").cast("bigint")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document left, placed in a sequence; a null text is its end alone."""
    return packing.pack(packing.tokenise(docs, WORDS, with_ids=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Languages, fingerprints, boosted trees and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
