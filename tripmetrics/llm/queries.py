"""The operators bound to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as f

from tripmetrics.llm import (
    bpe,
    conversations,
    exact_dedup,
    language,
    licenses,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    spelling,
    urls,
    warc,
)
from tripmetrics.llm.oracle import ORACLE
from tripmetrics.sources.shared import shared_path, store

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, their digest, and the digest of what they decode to."""
    encoded = bpe.encode(
        documents(spark, sf_dir).select("doc_id", "text"), RANKS, public_tokenizers.PATTERN
    )
    return bpe.decode(encoded.drop("text"), RANKS).select(
        "doc_id",
        (f.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        f.sha2("ids", 256).alias("ids_sha256"),
        f.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_dedup.deduplicate(documents(spark, sf_dir)).drop("__row")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = shared_path(spark, "archives")
    warc.write_archives(warc.page_records(pages), path)
    return warc.page_rows(warc.read_archives(spark, path))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    texts = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return language.predict(texts, language.fit_documents(docs)).drop("text")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return licenses.scan(documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, placed in a sequence."""
    return packing.pack(packing.tokenise(documents(spark, sf_dir), WORDS, with_ids=False))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict for every document."""
    return quality.assess(documents(spark, sf_dir)).drop("clean_text")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of secrets in every document."""
    candidates = store(secrets.find_candidates(documents(spark, sf_dir)), "candidates")
    found = secrets.scan_candidates(candidates, secrets.fit_candidates(candidates))
    return found.select(
        "doc_id",
        "n_candidates",
        f.size("secrets").cast("bigint").alias("n_secrets"),
        f.array_join(
            f.transform("secrets", lambda s: f.concat_ws(":", s.start, s.end)), ","
        ).alias("spans"),
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.detect(docs, pii.fit(docs)).drop("text")
    kinds = f.transform("base_spans", lambda s: s.kind)
    counts = [
        (f.size(kinds) - f.size(f.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        f.sha2(pii.listed("base_spans"), 256).alias("base_sha256"),
        pii.listed("all_spans").alias("spans"),
    )


URL_RULES = [
    ("com", "/", urls.ALLOW),
    ("example.com", "/en/", urls.BLOCK),
    ("www.example.com", "/en/", urls.ALLOW),
    ("net", "/es/", urls.BLOCK),
    ("net", "/fr/", urls.BLOCK),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, urls.RULES)
    return urls.judge(pages, rules).drop("url")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversations.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their near words, forms and roots."""
    return spelling.group_variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_warc": op3_warc,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_personal_data": op10_personal_data,
    "op11_url_filter": op11_url_filter,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
