"""Spelling variants: frequent words one edit apart, joined by asymmetric chunks.

A word is cut into two disjoint chunks, and each chunk into two parts. One edit leaves one chunk
and, of the other chunk, one part as they are: of the four parts three are preserved. So the
shorter (or equal) word of a pair contributes its parts with one left out, four keys, and the
longer one all grams that can lie around such a gap. A gram left of the edit is where it was, one
right of it is shifted by the difference of the lengths, which is none or one; other shifts need
no key. Pairs that meet at a key differ only in the gap, and the gap is verified.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.components import follow
from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

MIN_LENGTH = 5
MIN_COUNT = 3
#: A run whose checksum with its document this divides loses a code point, as a typing error.
ERROR_EVERY = 97
#: Distinct words that a task counts before it passes the counts on.
COUNTED_AT_ONCE = 100_000
LONG_TEXT = 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")
PARTS = 4


def _words(doc_id: str, text: str, error_every: int) -> Iterator[tuple[str, int]]:
    """Words of a text with their number, after the planted errors."""
    lowered = text.encode("utf-8").lower().decode("utf-8")  # of bytes, only A-Z have a lower case
    if len(lowered) < LONG_TEXT:
        runs = Counter(_RUN.findall(lowered))
    else:
        runs = Counter(match.group() for match in _RUN.finditer(lowered))
    start = crc32(f"{doc_id}:".encode())
    for word, n in runs.items():
        h = crc32(word.encode("utf-8"), start)
        if h % error_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def word_counts(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    error_every: int = ERROR_EVERY,
) -> DataFrame:
    """word, n: words of at least ``min_length`` letters that all texts together hold ``min_count``
    times. A null text has none, a null doc_id counts as empty. Repeated rows count each.

    Tasks send a row per word and some 100,000 distinct words, so frequent ones cost little.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def batch_of() -> pa.RecordBatch:
            words = pa.array(list(counts.keys()), pa.string())
            numbers = pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, numbers], names=["word", "n"])

        for batch in batches:
            ids = pc.fill_null(batch.column("doc_id"), "")
            for doc_id, text in zip(ids, batch.column("text")):
                if not text.is_valid:
                    continue
                for word, n in _words(doc_id.as_py(), text.as_py(), error_every):
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= COUNTED_AT_ONCE:
                    yield batch_of()
        yield batch_of()

    ship(docs.sparkSession)
    rows = docs.select(f.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(f.sum("n").alias("n"))
    return counted.filter(f.col("n") >= min_count)


def _keyed(words: DataFrame, size: Column, part: int) -> DataFrame:
    """Each word with part ``part`` left out, for partners of length ``size``: the chunk side if that
    is the word's own length, else the gram side with one letter more in the gap."""
    half = f.floor(size / 2).cast("int")
    first, second = f.floor(half / 2).cast("int"), f.floor((size - half) / 2).cast("int")
    cuts = [f.lit(0), first, half, half + second, size]
    start, end = cuts[part], cuts[part + 1]
    gap = end - start + f.length("word") - size
    return words.select(
        size.cast("int").alias("size"),
        f.lit(part).alias("part"),
        f.substring(f.col("word"), f.lit(1), start).alias("before"),
        f.substring(f.col("word"), start + gap + 1, f.length("word")).alias("after"),
        f.substring(f.col("word"), start + 1, gap).alias("gap"),
        "n",
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """short, short_n, long, long_n: each pair of words one edit apart, once.

    ``words`` has distinct words (3 letters at least) and n. A pair of equal length meets at the part
    that differs. With an inserted letter it may meet at several; it counts at the one where the words
    first differ, so pairs need no further exchange. Hot keys are a join's, and can be split.
    """
    length = f.length("word")
    chunks = _union([_keyed(words, length, part) for part in range(PARTS)])
    grams = _union([_keyed(words, length - 1, part) for part in range(PARTS)])
    keys = ["size", "part", "before", "after"]
    one_edit = f.levenshtein("gap", "gap_b", 1) == 1
    first_here = (f.col("part") == PARTS - 1) | ~f.col("gap_b").startswith(f.col("gap"))

    def met(partners: DataFrame, verified: Column) -> DataFrame:
        partners = partners.withColumnsRenamed({c: f"{c}_b" for c in partners.columns})
        on = [f.col(key) == f.col(f"{key}_b") for key in keys]
        return chunks.join(partners, [*on, verified]).select(
            f.concat("before", "gap", "after").alias("short"),
            f.col("n").alias("short_n"),
            f.concat("before", "gap_b", "after").alias("long"),
            f.col("n_b").alias("long_n"),
        )

    replaced = met(chunks, (f.col("gap") < f.col("gap_b")) & one_edit)
    return replaced.union(met(grams, one_edit & first_here))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for more in frames[1:]:
        result = result.union(more)
    return result


def variants(words: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (of equal ones the smallest by code points) if that is at
    least twice the word's, else null. Forms double n at each step, so following them ends; ``root``
    is the last, or the word itself. Words in ``words`` are distinct; none, no rows.
    """
    words = store(words, "words")
    pairs = store(near_pairs(words), "near_pairs")
    both = pairs.select(
        f.col("short").alias("word"), f.col("long").alias("near"), f.col("long_n").alias("near_n")
    ).union(pairs.select("long", "short", "short_n"))
    best = both.groupBy("word").agg(
        f.count("*").alias("n_near"),
        f.min(f.struct((-f.col("near_n")).alias("order"), f.col("near"))).alias("best"),
    )
    taken = -f.col("best.order") >= 2 * f.col("n")
    judged = store(
        words.join(best, "word", "left").select(
            "word",
            f.when(taken, f.col("best.near")).alias("form"),
            "n",
            f.coalesce("n_near", f.lit(0)).cast("bigint").alias("n_near"),
            f.when(taken, -f.col("best.order")).alias("form_n"),
        ),
        "variants",
    )
    # words without a form that others follow point to themselves
    variant = judged.filter("form is not null")
    ends = variant.select(f.col("form").alias("node")).distinct().join(
        judged.filter("form is null").select(f.col("word").alias("node")), "node", "left_semi"
    )
    pointers = variant.select(f.col("word").alias("node"), f.col("form").alias("to")).union(
        ends.select("node", f.col("node").alias("to"))
    )
    roots = follow(store(pointers, "forms")).select(f.col("node").alias("word"), f.col("to").alias("root"))
    return judged.join(roots, "word", "left").select(
        "word", "form", f.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the frequent words of all texts."""
    return variants(word_counts(docs))
