"""Spelling variants against all pairs."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import SF_DIR, TEXTS
from tripmetrics.llm import spelling
from tripmetrics.llm.queries import QUERIES

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_counts(docs, every=97):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    by_length = defaultdict(list)
    for word in counts:
        by_length[len(word)].append(word)
    near = defaultdict(list)
    for word in counts:
        for size in (len(word), len(word) + 1):
            for other in by_length[size]:
                if (len(other) > len(word) or other > word) and one_edit(word, other):
                    near[word].append(other)
                    near[other].append(word)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o))
        if counts[best] >= 2 * counts[word]:
            form[word] = best
    rows = set()
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        rows.add((word, form.get(word), root, n, len(near[word]), counts.get(form.get(word))))
    return rows


def test_odd_documents(odd_docs, no_docs):
    found = spelling.word_counts(odd_docs, min_count=1).collect()
    every = Counter()
    for doc_id, text in TEXTS:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            every[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    assert {r.word: r.n for r in found} == {w: n for w, n in every.items() if len(w) >= 5}
    rows = spelling.group_variants(odd_docs).select(*COLUMNS).collect()
    assert {tuple(r) for r in rows} == plain_variants(plain_counts(TEXTS)) and rows
    assert spelling.group_variants(no_docs).count() == 0


def test_long_texts_and_full_counters(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    docs = [(i, "Abcdefgh abcdefgh " * (i + 1) + f"×ÉCOLE word{i} Ābcde") for i in range(40)]
    rows = spelling.word_counts(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.word: r.n for r in rows} == plain_counts(docs)


def test_words_of_few_letters(spark, dice):
    """Many near words, insertions into runs of a letter, ties in n, chains of forms."""
    words = {"".join(dice.choice("aabé") for _ in range(dice.randint(5, 9))): dice.choice([3, 3, 4, 8, 20, 50]) for _ in range(1500)}
    words |= {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "zzzzz": 3, "zzzzy": 3}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(4)
    rows = [tuple(r) for r in spelling.variants(frame).select(*COLUMNS).collect()]
    assert len(rows) == len(words) and set(rows) == plain_variants(words)
    pairs = spelling.near_pairs(frame)
    assert pairs.count() == pairs.distinct().count()


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op13_spelling_variants"](spark, SF_DIR)
    assert found.dtypes == [(c, "string" if c in ("word", "form", "root") else "bigint") for c in COLUMNS]
    rows = [tuple(r) for r in found.collect()]
    expected = plain_variants(plain_counts(docs))
    assert len(rows) == len(expected) and set(rows) == expected


@pytest.mark.parametrize("words", [[], [("onlyone", 5)]])
def test_few_words(spark, words):
    rows = spelling.variants(spark.createDataFrame(words, "word string, n bigint")).collect()
    assert [tuple(r) for r in rows] == [(w, None, w, n, 0, None) for w, n in words]
