from collections import defaultdict

import pytest
from pyspark.sql import functions as f

from tests.llm.conftest import TEXTS
from tripmetrics.llm.exact_dedup import chunks, deduplicate, keep_one, normalised

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups():
    found = defaultdict(list)
    for i, text in TEXTS:
        found[(text or "").translate(LOWER)].append(i)
    return found


@pytest.mark.parametrize("identify", [f.xxhash64, lambda chunk: f.crc32(chunk) % 2])
def test_groups(odd_docs, identify):
    """Also with identifiers that stand for many chunks each."""
    rows = deduplicate(odd_docs, lambda chunk: identify(chunk)).collect()
    assert len(rows) == len(TEXTS)
    known = [i for i, _ in TEXTS if i is not None]
    by_id = {row.doc_id: row for row in rows}
    for ids in groups().values():
        best = max((i for i in ids if i is not None), default=None)
        for i in set(ids) & set(known):
            assert (by_id[i].keep_id, by_id[i].group_size) == (best, len(ids))
    kept = [row for row in rows if row.kept]
    assert len(kept) == len(groups())  # one row a group, of repeated rows too


def test_rows_that_stay_keep_all_columns(odd_docs):
    rows = keep_one(odd_docs)
    assert rows.columns == odd_docs.columns and rows.count() == len(groups())


def test_chunks_are_the_text(odd_docs):
    text = normalised("text")
    joined = odd_docs.filter(f.array_join(chunks(text), "") != text)
    assert joined.count() == 0
    assert odd_docs.filter("doc_id = 7").select(f.size(chunks(text))).first()[0] > 20


def test_an_insertion_changes_few_chunks(spark, dice):
    words = [dice.choice("the of and to in is that for it as was".split()) for _ in range(8000)]
    one, other = " ".join(words), "inserted " + " ".join(words)
    row = spark.createDataFrame([(one, other)], "a string, b string").select(
        f.size(f.array_except(chunks(f.col("b")), chunks(f.col("a")))).alias("new"),
        f.size(chunks(f.col("a"))).alias("all"),
    )
    assert row.first()["new"] <= 0.3 * row.first()["all"]


def test_no_documents(no_docs):
    assert deduplicate(no_docs).count() == 0 and keep_one(no_docs).count() == 0
