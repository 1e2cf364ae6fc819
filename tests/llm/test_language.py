import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as f

from tests.llm.conftest import SF_DIR, TEXTS
from tripmetrics.llm.language import _sparse, fit, fit_documents, held_out, predict, trigram_counts
from tripmetrics.llm.queries import op5_language_id

SENTENCES = {
    "en": "the house of the king is in the middle of the town and they went there with him",
    "de": "das haus des königs ist in der mitte der stadt und sie gingen mit ihm dorthin",
    "xx": "kzkz qwqw zkzk wqwq kzqw zqwk qkwz wzkq kkzz wwqq zzkk qqww kzwq",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, lang, text) for i in range(40) for lang, text in SENTENCES.items()]
    rows += [(i, None, "unlabelled") for i in range(9)] + [(i, "en", None) for i in range(9)]
    return fit(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), 20, 2)


def test_learns_what_it_was_given(spark, model):
    assert model.languages == ["de", "en", "xx"]
    rows = [(SENTENCES["de"],), ("the town and the king",), ("ЖЖЖЖ ЩЩЩЩ ЖЩЖЩЖ ЩЖЩЖ",), ("123 !",), (None,)]
    found = predict(spark.createDataFrame(rows, "text string"), model).collect()
    assert [r.lang_pred for r in found][:2] == ["de", "en"]
    assert [r.rejected for r in found] == [False, False, True, True, True]
    assert [r.lang_pred for r in found][3:] == ["und", "und"]
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_documents(odd_docs):
    rows = predict(odd_docs, fit_documents(odd_docs)).collect()
    assert len(rows) == len(TEXTS)
    assert all((r.lang_pred == "und") == (not trigram_counts(r.text).any()) for r in rows)


def test_nothing_to_learn_from(spark, odd_docs, no_docs):
    model = fit_documents(no_docs)
    assert {(r.lang_pred, r.score) for r in predict(odd_docs, model).collect()} == {("und", 0.0)}
    assert predict(no_docs, model).count() == 0


def test_a_null_id_is_not_held_out(odd_docs):
    assert odd_docs.filter(held_out() & f.col("doc_id").isNull()).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = op5_language_id(spark, SF_DIR).filter("held_out").join(docs, "doc_id")
    right = found.agg(f.avg((f.col("lang") == f.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.95


def test_sample_is_held_sparse():
    """A sampled text takes what its trigrams take, not a count per bucket."""
    texts = [f"{SENTENCES['en']} {n}" for n in range(1000)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    tracemalloc.start()
    (found,) = _sparse(iter([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 << 20
    for text, row in zip(texts, found.to_pylist()):
        counts = trigram_counts(text)
        assert row["buckets"] == counts.nonzero()[0].tolist()
        assert row["counts"] == counts[row["buckets"]].tolist()
