import re

import pytest

from tests.llm.conftest import TEXTS
from tripmetrics.llm import pii


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def plain_spans(text):
    """The base kinds by Python's own expressions."""
    out = []
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    for rank, (kind, pattern, good) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            if good(m[0]):
                out.append((m.start(), rank, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def spans(rows, column="base_spans"):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r[column]] for r in rows}


@pytest.fixture(scope="module")
def learned(spark):
    rows = []
    for i in range(400):
        kind = i % 5
        value = [f"m{i}@x.org", f"10.0.{i % 256}.7", "4111 1111 1111 1111", f"+1 (555) 123-{1000 + i}", f"version {i}.0"][kind]
        rows.append((i, f"some words before {value} and after, 3. of {i % 90} items"))
    for i in range(200):
        number = [f"4111 1111 1111 {1113 + 7 * i}", f"555-12{i % 10}-45{i % 90 + 10}", f"41111111{10**7 + i}"][i % 3]
        said = ["some words before", "my card number", "her phone:", "then"][i % 4]
        rows.append((1000 + i, f"{said} {number} and after, 3. of {i % 90} items"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return pii.fit(docs)


def test_base_spans_by_brute_force(spark, learned, dice):
    parts = ["a@b.c", "@", ".", "1", "22", "255", "256", " ", "-", "+1", "(555)", "x", "é", "🙂",
             "4111111111111111", "4111-1111 1111-1111", "10.0.0.1", "_", "+49 30 1234567", "d.e", "\n"]
    texts = ["".join(dice.choice(parts) for _ in range(dice.randint(0, 30))) for _ in range(600)]
    texts += ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "1" * 40_000, "a" * 40_000 + "@", "+1" + "(" * 40_000, "1 " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    found = pii.detect(docs, learned).collect()
    assert spans(found) == {i: plain_spans(text) for i, text in enumerate(texts)}
    for row in found:
        assert set(spans([row])[row.doc_id]) <= set(spans([row], "all_spans")[row.doc_id])


def test_proposals_come_on_top(spark, learned):
    assert learned.thresholds
    text = "my card 4111 1111 1111 1112 and after, 3. of 7 items and nothing else"
    docs = spark.createDataFrame([(1, text), (2, "clean words, 3. of 7 items, version 2.0")], "doc_id bigint, text string")
    found = spans(pii.detect(docs, learned).collect(), "all_spans")
    assert ("other", 8, 27) in found[1] and found[2] == []


def test_numbers_that_fail_their_check_need_a_telling_word(spark, learned):
    """Calibration looks at what is added: without context such a number stays."""
    texts = [
        "some words before 4111 1111 1111 1112 and after", "some words before 4111111111111112 and after",
        "the card number 4111 1111 1111 1112 and after", "card: 4111111111111112 and after",
        "phone 555-123-4567 and after", "some words before 555-123-4567 and after", "call no. 5551234567",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = spans(pii.detect(docs, learned).collect(), "all_spans")
    assert [len(found[i]) > 0 for i in range(len(texts))] == [False, False, True, True, True, False, True]
    for total, right in learned.added.values():
        assert right >= pii.PRECISION * total
    assert sum(total for total, _ in learned.added.values()) > 0


def test_redaction(spark, learned):
    text = "é mail a@b.co, 10.0.0.1 and +1 (555) 123-4567!"
    docs = spark.createDataFrame([(1, text, "k"), (2, None, "k"), (3, "clean", "k")], "doc_id bigint, text string, kind string")
    rows = pii.redact(docs, learned).orderBy("doc_id").collect()
    assert rows[0].text == "é mail [EMAIL], [IP] and [PHONE]!"
    assert rows[1].text is None and rows[2].text == "clean" and rows[0].kind == "k"


def test_odd_documents(odd_docs, no_docs):
    model = pii.fit(odd_docs)
    rows = pii.detect(odd_docs, model).collect()
    assert len(rows) == len(TEXTS)
    found = sorted(str([(s.kind, s.start, s.end) for s in r.base_spans]) for r in rows)
    assert found == sorted(str(plain_spans(t or "")) for _, t in TEXTS)
    assert pii.fit(no_docs).trees is None
    assert pii.detect(no_docs, model).count() == 0
    assert pii.redact(odd_docs, pii.Model()).columns == odd_docs.columns


def test_thresholds_come_from_all_spans(spark):
    rows = [(i, f"words before m{i}@x.org and {i} after, version {i}.0 of it") for i in range(300)]
    rows += [(1000, "write 2 jane [at] host [dot] com please")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = pii.fit(docs, 40)
    assert "spelled" in model.thresholds
    found = spans(pii.detect(docs.filter("doc_id = 1000"), model).collect(), "all_spans")
    assert found[1000] == [("other", 8, 32)]


def test_calibration_counts_every_span():
    assert pii._threshold([]) == pii.LEAST_THRESHOLD
    assert pii._threshold([(0.9, 5.0, 5), (0.3, 1.0, 1)]) == 0.3
    assert pii._threshold([(0.95, 99.0, 100), (0.9, 99.0, 100), (0.85, 10.0, 100)]) == 0.9
    assert pii._threshold([(0.9, 1.0, 2)]) is None


def test_one_label_does_not_stop_proposals(spark):
    rows = [(1, "1 x"), (2, "jane [at] host [dot] com 1 x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    personal = spark.createDataFrame([(1, "at @ jane (at) host.com")], "doc_id bigint, text string")
    for some in (docs, personal):
        found = spans(pii.detect(some, pii.fit(some)).collect(), "all_spans")
        assert any(kind == "other" for one in found.values() for kind, _, _ in one)


def test_spelled_addresses_without_digits_are_learned(spark):
    rows = [(i, "write jane [at] host [dot] com please") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    (row,) = pii._labelled(docs).collect()
    assert (row.generator, row.label, row.n) == ("spelled", 1.0, 3)


def test_many_spans_in_one_text(spark, learned):
    """Base spans, proposals and redaction of 100,000 addresses, in time linear in them."""
    import time

    text = "m1@x.org, " * 100_000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    start = time.perf_counter()
    row = pii.detect(docs, learned).selectExpr("size(base_spans) AS base", "size(all_spans) AS whole").first()
    assert row.base == 100_000 and row.whole >= row.base
    assert pii.redact(docs, learned).first().text == "[EMAIL], " * 100_000
    assert time.perf_counter() - start < 120
