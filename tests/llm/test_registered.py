"""The registered queries, column names and types included, against plain versions."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tests.llm.conftest import SF_DIR
from tests.llm.test_packing import check_sequences
from tests.llm.test_pii import plain_spans
from tripmetrics.llm.queries import QUERIES, RANKS, WORDS


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {row.doc_id: row for row in rows}


def found(spark, name, columns):
    frame = QUERIES[name](spark, SF_DIR)
    assert dict(frame.dtypes).items() >= columns.items()
    return frame.collect()


def test_op1(spark, docs):
    columns = {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = found(spark, "op1_byte_bpe", columns)
    assert len(rows) == len(docs)
    for row in rows:
        text = docs[row.doc_id].text or ""
        ids = np.array(known.encode_ordinary(text), "<u4")
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op4(spark, docs):
    rows = found(spark, "op4_simhash_near_dedup", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"})
    prints = {}
    for i, doc in docs.items():
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), doc.text or ""))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
        bits = np.zeros(64, int)
        for shingle in shingles:
            h = xxhash.xxh64_intdigest(shingle.encode(), 42)
            bits += np.array([(h >> b) & 1 for b in range(64)])
        prints[i] = sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))
    component = {i: i for i in docs}

    def top(i):
        while component[i] != i:
            i = component[i]
        return i

    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2 and top(i) != top(j):
                component[max(top(i), top(j))] = min(top(i), top(j))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (i, f"{prints[i]:016x}", top(i)) for i in docs
    }
    assert len(rows) == len(docs)


def test_op5(spark, docs):
    columns = {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    rows = found(spark, "op5_language_id", columns)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in docs}
    learned = {d.lang for i, d in docs.items() if not held[i] and d.lang is not None}
    hits = []
    for row in rows:
        text = docs[row.doc_id].text or ""
        assert row.held_out == held[row.doc_id] and 0 <= row.score <= 1
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in text))
        assert row.lang_pred in learned | {"und"}
        if row.held_out and docs[row.doc_id].lang is not None and row.lang_pred != "und":
            hits.append(row.lang_pred == docs[row.doc_id].lang)
    assert sum(hits) >= 0.95 * len(hits) > 0


def test_op7(spark, docs):
    columns = {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    }
    rows = found(spark, "op7_best_fit_packing", columns)
    tokenizer = Tokenizer.from_file(WORDS)
    expected = set()
    for i, doc in docs.items():
        ids = [*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            expected.add((i, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    floor = -(-sum(r.length for r in rows) // 2048)
    assert floor <= check_sequences(rows, 2048) <= floor + 1


def plain_candidates(text):
    """Runs of key characters, and values without such a run after a telling name."""
    key = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    run = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16}|PRIVATE KEY"
    names = "token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential"
    value = (
        rf"(?i:(?:{names})s?)[\"']?[ \t\n\x0b\f\r]{{0,16}}(?:[:=]|=>)[ \t\n\x0b\f\r]{{0,16}}[\"']?"
        r"([^ \t\n\x0b\f\r\"']{5,}[^ \t\n\x0b\f\r\"'.,;:)\]}])"
    )
    spans = [m.span() for m in re.finditer(key, text)]
    spans += [m.span(1) for m in re.finditer(value, text) if not re.search(run, m[1])]
    return sorted(spans)


def test_op9(spark, docs):
    columns = {"doc_id": "bigint", "n_candidates": "bigint", "n_secrets": "bigint", "spans": "string"}
    rows = found(spark, "op9_secret_scan", columns)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for row in rows:
        candidates = plain_candidates(docs[row.doc_id].text or "")
        spans = [tuple(map(int, s.split(":"))) for s in row.spans.split(",") if s]
        assert row.n_candidates == len(candidates) and row.n_secrets == len(spans)
        assert set(spans) <= set(candidates)
    assert sum(r.n_candidates for r in rows) > 0  # none of them a secret in the smallest table


def test_op10(spark, docs):
    kinds = ("email", "ip", "card", "phone")
    columns = {"doc_id": "bigint", "base_sha256": "string", "spans": "string"}
    rows = found(spark, "op10_personal_data", columns | {f"n_{kind}": "bigint" for kind in kinds})
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for row in rows:
        base = plain_spans(docs[row.doc_id].text or "")
        assert [row[f"n_{kind}"] for kind in kinds] == [sum(k == kind for k, _, _ in base) for kind in kinds]
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(row.spans.split(","))
