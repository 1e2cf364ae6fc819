"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded by itself. A segment tree over its byte positions
stores the smallest key ``rank * 2**32 + position`` of the pair that starts there, so the root
is the leftmost pair of lowest rank. A merge changes three leaves (the merged pair, its right
half, its left neighbour), each in logarithmic time, so a match of n bytes takes n log n steps
however long it is. Short matches are remembered per task, in a dictionary of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.shipping import ship

CACHE_ENTRIES = 250_000
CACHED_CHARS = 48
LONG_TEXT = 1 << 20
MATCHES_AT_ONCE = 1 << 16
_NONE = 1 << 62


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 and rank lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(None, lines))}


@lru_cache(maxsize=2)
def _packed_ids(path: str) -> _PackedIds:
    """One memory per Python worker, which serves many tasks."""
    return _PackedIds(load_ranks(path))


@lru_cache(maxsize=2)
def _tokens(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match of the pattern."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    rank_of = ranks.get
    width = 1 << max(n - 2, 0).bit_length()
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank << 32 | i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    after = list(range(1, n + 1))  # where the live token at i ends
    before = list(range(-1, n))  # where the live token before i starts
    while n > 1 and tree[1] != _NONE:
        start = tree[1] & 0xFFFFFFFF
        gone = after[start]
        end = after[start] = after[gone]
        changes = [(start, None)]
        if gone < n - 1:
            changes.append((gone, None))
        if end < n:
            before[end] = start
            changes[0] = (start, rank_of(piece[start : after[end]]))
        if start:
            changes.append((before[start], rank_of(piece[before[start] : end])))
        for leaf, rank in changes:
            node = width + leaf
            best = _NONE if rank is None else rank << 32 | leaf
            while node and tree[node] != best:
                tree[node] = best
                other = tree[node ^ 1]
                if other < best:
                    best = other
                node >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class _PackedIds(dict):
    """Match of the pattern to its ids as little-endian unsigned 32-bit integers.

    When full, it starts anew and keeps the previous generation to look up what is common.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.previous: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        packed = self.previous.get(match)
        if packed is None:
            ids = encode_piece(match.encode("utf-8"), self.ranks)
            packed = pack(f"<{len(ids)}I", *ids)
        if len(match) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.previous = dict(self)
                self.clear()
            self[match] = packed
        return packed


def _matches(pattern: regex.Pattern, text: str) -> Iterator[list[str]]:
    """All matches in lists of bounded length."""
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while block := list(islice(found, MATCHES_AT_ONCE)):
        yield block


def _append(batch: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    column = pa.array(values, pa.binary())
    return pa.RecordBatch.from_arrays(
        [*batch.columns, column], names=[*batch.schema.names, name]
    )


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``: the token ids of ``text``, packed little-endian in 4 bytes each.

    Null and empty texts have no ids. Texts of any length are encoded whole; repeated rows are
    encoded alike. Special tokens are ordinary text. A column called ``ids`` is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _packed_ids(ranks_path)
        split = regex.compile(pattern)
        for batch in batches:
            texts = batch.column(text)
            yield _append(
                batch,
                "ids",
                [
                    b"".join(
                        b"".join(map(cache.__getitem__, block))
                        for block in _matches(split, value.as_py() or "")
                    )
                    for value in texts
                ],
            )

    ship(docs.sparkSession)
    docs = docs.drop("ids")
    return docs.mapInArrow(run, docs.withColumn("ids", f.lit(b"")).schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that the packed ``ids`` stand for.

    Null ids decode to no bytes. Bytes, not text: ids may end inside a character. A column
    called ``decoded`` is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(ranks_path)
        for batch in batches:
            yield _append(
                batch,
                "decoded",
                [
                    b"".join(
                        map(tokens.__getitem__, np.frombuffer(v.as_py() or b"", "<u4").tolist())
                    )
                    for v in batch.column("ids")
                ],
            )

    ship(encoded.sparkSession)
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(run, encoded.withColumn("decoded", f.lit(b"")).schema)
