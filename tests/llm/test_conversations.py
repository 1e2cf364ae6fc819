"""The conversation trie against a plain one."""

import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from tripmetrics.llm.conversations import Parentheses, prefix_trie
from tripmetrics.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, path string, n long"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def plain_trie(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    members = defaultdict(list)
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(turns.get(lender, [])[:h] + own[h:])
        whole[c] = path
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        size = len(path[-1][1].encode()) if path else 0
        below = children[path]
        leaves[path] = sum(leaves[b] for b in below) if below else 1
        saved[path] = sum(saved[b] for b in below) + (len(members[path]) - 1) * size
    found = []
    for path, inside in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in inside if whole[c] == path))
        parent = min(members[path[:-1]]) if path else None
        found.append((
            min(inside), len(path), parent, len(inside), len(children[path]), leaves[path], saved[path],
            sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


def random_rows(dice, conversations, most, texts="abé"):
    """Few different turns, so that conversations share and copy; nulls, gaps and equal turns."""
    rows = []
    for _ in range(conversations):
        c = dice.randint(-12, 300)
        for turn in range(dice.randint(1, most)):
            role = dice.choice(["user", "user", None])
            text = dice.choice([*texts, *texts, "aaa", "bé🙂", None, ""])
            rows.append((c, dice.choice([turn, turn, None]), role, text, "k", "p", 1))
    return rows


@pytest.mark.parametrize("band, shard_turns, id_bits", [(256, 1 << 17, 16), (3, 7, 1), (2, 1, 0), (5, 40, 3)])
def test_against_plain_trie(spark, dice, band, shard_turns, id_bits):
    rows = random_rows(dice, 150, 14) + [(None, 1, "user", "lost", "k", "p", 1)]
    # ties of turn: the plain order and that of digests must not differ, so equal turns are equal
    first = {}
    rows = [first.setdefault((r[0], r[1]), r) for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert rows_of(prefix_trie(frame, band, shard_turns, id_bits)) == plain_trie(rows)


def test_one_conversation_of_most_rows_and_copies(spark, dice):
    rows = [(5, t, "user", f"turn {t % 7}", "", "", 0) for t in range(900)]
    rows += [(6, t, "user", f"turn {t % 7}", "", "", 0) for t in range(905)]
    rows += [(1000 + c, t, "user", "same", "", "", 0) for c in range(400) for t in range(2)]
    rows += [(3, 0, "user", "x" * 100_000, "", "", 0)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert rows_of(prefix_trie(frame, band=16, shard_turns=50, id_bits=4)) == plain_trie(rows)


def test_equal_turns_are_ordered_alike(spark):
    rows = [(c, 1, role, text, "", "", 0) for c in (10, 15, 20) for role, text in [("u", "b"), ("u", "a"), ("u", "b")]]
    found = rows_of(prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert max(r[1] for r in found) == 3 and len(found) == 4 and all(r[3] == 3 for r in found)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).count() == 0
    nameless = spark.createDataFrame([(None, 1, "u", "t", "", "", 0)], SCHEMA)
    assert prefix_trie(nameless).count() == 0


def test_closing_parentheses(dice):
    for size in (1, 2, 31, 32, 33, 64, 500, 3000):
        bits, level = [], 0
        for _ in range(2 * size):
            opening = level == 0 or (dice.random() < 0.5 and bits.count(1) < size)
            opening = opening and sum(bits) < size
            bits.append(int(opening))
            level += 1 if opening else -1
            if level == 0 and sum(bits) == size:
                break
        bits += [0] * level
        stack, expected = [], {}
        for at, bit in enumerate(bits):
            if bit:
                stack.append(at)
            else:
                expected[stack.pop()] = at
        opens = np.flatnonzero(bits)
        found = Parentheses(np.array(bits, bool)).close(opens)
        assert dict(zip(opens.tolist(), found.tolist())) == expected


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_conversation_trie"](spark, SF_DIR)
    assert found.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in COLUMNS]
    assert rows_of(found) == plain_trie(rows)
