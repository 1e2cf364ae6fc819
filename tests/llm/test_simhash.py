from collections import defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tests.llm.conftest import TEXTS
from tripmetrics.llm.components import component_labels
from tripmetrics.llm.simhash import BKTree, fingerprint, keep_one, links, near_duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    members = defaultdict(set)
    for x in fps:
        members[find(x)].add(x)
    return sorted(sorted(m) for m in members.values() if len(m) > 1)


def near(dice, seeds, copies):
    """Chains of fingerprints two bits apart, and lone ones."""
    found = {dice.getrandbits(64) for _ in range(seeds)}
    for x in list(found)[: seeds // 3]:
        for _ in range(copies):
            x ^= (1 << dice.randrange(64)) | (1 << dice.randrange(64))
            found.add(x)
    return found


def test_bk_tree_finds_all_within_the_radius(dice):
    values = np.array(sorted(near(dice, 60, 20)), np.uint64)
    found, nodes = BKTree(values).within(values, 2)
    expected = {
        (i, j)
        for i, a in enumerate(values.tolist())
        for j, b in enumerate(values.tolist())
        if (a ^ b).bit_count() <= 2
    }
    assert set(zip(found.tolist(), nodes.tolist())) == expected


@pytest.mark.parametrize("shard", [3, 4096])
def test_links_connect_what_brute_force_connects(spark, dice, shard):
    """With a small bound a shard becomes many trees."""
    base = dice.getrandbits(64)
    dense = {base ^ (1 << i) for i in range(16)} | {base ^ (3 << i) for i in range(16)}
    fps = near(dice, 60, 12) | dense | {0, 1, 2**64 - 1}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    found = links(spark.createDataFrame(signed, "fp bigint"), shard)
    assert found.filter("bit_count(a ^ b) > 2").count() == 0
    members = defaultdict(set)
    for row in component_labels(found).collect():
        members[row.label].add(row.node % (1 << 64))
    assert sorted(sorted(m) for m in members.values()) == plain_components(fps)


def test_documents(odd_docs):
    rows = near_duplicates(odd_docs).collect()
    prints = {(i, t): plain_fingerprint(t) for i, t in TEXTS}
    assert len(rows) == len(TEXTS)
    assert sorted(r.fingerprint for r in rows) == sorted(
        f"{plain_fingerprint(t):016x}" for _, t in TEXTS
    )
    by_id = {row.doc_id: row for row in rows if row.doc_id is not None}
    assert by_id[3].component_id == by_id[4].component_id == by_id[5].component_id == 3
    assert by_id[6].component_id == 1 and by_id[8].component_id == 7
    assert len(prints) > 5


def test_one_of_each_component_stays(odd_docs):
    rows = keep_one(odd_docs)
    ids = sorted(row.doc_id for row in rows.collect() if row.doc_id is not None)
    assert rows.columns == odd_docs.columns and ids == [1, 3, 7, 9, 12, 13]


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 300)] + [(1000, i) for i in range(1001, 1100)]
    chain += [(5, 5)]
    labels = {r.node: r.label for r in component_labels(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert {labels[i] for i in range(100, 301)} == {100}
    assert {labels[i] for i in range(1000, 1100)} == {1000} and 5 not in labels


def test_no_documents(no_docs):
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0


def test_few_words_are_one_shingle():
    assert fingerprint("One two") == plain_fingerprint("one  TWO\n") != 0
