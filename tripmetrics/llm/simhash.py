"""SimHash near-duplicates, found by BK-trees.

Fingerprints are linked when they differ in at most two bits. Equal fingerprints are one node.
Of the four 16-bit blocks of two linked fingerprints at least two are equal, so every distinct
fingerprint goes to six shards, one for each pair of blocks and their values, and a neighbour
is met in one of them. A shard is a BK-tree: a fingerprint hangs below its parent by the
Hamming distance between them, and a search with radius r follows only the edges at distance
d - r to d + r. A shard of more than ``SHARD`` fingerprints becomes several trees, each sent to
the task that searches it with all fingerprints of the shard; a tree's size is therefore
bounded. Searches emit a spanning forest of the links found, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f
from xxhash import xxh64_intdigest

from tripmetrics.llm.components import component_labels
from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

SEED = 42
SHINGLE = 3
RADIUS = 2
SHARD = 4096
SEARCHES_AT_ONCE = 512
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of ``text``; zero without words."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII case and white space
    if not words:
        return 0
    total = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, HASHES_AT_ONCE):
        block = words[start : start + HASHES_AT_ONCE + shingle - 1]
        parts = zip(*(block[i:] for i in range(shingle))) if len(words) >= shingle else [block]
        hashes = np.array([xxh64_intdigest(b" ".join(p), SEED) for p in parts], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, __row (if there) and ``fp``, the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py()) for t in batch.column("text")]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), column], names=[*kept, "fp"]
            )

    ship(docs.sparkSession)
    docs = docs.select("doc_id", *(c for c in docs.columns if c == "__row"), "text")
    return docs.mapInArrow(run, docs.drop("text").withColumn("fp", f.lit(0).cast("bigint")).schema)


class BKTree:
    """Nodes in arrays; children of a node are found by (node, distance)."""

    def __init__(self, values: np.ndarray):
        """``values``: distinct unsigned 64-bit integers. Built level by level: all that hang
        below a node at one distance form its child's subtree, whose first member is the child.
        """
        self.values = values
        n = len(values)
        self.child = np.full((n, 65), -1, np.int32)
        parent = np.zeros(n, np.int64)  # of those not placed yet: the node they hang below
        waiting = np.arange(1, n)
        while len(waiting):
            above = parent[waiting]
            distance = np.bitwise_count(values[waiting] ^ values[above]).astype(np.int64)
            edge = above * 65 + distance
            _, first, member = np.unique(edge, return_index=True, return_inverse=True)
            self.child[above[first], distance[first]] = waiting[first]
            parent[waiting] = waiting[first][member]
            placed = np.zeros(len(waiting), bool)
            placed[first] = True
            waiting = waiting[~placed]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, node index) at most ``radius`` apart. Searches go down the tree
        side by side, so a step is a few array operations."""
        found_query, found_node = [], []
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(query):
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            found_query.append(query[hit])
            found_node.append(node[hit])
            next_query, next_node = [], []
            for edge in range(-radius, radius + 1):
                at = distance + edge
                inside = (at >= 0) & (at <= 64)
                below = self.child[node[inside], at[inside]]
                there = below >= 0
                next_query.append(query[inside][there])
                next_node.append(below[there].astype(np.int64))
            query, node = np.concatenate(next_query), np.concatenate(next_node)
        return np.concatenate(found_query), np.concatenate(found_node)


def _spanning(queries: np.ndarray, values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between a query and a tree's value that suffice to connect all linked ones."""
    tree = BKTree(values)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    links = []
    for start in range(0, len(queries), SEARCHES_AT_ONCE):
        block = queries[start : start + SEARCHES_AT_ONCE]
        found, nodes = tree.within(block, radius)
        pairs = np.stack([block[found], values[nodes]], axis=1)
        for a, b in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
            ra, rb = find(a), find(b)
            if ra != rb:
                root[ra] = rb
                links.append((a, b))
    return links


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, tree, searched, fp), sorted: per key and tree first the tree's members, then
    those that only search it. Emits links (a, b)."""
    held_key, held = None, []

    def links(rows: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
        searches = np.concatenate([r[0] for r in rows])
        fps = np.concatenate([r[1] for r in rows])
        if len(fps) < 2 or searches.all():  # a tree may have got no member
            return []
        if len(fps) == 2 and not searches.any():
            a, b = fps.tolist()
            return [(a, b)] if (a ^ b).bit_count() <= RADIUS else []
        return _spanning(fps, fps[~searches], RADIUS)

    for batch in batches:
        key = np.stack([batch.column("key").to_numpy(), batch.column("tree").to_numpy()], axis=1)
        searches = batch.column("searches").to_numpy(zero_copy_only=False)
        fps = batch.column("fp").to_numpy().view(np.uint64)
        if not len(fps):
            continue
        starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(fps)]
        out: list[tuple[int, int]] = []
        for start, end in zip(starts, starts[1:]):
            here = tuple(key[start].tolist())
            if here != held_key and held:
                out += links(held)
                held = []
            held_key = here
            held.append((searches[start:end], fps[start:end]))
        if out:
            a, b = zip(*out)
            yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], names=["a", "b"])
    if held and (out := links(held)):
        a, b = zip(*out)
        yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], names=["a", "b"])


def _block(i: int) -> Column:
    return f.shiftrightunsigned(f.col("fp"), 16 * i).bitwiseAND(f.lit(0xFFFF))


def links(nodes: DataFrame, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect all of the distinct fingerprints ``fp`` within the radius."""
    ship(nodes.sparkSession)
    keys = [
        f.lit(which).cast("bigint") * (1 << 32) + _block(i) * (1 << 16) + _block(j)
        for which, (i, j) in enumerate(combinations(range(4), 2))
    ]
    dealt = nodes.select("fp", f.explode(f.array(*keys)).alias("key"))
    shards = (
        dealt.groupBy("key")
        .count()
        .filter("count > 1")
        .select("key", f.ceil(f.col("count") / shard).alias("trees"))
    )
    own = f.pmod(f.xxhash64("fp"), f.col("trees"))
    members = dealt.join(shards, "key").withColumn("own", own)
    rows = members.select(
        "key",
        "fp",
        f.posexplode(f.sequence(f.lit(0).cast("bigint"), f.col("trees") - 1)).alias("i", "tree"),
        "own",
    ).select("key", "tree", (f.col("tree") != f.col("own")).alias("searches"), "fp")
    return (
        rows.repartition("key", "tree")
        .sortWithinPartitions("key", "tree", "searches")
        .mapInArrow(_search_shards, "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """Per document: doc_id, fingerprint, component_id (and __row, if ``docs`` has it).

    A-Z counts as lower case; words are separated by ASCII white space; a text of fewer words
    than a shingle is one shingle; null, empty and blank texts have fingerprint zero and are
    linked like any other. component_id is the smallest doc_id that links reach; null doc_ids
    are no candidates for it, and a component of only such rows has component_id null.
    Repeated rows are members of their component like any other.
    """
    prints = store(fingerprints(docs), "fingerprints")
    nodes = store(prints.groupBy("fp").agg(f.min("doc_id").alias("least")), "nodes")
    labels = component_labels(store(links(nodes.select("fp"), shard), "links"))
    rooted = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", f.coalesce("label", "fp")
    )
    least = rooted.groupBy("label").agg(f.min("least").alias("component_id"))
    named = store(rooted.join(least, "label").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id",
        f.lower(f.lpad(f.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        *(c for c in prints.columns if c == "__row"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: the smallest doc_id (nulls last), of repeated ones the
    first row. All columns of ``docs``."""
    numbered = store(docs.withColumn("__row", f.monotonically_increasing_id()), "numbered")
    prints = store(near_duplicates(numbered), "components")
    order = f.struct(f.col("doc_id").isNull(), f.col("doc_id"), f.col("__row"))
    # a component is known by its id; those without any doc_id by their fingerprint
    group = ["component_id", f.when(f.col("component_id").isNull(), f.col("fingerprint"))]
    kept = prints.groupBy(*group).agg(f.min(order).alias("first"))
    return numbered.join(
        kept.select(f.col("first.__row").alias("__row")), "__row", "left_semi"
    ).select(*docs.columns)
