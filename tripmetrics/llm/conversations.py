"""A prefix trie of conversations, from balanced parentheses.

Conversations that begin with the same turns share the nodes of these turns. No text moves: a turn
is a token of its digest and its length in bytes, a conversation a path of tokens, and long paths
are cut into bands of 256 turns below a root that stands for all turns before. Equal pieces are
combined, sorted, and read in shards of bounded size. A shard writes its part of the trie as
balanced parentheses: closing ones, found over blocks of least excess, delimit subtrees; the rank
of leaf pairs counts leaves; cumulative arrays give members and savings. What lies on the paths
where a shard begins or ends, or where a band goes on, is the spine. Its parts are merged by key,
and totals climb it by pointer jumping, so neither wide nor deep tries meet in one task.
"""

from __future__ import annotations

from base64 import b64decode
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f
from pyspark.sql.window import Window

from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

FAMILY = 5
MOST_SHARED = 9
#: Turns of a path that stay together, and of a shard before it is closed.
BAND = 256
SHARD_TURNS = 1 << 17
#: Positions of parentheses that share a least excess.
BLOCK = 64
#: Conversations whose ids, after this many bits are cut off, are equal are listed together.
ID_BITS = 16
#: Characters of a token: 14 bytes of digest and 4 of length, in base 64.
TOKEN = 24
EMPTY_SHA256 = sha256(b"").hexdigest()
_PATH = "band long, root string, path string, n long, least long, goes_on boolean, ends_sha256 string"
_NODE = (
    "key string, parent_key string, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, size long, ends_sha256 string"
)


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, token and a row number; no row without a conv_id."""
    role, text = f.coalesce("role", f.lit("")), f.coalesce("text", f.lit(""))
    digest = f.sha2(f.concat(f.octet_length(role).cast("string"), f.lit(":"), role, text), 256)
    size = f.lpad(f.hex(f.octet_length(text).cast("bigint")), 8, "0")
    token = f.base64(f.unhex(f.concat(f.substring(digest, 1, 28), size)))
    return conversations.filter("conv_id is not null").select(
        f.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        token.alias("token"),
        f.monotonically_increasing_id().alias("row_no"),
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), total and token of each turn of each rebuilt conversation, and one
    row of depth 0 for one without turns.

    A conversation c takes its first h turns from c - c % 5, h = crc32 of c % 9, and what follows
    its own first h. Turns go by ``turn`` (null first), equal ones by their digests. They are
    numbered over a range partitioning, so a conversation may be as long as it likes.
    """
    order = ["conv_id", f.col("turn").asc_nulls_first(), "token", "row_no"]
    placed = store(
        store(_turns(conversations), "turns")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "token", f.monotonically_increasing_id().alias("place")),
        "ordered_turns",
    ).withColumn("part", f.shiftright("place", 33))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = store(
        placed.groupBy("conv_id", "part")
        .agg(f.min("place").alias("first"), f.count("*").alias("rows"))
        .withColumn("before", f.coalesce(f.sum("rows").over(earlier), f.lit(0))),
        "parts",
    )
    lengths = parts.groupBy("conv_id").agg(f.sum("rows").alias("length"))
    shared = f.crc32(f.col("conv_id").cast("string")) % MOST_SHARED
    lender = f.col("conv_id") - f.col("conv_id") % FAMILY
    lent = lengths.select(f.col("conv_id").alias("lender"), f.col("length").alias("has"))
    known = store(
        lengths.withColumns({"shared": shared, "lender": lender})
        .join(lent, "lender", "left")
        .withColumn("taken", f.least("shared", f.coalesce("has", f.lit(0))))
        .withColumn("total", f.col("taken") + f.greatest(f.col("length") - f.col("shared"), f.lit(0)))
        .drop("has", "length"),
        "rebuilt_lengths",
    )
    borrowers = known.groupBy("lender").agg(  # nine at most: -4 to 4 have one lender
        f.collect_list(f.struct("conv_id", "shared", "total")).alias("borrowers")
    )
    about = (
        parts.drop("rows")
        .join(known.drop("lender"), "conv_id")
        .join(borrowers.withColumnRenamed("lender", "conv_id"), "conv_id", "left")
    )
    position = f.col("place") - f.col("first") + f.col("before") + 1

    def turn(conv_id: Column, depth: Column, total: Column) -> Column:
        return f.struct(conv_id.alias("conv_id"), depth.alias("depth"), total.alias("total"))

    own = f.when(
        f.col("position") > f.col("shared"),
        turn(f.col("conv_id"), f.col("taken") + f.col("position") - f.col("shared"), f.col("total")),
    )
    lent_to = f.transform(
        f.filter("borrowers", lambda b: b["shared"] >= f.col("position")),
        lambda b: turn(b["conv_id"], f.col("position"), b["total"]),
    )
    none = f.array().cast("array<struct<conv_id:bigint,depth:bigint,total:bigint>>")
    uses = f.concat(f.array_compact(f.array(own)), f.coalesce(lent_to, none))
    turns = (
        placed.join(about, ["conv_id", "part"])
        .withColumn("position", position)
        .select(f.explode(uses).alias("use"), "token")
        .select("use.*", "token")
    )
    zero = f.lit(0).cast("bigint")
    turnless = known.filter("total = 0").select(
        "conv_id", zero.alias("depth"), "total", f.lit("").alias("token")
    )
    return turns.union(turnless)


def _key(root: str, prefix: str) -> str:
    """The key of the node that a prefix below a root leads to."""
    return sha256(f"{root}:{sha256(prefix.encode()).hexdigest()}".encode()).hexdigest()[:32]


def _roots(table: pa.Table) -> pa.Table:
    """The root of each band of one conversation, from the digests of the bands before."""
    rows = table.sort_by("band")
    roots, root = [], ""
    for link in rows.column("link").to_pylist():
        roots.append(root)
        root = sha256(f"{root}:{link}".encode()).hexdigest()[:32]
    return rows.select(["conv_id", "band"]).append_column("root", pa.array(roots, pa.string()))


def _pieces(turns: DataFrame, band: int) -> DataFrame:
    """conv_id, band, total, path and root: each conversation in pieces of ``band`` turns."""
    in_order = f.transform(
        f.array_sort(f.collect_list(f.struct("depth", "token"))), lambda turn: turn["token"]
    )
    pieces = store(
        turns.withColumn("band", f.floor(f.greatest(f.col("depth") - 1, f.lit(0)) / band))
        .groupBy("conv_id", "band")
        .agg(f.max("total").alias("total"), f.array_join(in_order, "").alias("path")),
        "pieces",
    )
    long = f.col("total") > band
    roots = (
        pieces.filter(long)
        .select("conv_id", "band", f.sha2("path", 256).alias("link"))
        .groupBy("conv_id")
        .applyInArrow(_roots, "conv_id long, band long, root string")
    )
    return (
        pieces.filter(~long)
        .withColumn("root", f.lit(""))
        .unionByName(pieces.filter(long).join(roots, ["conv_id", "band"]))
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its blocks, which follow each other in order."""
    last, digest = None, None

    def row() -> pa.RecordBatch:
        columns = [pa.array([last], pa.string()), pa.array([digest.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["ends_key", "ends_sha256"])

    for batch in batches:
        for key, ids in zip(batch.column("ends_key"), batch.column("ids")):
            if key.as_py() != last:
                if digest is not None:
                    yield row()
                last, digest = key.as_py(), sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
    if digest is not None:
        yield row()


def _paths(turns: DataFrame, band: int, id_bits: int) -> DataFrame:
    """The distinct pieces with their members: number, smallest conv_id, whether some go on, and
    the digest of those that end there.

    Copies are combined by blocks of ids first, so that a group of any size is spread; a digest over
    several blocks is a pass over them in order.
    """
    bottom = (f.col("band") + 1) * band
    ends = f.when(f.col("total") <= bottom, f.col("conv_id"))
    where = ["band", "root", "path"]
    blocks = store(
        _pieces(turns, band)
        .groupBy(*where, f.shiftright("conv_id", id_bits).alias("id_block"))
        .agg(
            f.count("*").alias("n"),
            f.min("conv_id").alias("least"),
            f.max(f.col("total") > bottom).alias("goes_on"),
            f.array_sort(f.collect_list(ends)).alias("ends"),
        )
        .withColumn("ids", f.when(f.size("ends") > 0, f.array_join("ends", ",")))
        .withColumn("ends_key", f.sha2(f.concat_ws(":", *where), 256))
        .drop("ends"),
        "id_blocks",
    )
    paths = store(
        blocks.groupBy(*where).agg(
            f.sum("n").alias("n"),
            f.min("least").alias("least"),
            f.max("goes_on").alias("goes_on"),
            f.count("ids").alias("blocks"),
            f.sha2(f.max("ids"), 256).alias("of_one"),
            f.min("ends_key").alias("ends_key"),
        ),
        "paths",
    )
    columns = [*where, "n", "least", "goes_on", f.col("of_one").alias("ends_sha256")]
    several = paths.filter("blocks > 1")
    of_several = (
        blocks.filter("ids is not null")
        .join(several.select("ends_key"), "ends_key", "left_semi")
        .repartition("ends_key")
        .sortWithinPartitions("ends_key", "id_block")
        .select("ends_key", "ids")
        .mapInArrow(_hashed, "ends_key string, ends_sha256 string")
    )
    return paths.filter("blocks <= 1").select(*columns).union(
        several.join(of_several, "ends_key").select(*columns[:-1], "ends_sha256")
    )


class Parentheses:
    """Balanced parentheses with a tree of least excess over blocks of positions."""

    def __init__(self, opening: np.ndarray):
        self.excess = np.cumsum(np.where(opening, 1, -1))
        blocks = max(1, -(-len(opening) // BLOCK))
        width = 1 << (blocks - 1).bit_length()
        # beyond the end lies the least of all, so that every search ends
        self.padded = np.full(width * BLOCK, -1, np.int64)
        self.padded[: len(opening)] = self.excess
        self.padded = self.padded.reshape(width, BLOCK)
        levels = [self.padded.min(axis=1)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).min(axis=1))
        self.levels = levels

    def close(self, opens: np.ndarray) -> np.ndarray:
        """The closing position of each opening one: the first after it with less excess."""
        found = np.full(len(opens), -1, np.int64)
        target = self.excess[opens] - 1
        inside = np.arange(BLOCK)
        for at in range(0, len(opens), 1 << 14):
            part = slice(at, at + (1 << 14))
            found[part] = self._close(opens[part], target[part], inside)
        return found

    def _close(self, opens: np.ndarray, target: np.ndarray, inside: np.ndarray) -> np.ndarray:
        block, place = np.divmod(opens, BLOCK)
        fits = (self.padded[block] <= target[:, None]) & (inside > place[:, None])
        here = fits.any(axis=1)
        found = np.where(here, opens - place + fits.argmax(axis=1), -1)
        waiting = np.flatnonzero(~here)
        node, wanted = block[waiting], target[waiting]
        done = np.zeros(len(waiting), np.int64)  # the block, once its level is reached
        for level in range(len(self.levels) - 1):  # up, to a right sibling that holds it
            right = node + 1
            hit = (node % 2 == 0) & (self.levels[level][np.minimum(right, len(self.levels[level]) - 1)] <= wanted)
            if hit.any():
                done[waiting_index := np.flatnonzero(hit)] = self._down(level, right[hit], wanted[hit])
                found[waiting[waiting_index]] = self._within(done[waiting_index], wanted[hit])
            waiting, node, wanted, done = waiting[~hit], node[~hit] // 2, wanted[~hit], done[~hit]
        return found

    def _down(self, level: int, node: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first block below each node with so little excess."""
        for below in range(level - 1, -1, -1):
            node = 2 * node
            node = node + (self.levels[below][node] > wanted)
        return node

    def _within(self, block: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        return block * BLOCK + (self.padded[block] <= wanted[:, None]).argmax(axis=1)


def _shard_nodes(rows: list[tuple], band_turns: int) -> pa.RecordBatch:
    """Nodes of one shard of sorted pieces: whole ones, and its parts of the spine (with a key)."""
    bands, roots, paths, n, least, goes_on, ends = zip(*rows)
    pieces = len(rows)
    common = np.zeros(pieces, np.int64)  # nodes shared with the piece before
    nodes = np.array([len(path) // TOKEN + 1 for path in paths], np.int64)
    for i in range(1, pieces):
        if roots[i] == roots[i - 1]:
            one, other, at = paths[i - 1], paths[i], 0
            while at < len(one) and one[at : at + TOKEN] == other[at : at + TOKEN]:
                at += TOKEN
            common[i] = at // TOKEN + 1
    new = nodes - common
    starts = np.concatenate([[0], np.cumsum(new)])
    total = int(starts[-1])
    # the nodes in preorder: level, piece that brings them, parent, and which are on the spine
    of_piece = np.repeat(np.arange(pieces), new)
    level = np.arange(total) - starts[of_piece] + common[of_piece]
    parent = np.arange(total) - 1
    spine = level == 0
    current: list[int] = []
    for i in range(pieces):
        start = int(starts[i])
        parent[start] = current[common[i] - 1] if common[i] else -1
        current[int(common[i]) :] = range(start, int(starts[i + 1]))
        if goes_on[i] or i in (0, pieces - 1):
            spine[current] = True
    counts = np.empty(2 * pieces, np.int64)
    counts[0::2], counts[1:-1:2], counts[-1] = new, nodes[:-1] - common[1:], nodes[-1]
    opening = np.repeat(np.arange(2 * pieces) % 2 == 0, counts)
    open_at = np.flatnonzero(opening)
    close_at = Parentheses(opening).close(open_at)
    leaf = np.zeros(total, bool)
    leaf[:] = ~opening[open_at + 1]

    def below(values: np.ndarray) -> np.ndarray:
        """Sums over subtrees, from the cumulative array over all positions."""
        cumulative = np.zeros(len(opening) + 1, np.int64)
        cumulative[open_at + 1] = values
        cumulative = np.cumsum(cumulative)
        return cumulative[close_at] - cumulative[open_at]

    last = starts[1:] - 1  # the node where each piece ends
    weight = np.zeros(total, np.int64)
    weight[last] = n
    members = below(weight)
    sizes = np.zeros(total, np.int64)
    for v in np.flatnonzero(level).tolist():
        at = (int(level[v]) - 1) * TOKEN
        sizes[v] = int.from_bytes(b64decode(paths[of_piece[v]][at : at + TOKEN])[-4:], "big")
    leaves = below((leaf & ~spine).astype(np.int64))
    saved = below(np.where(spine, 0, (members - 1) * sizes))
    # pieces below a node are neighbours, from the one that brings it
    is_last = np.zeros(total, np.int64)
    is_last[last] = 1
    bounds = np.stack([of_piece, of_piece + below(is_last)], axis=1).ravel()
    smallest = np.minimum.reduceat(np.append(np.array(least, np.int64), 0), bounds)[::2]
    inner = np.flatnonzero(~spine)
    children = np.bincount(parent[inner], minlength=total)
    # what hangs on a spine node alone, without what hangs on spine nodes below it
    inner_spine = np.flatnonzero(spine & (level > 0))
    for totals in (leaves, saved):
        np.subtract.at(totals, parent[inner_spine], totals[inner_spine].copy())

    keys: list[str | None] = [None] * total
    for v in np.flatnonzero(spine).tolist():
        i, up = of_piece[v], int(level[v])
        keys[v] = roots[i] if not up and bands[i] else _key(roots[i], paths[i][: up * TOKEN])
    parents = parent.tolist()
    depth = np.array(bands, np.int64)[of_piece] * band_turns + level
    # a band's root is counted in the band above, except for the trie's own
    again = (level == 0) & (depth > 0)
    known_parent = (parent >= 0) & ~spine & ~spine[parent]
    digests: list[str | None] = [None] * total
    for i, v in enumerate(last.tolist()):
        digests[v] = ends[i]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.string()),
            pa.array([keys[p] if p >= 0 else None for p in parents], pa.string()),
            pa.array(depth),
            pa.array(smallest, mask=again),
            pa.array(smallest[parent], mask=~known_parent),
            pa.array(np.where(again, 0, members)),
            pa.array(children.astype(np.int64)),
            pa.array(leaves),
            pa.array(saved),
            pa.array(sizes),
            pa.array(digests, pa.string()),
        ],
        names=[column.split()[0] for column in _NODE.split(", ")],
    )


def _shards(shard_turns: int, band: int):
    columns = [column.split()[0] for column in _PATH.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        turns = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                rows.append(row)
                turns += len(row[2]) // TOKEN + 1
                if turns >= shard_turns:
                    yield _shard_nodes(rows, band)
                    rows, turns = [], 0
        if rows:
            yield _shard_nodes(rows, band)

    return run


def _climbed(spine: DataFrame) -> DataFrame:
    """key, n_leaves and saved_tokens of each spine node over its whole subtree.

    Each round, a node's totals are added to those of the node its pointer has reached, and
    pointers double; rounds grow with the logarithm of the spine's depth. Each is written.
    """
    state = spine.select("key", f.col("parent_key").alias("up"), "n_leaves", "saved_tokens")
    while True:
        climbing = state.filter("up is not null")
        if climbing.isEmpty():
            return state.drop("up")
        below = climbing.groupBy(f.col("up").alias("key")).agg(
            f.sum("n_leaves").alias("more_leaves"), f.sum("saved_tokens").alias("more_saved")
        )
        further = state.select(f.col("key").alias("up"), f.col("up").alias("to"))
        pointers = climbing.join(further, "up").select("key", f.col("to").alias("up")).filter("up is not null")
        state = store(
            state.drop("up")
            .join(below, "key", "left")
            .join(pointers, "key", "left")
            .select(
                "key",
                "up",
                (f.col("n_leaves") + f.coalesce("more_leaves", f.lit(0))).alias("n_leaves"),
                (f.col("saved_tokens") + f.coalesce("more_saved", f.lit(0))).alias("saved_tokens"),
            ),
            "climbed",
        )


def prefix_trie(
    conversations: DataFrame,
    band: int = BAND,
    shard_turns: int = SHARD_TURNS,
    id_bits: int = ID_BITS,
) -> DataFrame:
    """Per distinct beginning of the rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty, null turns come first, rows without a conv_id are left out, and
    repeated rows are turns each. An empty table has no node, not even a root. Reads conv_id, turn,
    role and text, whatever else there is.
    """
    ship(conversations.sparkSession)
    paths = store(_paths(rebuilt(conversations), band, id_bits), "counted_paths")
    nodes = store(
        paths.repartitionByRange("root", "path")
        .sortWithinPartitions("root", "path")
        .mapInArrow(_shards(shard_turns, band), _NODE),
        "nodes",
    )
    merged = nodes.filter("key is not null").groupBy("key").agg(
        f.max("parent_key").alias("parent_key"),
        f.max("depth").alias("depth"),
        f.min("conv_id").alias("conv_id"),
        *[f.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        f.max("size").alias("size"),
        f.max("ends_sha256").alias("ends_sha256"),
    )
    merged = store(merged, "spine")
    on_spine = (
        merged.filter("parent_key is not null")
        .groupBy(f.col("parent_key").alias("key"))
        .agg(f.count("*").alias("more"))
    )
    children = f.col("n_children") + f.coalesce("more", f.lit(0))
    own = f.when(f.col("n_children") == 0, 1).otherwise(0)
    spine = store(
        merged.join(on_spine, "key", "left")
        .withColumn("n_children", children)
        .withColumn("n_leaves", f.col("n_leaves") + own)
        .withColumn("saved_tokens", f.col("saved_tokens") + (f.col("n_convs") - 1) * f.col("size"))
        .drop("more"),
        "merged_spine",
    )
    spine = store(spine.drop("n_leaves", "saved_tokens").join(_climbed(spine), "key"), "summed_spine")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    digest = f.coalesce("ends_sha256", f.lit(EMPTY_SHA256)).alias("ends_sha256")
    inner = nodes.filter("key is null")
    direct = inner.filter("parent_key is null").select(*columns, "parent_conv_id", digest)
    root = spine.filter("parent_key is null").select(
        *columns, f.lit(None).cast("bigint").alias("parent_conv_id"), digest
    )
    above = spine.select(f.col("key").alias("parent_key"), f.col("conv_id").alias("parent_conv_id"))
    hanging = (
        inner.select("parent_key", *columns, "ends_sha256")
        .unionByName(spine.select("parent_key", *columns, "ends_sha256"))
        .filter("parent_key is not null")
        .join(above, "parent_key")
        .select(*columns, "parent_conv_id", digest)
    )
    return direct.union(hanging).union(root).select(
        "conv_id", "depth", "parent_conv_id", *columns[2:], "ends_sha256"
    )
