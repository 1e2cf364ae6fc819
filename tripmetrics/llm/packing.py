"""Packing of tokenised documents into sequences, best fit decreasing with certified bounds.

Documents longer than a sequence are cut into whole sequences and a rest. Everything shorter
is dealt to partitions of bounded size. Each partition packs by best-fit decreasing and
computes a lower bound from dual-feasible functions. A partition that reaches its bound is
certified and keeps all sequences but its emptiest one; a partition with a gap keeps only its
full sequences. What is not kept is exchanged: dealt anew and packed again, until one partition is
left, or three rounds in a row neither certify a partition nor save a sequence. Each round's packing
is a whole one together with what was kept before it; the one with fewest sequences is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil
from typing import TYPE_CHECKING
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 2048
PARTITION_ITEMS = 60_000
#: Rounds without a gain after which the exchange ends.
PATIENCE = 3
CACHE_WORDS = 150_000
CACHE_MATCHES = 50_000
CACHED_BYTES = 64
MATCHES_AT_ONCE = 4096
TEXT_AT_ONCE = 1 << 20
# Words of characters for which normalisation and splitting are plain: ASCII and composed Latin
# letters. Both expressions are Arrow's, so that no word is looked at by itself.
_PLAIN = "^[\x21-\x7e\u00c0-\u012f\u0131-\u017f]+$"
_MATCH = (
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+|[0-9]"
    "|[^a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+"
)
# Matches with each plain character that a lower-cased word may have.
_SAMPLE = " ".join(
    [
        *"0123456789",
        "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u00d7\u00f7",
        "abcdefghijklmnopqrstuvwxyz",
        *(chr(c) for c in range(0xDF, 0x180) if chr(c).isalpha() and chr(c).islower()),
    ]
)
_PIECES = "row_no bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = _PIECES + ", bin bigint, offset bigint, kept boolean, bins bigint, bound bigint"


class _WordIds:
    """White-space delimited word to its ids, packed little-endian in 4 bytes each.

    Words of plain characters are cut into the matches that the tokenizer would split them
    into. Matches that are new are encoded many in one call, and told apart by the tokens that
    end a word. All other words are encoded one by one. Memories of bounded size keep both;
    a full one starts anew and keeps its previous generation.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same model, for matches that are lower-cased and told apart by spaces already
        self.matcher = Tokenizer(self.tokenizer.model)
        self.matcher.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        if self._ids(self.matcher, _SAMPLE) != self._ids(self.tokenizer, _SAMPLE):
            self.matcher = self.tokenizer
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.matches: dict[bytes, bytes] = {}
        self.old_matches: dict[bytes, bytes] = {}

    @staticmethod
    def _ids(tokenizer: Tokenizer, text: str) -> list[int]:
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_matches(self, matches: list[bytes]) -> list[bytes]:
        text = b" ".join(matches).decode("utf-8")
        ids = np.array(self._ids(self.matcher, text), "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(matches):  # not plain after all
            return [self._alone(match.decode("utf-8")) for match in matches]
        return _cut(ids.tobytes(), ends)

    def _plain_words(self, words: pa.Array) -> list[bytes]:
        """Ids of words of plain characters, put together from those of their matches."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(words), _MATCH, "\\0 ")
        split = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(spaced))
        matches = split.flatten().dictionary_encode()
        distinct = _bytes(matches.dictionary)
        ids = list(map(self.matches.get, distinct))
        new = [n for n, known in enumerate(ids) if known is None]
        unknown = []
        for n in new:
            ids[n] = self.old_matches.get(distinct[n])
            if ids[n] is None:
                unknown.append(n)
        for at in range(0, len(unknown), MATCHES_AT_ONCE):
            part = unknown[at : at + MATCHES_AT_ONCE]
            for n, found in zip(part, self._encode_matches([distinct[n] for n in part])):
                ids[n] = found
        self.matches.update((distinct[n], ids[n]) for n in new)
        found, ends = _gather(ids, matches.indices)
        return _cut(found.tobytes(), ends[split.offsets.to_numpy()[1:]])

    def _learn(self, new: pa.Array) -> list[bytes]:
        """Ids of words that are not remembered; all but words too long for it then are."""
        distinct = _bytes(new)
        ids = list(map(self.old_words.get, distinct))
        unknown = pa.array([n for n, known in enumerate(ids) if known is None], pa.int64())
        words = new.take(unknown)
        long = pc.greater(pc.binary_length(words), CACHED_BYTES)
        special = pc.or_(long, pc.match_substring(words, "<|"))
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), special)
        for n, found in zip(unknown.filter(plain).to_pylist(), self._plain_words(words.filter(plain))):
            ids[n] = found
        for n in unknown.filter(pc.invert(plain)).to_pylist():
            ids[n] = self._alone(distinct[n].decode("utf-8"))
        self.words.update(zip(distinct, ids))
        for n in unknown.filter(long).to_pylist():
            del self.words[distinct[n]]
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, a 0 after each, and where each begins in them (and the end).

        Arrow splits and tells words apart, so each distinct word of the texts is looked up once.
        """
        if len(self.words) >= CACHE_WORDS:
            self.old_words, self.words = self.words, {}
        if len(self.matches) >= CACHE_MATCHES:
            self.old_matches, self.matches = self.matches, {}
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = list(map(self.words.get, _bytes(words.dictionary)))
        new = [n for n, known in enumerate(ids) if known is None]
        if new:
            for n, learnt in zip(new, self._learn(words.dictionary.take(pa.array(new)))):
                ids[n] = learnt
        found, end_of_word = _gather(ids, words.indices)
        begins = end_of_word[split.offsets.to_numpy()]
        return np.insert(found, begins[1:], 0), begins + np.arange(len(begins))


def _bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _cut(packed: bytes, ends: np.ndarray) -> list[bytes]:
    """``packed`` ids cut at these ends."""
    places = (4 * ends).tolist()
    return [packed[at:end] for at, end in zip([0, *places], places)]


def _gather(ids: list[bytes], indices: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids that ``indices`` point at, one after the other, and where each ends, after a 0."""
    known = np.frombuffer(b"".join(ids), "<u4")
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    start = np.cumsum(size) - size
    code = indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(size[code])])
    place = np.repeat(start[code] - ends[:-1], size[code])
    return known[place + np.arange(len(place))], ends


@lru_cache(maxsize=2)
def _word_ids(path: str) -> _WordIds:
    return _WordIds(path)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``TEXT_AT_ONCE`` bytes, at least a row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes, dtype=np.int64) // TEXT_AT_ONCE
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
        yield batch.slice(start, end - start)


def _pieces(
    words: _WordIds, block: pa.RecordBatch, capacity: int, with_ids: bool
) -> pa.RecordBatch:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    doc_ids = block.column("doc_id").to_pylist()
    ids, begins = words.encode(pc.fill_null(block.column("text"), ""))
    packed, places = memoryview(ids.tobytes()), begins.tolist()
    rows: list[tuple] = []
    for doc_id, first, end in zip(doc_ids, places, places[1:]):
        for piece, at in enumerate(range(first, end, capacity)):
            part = packed[4 * at : 4 * min(at + capacity, end)]
            row = (doc_id, piece, at - first, len(part) // 4, crc32(part))
            rows.append((*row, part.tobytes()) if with_ids else row)
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])


def tokenise(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and ``ids`` (packed), if wanted.

    A document is its ids and a final 0; a null or empty text is the 0 alone. The tokenizer
    drops white space and never merges across it, so words are encoded by themselves and
    remembered per task (bounded). Pieces hold ``capacity`` ids, the last one the rest.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer_path)
        for batch in batches:
            for block in _blocks(batch):
                yield _pieces(words, block, capacity, with_ids)
                # else Arrow holds what a block took, also while later tasks run beside it
                pa.default_memory_pool().release_unused()

    ship(docs.sparkSession)
    docs = docs.select(f.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; lengths are at most ``capacity`` and sorted downwards.

    Bins are kept by their free space. The spaces in use are the bits of one integer, so the
    tightest bin with room is its lowest bit at or above the length.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, opened = 0, 0
    for i, length in enumerate(lengths.tolist()):
        fitting = spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            chosen = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, chosen = capacity, opened
            opened += 1
        bins[i], offsets[i] = chosen, capacity - space
        space -= length
        if space:
            by_space[space].append(chosen)
            spaces |= 1 << space
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of two families of dual-feasible functions.

    The first rounds (k + 1) x / capacity down to k-ths; the second lifts lengths above
    capacity - e to a whole sequence and drops those below e, for each e up to half.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    total = int(counts @ x)
    best = -(-total // capacity)
    for k in range(1, 65):
        scaled = (k + 1) * x
        weight = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)
        best = max(best, -(-int(counts @ weight) // (k * capacity)))
    mass, number = np.cumsum(counts * x), np.cumsum(counts)
    e = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    middle = mass[capacity - e] - mass[e - 1]
    return max(best, int((large + -(-middle // capacity)).max()))


def _pack_group(capacity: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["row_no", "doc_id", "piece", "start", "length", "ids_crc32"])
        rows = rows.sort_by([("length", "descending"), ("row_no", "ascending")])
        lengths = rows.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        opened = int(bins.max()) + 1
        bound = lower_bound(lengths, capacity)
        filled = np.bincount(bins, weights=lengths, minlength=opened).astype(np.int64)
        if last:
            kept = np.ones(opened, bool)
        elif opened == bound:
            kept = np.ones(opened, bool)
            kept[np.argmin(filled)] = filled.min() == capacity
        else:
            kept = filled == capacity
        group = pa.array(np.full(len(lengths), opened), pa.int64())
        for name, values in (
            ("bin", pa.array(bins)),
            ("offset", pa.array(offsets)),
            ("kept", pa.array(kept[bins])),
            ("bins", group),
            ("bound", pa.array(np.full(len(lengths), bound), pa.int64())),
        ):
            rows = rows.append_column(name, values)
        return rows

    return run


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, partition_items: int = PARTITION_ITEMS
) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset and the partition's
    ``bins`` and lower ``bound`` in the round that placed the piece (null for pieces that fill
    a sequence alone): their difference is what that partition may lose to a perfect packing. Ties
    in length go by row number, so a partition that runs twice packs alike. Repeated rows and
    null doc_ids are pieces like any other; no piece, no sequence.
    """
    ship(pieces.sparkSession)
    numbered = store(
        pieces.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn(
            "row_no", f.monotonically_increasing_id()
        ),
        "pieces",
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = [
        numbered.filter(f.col("length") >= capacity).select(
            *columns,
            (-1 - f.col("row_no")).alias("sequence_id"),
            f.lit(0).cast("bigint").alias("offset"),
            f.lit(None).cast("bigint").alias("bins"),
            f.lit(None).cast("bigint").alias("bound"),
        )
    ]

    rest = numbered.filter(f.col("length") < capacity)
    items = rest.count()
    rounds: list[DataFrame] = []
    kept, fewest, best, idle = 0, 0, 0, 0
    while items:
        turn, groups = len(rounds), ceil(items / partition_items)
        dealt = rest.withColumn("part", f.pmod(f.xxhash64("row_no", f.lit(turn)), f.lit(groups)))
        packed = dealt.groupBy("part").applyInArrow(
            _with_part(_pack_group(capacity, groups == 1)), _PACKED + ", part bigint"
        )
        rounds.append(store(packed, f"packed{turn}"))
        used, certified, items, left = _progress(rounds[-1])
        saved = not turn or kept + used < fewest
        if saved:
            fewest, best = kept + used, turn
        idle = 0 if saved or certified else idle + 1
        if groups == 1 or idle == PATIENCE:
            break
        kept += used - left
        rest = rounds[-1].filter("not kept").select("row_no", *columns)
    for turn, packed in enumerate(rounds[: best + 1]):
        # 14 bits of the round, 28 of the partition, 21 of the sequence in it
        sequence = f.lit(turn << 49) + f.shiftleft("part", 21) + f.col("bin")
        placed.append(
            (packed if turn == best else packed.filter("kept")).select(
                *columns, sequence.alias("sequence_id"), "offset", "bins", "bound"
            )
        )
    result = placed[0]
    for more in placed[1:]:
        result = result.union(more)
    return result


def _progress(packed: DataFrame) -> tuple[int, int, int, int]:
    """Sequences used, certified partitions, and pieces and sequences that are not kept."""
    sequences = packed.groupBy("part", "bin").agg(
        f.first("kept").alias("kept"),
        f.first("bins").alias("bins"),
        f.first("bound").alias("bound"),
        f.count("*").alias("pieces"),
    )
    kept = f.col("kept")
    row = sequences.agg(
        f.count("*").alias("used"),
        f.count_if((f.col("bins") == f.col("bound")) & (f.col("bin") == 0)).alias("certified"),
        f.sum(f.when(kept, 0).otherwise(f.col("pieces"))).alias("pieces"),
        f.count_if(~kept).alias("left"),
    ).first()
    return row["used"], row["certified"], row["pieces"] or 0, row["left"]


def _with_part(run):
    def group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = run(table)
        return rows.append_column("part", pa.array([key[0].as_py()] * len(rows), pa.int64()))

    return group
