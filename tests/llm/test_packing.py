import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from tests.llm.conftest import TEXTS
from tripmetrics.llm import packing
from tripmetrics.llm.packing import best_fit_decreasing, lower_bound, pack, tokenise
from tripmetrics.llm.queries import WORDS


def check_sequences(rows, capacity):
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
    for members in sequences.values():
        at = 0
        for row in sorted(members, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= capacity
    return len(sequences)


def test_documents(odd_docs):
    rows = pack(tokenise(odd_docs, WORDS)).collect()
    check_sequences(rows, 2048)
    tokenizer = Tokenizer.from_file(WORDS)
    expected, total = [], 0
    for i, text in TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4").tobytes()
            expected.append((i, piece, at, len(part) // 4, zlib.crc32(part)))
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert len({r.sequence_id for r in rows}) == -(-total // 2048)


@pytest.mark.parametrize("items", [60, 100_000])
def test_many_partitions_exchange_their_rests(spark, dice, items):
    """Lengths like those of documents: the bound is met but for one sequence a partition left."""
    lengths = [min(2048, int(dice.lognormvariate(5.5, 1))) or 1 for _ in range(900)]
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    packed = pack(spark.createDataFrame(rows, schema), partition_items=items).collect()
    assert sorted(r.doc_id for r in packed) == list(range(900))
    used = check_sequences(packed, 2048)
    bound = lower_bound(np.array(lengths), 2048)
    assert bound <= used <= bound + 1
    assert all(r.bound <= r.bins for r in packed if r.bins)


def test_bound_and_packing(dice):
    for _ in range(200):
        capacity = dice.choice([10, 100, 2048])
        lengths = sorted((dice.randint(1, capacity) for _ in range(dice.randint(1, 60))), reverse=True)
        bins, offsets = best_fit_decreasing(np.array(lengths), capacity)
        used = int(bins.max()) + 1
        assert lower_bound(np.array(lengths), capacity) <= used
        fill = np.zeros(used, int)
        for length, b, at in zip(lengths, bins, offsets):
            assert fill[b] == at
            fill[b] += length
        assert fill.max() <= capacity


def test_dual_feasible_bound_beats_the_sum():
    assert lower_bound(np.array([60] * 5), 100) == 5
    assert lower_bound(np.array([40] * 6), 100) == 3
    assert lower_bound(np.array([34] * 4), 100) == 2


def test_no_documents(no_docs):
    assert pack(tokenise(no_docs, WORDS)).count() == 0


def test_exchange_goes_on_while_it_saves(spark, dice):
    """Awkward lengths in many small partitions take more than six rounds."""
    lengths = [dice.randint(520, 800) for _ in range(3000)]
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    frame = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], schema).coalesce(2)
    packed = pack(frame, partition_items=60).collect()
    assert sorted(r.doc_id for r in packed) == list(range(3000))
    used = check_sequences(packed, 2048)
    bins, _ = best_fit_decreasing(np.array(sorted(lengths, reverse=True)), 2048)
    assert lower_bound(np.array(lengths), 2048) <= used <= 1.015 * (int(bins.max()) + 1)
    assert max(r.sequence_id >> 49 for r in packed) >= 6


def test_ids_are_those_of_the_tokenizer(spark, odd_docs):
    tokenizer = Tokenizer.from_file(WORDS)
    expected = {}
    for n, (i, text) in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.setdefault(i, set()).add(np.array(ids, "<u4").tobytes())
    found = {}
    for row in tokenise(odd_docs, WORDS, capacity=1 << 22).collect():
        found.setdefault(row.doc_id, set()).add(bytes(row.ids))
    assert found == expected


def test_full_memories_start_anew(monkeypatch, dice):
    """Frequent words outlive a full memory, matches too; every id stays that of the tokenizer."""
    for name, size in (("CACHE_WORDS", 40), ("CACHE_MATCHES", 15), ("MATCHES_AT_ONCE", 4)):
        monkeypatch.setattr(packing, name, size)
    words = packing._WordIds(WORDS)
    tokenizer = Tokenizer.from_file(WORDS)
    for _ in range(30):
        new = [f"It's {dice.getrandbits(24):x} the end, don't" for _ in range(5)]
        texts = [*new, "", "the the x1y2 Ünï 中文 " + "z" * 90]
        ids, begins = words.encode(pa.array(texts))
        alone = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert ids.tolist() == [i for one in alone for i in one]
        assert np.diff(begins).tolist() == [len(one) for one in alone]
        assert len(words.matches) < 15 + 100 and len(words.old_matches) < 15 + 100


_TAKES = """
import random, re, sys
import pyarrow as pa
from tripmetrics.llm.packing import _blocks, _word_ids

def taken():
    found = re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())
    return int(found[0]) >> 10

def text():
    return " ".join(f"{dice.getrandbits(40):x} word" for _ in range(350))

dice, words = random.Random(3), _word_ids(sys.argv[1])
before, most = taken(), 0
for _ in range(12):
    batch = pa.RecordBatch.from_pydict({"text": [text() for _ in range(500)]})
    for block in _blocks(batch):
        words.encode(block.column("text"))
        most = max(most, taken() - before)
print(most)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_words_that_never_return_take_bounded_memory():
    """Two million distinct words; a worker holds the memories for as long as it lives."""
    done = subprocess.run(
        [sys.executable, "-c", _TAKES, WORDS],
        cwd=Path(packing.__file__).parents[2],
        capture_output=True,
        text=True,
    )
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 200


def test_plain_words_are_normalised_and_split_once(dice):
    """Arrow lower-cases and splits new plain words, all characters; only the model sees them."""
    words = packing._WordIds(WORDS)
    tokenizer, words.tokenizer = words.tokenizer, None
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x180)) if chr(c) not in "İ<"]
    texts = ["".join(dice.choices(letters, k=dice.randint(1, 12))) for _ in range(3000)]
    texts += [a + b for a in ("It", "don", "''", "9", "É") for b in ("'s", "'T", "'re", "'LL", "'d1", "'dé")]
    texts += letters
    ids, _ = words.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in (*tokenizer.encode(t, add_special_tokens=False).ids, 0)]


def test_a_tokenizer_that_splits_otherwise_encodes_itself(tmp_path):
    other = Tokenizer.from_file(WORDS)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    other.save(str(tmp_path / "other.json"))
    words = packing._WordIds(str(tmp_path / "other.json"))
    assert words.matcher is words.tokenizer
