import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as f

from tests.llm.conftest import TEXTS
from tripmetrics.llm.bpe import decode, encode, encode_piece, load_ranks
from tripmetrics.llm.queries import RANKS


@pytest.fixture(scope="module")
def library():
    ranks = load_ranks(RANKS)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_equals_the_library_and_decodes_back(odd_docs, library):
    docs = odd_docs.select("doc_id", "text", "ids")
    found = decode(encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(found) == len(TEXTS)
    for row in found:
        assert bytes(row.ids) == packed(library.encode_ordinary(row.text or ""))
        assert bytes(row.decoded) == (row.text or "").encode()


def test_random_matches(dice, library):
    ranks = load_ranks(RANKS)
    for _ in range(500):
        piece = bytes(dice.choice(b"aabcehinrst \xc3\xa4\n") for _ in range(dice.randint(1, 40)))
        expected = library._encode_single_piece(piece)
        assert encode_piece(piece, ranks) == expected


def test_leftmost_of_equal_ranks_merges_first():
    ranks = {b"a": 0, b"aa": 1}
    assert encode_piece(b"aaaaa", ranks) == [1, 1, 0]


def test_no_documents(no_docs):
    docs = no_docs.select("doc_id", "text")
    assert decode(encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.range(1).withColumn("ids", f.lit(None).cast("binary"))
    assert bytes(decode(rows, RANKS).first().decoded) == b""
