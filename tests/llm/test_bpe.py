import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakeproof.llm import bpe
from lakeproof.llm.common import file_bytes
from lakeproof.llm.queries import QUERIES

RANKS = file_bytes(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
PARTS = ["a", " ", "'", "s", "  ", "\n", "\t", "7", "!", "é", "漢", "字", "ll", "re", "the", "　", " ",
         "\U0001F600", "\x1c", "x" * 30, " " * 20, "́", "٣", "\U0001E4F0"]


@pytest.fixture(scope="module")
def plain():
    codec = bpe.TreeCodec(RANKS, PATTERN)
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.mark.parametrize("sizes", [(3, 9, 5), (7, 20, 6), (16, 40, 8)])
def test_small_leaves_give_the_flat_encoding(plain, sizes):
    codec, r = bpe.TreeCodec(RANKS, PATTERN, *sizes), random.Random(sizes[0])
    for _ in range(1500):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 60)))
        ids = codec.encode(text)
        assert ids == plain.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("unit", ["a", "ab", "é", "漢字", "  ", "'", "\n", "!?", "abcdefgh"])
def test_long_pieces(plain, unit):
    for size in (100, 5000, 30_000):
        text = (unit * size)[:size]
        assert bpe.TreeCodec(RANKS, PATTERN, 64, 200, 16).encode(text) == plain.encode_ordinary(text)


def test_query_equals_the_library_on_whole_texts(spark, sf, few, plain):
    got = {r.doc_id: r for r in QUERIES["op1_bpe_round_trip"](spark, sf).collect()}
    assert len(got) == len(few)
    for doc, text in few:
        ids = plain.encode_ordinary(text)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(bpe.pack_ids(ids)).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edges(edge, spark, plain):
    out = bpe.decode(bpe.encode(edge, RANKS, PATTERN), RANKS, PATTERN)
    assert out.columns == ["doc_id", "ids", "decoded"]
    want = sorted((r.doc_id or 0, (r.text or "").encode()) for r in edge.select("doc_id", "text").collect())
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in out.collect()) == want
    assert bpe.encode(edge.where(F.lit(False)), RANKS, PATTERN).count() == 0
