import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeproof.llm import packing
from lakeproof.llm.bpe import pack_ids
from lakeproof.llm.common import file_bytes
from lakeproof.llm.queries import QUERIES

FILE = file_bytes(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_str(FILE.decode())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_equal_the_library(library, few):
    codes, r = packing.ChunkCodes(FILE), random.Random(1)
    letters = [*"abcABC.,!?:;' \n\t019éÉÄßşŞŉſĿñÑ", "é", "İ", "'s", "’", "漢", "字", "١", "́", " ",
               "\x1c", "ﬁ", "Σ", "Å", "<|endoftext|>"]
    made = ["".join(r.choice(letters) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    for text in made + [t[:3000] for _, t in few[:60]]:
        assert codes.encode(text) == pack_ids(library(text)), repr(text)


def test_added_tokens_are_found_as_written(library):
    codes = packing.ChunkCodes(FILE)
    assert library("hello <|endoftext|> world")[1] == 49407
    for text in ["hello <|endoftext|> world", "a<|endoftext|>b", "<|EndOfText|>", "<|endoftext|><|startoftext|>",
                 "x\n<|startoftext|>\ny <|endoftext|", "don<|endoftext|>'t", "e<|endoftext|>\u0301"]:
        assert codes.encode(text) == pack_ids(library(text)), text


@pytest.mark.parametrize("rule", ["dot", "norm"])
@pytest.mark.parametrize("limits", [(100, 100, 10_000), (100, 3, 10_000), (100, 100, 4000), (100, 4, 3600)])
def test_plan_keeps_every_capacity(rule, limits):
    capacity, docs, attention = limits
    r = random.Random(7)
    counts = Counter(r.choice([r.randint(1, 60), r.randint(1, 9), 17]) for _ in range(3000))
    bins, seen = defaultdict(list), Counter()
    for x, rank, n, first, offset in packing.plan(counts, capacity, docs, attention, rule):
        assert rank == seen[x]
        seen[x] += n
        for b in range(first, first + n):
            bins[b].append((offset, x))
    assert seen == counts
    for items in bins.values():
        assert len(items) <= docs and sum(x * x for _, x in items) <= attention
        end = 0
        for offset, x in sorted(items):
            assert offset == end
            end += x
        assert end <= capacity
    least = max(sum(x * n for x, n in counts.items()) / capacity, sum(counts.values()) / docs,
                sum(x * x * n for x, n in counts.items()) / attention)
    assert len(bins) <= 1.12 * least + 1


def check(rows, want, capacity):
    ids = {}
    by_bin = defaultdict(list)
    for r in rows:
        by_bin[r.sequence_id].append((r.offset, r.length))
        ids[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] = ids.get(
            (r.doc_id, r.piece, r.start, r.length, r.ids_crc32), 0) + 1
    assert ids == want
    for items in by_bin.values():
        end = 0
        for offset, n in sorted(items):
            assert offset == end
            end += n
        assert end <= capacity
    total = sum(n for items in by_bin.values() for _, n in items)
    assert len(by_bin) <= total / capacity * 1.02 + 1


def wanted(rows, library, capacity):
    out = Counter()
    for doc, text in rows:
        ids = library(text or "") + [1]
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out[doc, i, at, len(part), zlib.crc32(pack_ids(part))] += 1
    return dict(out)


def test_query(spark, sf, few, library):
    rows = QUERIES["op9_best_fit_packing"](spark, sf).collect()
    check(rows, wanted(few, library, 4096), 4096)


def test_edges(edge, library):
    rows = packing.packed_documents(edge, FILE, 4096).collect()
    check(rows, wanted(edge.select("doc_id", "text").collect(), library, 4096), 4096)
    assert packing.packed_documents(edge.where(F.lit(False)), FILE).count() == 0


def test_one_length_only(spark):
    df = spark.range(1000).selectExpr("id as doc_id", "'same words here' as text")
    rows = packing.packed_documents(df, FILE, 64).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000
    assert len({r.sequence_id for r in rows}) == -(-1000 // (64 // rows[0].length))
