import hashlib
import itertools
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeproof.llm import cross_align

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
EMPTY = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def files():
    return tuple(open(p, "rb").read() for p in PATHS)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


LETTERS = letters()


def direct(libraries, text):
    """Ids, groups and links of one text by plain loops."""
    a_lib, b_lib = libraries
    if not text:
        return None
    a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
    a_parts = [bytes(LETTERS[c] for c in a_lib.id_to_token(i)) for i in a]
    b_parts = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
               else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_parts) != (" " + text).encode() or b"".join(b_parts) != (" " + text).encode():
        return None
    spans = []
    for parts in (a_parts, b_parts):
        ends = list(itertools.accumulate(map(len, parts)))
        spans.append(list(zip([0, *ends], ends)))
    common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    group = {side: defaultdict(list) for side in (0, 1)}
    for side, ids in ((0, a), (1, b)):
        at = 0
        for i, (_, end) in zip(ids, spans[side]):
            group[side][at].append(str(i))
            at += end == common[at]
    groups = ["|".join(",".join(group[side][g]) for side in (0, 1)) for g in range(len(common))]
    links, j = [], 0
    for i, (s, e) in zip(a, spans[0]):
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(b) and spans[1][k][0] < e:
            links.append((i, b[k]))
            k += 1
    return len(a), len(b), len(common), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def brute(libraries, rows):
    found = [(doc, direct(libraries, text)) for doc, text in rows]
    counts = Counter(p for _, r in found if r for p in r[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc, r in found:
        if r is None:
            out.append((doc, *EMPTY))
        else:
            links = r[3]
            out.append((doc, r[0], r[1], r[2], len(links), sum(counts[p] == best[p[1]] for p in links),
                        sum(counts[p] for p in links), r[4]))
    return sorted(out, key=repr), counts


def measured(df, files, **options):
    rows, pairs = cross_align.alignment_measures(df, *files, **options)
    return sorted((tuple(r) for r in rows.collect()), key=repr), {(r.a, r.b): r.n for r in pairs.collect()}


def test_documents(spark, sf, files, libraries, few):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, counts = brute(libraries, [(r.doc_id, r.text) for r in few])
    got, pairs = measured(docs, files)
    assert got == want and pairs == counts
    joined, _ = measured(docs, files, pairs_sent=0)
    assert joined == want


def test_edges_and_copies(spark, edge, files, libraries):
    hot = spark.createDataFrame([(100 + i, "a copy of one text") for i in range(3000)], "doc_id long, text string")
    odd = spark.createDataFrame(enumerate(["a ▁ b", "<s> <0x41> <|endoftext|>", "nb sp \x1c x", "\n", " ", "é\n\n  ü",
                                           "\x00 zero", "x" * 5000, "日本 語　。"], 5000), "doc_id long, text string")
    df = edge.unionByName(hot, allowMissingColumns=True).unionByName(odd, allowMissingColumns=True)
    want, counts = brute(libraries, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    for sent in (0, cross_align.PAIRS_SENT):
        got, pairs = measured(df, files, pairs_sent=sent)
        assert got == want and pairs == counts
    assert measured(edge.where(F.lit(False)), files) == ([], {})
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert measured(nulls, files)[0] == [(1, *EMPTY), (2, *EMPTY)]


def test_blocks_give_what_whole_texts_give(files, libraries):
    r = random.Random(3)
    parts = [" ", "\n", "\t", "\r", " ", "\x1c", "\x85", "a", "the", " of", "'s", "12", ".", "é", "語", "▁", "<s>",
             "<0x41>", "<|endoftext|>", "᠎", "​", "﻿", "😀", "  "]
    whole, cut = cross_align.Aligner(*files), cross_align.Aligner(*files, block=3)
    assert whole.fast is not None and cut.block == 3
    for _ in range(1500):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        want = direct(libraries, text)
        want = (0, 0, 0, 0, "") if want is None else (*want[:3], len(want[3]), want[4])
        for one in (whole, cut):
            assert one.measure(["some words", text, "z"])[1][:5] == want
