import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from lakeproof.llm import token_counts as tc
from lakeproof.llm.common import file_bytes

MODEL = file_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def by_library(vocabulary, texts):
    """Counts of the public unigram tokenizer under the same pieces, bytes as a fallback."""
    pieces = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *vocabulary.scores.items()]
    low = min(vocabulary.scores.values())
    pieces = [(p, s if i > 256 else low) for i, (p, s) in enumerate(pieces)]
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_real_vocabulary_equals_the_library(few):
    vocabulary = tc.Vocabulary.of(MODEL)
    counter = tc.Counter(vocabulary)
    sp = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = [sp.normalize(t) for _, t in few]
    assert [counter.count(t)[0] for t in texts] == by_library(vocabulary, texts)


def test_ties_and_unknowns_equal_the_library():
    r = random.Random(3)
    for _ in range(60):
        words = {"".join(r.choice("ab▁c") for _ in range(r.randint(1, 4))) for _ in range(12)}
        vocabulary = tc.Vocabulary({w: float(-r.randint(1, 3)) for w in words})
        texts = ["".join(r.choice("ab▁céd") for _ in range(r.randint(0, 30))) for _ in range(40)]
        counter = tc.Counter(vocabulary)
        assert [counter.count(t)[0] for t in texts] == by_library(vocabulary, texts)


def test_edges(edge):
    got = tc.count_tokens(edge, MODEL)
    assert got.count() == edge.count()
    assert {(r.doc_id, r.n_tokens) for r in got.where("n_tokens = 0").collect()} == {(2, 0), (3, 0), (None, 0)}
    assert tc.count_tokens(edge.where(F.lit(False)), MODEL).count() == 0
