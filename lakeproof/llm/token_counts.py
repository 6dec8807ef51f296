"""Token counts under a unigram vocabulary: Viterbi that carries only score and count.

An Aho-Corasick automaton lists the vocabulary pieces that end at each place; the best path
to a place keeps its score and its number of pieces, and only the last places that a piece
can reach back to are kept. Tie rules of the public unigram tokenizers: of equal scores the
piece that starts earliest wins (a candidate must be strictly better to replace another); a
character without a piece of its own may also be passed as unknown, at ten below the lowest
score, and counts as its UTF-8 bytes. Scores are summed in double precision.

No piece has a word mark behind another character, so every path passes the places where a
mark follows one, and the words between are counted once each and remembered.

Defined results: null or empty text has 0 tokens and score 0; repeated rows are counted each
by itself; columns other than id and text are left out; an empty table stays empty.
"""
from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import regex
import sentencepiece
from pyspark.sql import DataFrame

from lakeproof.llm.common import Memo, by_rows, texts

MARK = "▁"
PENALTY = 10.0
COUNTED = "doc_id long, n_tokens long, n_byte_tokens long, score double"


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces with their scores."""
    scores: dict[str, float]

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = (i for i in range(sp.get_piece_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
        return cls({sp.id_to_piece(i): sp.get_score(i) for i in plain})


class Counter:
    """Counts the pieces of the best path."""

    def __init__(self, vocabulary: Vocabulary):
        self.scores = vocabulary.scores
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - PENALTY
        self.machine = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        # Words may be counted apart only if no piece has a mark after another character.
        self.apart = not any(MARK in p.lstrip(MARK) for p in self.scores)
        self.words = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.memo = Memo(self._path)

    def count(self, text: str) -> tuple[int, int, float]:
        """Pieces of the whole normalised text, how many of them are bytes, the score."""
        if not self.apart:
            return self._path(text)
        pieces = unknown = 0
        score = 0.0
        memo = self.memo
        for word in self.words.findall(text):
            a, b, c = memo[word]
            pieces, unknown, score = pieces + a, unknown + b, score + c
        return pieces, unknown, score

    def _path(self, text: str) -> tuple[int, int, float]:
        size = self.longest + 1
        best = [(0, 0, 0.0)] * size     # ring: pieces, byte pieces, score at the last places
        found = self.machine.iter(text)
        nxt = next(found, None)
        for end in range(1, len(text) + 1):
            # The longest match comes first, so the earliest start is seen first.
            chosen, top, single = None, 0.0, False
            while nxt is not None and nxt[0] == end - 1:
                length, piece = nxt[1]
                before = best[(end - length) % size]
                score = before[2] + piece
                if chosen is None or score > top:
                    chosen, top = (before[0] + 1, before[1], score), score
                single = single or length == 1
                nxt = next(found, None)
            if not single:
                before = best[(end - 1) % size]
                score = before[2] + self.unknown
                if chosen is None or score > top:
                    n = len(text[end - 1].encode("utf-8", "surrogatepass"))
                    chosen = (before[0] + n, before[1] + n, score)
            best[end % size] = chosen
        return best[len(text) % size]


@functools.lru_cache(maxsize=2)
def counter_of(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, Counter]:
    """Normaliser and counter, one for all tasks of a Python worker."""
    return (sentencepiece.SentencePieceProcessor(model_proto=model),
            Counter(Vocabulary.of(model)))


def count_tokens(df: DataFrame, model: bytes, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_byte_tokens, score`` of each whole text.

    ``model`` is a sentence-piece model file; its own normaliser and piece scores are used.
    """
    def start() -> Callable[[int, str], tuple]:
        normaliser, counter = counter_of(model)

        def one(doc: int, text: str) -> tuple:
            return doc, *counter.count(normaliser.normalize(text or ""))
        return one
    return by_rows(texts(df, id_col, text_col), COUNTED, start)
