"""Licence scans by a positional index of rare words.

Templates are short licence texts, phrases among them. An index holds, for each template's
words of highest IDF (over the scanned corpus), where in the template they stand. A file's
words that are in the index are looked up; each hit proposes a place of the template,
the difference of the two positions. Hits are intersected by place: a place of a longer template
needs hits from ``AGREE`` places of its index (all, if it has fewer) that propose it, give or take
``DRIFT`` words. It counts if the template's mandatory key phrase stands there word for word; its
score is the IDF-weighted share of the template's words found at their places, as freely.

A phrase is a template that is its own key phrase. Its rarest word is in the index, so each
place where its words stand consecutively is proposed and found.

Defined results: null and empty texts have no words, no places and empty labels; repeated
rows are scanned each by itself; columns other than id and text are left out; an empty table
stays empty.
"""
from __future__ import annotations

import functools
import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.common import by_rows, texts

# A to Z are lower-cased first, so all bytes up to 0x7F but digits and a to z separate words.
SEPARATORS = bytes.maketrans(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]),
                             b" " * (0x30 + 0x27 + 5))
ANCHORS = 4          # index words of each template
AGREE = 3            # places of the index that must propose one place of a longer template
DRIFT = 2            # words a template word may stand off its place
MIN_SCORE = 0.5      # share of a longer template that its label needs

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, mandatory key phrase, licence text.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction "
     "including without limitation the rights to use copy modify merge publish distribute sublicense "
     "and or sell copies of the software"),
    ("apache", "licensed under the apache license",
     "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license",
     "this program is free software you can redistribute it and or modify it under the terms of the "
     "gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met"),
    ("cc-by", "licensed under cc by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa", "licensed under cc by sa 4 0"),
    ("apache", "licensed under the apache license", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license",
     "this work is licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license", "released under the mit license"),
    ("reserved", "all rights reserved", "all rights reserved"),
)

SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double, places array<struct<label: string, "
           "start: long, length: long, score: double>>")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(SEPARATORS).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: tuple[bytes, ...]
    phrase: bool    # a base phrase

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key)


@functools.cache
def templates() -> tuple[Template, ...]:
    out = [Template(label, tuple(words_of(p)), tuple(words_of(p)), True) for p, label in PHRASES.items()]
    out += [Template(label, tuple(words_of(body)), tuple(words_of(key)), False)
            for label, key, body in TEMPLATES]
    return tuple(out)


def vocabulary() -> set[bytes]:
    return {w for t in templates() for w in t.words}


def document_frequencies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[bytes, int]:
    """In how many texts each licence word stands, over all rows; key ``b""`` counts texts.

    The result has a row for each template word at most.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = vocabulary(), Counter()
        for batch in batches:
            for text in batch.column("text"):
                found.update(known.intersection(words_of(text.as_py())))
            found[b""] += batch.num_rows
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.binary()),
                                          "n": pa.array(list(found.values()), pa.int64())})
    parts = texts(df, id_col, text_col).select("text").mapInArrow(run, "word binary, n long")
    return {bytes(r[0]): r[1] for r in parts.groupBy("word").agg(F.sum("n")).collect()}


class Index:
    """Where the rarest words of each template stand."""

    def __init__(self, frequency: dict[bytes, int]):
        total = frequency.get(b"", 0)
        self.idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) + 1 for w in vocabulary()}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed: list[int] = []
        for number, t in enumerate(templates()):
            # A phrase or key phrase is always proposed by a word of its own.
            rare = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[:ANCHORS]
            rarest_key = min(t.key, key=lambda w: (-self.idf[w], w))
            for at, w in enumerate(t.words):
                if w in rare or w == rarest_key:
                    self.postings[w].append((number, at))
            indexed = sum(w in rare or w == rarest_key for w in t.words)
            self.needed.append(1 if t.phrase else min(AGREE, indexed))

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        postings, every = self.postings, templates()
        hits: dict[tuple[int, int], set[int]] = defaultdict(set)
        for at, w in enumerate(words):
            if w in postings:
                for number, place in postings[w]:
                    hits[number, at - place].add(place)
        base, places = [], {}
        for number, start in list(hits):
            t = every[number]
            if not self._agreed(hits, number, start):
                continue
            key_at = self._key_place(words, t, start)
            if key_at is None:
                continue
            score = 1.0 if t.phrase else self._coverage(words, t, key_at - t.key_at)
            if t.phrase:
                base.append((key_at, t.label))
            elif score < MIN_SCORE:
                continue
            spot = (t.label, key_at, len(t.key))
            places[spot] = max(places.get(spot, 0.0), score)
        starts = sorted(at for at, _ in base)
        labels = {label for label, _, _ in places}
        return (len(words), len(base), starts[0] if base else None, starts[-1] if base else None,
                ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)),
                max(places.values(), default=0.0),
                [(label, at, n, s) for (label, at, n), s in sorted(places.items())])

    def _agreed(self, hits: dict[tuple[int, int], set[int]], number: int, start: int) -> bool:
        """Whether enough of the template's postings meet at this place."""
        needed = self.needed[number]
        if len(hits[number, start]) >= needed:
            return True
        near = (hits.get((number, start + off), ()) for off in range(-DRIFT, DRIFT + 1))
        return len(set().union(*near)) >= needed

    @staticmethod
    def _key_place(words: list[bytes], t: Template, start: int) -> int | None:
        """Where the key phrase stands for a proposed start; longer templates may drift."""
        expected, n = start + t.key_at, len(t.key)
        for off in (0,) if t.phrase else sorted(range(-DRIFT, DRIFT + 1), key=abs):
            at = expected + off
            if at >= 0 and tuple(words[at:at + n]) == t.key:
                return at
        return None

    def _coverage(self, words: list[bytes], t: Template, start: int) -> float:
        found = total = 0.0
        for at, w in enumerate(t.words):
            total += self.idf[w]
            low = max(0, start + at - DRIFT)
            if w in words[low:max(low, start + at + DRIFT + 1)]:
                found += self.idf[w]
        return found / total


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places, labels and score of each whole text; ``places`` lists every accepted place."""
    frequency = document_frequencies(df, id_col, text_col)

    def start() -> Callable[[int, str], tuple]:
        index = Index(frequency)
        return lambda doc, text: (doc, *index.scan(text))
    return by_rows(texts(df, id_col, text_col), SCANNED, start)
