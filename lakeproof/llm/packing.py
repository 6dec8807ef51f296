"""Packing token sequences into bins by vector best-fit.

A bin has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths). An open bin is a residual vector of the three; a piece goes to the bin, among
those it fits under every constraint, that scores best: the largest dot product of the
piece's and the bin's vectors weighted by demand (``dot``) or the smallest norm of what
would remain (``norm``), both in units of the capacities. Pieces are taken in order of
falling length.

All pieces of one length are alike, and so are all bins in the same state. The rule is
therefore played on counts: how many pieces of each length there are is one small
aggregation (at most ``capacity`` rows), and each step opens or splits few groups of alike
bins, however many rows there are. The result is a table of slots; pieces find theirs by
their rank among the pieces of their length. Ranks come from per-salt counts, so a length
that a third of the rows share is ranked in many tasks.

Defined results: a null or empty text is a document of only the end token; equal rows are
packed each by itself; columns other than id and text are left out; an empty table stays
empty.
"""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from lakeproof.llm.bpe import pack_ids
from lakeproof.llm.common import SLICE, Memo, release_unused, stored, texts, to_batch, worker_cache

PIECES = "doc_id long, piece int, start long, length long, ids binary"
SLOT = ("length", "first_rank", "n", "first_bin", "offset")
MARKS = (b".", b",", b"!", b"?", b":", b";")
# The pieces of a chunk of composed Latin letters, ASCII digits and marks. Without an
# apostrophe the tokenizer splits it in just these.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")


def byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = byte_letters()


class ChunkCodes:
    """Ids of texts, chunk by chunk between ASCII blanks, as packed bytes.

    The tokenizer drops blanks and neither its normaliser nor its split reaches over one,
    so the ids of a text are those of its chunks in a row. It first looks for its added tokens
    in the text as written; each stands for its own id and ends the chunk before it.
    """

    def __init__(self, tokenizer_file: bytes):
        self.tokenizer = Tokenizer.from_str(tokenizer_file.decode())
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word for t in added.values()):
            raise ValueError("added tokens must be found in the text as written, anywhere")
        self.added = {t.content: pack_ids([i]) for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        # Chunks are lower-cased: what looks like an added token in them was none as written.
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model
        self.known = Memo(self._code, 300_000)

    def _code(self, chunk: bytes) -> bytes:
        word = chunk.decode()
        if chunk.isalpha():     # ASCII letters, lower-cased before
            return pack_ids([t.id for t in self.merges.tokenize(word)])
        if chunk[-1:] in MARKS and chunk[:-1].isalpha():
            return self.known[chunk[:-1]] + self.known[chunk[-1:]]
        pieces = PLAIN.findall(word)
        if "".join(pieces) != word:
            return pack_ids(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(pieces) > 1:
            return b"".join([self.known[p.encode()] for p in pieces])
        if not word.isalpha():
            return pack_ids(self.tokenizer.encode(word, add_special_tokens=False).ids)
        # One piece whatever its normal form and case: the merges can be asked for directly.
        spelt = "".join(map(BYTE_LETTERS.__getitem__, word.lower().encode()))
        return pack_ids([t.id for t in self.merges.tokenize(spelt)])

    def encode(self, text: str | None) -> bytes:
        """Packed ids; the tokenizer lower-cases, doing so for A-Z beforehand changes nothing."""
        text = text or ""
        if self.marks is None or not any(t in text for t in self.added):
            return self._plain(text)
        # Parts at odd places are the added tokens that the others stand between.
        parts = self.marks.split(text)
        return b"".join([self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts)])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, text.encode().lower().split()))


@worker_cache
def codes_of(tokenizer_file: bytes) -> ChunkCodes:
    """One memo for all tasks of a Python worker."""
    return ChunkCodes(tokenizer_file)


def tokenised_pieces(df: DataFrame, tokenizer_file: bytes, capacity: int, end_id: int = 1,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids``: each text's ids and the end id, cut at capacity."""
    schema = StructType.fromDDL(PIECES)
    arrow = to_arrow_schema(schema)
    end, step = pack_ids([end_id]), 4 * capacity

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = codes_of(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                docs, bodies = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                rows = []
                for doc, body in zip(docs, bodies, strict=True):
                    ids = codes.encode(body) + end
                    rows += [(doc, i, o // 4, min(step, len(ids) - o) // 4, ids[o:o + step])
                             for i, o in enumerate(range(0, len(ids), step))]
                yield to_batch(rows, arrow)
            release_unused()
    return texts(df, id_col, text_col).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int, max_docs: int, max_attention: int,
         rule: str = "dot") -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, n, first bin, offset)`` for pieces counted by length.

    Piece number ``first rank + i`` of that length goes to bin ``first bin + i``.
    """
    if rule not in ("dot", "norm"):
        raise ValueError(f"unknown rule {rule!r}")
    if any(x > capacity or x * x > max_attention for x in counts) or max_docs < 1:
        raise ValueError("a piece is larger than an empty bin")
    total = sum(counts.values()) or 1
    # Weight of each dimension: how much of its capacity an average piece asks for.
    weight = np.array([sum(x * n for x, n in counts.items()) / total / capacity, 1 / max_docs,
                       sum(x * x * n for x, n in counts.items()) / total / max_attention])

    empty = np.array([capacity, max_docs, max_attention])

    def score(rest: np.ndarray, need: np.ndarray) -> np.ndarray:
        have, ask = rest / empty, need / empty
        if rule == "dot":   # largest when the residual is as tight as the piece
            return (weight * ask * (ask - have)).sum(axis=1)
        return -(weight * (have - ask) ** 2).sum(axis=1)

    # Groups of alike bins: residual vector, first bin, how many.
    rest, first, size, alive = np.zeros((64, 3)), np.zeros(64, int), np.zeros(64, int), 0
    slots, opened = [], 0
    for x in sorted(counts, reverse=True):
        left, rank, need = counts[x], 0, np.array([x, 1, x * x])
        while left:
            fits = np.flatnonzero((rest[:alive] >= need).all(axis=1))
            if len(fits):
                at = fits[np.argmax(score(rest[fits], need))]
            else:
                most = int((empty // need).min())
                if alive == len(size):
                    rest, first, size = (np.concatenate([a, np.zeros_like(a)]) for a in (rest, first, size))
                at, alive = alive, alive + 1
                rest[at], first[at], size[at] = empty, opened, -(-left // most)
                opened += int(size[at])
            used = min(int(size[at]), left)
            slots.append((x, rank, used, int(first[at]), int(capacity - rest[at, 0])))
            after = rest[at] - need
            if used < size[at]:     # split: the others stay as they were
                if alive == len(size):
                    rest, first, size = (np.concatenate([a, np.zeros_like(a)]) for a in (rest, first, size))
                rest[alive], first[alive], size[alive] = rest[at], first[at] + used, size[at] - used
                alive += 1
            rest[at], size[at] = after, used
            if not (after > 0).all():   # full: the last group takes its place
                alive -= 1
                rest[at], first[at], size[at] = rest[alive], first[alive], size[alive]
            rank, left = rank + used, left - used
    return slots


def ranked(df: DataFrame, key: Column, order: list[str], salts: int) -> DataFrame:
    """``df`` with ``rank``, gapless from 0 among the rows of one key; no key meets in one task."""
    salted = df.withColumns({"_key": key, "_salt": F.pmod(F.xxhash64(*order), F.lit(salts))})
    before = Window.partitionBy("_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("_key", "_salt").agg(F.count("*").alias("_n"))
              .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .select("_key", "_salt", "_from"))
    within = F.row_number().over(Window.partitionBy("_key", "_salt").orderBy(*order)) - 1
    return (salted.withColumn("_row", within).join(starts, ["_key", "_salt"])
            .withColumn("rank", F.col("_from") + F.col("_row"))
            .drop("_key", "_salt", "_from", "_row"))


def pack(pieces: DataFrame, capacity: int = 4096, max_docs: int | None = None,
         max_attention: int | None = None, rule: str = "dot") -> DataFrame:
    """``pieces`` (with ``doc_id, piece, length``) and their ``sequence_id, offset``.

    ``pieces`` is read more than once and must give the same rows each time, as a stored
    table does. Capacities left out do not bind.
    """
    spark = pieces.sparkSession
    max_docs, max_attention = max_docs or capacity, max_attention or capacity * capacity
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = plan(counts, capacity, max_docs, max_attention, rule)
    # From Arrow: a list of rows would start Python workers of another kind on every executor.
    table = spark.createDataFrame(pa.table(
        list(np.array(slots, dtype=np.int64).reshape(-1, len(SLOT)).T),
        pa.schema([(c, pa.int64()) for c in SLOT])))
    salts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    rows = ranked(pieces, F.col("length"), order, salts)
    # At most a few slots for each length, so the table is small whatever the input.
    at = (rows.join(F.broadcast(table.withColumnRenamed("length", "_length")),
                    (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first_rank"))
                    & (F.col("rank") < F.col("first_rank") + F.col("n"))))
    return at.select(*(F.col(f"`{c}`") for c in pieces.columns),
                     (F.col("first_bin") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
                     "offset")


def packed_documents(df: DataFrame, tokenizer_file: bytes, capacity: int = 4096,
                     end_id: int = 1, max_docs: int | None = None,
                     max_attention: int | None = None, rule: str = "dot",
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = tokenised_pieces(df, tokenizer_file, capacity, end_id, id_col, text_col)
    short = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(stored(short, "pieces"), capacity, max_docs, max_attention, rule)
