"""Alignment of two tokenizers on the same texts, each distinct text aligned once.

Texts are shuffled by their full text and equal ones become one row with their number. Each
such row is encoded by a byte-level BPE (A, with a space before the text) and by a
sentence-piece model (B, which adds that space itself) and aligned by byte offsets. Counts of
id pairs over the corpus weight each distinct text by its number of copies; what a document
gets is then joined back to the ids by a digest of the text.

Inside a task a block of texts is aligned at once: token ends of both sides are running sums
of token lengths, groups end where both have an end, and each stretch between neighbouring
ends is one link. A text longer than a block is cut where a space or a line end follows a
character that is no blank: A's pattern begins a match there whatever stands around it, and
no piece of B reaches over such a place (the vocabulary is looked through for that, and texts
stay whole if one does).

Pair counts are at most as many as id pairs that ever overlap. Up to ``PAIRS_SENT`` they are
sent to the tasks as sorted arrays; beyond that, links are joined with them in a shuffle.

Defined results: null and empty texts, and texts that one tokenizer does not give back byte
for byte, have no tokens: zeros and an empty digest. Rows equal in text get equal measures,
each row its own; a null id stays null; other columns are left out; an empty table gives an
empty one.
"""
from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from lakeproof.llm.common import SLICE, stored, texts, to_batch
from lakeproof.llm.packing import BYTE_LETTERS
from lakeproof.operators.lookup import lookup

PAIRS_SENT = 2_000_000      # id pairs, 17 bytes each
BLOCK = 500_000             # characters aligned at once
PARTIAL = 1_000_000         # pairs a task adds up before it hands them on
HOT_SHARE = 1000            # texts with more than this part of all rows are at most as many

FIRM = re.compile(r"(?<=\S)[ \n]")
# Characters whose class no two Unicode versions or regex libraries see differently.
PLAIN = re.compile("[\t\n\r -~\u00a1-\u024f]*")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MEASURES = "n_a long, n_b long, n_groups long, n_links long"
ALIGNED = f"key string, copies long, {MEASURES}, groups_sha256 string, pairs binary, times binary"
COUNTED = "a long, b long, n long"
SUMS = f"key string, copies long, {MEASURES}, n_best long, count_sum long, groups_sha256 string"
PAIR_BITS = 32
LETTER_BYTES = {c: b for b, c in BYTE_LETTERS.items()}


class Aligner:
    """Both tokenizers, from the contents of their files."""

    def __init__(self, byte_file: bytes, piece_file: bytes, block: int = BLOCK):
        self.a = Tokenizer.from_str(byte_file.decode())
        self.a.encode_special_tokens = True
        self.fast = rank_coder(json.loads(byte_file), self.a)
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(piece_file)
        a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(False).items():
            a_bytes[i] = spelt_bytes(token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i, p in enumerate(pieces)]
        plain = [p for i, p in enumerate(pieces)
                 if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        cuts = not any(re.search("[^\u2581]\u2581", p) or (len(p) > 1 and "\n" in p) for p in plain)
        self.block = block if cuts else None
        self.space = self.b.piece_to_id("\u2581")
        # By side: bytes of each id, their lengths, the id in digits before the next one or
        # (second half) before what ends its part of the group.
        self.sides = [(parts, np.array([len(p) for p in parts]),
                       np.array([f"{i}{mark}".encode() for mark in (",", end) for i in range(len(parts))], object))
                      for parts, end in ((a_bytes, "|"), (b_bytes, ";"))]

    def blocks(self, text: str) -> Iterator[str]:
        """Space + text, cut at firm places."""
        text, start = " " + text, 0
        while start < len(text):
            long = self.block is not None and len(text) - start > self.block
            found = FIRM.search(text, start + self.block) if long else None
            end = found.start() if found else len(text)
            yield text[start:end]
            start = end

    def encode(self, block: str) -> tuple[list[int], list[int]]:
        """Ids of both sides for a block, which begins with a space or a line end."""
        if self.fast and PLAIN.fullmatch(block):
            a = self.fast.encode_ordinary(block)
        else:
            a = self.a.encode(block, add_special_tokens=False).ids
        # B puts a space before what it is given: it stands for the one of the block, or is
        # a token of its own before a line end and taken off.
        if block == " ":
            return a, [self.space]
        if block[0] == " ":
            return a, self.b.encode(block[1:])
        b = self.b.encode(block)
        return a, b[1:] if b[:1] == [self.space] else []

    def same_bytes(self, body: bytes, ids: tuple[list[int], list[int]]) -> bool:
        return all(b"".join(map(parts.__getitem__, i)) == body for (parts, _, _), i in zip(self.sides, ids, strict=True))

    def measure(self, some: list[str]) -> list[tuple]:
        """``n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of each whole text."""
        sums = [Sums() for _ in some]
        waiting, size = [], 0
        for at, text in enumerate(some):
            for block in self.blocks(text):
                body = block.encode()
                ids = self.encode(block)
                if not self.same_bytes(body, ids):
                    sums[at] = None
                    break
                waiting.append((at, len(body), *ids))
                size += len(block)
                if size > (self.block or BLOCK):
                    self._align(waiting, sums)
                    waiting, size = [], 0
        self._align(waiting, sums)
        return [s.result() if s else NO_TOKENS for s in sums]

    def _align(self, waiting: list[tuple], sums: list) -> None:
        if not waiting:
            return
        stops = np.cumsum([n for _, n, _, _ in waiting])
        ids = [np.array([i for w in waiting for i in w[2 + side]], dtype=np.int64) for side in (0, 1)]
        ends = [np.cumsum(lengths[i]) for (_, lengths, _), i in zip(self.sides, ids, strict=True)]
        # Whether a token's end is also one of the other side, and the group of each token.
        cut = [ends[1 - s][np.searchsorted(ends[1 - s], ends[s])] == ends[s] for s in (0, 1)]
        group = [np.cumsum(c) - c for c in cut]
        n_groups = int(cut[0].sum())
        # A group's ids in digits: those of A before those of B, group by group.
        before = [np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n_groups))]) for g in group]
        digits = np.empty(len(ids[0]) + len(ids[1]), object)
        for s in (0, 1):
            place = np.arange(len(ids[s])) + before[1 - s][group[s] + s]
            digits[place] = self.sides[s][2][ids[s] + cut[s] * len(self.sides[s][0])]
        links_end = np.union1d(*ends)
        links = [ids[s][np.searchsorted(ends[s], links_end)].astype(np.uint64) for s in (0, 1)]
        pairs = (links[0] << np.uint64(PAIR_BITS)) | links[1]
        to = [np.searchsorted(x, stops, "right") for x in (*ends, ends[0][cut[0]], links_end)]
        since = (0, 0, 0, 0)
        for k, (at, *_) in enumerate(waiting):
            until = tuple(int(t[k]) for t in to)
            if sums[at] is not None:
                part = digits[since[0] + since[1]:until[0] + until[1]]
                sums[at].add([u - s for u, s in zip(until, since, strict=True)], b"".join(part.tolist()),
                             pairs[since[3]:until[3]])
            since = until


class Sums:
    """What the blocks of one text add up to."""

    def __init__(self):
        self.counts, self.digest, self.last, self.bags = [0, 0, 0, 0], hashlib.sha256(), b"", []

    def add(self, counts: list[int], groups: bytes, pairs: np.ndarray) -> None:
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]
        self.digest.update(self.last + groups[:-1])     # the last mark only if more follows
        self.last = groups[-1:]
        self.bags.append(np.unique(pairs, return_counts=True))

    def result(self) -> tuple:
        pairs, times = self.bags[0] if len(self.bags) == 1 else added(self.bags)
        return *self.counts, self.digest.hexdigest(), pairs.tobytes(), times.astype(np.uint32).tobytes()


def spelt_bytes(token: str) -> bytes:
    """The bytes that a byte-level token spells; none for one that spells no bytes."""
    try:
        return bytes(map(LETTER_BYTES.__getitem__, token))
    except KeyError:
        return b""


def rank_coder(parsed: dict, tokenizer: Tokenizer) -> tiktoken.Encoding | None:
    """The same encoding by ranks, several times faster; None if the file is not so ordered.

    It must split by the usual pattern, have its merges in the order of the ids they make,
    and give every token back as itself.
    """
    split = parsed["pre_tokenizer"] or {}
    made = [parsed["model"]["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1)
            for m in parsed["model"]["merges"]]
    plain = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
             and parsed["normalizer"] is None and made == sorted(set(made)))
    if not plain or any(len(tokenizer.model.tokenize(t)) != 1 for t in parsed["model"]["vocab"]):
        return None
    ranks = {spelt_bytes(t): i for t, i in parsed["model"]["vocab"].items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


NO_TOKENS = (0, 0, 0, 0, "", b"", b"")


def added(bags: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their summed numbers."""
    keys = np.concatenate([k for k, _ in bags])
    numbers = np.concatenate([n for _, n in bags]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(numbers[order], starts) if len(keys) else numbers


@functools.lru_cache(maxsize=1)
def aligner_of(byte_file: bytes, piece_file: bytes) -> Aligner:
    """One aligner for all tasks of a Python worker."""
    return Aligner(byte_file, piece_file)


def align_texts(distinct: DataFrame, byte_file: bytes, piece_file: bytes) -> DataFrame:
    """``ALIGNED`` of rows ``text, copies``."""
    schema = StructType.fromDDL(ALIGNED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner_of(byte_file, piece_file)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                keys, bodies, copies = (c.to_pylist() for c in part.columns)
                yield to_batch([(k, n, *m) for k, n, m in zip(keys, copies, one.measure(bodies), strict=True)], arrow)
    return distinct.select(F.sha2("text", 256).alias("key"), "text", "copies").mapInArrow(run, schema)


def bag(pairs: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(pairs, np.uint64), np.frombuffer(times, np.uint32).astype(np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, n, best``: links of each id pair over the corpus; whether b has none higher."""
    schema = StructType.fromDDL(COUNTED)
    arrow = to_arrow_schema(schema)

    def rows(bags: list) -> pa.RecordBatch:
        keys, n = added(bags)
        low = np.uint64((1 << PAIR_BITS) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array((keys >> np.uint64(PAIR_BITS)).astype(np.int64)), pa.array((keys & low).astype(np.int64)),
             pa.array(n)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, waiting = [], 0
        for batch in batches:
            for copies, pairs, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, n = bag(pairs, times)
                bags.append((keys, n * copies))
                waiting += len(keys)
                if waiting > 2 * PARTIAL:
                    bags = [added(bags)]
                    waiting = len(bags[0][0])
                    if waiting > PARTIAL:
                        yield rows(bags)
                        bags, waiting = [], 0
        if bags:
            yield rows(bags)
    partial = aligned.where("n_links > 0").select("copies", "pairs", "times").mapInArrow(run, schema)
    totals = partial.groupBy("a", "b").agg(F.sum("n").alias("n"))
    # At most as many rows for one b as A has ids.
    best = F.col("n") == F.max("n").over(Window.partitionBy("b"))
    return totals.withColumn("best", best)


def _sent(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``SUMS`` with the pair counts as sorted arrays in every task."""
    table = counts.withColumn("pair", F.shiftleft("a", PAIR_BITS).bitwiseOR(F.col("b"))).select("pair", "n", "best").toPandas()
    order = np.argsort(table["pair"].to_numpy(np.uint64))
    known, n, best = (table[c].to_numpy(t)[order] for c, t in
                      (("pair", np.uint64), ("n", np.int64), ("best", np.bool_)))
    schema = StructType.fromDDL(SUMS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = []
                for key, copies, *sizes, digest, pairs, times in zip(
                        *(c.to_pylist() for c in batch.slice(at, SLICE).columns), strict=True):
                    keys, links = bag(pairs, times)
                    place = np.searchsorted(known, keys)
                    out.append((key, copies, *sizes, int(links[best[place]].sum()), int((links * n[place]).sum()), digest))
                yield to_batch(out, arrow)
    return aligned.mapInArrow(run, schema)


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``SUMS`` by a join of every distinct link of a text with the pair counts."""
    schema = StructType.fromDDL("key string, a long, b long, links long")
    arrow = to_arrow_schema(schema)
    low = np.uint64((1 << PAIR_BITS) - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, pairs, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, links = bag(pairs, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(keys), pa.string()), pa.array((keys >> np.uint64(PAIR_BITS)).astype(np.int64)),
                     pa.array((keys & low).astype(np.int64)), pa.array(links)], schema=arrow)
    links = aligned.where("n_links > 0").select("key", "pairs", "times").mapInArrow(run, schema)
    sums = (lookup(links, counts, ["a", "b"]).groupBy("key")
            .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("links") * F.col("n")).alias("count_sum")))
    return aligned.drop("pairs", "times").join(sums, "key", "left").select(
        *(c for c in StructType.fromDDL(SUMS).names if c not in ("n_best", "count_sum", "groups_sha256")),
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256")


def alignment_measures(df: DataFrame, byte_file: bytes, piece_file: bytes, id_col: str = "doc_id",
                       text_col: str = "text", pairs_sent: int = PAIRS_SENT) -> tuple[DataFrame, DataFrame]:
    """``(measures, pairs)``: a row per row of ``df``, and ``a, b, n, best`` of every id pair.

    Measures are ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.
    """
    rows = texts(df, id_col, text_col)
    filled = rows.where("length(text) > 0")
    distinct = filled.groupBy("text").agg(F.count("*").alias("copies"))
    aligned = stored(align_texts(distinct, byte_file, piece_file), "aligned", "zstd")
    counts = stored(pair_counts(aligned), "pairs")
    small = counts.count() <= pairs_sent
    sums = stored((_sent if small else _joined)(aligned, counts), "sums")

    keyed = stored(rows.select("doc_id", F.when(F.length("text") > 0, F.sha2("text", 256)).alias("key")), "keyed")
    many = keyed.count() / HOT_SHARE
    hot = F.broadcast(sums.where(F.col("copies") > many))
    with_key = keyed.where("key is not null")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    empty = keyed.where("key is null").select("doc_id", *(F.lit(0).cast("long").alias(c) for c in names[1:-1]),
                                              F.lit("").alias(names[-1]))
    parts = [with_key.join(hot, "key").select(names),
             with_key.join(hot.select("key"), "key", "left_anti").join(sums.where(F.col("copies") <= many), "key").select(names),
             empty]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]), counts
