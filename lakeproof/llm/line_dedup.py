"""Line dedup by pairwise alignment.

A seed is a shortest run of lines (blank ones aside) with ``MIN_WORDS`` words or more, taken
forward from each line and backward from it; a long line is a seed by itself. Runs are far
rarer than lines, and any common block of that many words holds a seed at each of its lines.
A document is paired with the first document that has one of its seeds, so a passage in
many documents costs one pair for each, never all pairs.

A pair is aligned by patience diff. Its anchors are seeds that both documents have just once,
in common order; where there is none, the common seed that occurs least often, first places
first. An anchor grows in both directions while lines are equal, and the gaps between are aligned
in turn. Each aligned block has ``MIN_WORDS`` words or more and is deleted from the later
document. What is left, cut where blocks were deleted, is aligned again with the whole earlier
document until no block is found, so blocks that cross over go as well. All of a document's pairs
count.

Hence each deleted line lies in a run of ``MIN_WORDS`` words or more that stands, line for line,
in an earlier document, and no such run is left whole. Where two common runs overlap, the
alignment decides: what is left of the second one stays if it has fewer words. Earlier is by id,
then by a hash of the text; a row without an id comes last. Lines are compared without blanks at
their ends.

Defined results: a null text stays null, an empty one empty; rows equal in id and text are
one document and share its result; columns other than id and text are left out; an empty
table stays empty.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.common import by_rows, spread_join, stored, texts
from lakeproof.llm.text_stats import BLANKS

MIN_WORDS = 8
SMALL = 500_000     # rows of a lookup side that may be broadcast after counting them

LINED = "doc_id long, text_hash long, lines array<long>, words array<int>, seeds array<long>"
MARKED = "doc_id long, text_hash long, gone array<int>"


def code(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def lines_of(text: str | None) -> list[str]:
    """Lines with a word, without blanks at their ends."""
    return [line for raw in (text or "").split("\n") if (line := raw.strip(BLANKS))]


def forward_runs(words: list[int], least: int) -> Iterator[tuple[int, int]]:
    """Shortest runs ``[a, b)`` of ``least`` words or more from each line on."""
    b = total = 0
    for a in range(len(words)):
        while b < len(words) and total < least:
            total, b = total + words[b], b + 1
        if total < least:
            return
        yield a, b
        total -= words[a]


def runs(words: list[int], least: int) -> Iterator[tuple[int, int]]:
    """Shortest runs of ``least`` words or more: from each line on, and up to each."""
    yield from forward_runs(words, least)
    n = len(words)
    for a, b in forward_runs(words[::-1], least):
        yield n - b, n - a


def seed(lines: list[int], a: int, b: int) -> int:
    if b - a == 1:
        return lines[a]
    return code(b"".join(x.to_bytes(8, "little", signed=True) for x in lines[a:b]))


def lined(df: DataFrame, least: int) -> DataFrame:
    """``LINED`` for every distinct pair of id and text."""
    def start() -> Callable[[int, int, str], tuple]:
        def one(doc: int, text_hash: int, text: str) -> tuple:
            lines = lines_of(text)
            hashes = [code(x.encode()) for x in lines]
            words = [len(x.encode().split()) for x in lines]
            return doc, text_hash, hashes, words, list({seed(hashes, a, b) for a, b in runs(words, least)})
        return one
    return by_rows(df.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), LINED, start)


# -- alignment of one pair

def anchors(mine: dict[tuple, list[int]], theirs: dict[tuple, list[int]]) -> list[tuple[int, int]]:
    """Places of seeds unique on both sides, rising; else of the one that occurs least."""
    unique = sorted((at[0], theirs[s][0]) for s, at in mine.items() if len(at) == len(theirs.get(s, ())) == 1)
    if unique:
        return longest_rising(unique)
    common = [(len(at) * len(theirs[s]), at[0], theirs[s][0]) for s, at in mine.items() if s in theirs]
    return [min(common)[1:]] if common else []


def patience(x: list[int], words: list[int], y: list[int], a: int, b: int,
             least: int) -> Iterator[tuple[int, int, int]]:
    """Aligned blocks ``i, j, n`` of ``x[a:b]`` and ``y``: ``n`` equal lines, ``least`` words or more."""
    todo = [(a, b, 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        mine: dict[tuple, list[int]] = defaultdict(list)
        for i, k in forward_runs(words[a:b], least):
            mine[tuple(x[a + i:a + k])].append(a + i)
        theirs: dict[tuple, list[int]] = defaultdict(list)
        for size in {len(s) for s in mine}:
            for j in range(c, d - size + 1):
                if (s := tuple(y[j:j + size])) in mine:
                    theirs[s].append(j)
        end_x, end_y, any_block = a, c, False
        for i, j in anchors(mine, theirs):
            if i < end_x or j < end_y:      # in the block before
                continue
            first_x, first_y = i, j
            while first_x > end_x and first_y > end_y and x[first_x - 1] == y[first_y - 1]:
                first_x, first_y = first_x - 1, first_y - 1
            while i < b and j < d and x[i] == y[j]:
                i, j = i + 1, j + 1
            n = i - first_x
            if sum(words[first_x:i]) < least:   # the block before took a part of it
                continue
            yield first_x, first_y, n
            todo.append((end_x, first_x, end_y, first_y))
            end_x, end_y, any_block = i, j, True
        if any_block:
            todo.append((end_x, b, end_y, d))


def longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, rising in both places."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        tails[p:p + 1], at[p:p + 1] = [j], [k]
        before.append(at[p - 1] if p else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def common_blocks(x: list[int], words: list[int], y: list[int], least: int) -> list[int]:
    """Places of ``x`` in aligned blocks with ``y`` of ``least`` words or more."""
    gone = [False] * len(x)
    todo = [(0, len(x))]
    while todo:                 # stretches that are still there
        a, b = todo.pop()
        blocks = sorted((i, i + n) for i, _, n in patience(x, words, y, a, b, least))
        for i, k in blocks:
            gone[i:k] = [True] * (k - i)
        if blocks:
            cuts = [a, *(place for block in blocks for place in block), b]
            todo += [(i, k) for i, k in zip(cuts[::2], cuts[1::2], strict=True) if i < k]
    return [i for i, g in enumerate(gone) if g]


# -- all pairs of a table

def lookup(df: DataFrame) -> DataFrame:
    """A side that may be broadcast if it was counted and found small."""
    return F.broadcast(df) if df.count() <= SMALL else df


def order() -> Column:
    """Sorts documents: by id, those without one last, then by text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"),
                    F.col("text_hash").alias("text_hash"))


def pairs(lines: DataFrame) -> DataFrame:
    """``late, early``: each document and the first holders of its seeds."""
    held = lines.select(order().alias("late"), F.explode("seeds").alias("seed"))
    first = stored(held.groupBy("seed").agg(F.min("late").alias("early"), F.count("*").alias("n"))
                   .where("n > 1").select("seed", "early"), "seeds")
    return held.join(lookup(first), "seed").where("late > early").select("late", "early").distinct()


def deletions(lines: DataFrame, least: int) -> DataFrame:
    """``MARKED``: places of lines to delete, among lines with a word."""
    keyed = lines.select(order().alias("key"), "lines", "words")
    late = keyed.select(F.col("key").alias("late"), F.col("lines").alias("x"), "words")
    early = keyed.select(F.col("key").alias("early"), F.col("lines").alias("y"))
    met = stored(pairs(lines), "pairs")
    # A first holder may meet any number of later documents.
    both = spread_join(met, early, "early", met.groupBy("early").agg(F.count("*").alias("n")),
                       met.count()).join(late, "late")

    def start() -> Callable[..., tuple]:
        return lambda doc, text_hash, x, words, y: (doc, text_hash, common_blocks(x, words, y, least))
    found = by_rows(both.select("late.doc_id", "late.text_hash", "x", "words", "y"), MARKED, start)
    # A document has as many pairs as it has seeds at most.
    return (found.where(F.size("gone") > 0).groupBy("doc_id", "text_hash")
            .agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")))


def without(text: str | None, gone: list[int] | None) -> tuple[str | None, int, int, int]:
    """The text without those lines, its number of lines with a word, what was deleted."""
    if text is None:
        return None, 0, 0, 0
    drop, at, kept, words = set(gone or ()), -1, [], 0
    for raw in text.split("\n"):
        if raw.strip(BLANKS):
            at += 1
            if at in drop:
                words += len(raw.encode().split())
                continue
        kept.append(raw)
    return "\n".join(kept), at + 1, len(drop), words


def dedup_lines(df: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, n_lines, n_deleted, n_deleted_words`` and the columns of ``carry``, one row per row of ``df``."""
    source = texts(df, id_col, text_col)
    # Rows equal in id and text are one document.
    lines = stored(lined(source, least).dropDuplicates(["doc_id", "text_hash"]), "lines")
    gone = stored(deletions(lines, least), "gone").select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "gone")
    whole = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"),
                      F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(c) for c in carry)).alias("carried"))
    # Lists of places have no bound, so they are never broadcast by the size of their file.
    joined = whole.withColumn("text_hash", F.xxhash64("text")).join(
        gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    return (joined.withColumn("cut", cutter()(F.col("text"), F.col("gone")))
            .select("doc_id", "cut.*", *(F.col(f"carried.`{c}`").alias(c) for c in carry)))


def cutter():
    """``without`` for a column of texts and one of places."""
    @F.pandas_udf("text string, n_lines int, n_deleted int, n_deleted_words int")
    def cut(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = [without(t, None if g is None else list(g)) for t, g in zip(text, gone, strict=True)]
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_deleted", "n_deleted_words"])
    # Else a filter on the counts is pushed below and cuts every text once more, in a second Python
    # worker for each task.
    return cut.asNondeterministic()
