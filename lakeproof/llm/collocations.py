"""Collocations: frequent phrases of two to five words, counted by direct-address tiles.

Texts become sequences of word numbers, many texts of one language in a bundle. Words
are dealt out by a checksum and counted tile by tile; frequent ones get ids in order of
frequency. All pairs of neighbouring ids are then counted: the
space of pairs is dealt out in tiles, a pair going to the tile that both ids name by their
remainders, so that frequent ids spread over all tiles alike; in a tile, the pairs of its
most frequent ids are counted in a dense table by ``bincount``, the others as sorted
coordinates. Pairs that are frequent get ids by frequency themselves (by rank inside the tile,
tiles interleaved), each bundle learns those it holds, and the step is repeated: a phrase of
m + 1 words is a pair of frequent phrases of m words that overlap in all but one. No step
sends a vocabulary to the tasks; a task holds one bundle or one tile, whose number grows with
the table. Counts of a bundle are added up before anything is shuffled, so a pair that a third
of all texts repeat is one entry for each bundle.

Words are runs of characters other than space and tab in the pieces between the marks
``. , ; : ! ?`` and line ends; A to Z count as lower case. A phrase's score is the lowest, over
its cuts in two, of ``floor(1000 a n / (l r))`` with exact numbers (decimals of 38 digits).

Defined results: a null text is empty, a null language ``und``; repeated rows count each;
ties go by number, then by the bytes of the phrase; ids and other columns are not read; a
table without frequent phrases, or without rows, gives none.
"""
from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeproof.llm.common import stored, to_batch
from lakeproof.llm.cross_align import added

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
BUNDLE = 1 << 21        # words of all languages that a task gathers before it writes bundles
TILE = 1 << 21          # words of the table for each tile
DENSE = 1024            # ids of either side that a tile counts in its dense table
BLOCK = 1 << 20         # bytes of a text split at once
NONE = (1 << 32) - 1    # no frequent phrase begins here
KEY_BITS = np.uint64(32)

MARK = b"."
MARKS = b".,;:!?\n\x0b\x0c\r"
TO_MARK = bytes.maketrans(MARKS, MARK * len(MARKS))

GATHERED = "bundle string, lang string, n_words long, ids binary, words array<string>, times array<long>"
BUNDLED = "bundle string, lang string, ids binary"
TILED = "lang string, tile long, bundle string, keys binary, times binary"
COUNTED = "lang string, bundle string, keys binary, new binary, left array<long>, right array<long>, id array<long>, f array<long>"
WORDS_TILED = "lang string, tile long, bundle string, words array<string>, numbers binary, times binary"
WORDS_COUNTED = "lang string, bundle string, keys binary, new binary, word array<string>, id array<long>, f array<long>"
ANSWERED = "bundle string, lang string, turn int, ids binary, keys binary, new binary"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: high bytes are mostly alike."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their steps."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


class Numbers(dict):
    """Words numbered as they come; 0 is the mark between pieces."""

    def __init__(self):
        super().__init__({MARK: 0})

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def gather(df: DataFrame, bundle: int = BUNDLE) -> DataFrame:
    """``GATHERED``: texts of a task as word numbers of a bundle, and the bundle's words."""
    schema = StructType.fromDDL(GATHERED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, written = TaskContext.get().partitionId(), 0
        open_: dict[str, tuple[Numbers, array]] = {}
        waiting = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal written
            for lang, (numbers, ids) in open_.items():
                sequence = np.frombuffer(ids, np.uint32)
                times = np.bincount(sequence, minlength=len(numbers))
                words = [w.decode() for w in numbers]
                yield to_batch([(f"{task}-{written}", lang, int(times[1:].sum()), packed(sequence),
                                 words[1:], times[1:].tolist())], arrow)
                written += 1
            open_.clear()

        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                lang, text = lang.as_py() or "und", text.as_py()
                if not text:
                    continue
                if lang not in open_:
                    open_[lang] = Numbers(), array("I")
                numbers, ids = open_[lang]
                had = len(ids)
                raw, start = text.encode().lower().translate(TO_MARK).replace(MARK, b" . "), 0
                while start < len(raw):
                    end = raw.find(b" ", start + BLOCK)
                    end = len(raw) if end < 0 else end
                    ids.extend([numbers[w] for w in raw[start:end].split()])
                    start = end
                ids.append(0)
                waiting += len(ids) - had
                if waiting >= bundle:
                    yield from close()
                    waiting = 0
        yield from close()
    return df.mapInArrow(run, schema)


def neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of pairs of neighbouring phrases, and where each begins."""
    at = np.flatnonzero((ids[:-1] != NONE) & (ids[1:] != NONE))
    left, right = ids[at].astype(np.uint64), ids[at + 1].astype(np.uint64)
    return (left << KEY_BITS) | right, at


def squeezed(ids: np.ndarray) -> np.ndarray:
    """Only ids with a neighbour, runs of them kept apart by one ``NONE``; places do not matter."""
    has = ids != NONE
    beside = np.zeros(len(ids), np.bool_)
    beside[1:] |= has[:-1]
    beside[:-1] |= has[1:]
    has &= beside
    gap = ~has
    gap[1:] &= has[:-1]     # the first place after a run
    return np.where(has, ids, np.uint32(NONE))[has | gap]


def halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> KEY_BITS).astype(np.int64), (keys & np.uint64(NONE)).astype(np.int64)


def counted(keys: np.ndarray, times: np.ndarray | None, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs.

    ``every`` is the step between the ids of a tile. The square of its smallest ids is counted
    in a dense table, what is left by sorting.
    """
    left, right = halves(keys)
    rows, columns = left // every, right // every
    dense = (rows < DENSE) & (columns < DENSE)
    parts = []
    if dense.any():
        first_left, first_right = left[dense][0] % every, right[dense][0] % every
        width = int(columns[dense].max()) + 1
        # Sums of whole numbers below 2**53 are exact in doubles.
        table = np.bincount(rows[dense] * width + columns[dense], None if times is None else times[dense])
        cells = np.flatnonzero(table)
        found = ((cells // width * every + first_left).astype(np.uint64) << KEY_BITS) | \
            (cells % width * every + first_right).astype(np.uint64)
        parts.append((found, table[cells].astype(np.int64)))
    if not dense.all():
        if times is None:
            parts.append(np.unique(keys[~dense], return_counts=True))
        else:
            parts.append((keys[~dense], times[~dense]))
    return added(parts) if parts else (keys, np.zeros(0, np.int64))


def tiles(bundles: DataFrame, side: int) -> DataFrame:
    """``TILED``: the pairs of each bundle with their counts, a row for each tile."""
    schema = StructType.fromDDL(TILED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bundle, lang, ids = (batch.column(c)[row].as_py() for c in ("bundle", "lang", "ids"))
                keys, times = counted(neighbours(unpacked(ids, np.uint32))[0], None, 1)
                left, right = halves(keys)
                tile = left % side * side + right % side
                order = np.argsort(tile, kind="stable")
                keys, times, tile = keys[order], times[order].astype(np.uint32), tile[order]
                borders = [0, *(np.flatnonzero(np.diff(tile)) + 1), len(tile)] if len(tile) else [0]
                yield to_batch([(lang, int(tile[a]), bundle, packed_keys(keys[a:b]), packed(times[a:b]))
                                for a, b in zip(borders, borders[1:])], arrow)
    return bundles.select("bundle", "lang", "ids").mapInArrow(run, schema)


def count_tiles(tiled: DataFrame, side: int, least: int) -> DataFrame:
    """``COUNTED``: frequent pairs of each tile (``bundle`` null), and those each bundle holds."""
    schema = StructType.fromDDL(COUNTED)
    arrow = to_arrow_schema(schema)

    def finish(lang: str, tile: int, held: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([k for _, k, _ in held])
        found, totals = counted(keys, np.concatenate([t for _, _, t in held]), side)
        often = totals >= least
        found, totals = found[often], totals[often]
        rank = np.empty(len(found), np.int64)
        rank[np.lexsort((found, -totals))] = np.arange(len(found))
        new = rank * side * side + tile
        rows = []
        if len(found):
            left, right = halves(found)
            rows.append((lang, None, None, None, left.tolist(), right.tolist(), new.tolist(), totals.tolist()))
            for bundle, mine, _ in held:
                place = np.minimum(np.searchsorted(found, mine), len(found) - 1)
                has = found[place] == mine
                if has.any():
                    rows.append((lang, bundle, packed_keys(mine[has]), packed(new[place[has]].astype(np.uint32)),
                                 None, None, None, None))
        return to_batch(rows, arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                lang, tile, bundle, keys, times = (c[row].as_py() for c in batch.columns)
                if now not in (None, (lang, tile)):
                    yield finish(*now, held)
                    held = []
                now = lang, tile
                held.append((bundle, unpacked_keys(keys), unpacked(times, np.uint32).astype(np.int64)))
        if held:
            yield finish(*now, held)
    return (tiled.select(*schema_names(TILED)).repartition("lang", "tile").sortWithinPartitions("lang", "tile")
            .mapInArrow(run, schema))


def schema_names(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).names


def renumbered(bundles: DataFrame, answers: DataFrame, pairs: bool) -> DataFrame:
    """``BUNDLED`` with the new ids; ``answers`` are the keys each bundle holds of them."""
    schema = StructType.fromDDL(BUNDLED)
    arrow = to_arrow_schema(schema)
    none = F.lit(None).cast("binary")
    rows = bundles.select("bundle", "lang", F.lit(0).alias("turn"), "ids", none.alias("keys"), none.alias("new"))
    rows = rows.unionByName(answers.select("bundle", "lang", F.lit(1).alias("turn"), none.alias("ids"), "keys", "new"))

    def finish(bundle: str, lang: str, ids: np.ndarray, held: list[tuple]) -> pa.RecordBatch:
        out = np.full(len(ids), NONE, np.uint32)
        keys, at = neighbours(ids) if pairs else (ids.astype(np.uint64), np.arange(len(ids)))
        if held:
            known, new = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(known)
            known, new = known[order], new[order]
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            has = known[place] == keys
            out[at[has]] = new[place[has]]
        return to_batch([(bundle, lang, packed(squeezed(out)))], arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                bundle, lang, turn, ids, keys, new = (c[row].as_py() for c in batch.columns)
                if turn == 0:
                    if now:
                        yield finish(*now, held)
                    now, held = (bundle, lang, unpacked(ids, np.uint32)), []
                else:
                    held.append((unpacked_keys(keys), unpacked(new, np.uint32)))
        if now:
            yield finish(*now, held)
    return (rows.select(*schema_names(ANSWERED)).repartition("bundle").sortWithinPartitions("bundle", "turn")
            .mapInArrow(run, schema))


def word_tiles(gathered: DataFrame, deal: int) -> DataFrame:
    """``WORDS_TILED``: the words of each bundle with their numbers and counts, a row for each tile."""
    schema = StructType.fromDDL(WORDS_TILED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bundle, lang, words, times = (batch.column(c)[row].as_py() for c in ("bundle", "lang", "words", "times"))
                tile = np.fromiter((zlib.crc32(w.encode()) % deal for w in words), np.int64, len(words))
                order = np.argsort(tile, kind="stable")
                borders = [0, *(np.flatnonzero(np.diff(tile[order])) + 1), len(words)] if words else [0]
                times = np.array(times, np.uint32)
                rows = []
                for a, b in zip(borders, borders[1:]):
                    mine = order[a:b]
                    rows.append((lang, int(tile[mine[0]]), bundle, [words[i] for i in mine],
                                 packed_keys(mine.astype(np.uint64) + np.uint64(1)), packed(times[mine])))
                yield to_batch(rows, arrow)
    return gathered.select("bundle", "lang", "words", "times").mapInArrow(run, schema)


def count_words(tiled: DataFrame, deal: int, least: int) -> DataFrame:
    """``WORDS_COUNTED``: frequent words of each tile (``bundle`` null), and those each bundle holds."""
    schema = StructType.fromDDL(WORDS_COUNTED)
    arrow = to_arrow_schema(schema)

    def finish(lang: str, tile: int, held: list[tuple]) -> pa.RecordBatch:
        totals: dict[str, int] = defaultdict(int)
        for _, words, _, times in held:
            for word, n in zip(words, times.tolist(), strict=True):
                totals[word] += n
        often = sorted((-n, w.encode()) for w, n in totals.items() if n >= least)
        new = {w.decode(): rank * deal + tile for rank, (_, w) in enumerate(often)}
        if not new:
            return to_batch([], arrow)
        rows = [(lang, None, None, None, list(new), list(new.values()), [-n for n, _ in often])]
        for bundle, words, numbers, _ in held:
            ids = [new.get(w, -1) for w in words]
            known = np.array(ids, np.int64)
            has = known >= 0
            if has.any():
                rows.append((lang, bundle, packed_keys(numbers[has]), packed(known[has].astype(np.uint32)), None, None, None))
        return to_batch(rows, arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                lang, tile, bundle, words, numbers, times = (c[row].as_py() for c in batch.columns)
                if now not in (None, (lang, tile)):
                    yield finish(*now, held)
                    held = []
                now = lang, tile
                held.append((bundle, words, unpacked_keys(numbers), unpacked(times, np.uint32)))
        if held:
            yield finish(*now, held)
    return (tiled.select(*schema_names(WORDS_TILED)).repartition("lang", "tile").sortWithinPartitions("lang", "tile")
            .mapInArrow(run, schema))


def first_level(counts: DataFrame) -> DataFrame:
    """Frequent words as phrases of one word."""
    rows = counts.where("bundle is null").select("lang", F.inline(F.arrays_zip("word", "id", "f")))
    none = F.array().cast("array<long>")
    return rows.select("lang", "id", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                       none.alias("heads"), none.alias("tails"))


def next_level(counts: DataFrame, phrases: DataFrame) -> DataFrame:
    """Frequent pairs of phrases as phrases of one word more.

    ``heads`` and ``tails`` hold the counts of a phrase's beginnings and ends by length.
    """
    pairs = counts.where("bundle is null").select("lang", F.inline(F.arrays_zip("left", "right", "id", "f")))
    a = phrases.select("lang", F.col("id").alias("left"), F.col("phrase").alias("head"),
                       F.array_append("heads", F.col("f")).alias("heads"))
    b = phrases.select("lang", F.col("id").alias("right"), "last", F.array_append("tails", F.col("f")).alias("tails"))
    joined = pairs.join(a, ["lang", "left"]).join(b, ["lang", "right"])
    return joined.select("lang", "id", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", "heads", "tails",
                         "left", "right")


def collocations(df: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 inside_percent: int = 100, text_col: str = "text", lang_col: str = "lang",
                 bundle: int = BUNDLE, tile: int = TILE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language.

    A phrase inside a longer candidate that is at least ``inside_percent`` as frequent is
    left out.
    """
    source = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    gathered = stored(gather(source, bundle), "bundles")
    total = gathered.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    side = max(8, math.ceil(math.sqrt(total / tile)))
    words = gathered.groupBy("lang").agg(F.sum("n_words").alias("n"))

    counts = stored(count_words(word_tiles(gathered, side * side), side * side, least), "words")
    phrases = stored(first_level(counts), "level")
    answers = counts.where("bundle is not null").select("bundle", "lang", "keys", "new")
    bundles, levels = gathered, []
    for size in range(2, longest + 1):
        bundles = stored(renumbered(bundles, answers, size > 2), "phrases")
        counts = stored(count_tiles(tiles(bundles, side), side, least), "counts")
        phrases = stored(next_level(counts, phrases), "level")
        answers = counts.where("bundle is not null").select("bundle", "lang", "keys", "new")
        levels.append(phrases)

    kept = []
    for level, longer in zip(levels, [*levels[1:], None], strict=True):
        if longer is not None:
            around = longer.select("lang", F.explode(F.array("left", "right")).alias("id"), "f")
            around = around.groupBy("lang", "id").agg(F.max("f").alias("longer"))
            level = level.join(around, ["lang", "id"], "left").where(
                F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("f")))
        kept.append(level.select("lang", "phrase", F.col("f").alias("a"), "heads", "tails"))
    candidates = kept[0]
    for level in kept[1:]:
        candidates = candidates.unionByName(level)
    cuts = F.expr("""array_min(transform(sequence(1, size(heads)), k -> named_struct(
        'score', (cast(1000 * a as decimal(20, 0)) * cast(n as decimal(17, 0)))
                 div (cast(heads[k - 1] as decimal(18, 0)) * cast(tails[size(tails) - k] as decimal(18, 0))),
        'k', k, 'l', heads[k - 1], 'r', tails[size(tails) - k])))""")
    # A row for each language.
    scored = candidates.join(words, "lang").withColumn("cut", cuts)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return (scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                          F.col("cut.score").alias("score"))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
