"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by a key: a hash of the text, the id, and a number given once when the keys
are stored. Equal texts are neighbours, so a group of copies stays together unless a border
has to fall inside it. Borders are found by counting: bytes and rows below many candidate
keys at once, over all partitions; around each border the interval that holds it is probed
again, more finely, until a candidate meets the tolerance. A hash that alone is heavier than
the tolerance is refined by id, and an id by row number. Then rows go to their place in one
exchange, cut into many pieces of a shard, whose first slots are known from the counts.

What the driver holds is one interval for each border and ``PROBES`` counts in all, whatever
the size of the table. A border lies within ``tolerance`` of a shard's size of its ideal
place, or at a row, whichever is wider.

Defined results: a null text has no bytes and the checksum of an empty one; a null id sorts
as the lowest number; repeated rows are told apart by their number; columns of the input
other than those asked for are left out; an empty table stays empty.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.llm.common import stored, texts

PROBES = 1 << 15    # counts that one round brings to the driver at most, about
TOLERANCE = 0.002   # of a shard's bytes
PIECE_TOLERANCE = 0.25
KEYS = ("k0", "k1", "k2", "k3")


# Widest range of each key part.
RANGES = ((0, (1 << 63) - 1), (-(1 << 31), (1 << 31) - 1), (0, (1 << 32) - 1), (0, (1 << 63) - 1))


@dataclass(frozen=True)
class Border:
    """Keys from ``key`` on (missing parts count as lowest) belong to what follows."""
    key: tuple[int, ...]
    below: tuple[int, int]      # bytes and rows of smaller keys


@dataclass(frozen=True)
class Box:
    """Keys that agree on the first parts and lie in ``[low, high]`` on the next one."""
    fixed: tuple[int, ...]
    low: int
    high: int
    below: tuple[int, int]
    inside: tuple[int, int]
    after: Border | None = None     # where the next keys begin

    @property
    def level(self) -> int:
        return len(self.fixed)

    def start(self) -> Border:
        return Border((*self.fixed, self.low), self.below)

    def deeper(self) -> Box | None:
        """What to probe for a border in this box; None for a single row."""
        if self.inside[1] <= 1:
            return None
        if self.low < self.high:
            return self
        if self.level == len(KEYS) - 1:
            return None
        low, high = RANGES[self.level + 1]
        return replace(self, fixed=self.start().key, low=low, high=high)


def key_columns(text_hash: Column, doc_id: Column, number: Column) -> dict[str, Column]:
    """Parts whose differences fit a long."""
    doc = F.coalesce(doc_id, F.lit(-(1 << 63)))
    return {"k0": F.shiftrightunsigned(text_hash, 1), "k1": F.shiftright(doc, 32),
            "k2": doc.bitwiseAND(F.lit((1 << 32) - 1)), "k3": number}


def _counts(keys: DataFrame, boxes: list[Box], whole: Box) -> dict[int, list[tuple]]:
    """For each box, occupied cells in order: lowest and highest key part, bytes, rows."""
    fan = max(16, PROBES // len(boxes))
    coarse = max(1, -(-(whole.high - whole.low + 1) // PROBES))
    rows = []
    for i, b in enumerate(boxes):
        bounds = [x for k in range(len(KEYS)) for x in (
            (b.fixed[k],) * 2 if k < b.level else (b.low, b.high) if k == b.level else RANGES[k])]
        rows.append((i, b.level, max(1, -(-(b.high - b.low + 1) // fan)),
                     ((b.fixed or (b.low,))[0] - whole.low) // coarse, *bounds))
    if boxes == [whole]:
        inside = keys.select(F.lit(0).alias("box"), "size", F.col("k0").alias("part"),
                             F.lit(rows[0][2]).alias("width"), F.lit(whole.low).alias("low"))
    else:
        # Every later box lies in one cell of the first round, so the join has an equal key.
        names = [f"{e}{k}" for k in range(len(KEYS)) for e in ("lo", "hi")]
        table = keys.sparkSession.createDataFrame(
            rows, "box int, level int, width long, first long, " + ", ".join(f"{n} long" for n in names))
        where = F.expr(f"(k0 - {whole.low}) div {coarse}") == F.col("first")
        for k in range(len(KEYS)):
            where = where & F.col(f"k{k}").between(F.col(f"lo{k}"), F.col(f"hi{k}"))
        inside = keys.join(F.broadcast(table), where).select(
            "box", "size", F.expr("case level when 0 then k0 when 1 then k1 when 2 then k2 else k3 end")
            .alias("part"), "width",
            F.expr("case level when 0 then lo0 when 1 then lo1 when 2 then lo2 else lo3 end").alias("low"))
    cells = (inside.withColumn("cell", F.expr("(part - low) div width")).groupBy("box", "cell")
             .agg(F.min("part"), F.max("part"), F.sum("size"), F.count("*")))
    out: dict[int, list[tuple]] = {i: [] for i in range(len(boxes))}
    for box, _, least, most, size, n in cells.collect():
        out[box].append((least, most, size, n))
    return {i: sorted(v) for i, v in out.items()}


def borders(keys: DataFrame, targets: list[tuple[float, float, int]]) -> list[Border]:
    """For each target ``(amount, slack, measure)`` a border with about that amount below.

    ``measure`` is 0 for bytes and 1 for rows.
    """
    first = keys.agg(F.min("k0"), F.max("k0"), F.sum("size"), F.count("*")).first()
    whole = Box((), first[0], first[1], (0, 0), (first[2], first[3]))
    at: dict[int, Box] = dict.fromkeys(range(len(targets)), whole)
    done: dict[int, Border] = {}
    while at:
        boxes = list(dict.fromkeys(at.values()))
        counted = _counts(keys, boxes, whole)
        cells: dict[Box, list[Box]] = {}
        for i, box in enumerate(boxes):
            below, found = box.below, []
            for least, most, size, n in counted[i]:
                found.append(Box(box.fixed, least, most, below, (size, n)))
                below = (below[0] + size, below[1] + n)
            ends = [c.start() for c in found[1:]] + [box.after]
            cells[box] = [replace(c, after=e) for c, e in zip(found, ends, strict=True)]
        for t, box in list(at.items()):
            amount, slack, m = targets[t]
            holds = next((c for c in reversed(cells[box]) if c.below[m] <= amount), cells[box][0])
            best = min((b for b in (holds.start(), holds.after) if b), key=lambda b: abs(b.below[m] - amount))
            deeper = holds.deeper()
            if abs(best.below[m] - amount) <= slack or deeper is None:
                done[t] = best
                del at[t]
            else:
                at[t] = deeper
    return [done[t] for t in range(len(targets))]


def shard_by_bytes(df: DataFrame, shards: int = 8, tolerance: float = TOLERANCE,
                   text_col: str = "text", id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` and the columns of ``carry``.

    ``size`` is the text's UTF-8 bytes plus one; shards are near equal in it; slots number
    the rows of a shard without gaps, in key order.
    """
    spark = df.sparkSession
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_col}`").cast("long")
    rows = df.select(
        doc.alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried") if carry else F.lit(None).cast("int").alias("carried"),
        *(c.alias(k) for k, c in key_columns(F.xxhash64(body), doc, F.monotonically_increasing_id()).items()))
    keys = stored(rows, "keys")     # numbers are fixed from here on
    total, n = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    names = [F.col(f"carried.`{c}`").alias(c) for c in carry]
    if not n:
        return keys.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), *names)
    each = max(1, math.ceil(2 * int(spark.conf.get("spark.sql.shuffle.partitions")) / shards))
    share = total / shards
    targets = [(share * s, tolerance * share, 0) for s in range(1, shards)]
    pieces = shards * each
    targets += [(n * p / pieces, PIECE_TOLERANCE * n / pieces, 1) for p in range(1, pieces)]
    found = borders(keys, targets)
    cuts = found[:shards - 1]
    return place(keys, cuts, found[shards - 1:]).select("doc_id", "size", "text_crc32", "shard", "slot", *names)


def full(key: tuple[int, ...]) -> tuple[int, ...]:
    """All parts of a border's key; missing ones are the lowest."""
    return (*key, *[-(1 << 62)] * (len(KEYS) - len(key)))


def place(keys: DataFrame, cuts: list[Border], inner: list[Border]) -> DataFrame:
    """Shard and slot of each row, by one exchange into the pieces between all borders."""
    spark = keys.sparkSession
    marks = sorted({full(b.key): b.below[1] for b in [*cuts, *inner]}.items())
    marks = [(full(()), 0), *((k, r) for k, r in marks if r > 0)]
    shard_starts = [(full(b.key), b.below[1]) for b in cuts]
    rows = []
    for i, (key, start) in enumerate(marks):
        shard = sum(k <= key for k, _ in shard_starts)
        origin = max([r for k, r in shard_starts if k <= key], default=0)
        rows.append((i, shard, start - origin, *key))
    bounds = [F.struct(*(F.lit(x).cast("long").alias(k) for x, k in zip(key, KEYS, strict=True)))
              for key, _ in marks]
    # Halving over the sorted borders: each row takes a logarithmic number of comparisons.
    piece = _search(F.struct(*KEYS), bounds, 0, len(bounds))
    table = spark.createDataFrame([r[:3] for r in rows], "piece int, shard int, start long")
    order = Window.partitionBy("piece").orderBy(*KEYS)
    return (keys.withColumn("piece", piece).join(F.broadcast(table), "piece")
            .withColumn("slot", F.col("start") + F.row_number().over(order) - 1))


def _search(key: Column, bounds: list[Column], low: int, high: int) -> Column:
    """Index of the last bound that is not above the key."""
    if high - low == 1:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key < bounds[mid], _search(key, bounds, low, mid)).otherwise(_search(key, bounds, mid, high))
