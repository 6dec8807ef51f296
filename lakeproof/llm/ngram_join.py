"""Similarity self-join of word n-gram sets by token-combination prefixes.

A document is the set of its distinct n-word shingles; two documents link when the Jaccard
similarity of their sets reaches ``num / den``. All sets are ordered alike, by a hash of the
shingle. If a set of ``s`` shingles links with another, at most ``D = s * (den - num) // num``
shingles lie in only one of the two. Hence:

* Both sets share a shingle among their first ``D + 1`` (single prefix).
* Both share two shingles that follow each other in both sets among their first ``2 D + 2``
  (extended prefix): ``D`` differences cut the shared ones, ``D + 2`` or more, into at most
  ``D + 1`` runs.

A shingle is frequent if more than ``FREQUENT`` sets have it in their single prefix. Rare
shingles of the single prefix are indexed one by one; a set with a frequent one is indexed
by pairs of neighbours of its extended prefix as well. A linked pair either shares a rare
indexed shingle or a frequent one, and then both sets have their pairs indexed.

Within the index entry of a signature, candidates are tested by the size of the sets and by
the parity bitmaps of 1024 bits, whose differing bits never outnumber the differing
shingles; larger sets are tested again with larger bitmaps before whole sets are compared. Two rounds avoid all pairs of a group: the first takes a spanning forest of the
candidates of each entry, verifies it on whole sets and contracts the components found; the
second verifies the candidates that remain between different components. Entries of more
than ``BLOCK`` sets are cut into blocks that meet in separate tasks. No link is lost and
nothing is capped.

Equal sets are one class with one representative; copies are never paired.

Defined results: a text with fewer words than a shingle is one shingle of all its words; a
text without words (or null) is an empty set and its own component; a row without an id
takes part and is named by null only if its whole component has no id; repeated rows fall
in one class; columns other than id and text are left out; an empty table stays empty.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeproof.llm.common import Memo, by_rows, spread_join, stored, texts, worker_cache
from lakeproof.llm.components import components

FREQUENT = 64       # sets sharing a shingle, from which on it counts as frequent
BLOCK = 2048        # sets of one index entry that meet in one task
SMALL = 500_000     # rows of a lookup side that may be broadcast after counting them
WORDS = 16          # 64-bit words of a bitmap

U = np.uint64
PREPARED = ("row long, doc_id long, text_hash long, n long, print binary, head array<long>, "
            "bits binary, wide binary")
SETS = "row long, print binary, shingles array<long>"


def word_code(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


@worker_cache
def word_codes() -> Memo:
    return Memo(word_code, 100_000)     # cheap to compute again


def mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Distinct shingle hashes in ascending order."""
    words = (text or "").encode().lower().split()   # lower-cases A to Z only
    if not words:
        return np.zeros(0, np.int64)
    codes = np.fromiter(map(word_codes().__getitem__, words), U, len(words))
    width = min(width, len(words))
    last = len(words) - width + 1
    hashed = mixed(codes[:last])
    for k in range(1, width):
        hashed = mixed(hashed * U(3) + codes[k:last + k])
    return np.unique(hashed.view(np.int64))


def bitmap(tokens: np.ndarray, places: int = 64 * WORDS) -> bytes:
    """Parity of the number of tokens in each of so many places, a power of two."""
    place = mixed(tokens.view(U) + U(1)) & U(places - 1)
    odd = (np.bincount(place.astype(np.int64), minlength=places) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def wide_bitmap(tokens: np.ndarray) -> bytes | None:
    """A bitmap of twice as many places as tokens, where the common size is less than that."""
    places = 1 << (2 * len(tokens) - 1).bit_length()
    return bitmap(tokens, places) if places > 64 * WORDS else None


def apart(x: bytes, y: bytes) -> int:
    """Differing bits of two bitmaps; the larger is folded to the size of the smaller."""
    a, b = sorted((np.frombuffer(x, U), np.frombuffer(y, U)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def prepare(df: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``PREPARED``: size, fingerprint, extended prefix and bitmap of each set."""
    def start() -> Callable[..., tuple]:
        def one(row: int, doc: int, text_hash: int, text: str) -> tuple:
            tokens = shingles(text, width)
            n = len(tokens)
            if not n:
                return row, doc, text_hash, 0, None, [], None, None
            differ = n * (den - num) // num
            # Without room for a difference only equal sets link, and those are one class.
            head = tokens[:2 * differ + 2] if differ else tokens[:0]
            return (row, doc, text_hash, n, set_print(tokens), head, bitmap(tokens), wide_bitmap(tokens))
        return one
    return by_rows(df, PREPARED, start)


def set_print(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def numbered(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = texts(df, id_col, text_col)
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       F.xxhash64("text").alias("text_hash"), "text")


def lookup(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A side that may be broadcast if it was counted and found small."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= SMALL else df


def grouped(rows: DataFrame) -> DataFrame:
    """Signatures that two sets or more have, with the count and two of the sets."""
    return stored(rows.groupBy("sig").agg(F.count("*").alias("n"), F.min("row").alias("a"),
                                          F.max("row").alias("b")).where("n > 1"), "signatures")


def candidate_groups(sets: DataFrame, num: int, den: int,
                     frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of signatures with two sets, and rows ``sig, n, row`` of larger ones."""
    differ = F.expr(f"cast(n * {den - num} div {num} as int)")
    single = (sets.where(F.size("head") > 0)
              .select("row", F.explode(F.slice("head", F.lit(1), differ + 1)).alias("sig")))
    one = grouped(single)
    common = lookup(one.where(f"n > {frequent}").select("sig"))
    flagged = stored(single.join(common, "sig", "left_semi").select("row").distinct(), "flagged")
    neighbours = F.expr("transform(sequence(1, size(head) - 1), "
                        "i -> xxhash64(element_at(head, i), element_at(head, i + 1)))")
    pair = (sets.where(F.size("head") > 1).join(lookup(flagged), "row", "left_semi")
            .select("row", F.explode(neighbours).alias("sig")))
    two = grouped(pair)
    rare = one.where(f"n <= {frequent}")
    duos = rare.where("n = 2").select("a", "b").unionByName(two.where("n = 2").select("a", "b"))
    more = [(single, rare.where("n > 2").select("sig", "n")), (pair, two.where("n > 2").select("sig", "n"))]
    rows = [r.join(lookup(s), "sig").select("sig", "n", "row") for r, s in more]
    return stored(duos.distinct(), "duos"), rows[0].unionByName(rows[1])


def cells(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of index entries, each in every pair of blocks it takes part in."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("row", "sig"), blocks).cast("int")
    return (rows.withColumns({"block": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
            .select("sig", "row", "block", F.least("block", "other").alias("i"),
                    F.greatest("block", "other").alias("j")))


def mixed_cells(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """``entries`` with their sets' components, without the pairs of blocks that hold only one."""
    cell = Window.partitionBy("sig", "i", "j")      # two blocks at most
    return (entries.join(parts.withColumnRenamed("id", "row"), "row", "left")
            .withColumn("component", F.coalesce("component", "row"))
            .withColumns({"low": F.min("component").over(cell), "high": F.max("component").over(cell)})
            .where("low < high").drop("low", "high"))


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal (sig, i, j) in sorted rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "i", "j")], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(keys[a].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def near_pairs(rows: DataFrame, sets: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """Candidates ``a, b`` of index entries: a spanning forest, or all between components."""
    schema = StructType.fromDDL("a long, b long")
    arrow = to_arrow_schema(schema)

    def pairs_of(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        column = {c: table.column(c).to_numpy() for c in ("row", "size", "block", "component")}
        row, size, block, part = (column[c] for c in ("row", "size", "block", "component"))
        m = len(row)
        if m < 2 or not forest and (part == part[0]).all():
            return
        cross = bool(table.column("i")[0].as_py() != table.column("j")[0].as_py())
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), U).reshape(m, WORDS)

        def near(x: int, among: np.ndarray) -> np.ndarray:
            s = size[among]
            total = s + size[x]
            fits = den * np.minimum(s, size[x]) >= num * np.maximum(s, size[x])
            if cross:
                fits &= block[among] != block[x]
            if not forest:
                fits &= part[among] != part[x]
            among, total = among[fits], total[fits]
            if not len(among):
                return among
            apart = np.bitwise_count(bits[among] ^ bits[x]).sum(axis=1)
            return among[apart <= total + 2 * (-num * total // (num + den))]
        if not forest:
            every = np.arange(m)
            for x in range(m - 1):
                found = near(x, every[x + 1:])
                if len(found):
                    yield np.full(len(found), row[x]), row[found]
            return
        free = np.ones(m, dtype=bool)
        for seed in range(m):
            if not free[seed]:
                continue
            free[seed] = False
            queue = [seed]
            while queue:
                x = queue.pop()
                found = near(x, np.flatnonzero(free))
                if len(found):
                    free[found] = False
                    queue += found.tolist()
                    yield np.full(len(found), row[x]), row[found]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for table in _groups(batches):
            fresh = set()
            for x, y in pairs_of(table):
                fresh.update(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True))
            fresh -= seen
            if fresh:
                a, b = zip(*fresh, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=arrow)
            if len(seen) > 200_000:
                seen = set()
            seen |= fresh
    # Bitmaps are joined here and not stored with the entries, of which a set has many.
    rows = rows.join(sets.select("row", F.col("n").alias("size"), "bits"), "row")
    dealt = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return dealt.select("sig", "i", "j", "row", "size", "block", "component", "bits").mapInArrow(run, schema)


def with_sides(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Stored ``pairs`` with both sides' rows; a set of many pairs is dealt over many tasks."""
    out, total = pairs, pairs.count()
    for key, side in (("a", a), ("b", b)):
        out = spread_join(out, side, key, pairs.groupBy(key).agg(F.count("*").alias("n")), total)
    return out


def near_duos(duos: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that pass the tests of size and bitmap."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("row").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    schema = StructType.fromDDL("a long, b long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), U).reshape(-1, WORDS)
                    for c in ("bits_a", "bits_b"))
            total = n_a + n_b
            near = (np.bitwise_count(x ^ y).sum(axis=1) <= total + 2 * (-num * total // (num + den)))
            near &= den * np.minimum(n_a, n_b) >= num * np.maximum(n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array(near))
    both = with_sides(duos, side("a"), side("b"))
    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, schema)


def near_wide(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that also pass the test with bitmaps that grow with the sets."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("row").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"),
                           F.col("wide").alias(f"wide_{name}"))
    schema = StructType.fromDDL("a long, b long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = (total + 2 * (-num * total // (num + den))).tolist()
            near = [apart(x.as_py(), y.as_py()) <= m for x, y, m in
                    zip(batch.column("x"), batch.column("y"), most, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
    both = with_sides(pairs, side("a"), side("b"))
    return both.select("a", "b", "n_a", "n_b", F.coalesce("wide_a", "bits_a").alias("x"),
                       F.coalesce("wide_b", "bits_b").alias("y")).mapInArrow(run, schema)


def verified(pairs: DataFrame, sets: DataFrame, source: DataFrame, width: int, num: int,
             den: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity."""
    pairs = stored(near_wide(pairs, sets, num, den), "near")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    wanted = stored(ids.join(sets.select("row", "doc_id", "text_hash", "print"), "row"), "wanted")
    named = lookup(wanted.select("row", F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "print"))
    found = source.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(
        named, F.col("text_hash").eqNullSafe(F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")))

    def start() -> Callable[..., tuple]:
        return lambda row, mark, text: (row, mark, shingles(text, width))
    whole = by_rows(found.select("row", "print", "text").dropDuplicates(["row"]), SETS, start)
    whole = stored(whole, "sets").select("row", "shingles")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    sides = (whole.select(F.col("row").alias(c), F.col("shingles").alias(f"set_{c}")) for c in ("a", "b"))
    return (with_sides(pairs, *sides)
            .where(den * shared >= num * (F.size("set_a") + F.size("set_b") - shared))
            .select("a", "b"))


def similar_sets(sets: DataFrame, source: DataFrame, width: int, num: int, den: int,
                 frequent: int = FREQUENT, block: int = BLOCK) -> DataFrame:
    """``id, component`` of the representatives that link with another one."""
    duos, rows = candidate_groups(sets, num, den, frequent)
    entries = stored(cells(rows, block), "entries")
    first = stored(near_duos(duos, sets, num, den)
                   .unionByName(near_pairs(entries.withColumn("component", F.col("row")), sets, num, den, True))
                   .distinct(), "candidates")
    links = stored(verified(first, sets, source, width, num, den), "links")
    parts = components(links)
    known = mixed_cells(entries, parts)
    second = near_pairs(known, sets, num, den, False).distinct().join(first, ["a", "b"], "left_anti")
    second = stored(second, "candidates")
    if second.isEmpty():
        return parts
    return components(links.unionByName(verified(second, sets, source, width, num, den)))


def link_documents(df: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                   id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT,
                   block: int = BLOCK) -> DataFrame:
    """``row, doc_id, text_hash, n_shingles, class_row, component_row, component_id``, one per row of ``df``.

    ``row`` numbers the rows, ``class_row`` names the row that stands for all with an equal
    set, ``component_row`` the smallest such row of the component.
    """
    source = texts(df, id_col, text_col)
    rows = stored(prepare(numbered(df, id_col, text_col), width, num, den), "prepared")
    classes = stored(rows.where("n > 0").groupBy("print")
                     .agg(F.min("row").alias("class_row"), F.count("*").alias("n")), "classes")
    sets = rows.join(lookup(classes.select(F.col("class_row").alias("row"))), "row", "left_semi")
    parts = similar_sets(sets, source, width, num, den, frequent, block)
    named = classes.join(parts.withColumnRenamed("id", "class_row"), "class_row", "left")
    named = named.select("print", "class_row", F.coalesce("component", "class_row").alias("component_row"))
    total = rows.count()
    small = spread_join(rows.select("row", "doc_id", "text_hash", "n", "print"), named, "print",
                        classes.select("print", "n"), total, "left")
    out = stored(small.select(
        "row", "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("class_row", "row").alias("class_row"),
        F.coalesce("component_row", "row").alias("component_row")), "members")
    least = out.groupBy("component_row").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    return spread_join(out, least.drop("n"), "component_row", least.drop("component_id"), total).select(
        "row", "doc_id", "text_hash", "n_shingles", "class_row", "component_row", "component_id")


def without_near_duplicates(df: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without all but the first document of each component.

    The first is the one with the smallest id (rows without an id come last). Rows equal in
    id and text are one document, of which one row stays. Documents without words stay.
    """
    linked = link_documents(df, width, num, den, id_col, text_col).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    first = linked.groupBy("component_row").agg(F.min(order).alias("first")).select(
        F.col("first.row").alias("row"), F.lit(True).alias("stays"))
    # Most documents stay and have one row: only the others are looked up, so few texts move.
    marks = stored(linked.join(first, "row", "left").groupBy("doc_id", "text_hash")
                   .agg(F.coalesce(F.max("stays"), F.lit(False)).alias("stays"), F.count("*").alias("n"))
                   .where("n > 1 or not stays"), "marks").select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "stays")
    # All columns travel in one, so that none can clash with those added here.
    whole = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("whole"),
                      F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    single = whole.join(lookup(marks), same, "left_anti").select("whole")
    # Of equal rows one stays; copies meet only with their own kind.
    one = whole.join(lookup(marks.where("stays")), same).dropDuplicates(["_doc", "_hash"]).select("whole")
    return single.unionByName(one).select(*(F.col(f"whole.`{c}`").alias(c) for c in df.columns))
