"""Approximate nearest neighbours by balanced posting lists.

Vectors are grouped in posting lists around centroids. Centroids come from k-means on a
bounded sample (``SAMPLE`` vectors, in order of a hash), whose assignment step charges a
centroid for the vectors it already has, so lists are balanced. A vector near a boundary is
put in every list whose centroid is at most ``1 + CLOSURE`` times as far as its nearest (at
most ``REPLICAS`` lists, the nearest always). Tasks search the centroids through an in-memory
graph of their neighbours, best first. A query scans the lists whose centroid is at most
``1 + prune`` times as far as its nearest one (``probes`` lists at most), and further ones,
next in order, until the lists' own vectors suffice for the number asked. How many lists that
takes depends on the table: ``HELD`` vectors, those of queries first, are held back from
the k-means sample of a table much larger than that, their nearest are found by brute force
over the whole table, and ``probes`` and ``prune`` grow from ``PROBES`` and ``PRUNE`` until
``RECALL`` of these are in scanned lists.

Equal vectors are one: only the ``k + 1`` smallest ids of a vector can be among anybody's k
nearest, and a query's own id may be one of them. They are cut to that by a ranked window,
which keeps as few rows of each key in every task before any exchange. Lists longer than
``BLOCK`` are cut into blocks scanned by separate tasks. Nearness is cosine in double
precision, summed in the same order for every pair; ties go to the smaller id.

Defined results: vectors that are null, empty, zero, of another length than most of the
table's first sample, or hold null or non-finite components take no part, neither as query
nor as candidate; a query without candidates has no row; repeated ids are each a row of
their own as candidates, but never their own query's; an empty table gives an empty result.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, StructType

from lakeproof.llm.common import stored

SAMPLE = 40_000
LIST = 160          # vectors of a list aimed at
CENTROIDS = 4096    # at most; beyond that lists grow and are scanned in blocks
REPLICAS, CLOSURE = 4, 0.15
PROBES, PRUNE = 24, 0.35    # at least
HELD, RECALL = 512, 0.95
LINKS, BEAM = 16, 64
BLOCK = 4096
ROUNDING = 1e-10    # more than two ways of summing a cosine differ by
SEED = 11


@dataclass(frozen=True)
class Centroids:
    """Unit centroids, each with links to near ones and to a few at random."""
    points: np.ndarray
    links: np.ndarray

    def nearest(self, vectors: np.ndarray, count: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the nearest centroids found for each unit vector."""
        k = len(self.points)
        count = min(count, k)
        if count == k:    # all of them: a walk would save nothing
            every = [np.argsort(d, kind="stable") for d in 2 - 2 * vectors @ self.points.T]
            ids = np.array(every, dtype=np.int64).reshape(len(vectors), k)
            far = np.maximum(2 - 2 * vectors @ self.points.T, 0.0)
            return ids, np.sqrt(np.take_along_axis(far, ids, axis=1))
        ids, dist = np.zeros((len(vectors), count), np.int64), np.zeros((len(vectors), count))
        for row, v in enumerate(vectors):
            found = self._search(v, max(beam, count), count)
            ids[row], dist[row] = [c for _, c in found], [math.sqrt(max(d, 0.0)) for d, _ in found]
        return ids, dist

    def _search(self, v: np.ndarray, beam: int, count: int) -> list[tuple[float, int]]:
        """Best-first walk over the links; keeps the best ``beam`` seen."""
        points, links = self.points, self.links
        seen = np.zeros(len(points), dtype=bool)
        entry = np.arange(0, len(points), max(1, len(points) // 32))
        seen[entry] = True
        first = [(d, int(c)) for d, c in zip((2 - 2 * points[entry] @ v).tolist(), entry, strict=True)]
        open_, best = list(first), [(-d, c) for d, c in first]
        heapq.heapify(open_)
        heapq.heapify(best)
        while len(best) > beam:
            heapq.heappop(best)
        while open_:
            d, c = heapq.heappop(open_)
            if len(best) >= beam and d > -best[0][0]:
                break
            fresh = links[c][~seen[links[c]]]
            seen[fresh] = True
            for e, n in zip((2 - 2 * points[fresh] @ v).tolist(), fresh.tolist(), strict=True):
                if len(best) < beam or e < -best[0][0]:
                    heapq.heappush(open_, (e, n))
                    heapq.heappush(best, (-e, n))
                    if len(best) > beam:
                        heapq.heappop(best)
        return sorted((-d, c) for d, c in best)[:count]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def balanced_means(vectors: np.ndarray, k: int, rounds: int = 8, charge: float = 0.15) -> np.ndarray:
    """Unit centroids of unit vectors; full clusters look farther away than they are."""
    rng = np.random.default_rng(SEED)
    centre = vectors[rng.choice(len(vectors), k, replace=False)].copy()
    load = np.full(k, len(vectors) / k)
    for _ in range(rounds):
        mean = len(vectors) / k
        extra = charge * np.log(np.maximum(load, 1) / mean).clip(-2, 2) * 0.1
        pick = np.concatenate([np.argmin(2 - 2 * part @ centre.T + extra, axis=1)
                               for part in np.array_split(vectors, max(1, len(vectors) * k // 8_000_000))])
        load = np.bincount(pick, minlength=k).astype(float)
        total = np.zeros_like(centre)
        np.add.at(total, pick, vectors)
        empty = load == 0
        total[empty] = vectors[rng.choice(len(vectors), int(empty.sum()))]
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), centre)
    return centre


def linked(points: np.ndarray) -> Centroids:
    rng = np.random.default_rng(SEED)
    k = len(points)
    near = min(LINKS, k - 1)
    rows = []
    for part in np.array_split(np.arange(k), max(1, k * k // 4_000_000)):
        d = -points[part] @ points.T
        d[np.arange(len(part)), part] = np.inf
        close = np.argpartition(d, near - 1, axis=1)[:, :near] if near else np.zeros((len(part), 0), int)
        rows.append(np.concatenate([close, rng.integers(0, k, (len(part), 4))], axis=1))
    return Centroids(points, np.concatenate(rows))


def valid(vector: str, size: int | None = None) -> Column:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False))
            & F.exists(v, lambda x: x != 0) & (F.lit(True) if size is None else F.size(v) == size))


def distinct_vectors(df: DataFrame, k: int) -> DataFrame:
    """``key, vec, ids``: each vector once, with its ``k + 1`` smallest ids."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    one = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return one.select(F.monotonically_increasing_id().alias("key"), "vec", "ids")


def as_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def assigned(df: DataFrame, key: str, index: Centroids, count: int, ratio: float,
             own: np.ndarray | None, enough: int) -> DataFrame:
    """``key, first, list, nearest, vec``: the lists of each vector whose distance passes the ratio.

    With ``own`` (vectors that have each list as their nearest) lists are taken beyond the
    ratio until they hold ``enough``.
    """
    # Single precision stays so: the vectors of queries travel once for each list.
    vec = "array<float>" if df.schema["vec"].dataType == ArrayType(FloatType()) else "array<double>"
    schema = StructType.fromDDL(f"key long, first long, list int, nearest boolean, vec {vec}")
    arrow = to_arrow_schema(schema)
    step = max(1, min(2048, 50_000 // min(count, len(index.points))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                keys, vectors = part.column("key").to_pylist(), as_matrix(part.column("vec"))
                first = part.column("first").to_pylist()
                ids, dist = index.nearest(unit(vectors), count)
                out: list[tuple] = []
                for i, key_ in enumerate(keys):
                    bound = (1 + ratio) * max(dist[i, 0], 1e-6)
                    n = int(np.searchsorted(dist[i], bound, side="right"))
                    chosen = ids[i, :max(1, n)].tolist()
                    if own is not None:
                        held = int(own[chosen].sum())
                        if held < enough:   # next in order, over all centroids
                            every = np.argsort(-(index.points @ unit(vectors[i:i + 1])[0]), kind="stable")
                            for c in every.tolist():
                                if held >= enough:
                                    break
                                if c not in chosen:
                                    chosen.append(c)
                                    held += int(own[c])
                    out += [(key_, first[i], c, j == 0, vectors[i]) for j, c in enumerate(chosen)]
                columns = list(zip(*out, strict=True)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
    return df.select(F.col(key).alias("key"), "first", F.col("vec").cast(vec).alias("vec")).mapInArrow(run, schema)


def true_nearest(one: DataFrame, held: np.ndarray, own: list[int], k: int) -> DataFrame:
    """``query, key``: the ``k`` nearest vectors of each of ``held`` (unit vectors with keys
    ``own``), by brute force over all of ``one``; ``query`` is the place in ``held``."""
    schema = StructType.fromDDL("query int, key long, score double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, scores = np.zeros((len(held), 0), np.int64), np.zeros((len(held), 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                new = part.column("key").to_numpy()
                close = held @ unit(as_matrix(part.column("vec"))).T
                close[np.array(own)[:, None] == new[None, :]] = -np.inf
                scores = np.concatenate([scores, close], axis=1)
                keys = np.concatenate([keys, np.broadcast_to(new, close.shape)], axis=1)
                if scores.shape[1] > k:
                    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                    scores, keys = np.take_along_axis(scores, top, 1), np.take_along_axis(keys, top, 1)
        query, column = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(keys[query, column]),
                                          pa.array(scores[query, column])], schema=arrow)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return (one.select("key", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(run, schema)
            .withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).select("query", "key"))


def calibrated(index: Centroids, held: np.ndarray, near: dict[tuple[int, int], set[int]], probes: int,
               prune: float, recall: float) -> tuple[int, float]:
    """The number of lists and the distance ratio, from the given ones up, with which ``recall``
    of ``near`` is scanned; ``near`` has the lists of each near vector of each of ``held``."""
    probes = max(1, probes)
    while near:
        ids, dist = index.nearest(held, probes)
        nearest = np.maximum(dist[:, :1], 1e-6)
        # For each near vector the ratio at which its first list is scanned.
        ratio = np.array([min((dist[q, j] / nearest[q, 0] - 1 for j in np.flatnonzero(np.isin(ids[q], list(lists)))),
                              default=math.inf) for (q, _), lists in near.items()])
        if probes < len(index.points) and (ratio < math.inf).mean() < recall:
            probes = min(len(index.points), probes + max(1, probes // 4))
            continue
        needed = float(np.sort(ratio)[math.ceil(recall * len(ratio)) - 1])
        return probes, max(prune, needed + 1e-9)
    return probes, prune


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row in one order of summing, so equal pairs give equal numbers."""
    top = (vectors * query).sum(axis=1)
    return top / np.sqrt((vectors * vectors).sum(axis=1)) / math.sqrt(float((query * query).sum()))


def scanned(postings: DataFrame, probes: DataFrame, keep: int) -> DataFrame:
    """``query, key, score``: the best ``keep`` vectors of each block for each query, those
    with the smaller ``first`` id where scores are equal."""
    schema = StructType.fromDDL("query long, key long, score double")
    arrow = to_arrow_schema(schema)

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            vectors, keys = as_matrix(left.column("vec").combine_chunks()), left.column("key").to_numpy()
            wanted = as_matrix(right.column("vec").combine_chunks())
            first = left.column("first").to_numpy()
            rough, queries = unit(vectors), right.column("key").to_numpy()
            for q, w in zip(queries, wanted, strict=True):
                close = rough @ (w / math.sqrt(float((w * w).sum())))
                # All within rounding of the last one asked, as the last digits are settled below.
                n = min(len(keys), keep)
                near = np.flatnonzero(close >= np.partition(close, -n)[-n] - ROUNDING)
                score = cosine(w, vectors[near])
                best = np.lexsort((keys[near], first[near], -score))[:keep]
                out.append((np.full(len(best), q), keys[near][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table(dict(zip(("query", "key", "score"), columns, strict=True)),
                        schema=arrow)
    return (postings.groupBy("list", "block").cogroup(probes.groupBy("list", "block"))
            .applyInArrow(scan, schema))


def nearest_vectors(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                    vector_col: str = "embedding", probes: int = PROBES, prune: float = PRUNE,
                    recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row that is a query.

    ``is_query`` is a condition on ``vec_id``. More than ``probes`` and ``prune`` are taken
    where held-back vectors need it for ``recall``.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vec"))
    rows = rows.where(valid("vec") & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("vec")).count().orderBy(F.desc("count"), "size(vec)").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("vec") == sizes[0][0])
    one = stored(distinct_vectors(rows, k), "vectors")
    n = one.count()
    asked = rows.where(is_query).select("vec", "vec_id")
    queries = asked.join(one, "vec").select("key", "vec", F.col("vec_id").alias("query_id"))
    queries = stored(queries, "queries")
    few = (one.join(queries.select("key").distinct().withColumn("asked", F.lit(1)), "key", "left")
           .orderBy(F.desc_nulls_last("asked"), F.xxhash64("vec"), "key").limit(HELD)
           .select("key", F.col("vec").cast("array<double>").alias("vec")).toArrow())
    own_keys, held_back = few.column("key").to_pylist(), unit(as_matrix(few.column("vec").combine_chunks()))
    rest = one.where(~F.col("key").isin(own_keys)) if n > 8 * HELD else one
    sample = rest.orderBy(F.xxhash64("vec"), "key").limit(SAMPLE).select(F.col("vec").cast("array<double>")).toArrow()
    vectors = unit(as_matrix(sample.column(0).combine_chunks()))
    count = max(1, min(CENTROIDS, len(vectors) // 4, -(-n // LIST)))
    index = linked(balanced_means(vectors, count))
    lists = stored(assigned(one.withColumn("first", F.col("ids")[0]), "key", index, REPLICAS, CLOSURE, None, 0), "postings")
    held = {r[0]: (r[1], r[2]) for r in lists.groupBy("list").agg(
        F.count("*"), F.sum(F.col("nearest").cast("int"))).collect()}    # a row per centroid
    own = np.array([held.get(c, (0, 0))[1] for c in range(count)])
    blocks = [max(1, -(-held.get(c, (0, 0))[0] // BLOCK)) for c in range(count)]
    table = spark.createDataFrame(list(enumerate(blocks)), "list int, blocks int")
    near: dict[tuple[int, int], set[int]] = {}
    truth = true_nearest(one, held_back, own_keys, k)
    for q, key, c in lists.select("key", "list").join(F.broadcast(truth), "key").select("query", "key", "list").collect():
        near.setdefault((q, key), set()).add(c)    # HELD * k * REPLICAS at most
    probes, prune = calibrated(index, held_back, near, probes, prune, recall)
    wanted = assigned(queries.dropDuplicates(["key"]).withColumn("first", F.col("query_id")), "key", index, probes, prune, own, 4 * (k + 1))
    wanted = (wanted.join(F.broadcast(table), "list")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = (lists.join(F.broadcast(table), "list")
             .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))
    found = scanned(dealt.select("list", "block", "key", "first", "vec"), wanted.select("list", "block", "key", "vec"), k + 1)
    found = found.dropDuplicates(["query", "key"]).join(one.select("key", "ids"), "key")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # k + 1 ids of each query's vector: one of them may be the query itself.
    near = (found.select("query", "score", F.explode("ids").alias("vec_id"))
            .withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1))
    own_first = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
    named = queries.select(F.col("key").alias("query"), "query_id", F.monotonically_increasing_id().alias("part"))
    return (near.join(named, "query").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(own_first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
