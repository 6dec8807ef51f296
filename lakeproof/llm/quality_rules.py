"""Quality rules: isolation forests on rule statistics, their threshold set by labelled rows.

Base rules fail a text of fewer than 50 words, or one in which over half of the words lie in
three-word windows that the text repeats. For the others isolation forests give the mean
length of the path that isolates their statistics by random splits; short paths are
anomalous. One forest looks at every statistic, and one at each alone, so that none hides
another; the anomaly is the highest score. They are grown on a bounded sample of good rows
that pass the base rules (``SAMPLE`` rows, ``PER_TREE`` of them for each tree), known bad rows
take no part. Splits fall in a range wider than that of the rows, by ``LEAST`` at least, so
values that no good text has are isolated early, also in a statistic that is the same in all
good texts. The threshold looks at every good row, through a histogram of scores: it is the
lowest at which at most ``CLEAN_LOSS`` of those that pass the base rules would be rejected,
which rejects the most bad rows that this bound allows.

Defined results: null and empty texts have zero counts and fail the base rules; without
labelled rows nothing but the base rules rejects; repeated rows are judged each by itself;
several labels of one document count as the lowest, null labels as none; columns other than
id and text are left out; an empty table stays empty.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.common import stored
from lakeproof.llm.text_stats import COUNTS, FEATURES, features, keep_where, statistics, vectorised

SAMPLE = 20_000
TREES, PER_TREE, SEED = 48, 256, 7
CLEAN_LOSS = 0.005
BINS = 10_000
MIN_WORDS, REPEAT_PERCENT = 50, 50
# By how much at least splits fall outside the rows' values, for each of FEATURES.
LEAST = np.array([1.0 if f in ("log_words", "word_length") else 0.1 for f in FEATURES])
JUDGED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, anomaly double, kept boolean")


def mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a tree of ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Forest:
    """Random splits as flat arrays, one row per tree.

    A split lies within the node's rows or as far outside as the tree's rows range (``least``
    if that is more), as far as the node reaches. ``columns`` are those split on, or all.
    """

    def __init__(self, rows: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE,
                 seed: int = SEED, columns: list[int] | None = None, least: np.ndarray | float = 0.0):
        self.columns = np.arange(rows.shape[1]) if columns is None else np.array(columns)
        rng = np.random.default_rng(seed)
        self.size = min(per_tree, len(rows))
        self.depth = max(1, math.ceil(math.log2(max(2, self.size))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.zeros((trees, nodes), dtype=np.int64)
        self.split = np.full((trees, nodes), np.inf)    # everything goes left of infinity
        self.path = np.zeros((trees, nodes))
        for t in range(trees):
            picked = rows[rng.choice(len(rows), self.size, replace=False)]
            pad = np.maximum(np.ptp(picked, axis=0), least)
            everywhere = np.full(rows.shape[1], np.inf)
            self._grow(t, 0, picked, 0, rng, pad, -everywhere, everywhere)

    def _grow(self, t: int, node: int, rows: np.ndarray, depth: int, rng, pad: np.ndarray,
              floor: np.ndarray, top: np.ndarray) -> None:
        self.path[t, node] = depth + mean_path(len(rows))
        if depth == self.depth or len(rows) < 2:
            return
        low = np.maximum(floor, rows.min(axis=0) - pad)
        high = np.minimum(top, rows.max(axis=0) + pad)
        usable = self.columns[high[self.columns] > low[self.columns]]
        if not len(usable):
            return
        f = int(rng.choice(usable))
        at = rng.uniform(low[f], high[f])
        self.feature[t, node], self.split[t, node] = f, at
        left, below, above = rows[:, f] < at, top.copy(), floor.copy()
        below[f] = above[f] = at
        self._grow(t, 2 * node + 1, rows[left], depth + 1, rng, pad, floor, below)
        self._grow(t, 2 * node + 2, rows[~left], depth + 1, rng, pad, above, top)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path, the higher."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                inner = split[node] < np.inf
                if not inner.any():
                    break
                right = rows[every, feature[node]] >= split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return np.exp2(-total / len(self.feature) / max(mean_path(self.size), 1e-9))


@dataclass(frozen=True)
class Rules:
    """Fitted rules; without forests only the base rules hold."""
    forests: tuple[Forest, ...]
    threshold: float

    def anomaly(self, table: np.ndarray) -> np.ndarray:
        rows = features(table)
        return np.max([forest.score(rows) for forest in self.forests] or [np.zeros(len(rows))], axis=0)

    def judge(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the base rules fail, the anomaly score, whether the text is kept."""
        failed, score = base_failed(table), self.anomaly(table)
        return failed, score, ~failed & (score < self.threshold)


def grown(rows: np.ndarray) -> tuple[Forest, ...]:
    """A forest on all of ``FEATURES`` and one on each."""
    return tuple(Forest(rows, columns=columns, least=LEAST)
                 for columns in [None, *([f] for f in range(len(FEATURES)))])


def base_failed(table: np.ndarray) -> np.ndarray:
    words, repeated = table[:, COUNTS.index("n_words")], table[:, COUNTS.index("n_repeat_words")]
    return (words < MIN_WORDS) | (100 * repeated > REPEAT_PERCENT * words)


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE,
        clean_loss: float = CLEAN_LOSS) -> Rules:
    """Forests and threshold from the statistics of labelled rows (``doc_id, quality``)."""
    labelled = stats.join(labels.where("quality is not null").groupBy("doc_id")
                          .agg(F.min("quality").alias("quality")), "doc_id")
    good = labelled.where(f"quality = 1 and n_words >= {MIN_WORDS} "
                          f"and 100 * n_repeat_words <= {REPEAT_PERCENT} * n_words")
    rows = good.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample).select(*COUNTS).toPandas()
    if not len(rows):
        return Rules((), math.inf)
    trial = Rules(grown(features(rows.to_numpy())), math.inf)
    # Every good row counts, in a histogram of BINS at most.
    scored = vectorised(good, "doc_id long, bin int",
                        lambda table: ((trial.anomaly(table) * BINS).astype(int),))
    bins = dict(scored.groupBy("bin").count().collect())
    allowed, threshold = clean_loss * sum(bins.values()), BINS + 1
    for b in sorted(bins, reverse=True):
        allowed -= bins[b]
        if allowed < 0:
            threshold = b + 1
            break
    return Rules(trial.forests, threshold / BINS)


def judge_statistics(stats: DataFrame, rules: Rules) -> DataFrame:
    """``JUDGED`` for rows of statistics."""
    def scored(table: np.ndarray) -> tuple:
        return (*table[:, :5].T.astype(np.int64), *rules.judge(table))
    return vectorised(stats, JUDGED, scored)


def quality_rules(df: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Statistics, base verdict, anomaly score and verdict of each text."""
    stats = stored(statistics(df, id_col, text_col), "rules")
    return judge_statistics(stats, fit(stats, labels))


def keep(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows of ``df`` whose whole text the rules keep."""
    return keep_where(df, lambda table: rules.judge(table)[2])
