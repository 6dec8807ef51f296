"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; every other row is unlabelled web text. A linear
model on rule statistics, their squares and products minimises the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

with the logistic loss, by full-batch gradient steps. The class prior is the share of good
rows among the labelled ones. Labels of held-out rows are never read, and a score sees only
the text. The fit uses bounded samples: at most ``SAMPLE`` positives and ``SAMPLE``
unlabelled rows, taken in order of a hash of the id. A last step on labelled rows (bounded
alike) turns the model's value into a probability.

Defined results: null and empty texts get the score of all-zero counts; with no labelled
rows every score is 0.5; repeated rows are scored each by itself; several labels of one
document count as the lowest, null labels as none; columns other than id and text are left
out; an empty table stays empty.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.common import stored
from lakeproof.llm.text_stats import COUNTS, features, keep_where, statistics, vectorised

SAMPLE = 20_000
FOLDS, CUT = 5, 0.3
STEPS, RATE, DECAY = 400, 0.05, 1e-4
SCORED = "doc_id long, score double"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def expand(table: np.ndarray) -> np.ndarray:
    """Features, their squares and products."""
    x = features(table)
    first, second = np.triu_indices(x.shape[1])
    return np.concatenate([x, x[:, first] * x[:, second]], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def value(self, table: np.ndarray) -> np.ndarray:
        z = np.clip((expand(table) - self.mean) / self.scale, -8, 8)
        return z @ self.weight + self.bias

    def score(self, table: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.value(table) + self.shift)


def descend(gradient, size: int, steps: int = STEPS, rate: float = RATE) -> np.ndarray:
    """Gradient steps with momentum and step sizes by coordinate, from zero."""
    at, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, steps + 1):
        g = gradient(at)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        at = at - rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
    return at


def learn(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimises the non-negative risk over rows of ``COUNTS``."""
    p, u = expand(positive), expand(unlabelled)
    mean, scale = u.mean(axis=0), u.std(axis=0) + 1e-9
    p, u = (np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))] for x in (p, u))

    def gradient(w: np.ndarray) -> np.ndarray:
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        soft = np.logaddexp(0, np.clip(u @ w, -60, 60)).mean()
        negative = soft - prior * np.logaddexp(0, np.clip(p @ w, -60, 60)).mean()
        g_neg = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if negative < 0:    # the risk of negatives may not go below zero: step back
            return -g_neg + DECAY * w
        return prior * (p.T @ (sp - 1)) / len(p) + g_neg + DECAY * w
    w = descend(gradient, p.shape[1])
    return Model(mean, scale, w[:-1], float(w[-1]))


def calibrated(model: Model, table: np.ndarray, quality: np.ndarray) -> Model:
    """Slope and shift that make the score a probability on labelled rows."""
    if len(set(quality)) < 2:
        return model
    value = model.value(table)
    unit = value.std() + 1e-9

    def gradient(w: np.ndarray) -> np.ndarray:
        miss = sigmoid(w[0] * value / unit + w[1]) - quality
        return np.array([(miss * value / unit).mean(), miss.mean()]) + 1e-3 * w
    slope, shift = descend(gradient, 2)
    return Model(model.mean, model.scale, model.weight, model.bias, max(slope, 1e-6) / unit, shift)


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rows that are not held out; None without positives."""
    marked = (labels.where("quality is not null").groupBy("doc_id")
              .agg(F.min("quality").cast("int").alias("quality")))
    rows = stats.where(~held_out(F.col("doc_id"))).join(marked, "doc_id", "left")
    order = [F.xxhash64("doc_id"), "doc_id", *COUNTS]
    known = rows.where("quality is not null")

    def some(df: DataFrame) -> pd.DataFrame:
        return df.orderBy(*order).limit(sample).select(*COUNTS, "quality").toPandas()
    positive = some(known.where("quality = 1"))
    if not len(positive):
        return None
    prior = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    unlabelled, judged = some(rows), some(known)
    model = learn(positive[list(COUNTS)].to_numpy(), unlabelled[list(COUNTS)].to_numpy(), prior)
    return calibrated(model, judged[list(COUNTS)].to_numpy(), judged["quality"].to_numpy())


def score_statistics(stats: DataFrame, model: Model | None) -> DataFrame:
    return vectorised(stats, SCORED, lambda table: (
        model.score(table) if model else np.full(len(table), 0.5),))


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each whole text."""
    stats = stored(statistics(df, id_col, text_col), "quality")
    scored = score_statistics(stats, fit(stats, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def accept(df: DataFrame, model: Model | None, cut: float = CUT) -> DataFrame:
    """Rows of ``df`` whose whole text reaches the cut; all without a model."""
    if model is None:
        return df
    return keep_where(df, lambda table: model.score(table) >= cut)
