"""Rule statistics of one text, shared by the quality rules and the quality classifier.

Words are runs of characters other than U+0020 and U+0009 to U+000D, taken from the whole
text. A null text counts as an empty one.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.common import SLICE, by_rows, drop_kept, texts

BLANKS = " \t\n\x0b\x0c\r"
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_digits", "n_distinct", "n_top_word", "n_marks", "n_wide")
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeated", "upper", "digits",
            "distinct", "top_word", "marks", "wide")


def repeated_words(ids: list[int]) -> int:
    """Words that lie in a window of three words that the text has twice or more."""
    if len(ids) < 4:
        return 0
    a = np.array(ids, dtype=np.int64)
    n = int(a.max()) + 1
    keys = (a[:-2] * n + a[1:-1]) * n + a[2:] if n < 2_000_000 else \
        np.unique(np.stack([a[:-2], a[1:-1], a[2:]], 1), axis=0, return_inverse=True)[1].ravel()
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    covered = np.zeros(len(a), dtype=bool)
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()     # bytes split at exactly these blanks
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    ascii_only = len(raw) == len(text)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(ids), len(lines),
            len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, DIGITS)),
            len(number), int(np.bincount(ids).max()) if ids else 0,
            text.count("!") + text.count("?"), 0 if ascii_only else len(raw) - len(text))


def count_table(some: list[str | None]) -> np.ndarray:
    """Counts of several texts, a row for each."""
    return np.array([counts(t) for t in some], dtype=np.int64).reshape(-1, len(COUNTS))


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of each whole text."""
    def start() -> Callable[..., tuple]:
        drop_kept()
        return lambda doc, text: (doc, *counts(text))
    return by_rows(texts(df, id_col, text_col), STATS, start)


def counted(batch: pa.Array) -> np.ndarray:
    """Counts of a batch of texts, a row for each; a few texts at a time leave Arrow."""
    drop_kept()
    parts = [count_table(batch.slice(at, SLICE).to_pylist()) for at in range(0, len(batch), SLICE)]
    return np.concatenate(parts) if parts else count_table([])


def keep_where(df: DataFrame, decide: Callable[[np.ndarray], np.ndarray], text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that are decided to stay by the ``COUNTS`` of their text.

    Texts are counted and judged in one Python worker; only the verdict comes back.
    """
    def stays(batch: pa.Array) -> pa.Array:
        return pa.array(decide(counted(batch)), pa.bool_())
    return df.where(F.arrow_udf(stays, "boolean")(F.col(f"`{text_col}`")))


def features(table: np.ndarray) -> np.ndarray:
    """Rows of ``COUNTS`` as rows of ``FEATURES``: shares, so that length alone says little."""
    c = dict(zip(COUNTS, np.asarray(table, dtype=float).reshape(-1, len(COUNTS)).T, strict=True))
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, np.minimum(c["n_symbols"] / words, 3),
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words,
        c["n_upper"] / chars, c["n_digits"] / chars, c["n_distinct"] / words,
        c["n_top_word"] / words, np.minimum(c["n_marks"] / words, 3), c["n_wide"] / chars], axis=1)


def vectorised(df: DataFrame, schema: str, scored: Callable[[np.ndarray], tuple]) -> DataFrame:
    """``doc_id`` and what ``scored`` makes of the ``COUNTS`` of a batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            table = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS], axis=1)
            columns = [batch.column("doc_id"), *scored(table)]
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, f.type)
                 for x, f in zip(columns, arrow, strict=True)], schema=arrow)
    return df.select("doc_id", *COUNTS).mapInArrow(run, out)
