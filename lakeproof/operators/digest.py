"""Order-free digests of whole partitions, and descent into those that differ.

A partition's digest is the sum, word by word, of the SHA-256 digests of its rows, taken as
eight numbers of 32 bits, with the number of rows. Sums do not depend on order and fold in
every task, so comparing two tables moves a row per task, partition and range, never the data.
Equal rows count as often as they occur.

Where a partition differs, its rows are summed again by ranges of their digest (its first hex
digits), and only rows in ranges that differ are compared one by one: the work after the first
pass follows the damage and not the table. Where the damage is spread over most of the rows, by
the row counts or by the ranges, descent cannot leave rows out: then all rows of the partitions
are compared in one shuffle of their digests.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.operators import checksum as cs, partitions as parts
from lakeproof.operators.lookup import is_small, lookup
from lakeproof.session import cut_lineage

WORDS = [f"w{i}" for i in range(8)]
# Digits of a range in the first pass: a sum of 32-bit words then holds 2**35 rows a partition.
FIRST = 1
# Digits in the second pass: at most 4,096 ranges of each partition that differs, and on average
# at least so many rows in one, so that ranges fold before they are shuffled.
SECOND, ROWS_A_RANGE = 3, 1000


def _digested(df: DataFrame, by: list[str], exclude: list[str], strict: bool) -> DataFrame:
    hashed = cs.row_checksum(df, cs.hashed_columns(df, exclude), strict)
    return df.select(*by, hashed.alias("checksum"))


def _word(i: int) -> Column:
    return F.conv(F.substring("checksum", 1 + 8 * i, 8), 16, 10).cast("bigint")


def digests(df: DataFrame, by: list[str], exclude: list[str], digits: int = 0, strict: bool = True) -> DataFrame:
    """``by, range``, rows and word sums; a range is the first ``digits`` of the row digests."""
    rows = _digested(df, by, exclude, strict)
    return rows.groupBy(*by, F.substring("checksum", 1, digits).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(_word(i)).alias(w) for i, w in enumerate(WORDS)])


def compare_digests(source: DataFrame, target: DataFrame, by: list[str], exclude: list[str],
                    digits: int = FIRST, strict: bool = True) -> DataFrame:
    """Per partition and range: rows on either side and whether the digests are equal."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        found = digests(df, by, exclude, digits, strict)
        return found.select(*by, "range", *[(sign * F.col(c)).alias(c) for c in ("rows", *WORDS)],
                            F.when(F.lit(sign > 0), F.col("rows")).otherwise(0).alias("source_rows"),
                            F.when(F.lit(sign < 0), F.col("rows")).otherwise(0).alias("target_rows"))
    # Equal sums cancel; a partition on one side only does not.
    both = side(source, 1).unionByName(side(target, -1))
    sums = both.groupBy(*by, "range").agg(*[F.sum(c).alias(c) for c in ("rows", *WORDS, "source_rows", "target_rows")])
    equal = F.col("rows") == 0
    for w in WORDS:
        equal = equal & (F.col(w) == 0)
    return sums.select(*by, "range", "source_rows", "target_rows", equal.alias("equal"))


def compare_partitions(source: DataFrame, target: DataFrame, by: list[str], exclude: list[str],
                       strict: bool = True) -> DataFrame:
    """Every partition of either side: its rows there, and PASS where the digests are equal."""
    found = compare_digests(source, target, by, exclude, FIRST, strict).groupBy(*by).agg(
        F.sum("source_rows").alias("source_record_count"), F.sum("target_rows").alias("target_record_count"),
        F.bool_and("equal").alias("equal"))
    return found.select(*by, "source_record_count", "target_record_count",
                        F.when(F.col("equal"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


def differing_rows(source: DataFrame, target: DataFrame, by: list[str], exclude: list[str],
                   verdicts: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """``by, checksum, src, tgt``: row checksums that the sides do not have equally often.

    ``verdicts`` is a result of ``compare_partitions``, computed here if not given. Partitions
    that pass are not read again.
    """
    if verdicts is None:
        if _widespread(cut_lineage(_counts(source, target, by))):
            return _unequal(source, target, by, exclude, strict)
        verdicts = compare_partitions(source, target, by, exclude, strict)
    wrong = cut_lineage(verdicts.filter("status = 'FAIL'").select(*by, "source_record_count", "target_record_count"))
    n, rows = wrong.agg(F.count(F.lit(1)), F.coalesce(F.sum(_both_rows()), F.lit(0))).first()
    a, b = (parts.restrict(df, wrong, by, n) for df in (source, target))
    if _widespread(wrong):
        return _unequal(a, b, by, exclude, strict)
    digits = max([d for d in range(FIRST, SECOND + 1) if n * 16 ** d * ROWS_A_RANGE <= rows], default=FIRST)
    ranges = cut_lineage(compare_digests(a, b, by, exclude, digits, strict).filter(~F.col("equal"))
                         .select(*by, "range", (F.col("source_rows") + F.col("target_rows")).alias("rows")))
    left = ranges.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if 2 * left > rows or not is_small(ranges):
        return _unequal(a, b, by, exclude, strict)
    ranges = ranges.drop("rows")

    def suspects(df: DataFrame, in_source: int) -> DataFrame:
        found = _digested(df, by, exclude, strict).withColumn("range", F.substring("checksum", 1, digits))
        kept = _null_safe(found, ranges, [*by, "range"], "left_semi", True)
        return kept.select(*by, F.unhex("checksum").alias("checksum"), F.lit(in_source).cast("bigint").alias("src"),
                           F.lit(1 - in_source).cast("bigint").alias("tgt"))
    both = suspects(a, 1).unionByName(suspects(b, 0))
    counts = both.groupBy(*by, "checksum").agg(F.sum("src").alias("src"), F.sum("tgt").alias("tgt"))
    return _differing(counts)


def _counts(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Rows of each partition on either side; reads the partition columns only."""
    def side(df: DataFrame, in_source: int) -> DataFrame:
        return df.select(*by, F.lit(in_source).alias("s"), F.lit(1 - in_source).alias("t"))
    return side(source, 1).unionByName(side(target, 0)).groupBy(*by).agg(
        F.sum("s").alias("source_record_count"), F.sum("t").alias("target_record_count"))


def _both_rows() -> Column:
    return F.col("source_record_count") + F.col("target_record_count")


def _widespread(counts: DataFrame) -> bool:
    """True when partitions whose row counts differ hold most of the rows."""
    differ = F.when(F.col("source_record_count") != F.col("target_record_count"), _both_rows())
    inside, rows = counts.agg(F.sum(differ), F.sum(_both_rows())).first()
    return 2 * (inside or 0) > (rows or 0)


def _differing(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("src") != F.col("tgt")).withColumn("checksum", F.lower(F.hex("checksum")))


def _unequal(source: DataFrame, target: DataFrame, by: list[str], exclude: list[str], strict: bool) -> DataFrame:
    """All rows compared in one shuffle of their digests."""
    return _differing(cs.checksum_counts(source, target, exclude, by, strict))


def _null_safe(rows: DataFrame, table: DataFrame, keys: list[str], how: str, small: bool) -> DataFrame:
    """``lookup`` by keys that may be null."""
    marked = {f"__{k}": F.struct(F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys}
    side = table.withColumns(marked).drop(*keys)
    return lookup(rows.withColumns(marked), side, list(marked), how, small=small).drop(*marked)


def with_rows(df: DataFrame, differing: DataFrame, by: list[str], exclude: list[str], strict: bool = True) -> DataFrame:
    """The rows of ``df`` whose checksum was found to differ, with ``checksum, src, tgt``."""
    found = cut_lineage(differing)
    hashed = df.withColumn("checksum", cs.row_checksum(df, cs.hashed_columns(df, exclude), strict))
    return _null_safe(hashed, found, [*by, "checksum"], "inner", is_small(found))
