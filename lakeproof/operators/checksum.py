"""Row checksums and their comparison; repeatable samples for file checksums."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions import paths

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def hashed_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Data columns in name order, partition columns left out."""
    skip = {c.lower() for c in exclude}
    return sorted(c for c in df.columns if c.lower() not in skip)


def _text(df: DataFrame, name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.to_json(value) if isinstance(df.schema[name].dataType, _NESTED) else value.cast("string")


def row_checksum(df: DataFrame, columns: list[str], strict: bool = False) -> Column:
    """SHA-256 of a row.

    Default: values joined by ``||``, nulls skipped.  Strict: every value carries its
    length and nulls are marked, so moved nulls and moved separators change the sum.
    """
    if not columns:
        raise ValueError("no columns left to hash")
    values = [_text(df, c) for c in columns]
    if strict:
        values = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))
                  for v in values]
        return F.sha2(F.concat_ws("|", *values), 256)
    return F.sha2(F.concat_ws("||", *values), 256)


def checksum_counts(source: DataFrame, target: DataFrame, exclude: list[str],
                    by: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Rows per checksum on either side, both sides in one shuffle.

    Equal rows are combined before the shuffle, so mass copies cost one row per task.
    Checksums travel as 32 bytes, not as 64 characters.
    """
    by = by or []

    def one_side(df: DataFrame, in_source: int) -> DataFrame:
        digest = F.unhex(row_checksum(df, hashed_columns(df, exclude), strict))
        return df.select(*by, digest.alias("checksum"),
                         F.lit(in_source).cast("bigint").alias("src"),
                         F.lit(1 - in_source).cast("bigint").alias("tgt"))

    both = one_side(source, 1).unionByName(one_side(target, 0))
    return both.groupBy(*by, "checksum").agg(F.sum("src").alias("src"), F.sum("tgt").alias("tgt"))


def compare_checksums(source: DataFrame, target: DataFrame, exclude: list[str],
                      by: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Verdict over checksums, per group of ``by`` or over all rows.

    PASS when both sides have the same distinct checksums; strict also wants every
    checksum equally often.
    """
    in_src, in_tgt = F.col("src") > 0, F.col("tgt") > 0
    counts = checksum_counts(source, target, exclude, by, strict).groupBy(*(by or [])).agg(
        F.coalesce(F.sum("src"), F.lit(0)).alias("source_record_count"),
        F.coalesce(F.sum("tgt"), F.lit(0)).alias("target_record_count"),
        F.count_if(in_src).alias("source_distinct"),
        F.count_if(in_tgt).alias("target_distinct"),
        F.count_if(in_src & in_tgt).alias("matched_record_count"),
        F.coalesce(F.sum(F.abs(F.col("src") - F.col("tgt"))), F.lit(0)).alias("unmatched_rows"))
    equal = ((F.col("source_distinct") == F.col("target_distinct"))
             & (F.col("source_distinct") == F.col("matched_record_count")))
    if strict:
        equal = equal & (F.col("unmatched_rows") == 0)
    return counts.withColumn("status", F.when(equal, F.lit("PASS")).otherwise(F.lit("FAIL")))


def sample_candidates(same: DataFrame, key: str = "rel_key", size: str = "size") -> DataFrame:
    """Non-empty objects with a file type, the population of the checksum sample."""
    typed = same.withColumn("file_type", paths.file_type(key))
    return typed.filter(F.col("file_type").isNotNull() & (F.col(size) > 0))


def normal_type_name(file_type: Column) -> Column:
    return F.lower(F.ltrim(file_type, F.lit(".")))


def stratified_sample(candidates: DataFrame, fraction: float = 0.05,
                      fractions: dict[str, float] | None = None, seed: int = 42) -> DataFrame:
    """Random sample per file type; types are named without their dot.

    The share is drawn per row against the type's fraction, so no list of the types that
    occur is needed first.
    """
    share = _share(fraction, fractions)
    return candidates.filter(F.rand(seed) < share)


def hash_sample(candidates: DataFrame, fraction: float = 0.05,
                fractions: dict[str, float] | None = None, key: str = "rel_key") -> DataFrame:
    """Sample decided by a hash of the key: the same rows on every run and layout."""
    bucket = F.conv(F.substring(F.md5(F.col(key)), 1, 7), 16, 10).cast("bigint") % 10000
    return candidates.filter(bucket < _share(fraction, fractions) * 10000)


def _share(fraction: float, fractions: dict[str, float] | None) -> Column:
    share = F.lit(float(fraction))
    for name, value in (fractions or {}).items():
        share = F.when(normal_type_name(F.col("file_type")) == name.lstrip(".").lower(),
                       F.lit(float(value))).otherwise(share)
    return share
