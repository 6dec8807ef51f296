"""Column functions over object paths and keys.

Buckets, prefixes and roots are always taken literally, never as patterns.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeproof.spec import DEFAULT, PartitionSpec


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_root(path: Column, root: Column) -> Column:
    """``path`` without a leading ``root``; unchanged when it does not start with it."""
    rest = path.substr(F.length(root) + F.lit(1), F.length(path))
    return F.when(F.startswith(path, root), rest).otherwise(path)


def object_key(path: Column | str, bucket: Column | str, scheme: str = "s3://") -> Column:
    return strip_root(_as_column(path), F.concat(F.lit(scheme), _as_column(bucket), F.lit("/")))


def file_name(path: Column | str) -> Column:
    return F.substring_index(_as_column(path), "/", -1)


def extension(name: Column | str) -> Column:
    """Text after the last dot of a file name; null without a dot."""
    name = _as_column(name)
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1))


def file_type(key: Column | str) -> Column:
    """Suffix with its dot; empty when only a folder or a leading dot has one; null without any."""
    key = _as_column(key)
    suffix = F.regexp_extract(file_name(key), r"^\.*[^.].*?(\.[^.]*)$", 1)
    return F.when(F.contains(key, F.lit(".")), suffix)


def partition_key(key: Column | str) -> Column:
    """All ``name=`` tokens of the lower-cased key, joined by comma and blank."""
    # The look-behind only saves work: a match cannot start inside a word.
    names = F.regexp_extract_all(F.lower(_as_column(key)), F.lit("(?<![a-z0-9_])([a-z0-9_]++)="))
    return F.when(F.size(names) > 0, F.array_join(names, ", "))


def partition_value(key: Column | str, name: str, lower: bool = False) -> Column:
    """Value of ``name=value`` in the key, name in any case; null when absent."""
    key = _as_column(key)
    if lower:
        key = F.lower(key)
    return F.nullif(F.regexp_extract(key, rf"(?i)(?:^|/)\Q{name}\E=([^/]+)", 1), F.lit(""))


def partition_date(key: Column | str, name: str) -> Column:
    return lenient_date(partition_value(key, name))


def lenient_date(value: Column | str) -> Column:
    """A date, or null where the text is none."""
    return _as_column(value).try_cast("date")


def parent(key: Column | str) -> Column:
    """Everything before the last slash; the key itself without a slash."""
    key = _as_column(key)
    above = F.length(key) - F.length(file_name(key)) - F.lit(1)
    return F.when(F.contains(key, F.lit("/")), key.substr(F.lit(1), above)).otherwise(key)


def partition_path(bucket: Column | str, key: Column | str, scheme: str = "s3://") -> Column:
    return F.concat(F.lit(scheme), _as_column(bucket), F.lit("/"), parent(key))


def dataset_name(prefix: Column | str) -> Column:
    """Last segment of a prefix, one trailing slash allowed."""
    return file_name(F.regexp_replace(_as_column(prefix), "/$", ""))


def partition_structure(path: Column | str) -> Column:
    """Sorted names of the ``name=value`` segments, joined by a slash."""
    names = F.regexp_extract_all(_as_column(path), F.lit("([^/]+)=[^/]+"))
    return F.array_join(F.array_sort(names), "/")


def percent_decode(key: Column | str) -> Column:
    """Percent-decoding that keeps ``+`` and any ``%`` that starts no escape."""
    safe = F.replace(_as_column(key), F.lit("+"), F.lit("%2B"))
    safe = F.regexp_replace(safe, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(safe)


def megabytes(total: Column) -> Column:
    """Bytes as MB with two decimals; 0 when there is nothing to count."""
    value = total.cast("double") / F.lit(1048576.0)
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.round(F.when(usable, value).otherwise(F.lit(0.0)), 2)


def short_text(text: Column | str, size: int = 1000) -> Column:
    return F.substring(_as_column(text), 1, size)


def is_folder_marker(key: Column | str) -> Column:
    return F.endswith(_as_column(key), F.lit("/"))


def node_type(key: Column | str) -> Column:
    return F.when(is_folder_marker(key), F.lit("dir")).otherwise(F.lit("file"))


def has_prefix(key: Column | str, prefix: Column | str) -> Column:
    return F.startswith(_as_column(key), prefix if isinstance(prefix, Column) else F.lit(prefix))


def swap_root(path: Column | str, old: str | Column, new: str | Column) -> Column:
    """The same path under another root (first occurrence at the start only)."""
    path = _as_column(path)
    old = old if isinstance(old, Column) else F.lit(old)
    new = new if isinstance(new, Column) else F.lit(new)
    return F.when(F.startswith(path, old), F.concat(new, strip_root(path, old))).otherwise(path)


def report_parent(path: Column | str) -> Column:
    """Folder two levels above the end of ``parent/run/`` (the report's family)."""
    return F.regexp_extract(_as_column(path), "^(.*)/(.*)/", 1)


def report_run(path: Column | str) -> Column:
    return F.regexp_extract(_as_column(path), "^(.*)/(.*)/", 2)


def manifest_root(location: Column | str, bucket: Column | str, name: Column | str) -> Column:
    return F.concat_ws("/", _as_column(location), _as_column(bucket), _as_column(name))


def object_url(bucket: Column | str, prefix: Column | str, key: Column | str,
               scheme: str = "s3://") -> Column:
    return F.concat(F.lit(scheme), _as_column(bucket), F.lit("/"), _as_column(prefix),
                    _as_column(key))


def hive_layout(path: Column | str, spec: PartitionSpec = DEFAULT) -> Column:
    """Both partition folders in order, and the date folder only once."""
    path = _as_column(path)
    run, date = rf"\Q{spec.run}\E", rf"\Q{spec.date}\E"
    ordered = F.rlike(path, F.lit(f"/{run}=[^/]+/{date}=[^/]+/"))
    repeated = F.rlike(path, F.lit(f"/{date}=[^/]+/(?:.*/)?{date}="))
    return ordered & ~repeated


def current_version(is_latest: Column | str) -> Column:
    """True for the latest version of an object; unversioned reports leave it blank."""
    flag = F.lower(_as_column(is_latest).cast("string"))
    return flag.isNull() | flag.isin("", "true")
