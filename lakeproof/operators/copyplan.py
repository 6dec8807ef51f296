"""Copy units of a folder tree and checks on a list of copy pairs."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions import paths
from lakeproof.operators.lookup import SALT, lookup

# Levels below the root at which a tree is cut, by copy depth.
LEVELS = {2: 2, 3: 4}
SHOWN = 5  # offending folders named in an error


def copy_units(objects: DataFrame, source_root: str, dest_root: str, depth: int = 2,
               path: str = "path", size: str = "size") -> DataFrame:
    """Folders and files to hand to a copier, cut at a fixed depth below the root.

    Depth 2 gives the children of first-level folders and the first-level files; depth 3
    opens each of those folders by two more levels.  A folder marker above the cut is a
    unit only when nothing lies below it.
    """
    cut = LEVELS[depth]
    rel = paths.strip_root(F.col(path), F.lit(source_root))
    inside = objects.filter(F.startswith(path, F.lit(source_root))).select(
        rel.alias("rel"), F.col(size).alias("size"))
    marker = F.endswith("rel", F.lit("/")) | (F.col("rel") == "")
    parts = F.split(F.regexp_replace("rel", "/$", ""), "/")
    levels = F.when(F.col("rel") == "", F.lit(0)).otherwise(F.size(parts))
    head = F.array_join(F.slice(parts, 1, cut), "/")
    deep = levels > cut
    unit = F.when(deep, F.concat(head, F.lit("/"))).otherwise(F.col("rel"))
    kind = F.when(deep | marker, F.lit("dir")).otherwise(F.lit("file"))
    units = inside.groupBy(unit.alias("unit"), kind.alias("type"),
                           F.least(levels, F.lit(cut)).alias("levels")).agg(
        F.sum("size").alias("size"), F.count_if(~marker).alias("files"))
    # Folders that hold some unit: the marker of such a folder is not empty.
    level = F.explode(F.sequence(F.lit(0), F.col("levels") - F.lit(1)))
    above = (units.filter(F.col("levels") > 0).select("unit", level.alias("keep"))
             .select(_folder("unit", F.col("keep")).alias("unit")).distinct()
             .withColumn("type", F.lit("dir")))
    upper = units.filter((F.col("type") == "dir") & (F.col("levels") < cut))
    rest = units.filter(~((F.col("type") == "dir") & (F.col("levels") < cut)))
    kept = upper.join(above, ["unit", "type"], "left_anti").select(*rest.columns).unionByName(rest)
    return kept.select(
        F.concat(F.lit(source_root), F.col("unit")).alias("path"),
        F.concat(F.lit(dest_root), F.col("unit")).alias("dest_path"), "type",
        F.col("size").cast("bigint").alias("size"), "files")


def _folder(unit: str, keep: Column) -> Column:
    """The first ``keep`` segments of a path as a folder; the root is the empty text."""
    head = F.array_join(F.slice(F.split(unit, "/"), F.lit(1), keep), "/")
    return F.when(keep == 0, F.lit("")).otherwise(F.concat(head, F.lit("/")))


def duplicate_folders(pairs: DataFrame, columns: tuple[str, str] = ("src", "dst")) -> DataFrame:
    """Folders named more than once, on each side."""
    both = _sides(pairs, columns)
    return (both.groupBy("side", "folder").agg(F.count(F.lit(1)).alias("times"))
            .filter(F.col("times") > 1))


def _sides(pairs: DataFrame, columns: tuple[str, str]) -> DataFrame:
    """Both sides as rows, without trailing or doubled slashes (scheme kept)."""
    def side(c: str) -> DataFrame:
        clean = F.regexp_replace(F.regexp_replace(c, "(?<!:)/{2,}", "/"), "(?<=[^/:])/+$", "")
        return pairs.select(F.lit(c).alias("side"), clean.alias("folder"))
    return side(columns[0]).unionByName(side(columns[1]))


def check_pairs(pairs: DataFrame, columns: tuple[str, str] = ("src", "dst")) -> None:
    """Raises when a folder is listed twice or lies inside another listed one."""
    for what, found in (("duplicate", duplicate_folders(pairs, columns)),
                        ("nested", nested_folders(pairs, columns))):
        shown = [tuple(r) for r in found.limit(SHOWN).collect()]
        if shown:
            raise ValueError(f"{what} folders in the copy list, for example {shown}")


def nested_folders(pairs: DataFrame, columns: tuple[str, str] = ("src", "dst"),
                   salt: int = SALT) -> DataFrame:
    """(side, child, parent) where one listed folder lies below another listed one.

    Each folder is matched with its own ancestors by equality, so the work grows with
    folders times depth and never with folders squared.
    """
    folders = _sides(pairs, columns).distinct()
    parts = F.split("folder", "/")
    upto = F.explode(F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)))
    climbed = folders.select("side", F.col("folder").alias("child"), upto.alias("keep")).select(
        "side", "child", F.array_join(F.slice(F.split("child", "/"), F.lit(1), F.col("keep")), "/")
        .alias("parent"))
    # Only folders that are someone's ancestor can match; that set is counted first.
    ancestors = climbed.groupBy("side", "parent").agg(F.count(F.lit(1)).alias("n"))
    parents = (folders.withColumnRenamed("folder", "parent")
               .join(ancestors.select("side", "parent"), ["side", "parent"], "left_semi"))
    return lookup(climbed, parents, ["side", "parent"], "inner", salt).select("side", "child", "parent")
