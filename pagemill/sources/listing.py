"""Reading only the objects a micro-batch names."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.ordinals import shard_of

# Keys that are named on the driver at a time. However many keys a micro-batch has, it works
# through slices of about this size, every one in the same way.
SLICE_KEYS = 10_000


def slices(keys: DataFrame, size: int = SLICE_KEYS) -> int:
    """Number of slices for ``keys``, at least one."""
    return max(1, -(-keys.count() // size))


def names_of(keys: DataFrame, slice_no: int, n: int) -> list[str]:
    """The keys of one of ``n`` slices, which are cut by a hash."""
    mine = keys.filter(shard_of(F.col("s3_key"), n) == slice_no)
    return sorted(row["s3_key"] for row in mine.select("s3_key").collect())


def ranged_slices(keys: DataFrame, size: int = SLICE_KEYS) -> DataFrame:
    """``s3_key, slice``: ranges of keys in order, of about ``size`` keys each.

    To be written and read back: the bounds come from a sample. Wherever they are, the slices one after the other
    are the keys in order.
    """
    ranged = keys.select("s3_key").repartitionByRange(slices(keys, size), "s3_key")
    return ranged.withColumn("slice", F.spark_partition_id())


# What patterns or paths take for something else, control characters included.
SPECIAL = r"[\\{}\[\]*?,^:\x00-\x1f]"


def is_listable(name: str) -> bool:
    """Whether a key can be the path of an object below a folder."""
    return bool(name) and not any(part in ("", ".", "..") for part in name.split("/"))


def as_pattern(name: str) -> str:
    """A path pattern that finds ``name``: any character stands for those patterns use.

    It may find similar names as well; callers compare keys afterwards.
    """
    return re.sub(SPECIAL, "?", name)


def has_patterns(names: list[str]) -> bool:
    return any(re.search(SPECIAL, name) for name in names)


def paths_of(root: str, names: list[str]) -> list[str]:
    """Patterns for the paths of ``names`` below ``root``."""
    return [f"{root.rstrip('/')}/{as_pattern(name)}" for name in names]


# Scheme and authority of a URI: ``s3a://bucket``, ``hdfs://host:port``, ``file:``.
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def key_under(root: str, path: Column) -> Column:
    """The part of a file's URI below the absolute folder ``root``, in plain text."""
    folder = re.sub(AUTHORITY, "", root).rstrip("/")
    local = F.regexp_replace(path, AUTHORITY, "")
    # URIs are percent-encoded, and a plus sign in them stands for itself.
    plain = F.url_decode(F.replace(local, F.lit("+"), F.lit("%2B")))
    return F.substr(plain, F.lit(len(folder) + 2))


def file_keys(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame | None:
    """``s3_key`` of all files below ``root``, or of those a pattern finds; None without any.

    Contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.load(root if pattern is None else pattern)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return None
    return files.select(key_under(root, F.col("_metadata.file_path")).alias("s3_key"))


def existing(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    """Those of a bounded list of names that are files below ``root``.

    A name that is a folder is no file, whatever lies below it.
    """
    names = [name for name in names if is_listable(name)]
    if not names:
        return []
    pattern = f"{root.rstrip('/')}/{{{','.join(as_pattern(name) for name in names)}}}"
    found = file_keys(spark, root, pattern)
    if found is None:
        return []
    # No more rows come back than there are names.
    keys = {row["s3_key"] for row in found.filter(F.col("s3_key").isin(names)).distinct().collect()}
    return [name for name in names if name in keys]
