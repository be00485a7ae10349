"""The few directory operations Spark's own API lacks, through the session's Hadoop client.

They work on every store the session can read, and touch names only, never data.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    sc = spark.sparkContext
    handle = sc._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(sc._jsc.hadoopConfiguration()), handle


def qualified(spark: SparkSession, path: str) -> str:
    fs, handle = _open(spark, path)
    return fs.makeQualified(handle).toString()


def depth(spark: SparkSession, path: str) -> int:
    """How many names lead from the root of a store to `path`."""
    fs, handle = _open(spark, path)
    return fs.makeQualified(handle).depth()


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def make_directory(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.mkdirs(handle)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a directory of few; none if there is no such directory."""
    fs, handle = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(handle)] if fs.exists(handle) else []


def matching(spark: SparkSession, base: str, pattern: str) -> list[tuple[str, int]]:
    """(path, time of change in milliseconds) of what lies below `base` by a pattern of names.

    `base` is taken as it is, whatever characters it has.
    """
    plain = re.sub(r"([\\{}\[\]*?,^])", r"\\\1", base)
    fs, handle = _open(spark, f"{plain}{pattern}")
    found = fs.globStatus(handle)
    return [(s.getPath().toString(), s.getModificationTime()) for s in found or []]


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a directory tree; false when there was nothing to remove."""
    fs, handle = _open(spark, path)
    return fs.delete(handle, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, handle = _open(spark, source)
    if not fs.rename(handle, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def reads_under(df: DataFrame, path: str) -> bool:
    """Whether any file `df` reads lies at or below `path`.

    The paths that the plan's file relations were opened with mostly tell. Only where `path`
    lies inside one of them, or the plan reads something else, do the names of files count;
    they cross from the JVM as one string.
    """
    spark = df.sparkSession
    target = _parts(qualified(spark, path))
    roots = _roots(df)
    if roots is not None:
        if any(_within(root, target) for root in roots):
            return True
        if not any(_within(target, root) for root in roots):
            return False
    files = (_parts(name) for name in _names(df))
    return any(_within((scheme, host, unquote(file)), target) for scheme, host, file in files)


def _names(df: DataFrame) -> list[str]:
    join = df.sparkSession.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join
    return join("\n", df._jdf.inputFiles()).split("\n")


def _roots(df: DataFrame) -> list[tuple[str, str, str]] | None:
    """Where the plan's file relations begin; None if it reads anything else but memory."""
    leaves, found = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind in ("LocalRelation", "Range", "OneRowRelation"):
            continue
        if kind != "LogicalRelation":
            return None
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            return None
        paths = relation.location().rootPaths()
        found += [_parts(paths.apply(j).toString()) for j in range(paths.size())]
    return found


def _within(inner: tuple[str, str, str], outer: tuple[str, str, str]) -> bool:
    """Whether one address is another or lies below it."""
    below = outer[2].rstrip("/") + "/"
    return inner[:2] == outer[:2] and f"{inner[2].rstrip('/')}/".startswith(below)


def _parts(address: str) -> tuple[str, str, str]:
    """Scheme, host and path of a Hadoop path as text, in which nothing is escaped."""
    scheme, host, path = re.fullmatch("(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)", address).groups()
    return scheme or "", host or "", path
