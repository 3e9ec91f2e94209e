"""Versioned tables: a replace that cannot lose the table.

A new version is written beside the old one and becomes current by one empty file, named after it,
in the table's commit folder; creating that file is the whole switch. Readers resolve the newest
commit, so a write that fails half-way leaves the earlier version readable, and a reader that holds
a version keeps its files until ``remove_old`` is called. Works through Hadoop's file systems, so on
any store that Spark writes to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"  # names that start with an underscore are no data for Spark


def _fs(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path), _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed versions, oldest first; of two writers of one number the larger name counts as newer."""
    return [name.split(".", 1)[1] for name in _names(spark, f"{path}/{COMMITS}") if "." in name and not name.endswith(".crc")]


def current(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no version of a table at {path}")
    return f"{path}/{found[-1]}"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))


def replace_version(df: DataFrame, path: str) -> str:
    """Write ``df`` as the new current version; its folder. ``df`` may read the table itself."""
    spark = df.sparkSession
    found = versions(spark, path)
    number = int(found[-1].split("-")[1]) + 1 if found else 1
    name = f"data-{number:012d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    if not _fs(spark, path).createNewFile(_path(spark, path, COMMITS, f"{number:012d}.{name}")):
        raise FileExistsError(f"version {name} of {path} is committed already")
    return f"{path}/{name}"


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` committed versions and what failed writes left behind
    (folders no newer than the current version without a commit). The names removed."""
    if keep < 1:
        raise ValueError("the current version stays")
    fs, found = _fs(spark, path), versions(spark, path)
    if not found:
        return []
    kept = set(found[-keep:])
    gone = [n for n in _names(spark, path) if n.startswith("data-") and n not in kept and n.split("-")[1] <= found[-1].split("-")[1]]
    for name in gone:  # the commit first: a reader never resolves a version that is going
        commit = _path(spark, path, COMMITS, f"{name.split('-')[1]}.{name}")
        if fs.exists(commit):
            fs.delete(commit, False)
        fs.delete(_path(spark, path, name), True)
    return gone
