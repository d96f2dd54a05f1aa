"""Staged tables for jobs that read an intermediate result more than once."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: tables by the scope they were staged in, the innermost last; the first lives with the process
_scopes: list[list[str]] = [[]]


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: the session's checkpoint directory.

    ``spark.checkpoint.dir`` or an earlier ``setCheckpointDir`` decides.  Only on one machine,
    as in tests, a temporary folder is made and registered where neither is set; on a
    cluster executors would not see each other's files there, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: {master} needs a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def _write(df: DataFrame) -> tuple[str, DataFrame]:
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the staging folder and return the table that reads it.

    Multi-pass operators read their narrow input from here: it is computed once, survives
    the loss of executors, is scanned column by column, and every pass sees the same rows.
    The table lives as long as the innermost :func:`staging_scope` around the call; outside of
    any, until :func:`drop_staged`.
    """
    path, table = _write(df)
    _scopes[-1].append(path)
    return table


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """A staged table for the length of a block, for results that are fetched inside it."""
    path, table = _write(df)
    try:
        yield table
    finally:
        _delete(df.sparkSession, path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`stage` writes inside the block are deleted at its end.

    For callers that consume their results inside the block; other callers' tables are not touched.
    """
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield
    finally:
        _scopes.remove(mine)
        for path in mine:
            _delete(spark, path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged outside of every scope; returns their number.

    For the end of a process, or where all results have been consumed.
    """
    count = 0
    while _scopes[0]:
        count += _delete(spark, _scopes[0].pop())
    return count
