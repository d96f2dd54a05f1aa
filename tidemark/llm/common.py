"""Helpers shared by the operators of this subpackage.

Every operator reads a few named columns of its input and works under private names, so extra
columns, also those whose names clash with a result's, never reach it.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import stage, staging_dir

# A word is a run of anything but these six white-space characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: a side with a counted number of narrow rows (a few numbers each) up to this one is broadcast
BROADCAST_ROWS = 1_000_000

__all__ = ["BROADCAST_ROWS", "SPACE", "WORD", "documents", "join_counted", "join_null_safe", "lower_ascii", "ship_by_value", "stage", "staging_dir", "word_count"]


def ship_by_value(module: str) -> None:
    """Functions of the module travel inside the tasks that run them, so executors need not have
    this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_of(column: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and the named columns, nothing else."""
    return docs.select("doc_id", text_of().alias("text"), *more)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is (``lower`` does just that to ASCII texts, faster)."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def join_counted(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with a staged, narrow right side: broadcast if its counted rows stay under
    :data:`BROADCAST_ROWS`, else both sides are shuffled and skew is left to adaptive execution."""
    count = right.count() if rows is None else rows
    return left.join(F.broadcast(right) if count <= BROADCAST_ROWS else right.hint("merge"), on, how)


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null equals null; the right side brings its other columns."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])
