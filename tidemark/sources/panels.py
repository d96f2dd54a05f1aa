"""Panel readers, writers and the monthly append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.selection import require_columns
from ..spec import PanelSpec


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header, plain or compressed.  A schema saves the pass that infers types."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_panel(
    spark: SparkSession,
    path: str,
    spec: PanelSpec | None = None,
    schema: T.StructType | str | None = None,
    other_as_csv: bool = False,
) -> DataFrame:
    """Reader by suffix; an unknown suffix is an error unless it is to be read as CSV."""
    lower = path.rstrip("/").lower()
    if lower.endswith(".parquet"):
        df = read_parquet(spark, path)
    elif lower.endswith((".csv", ".csv.gz")) or other_as_csv:
        df = read_csv(spark, path, schema)
    else:
        raise ValueError(f"unsupported file format: {path}")
    return require_columns(df, spec.key) if spec else df


def write_parquet(
    df: DataFrame, path: str, period: str | None = None, mode: str = "overwrite"
) -> None:
    """Write a panel; with ``period`` one folder per period, which later filters prune.

    The rebalance hint brings a period's rows together in files of the advisory size; the
    adaptive planner splits a period that is larger than that over several tasks.
    """
    if period:
        df.hint("rebalance", period).write.mode(mode).partitionBy(period).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def standard_names(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rename the key to ``entity_id`` and ``period`` (an integer)."""
    renamed = df.withColumnsRenamed({spec.id: "entity_id", spec.period: "period"})
    return renamed.withColumn("period", F.col("period").cast("int"))


def original_names(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumnsRenamed({"entity_id": spec.id, "period": spec.period})


def append_snapshot(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """History plus a new period; names and types of the columns must be equal.

    A union by name loses no row, so nothing is counted; :func:`written_rows` says what a written
    table holds.
    """
    if dict(history.dtypes) != dict(snapshot.dtypes):
        different = sorted(set(history.dtypes) ^ set(snapshot.dtypes))
        raise ValueError(f"columns differ: {different}")
    return history.unionByName(snapshot)


def written_rows(spark: SparkSession, path: str) -> int:
    """Rows of a written Parquet table; reads the footers only."""
    return spark.read.parquet(path).count()


def same_shape(a: DataFrame, b: DataFrame) -> bool:
    """Equal row counts and column sets: the check after writing and reading back."""
    return set(a.columns) == set(b.columns) and a.count() == b.count()


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL."""
    df.createOrReplaceTempView(name)
    return df


def write_predictions(
    scored: DataFrame, spec: PanelSpec, path: str, flag: str = "contact", columns: Sequence[str] = ()
) -> None:
    """The two files of a scoring run: detail (partitioned by period) and the contact list."""
    from ..operators.scoring import simple_export

    detail = scored.select(*columns) if columns else scored
    write_parquet(detail, f"{path}/detail", spec.period)
    write_csv(simple_export(scored, spec, flag), f"{path}/contacts")
