"""Stored panels that grow month by month, stored partitionings, and checked external files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PanelSpec

CORRUPT = "_corrupt_record"


def append_period(df: DataFrame, path: str, period: str) -> None:
    """Write the periods of ``df`` into a table partitioned by period, replacing those periods only.

    Dynamic partition overwrite: writing the same month again changes nothing, and a repeated job after
    a failure leaves no row twice.  Other periods are not read.
    """
    writer = df.hint("rebalance", period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(period).parquet(path)


def read_history(spark: SparkSession, path: str, entity: str, period: str, last: int, periods: int) -> DataFrame:
    """The last ``periods`` stored periods up to ``last``; partition pruning skips the other folders."""
    stored = spark.read.parquet(path)
    known = [r[0] for r in stored.where(F.col(period) <= last).select(period).distinct().orderBy(F.col(period).desc()).limit(periods).collect()]
    return stored.where(F.col(period).isin(known))


def new_month_lags(spark: SparkSession, path: str, spec: PanelSpec, columns: list[str], month: int, steps: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Lags and deltas of one stored month from the carried state: each entity's last rows before it.

    The state is a table of an entity's last ``max(steps)`` rows (:func:`carried_rows`), stored under
    ``path``/state of the month before; the history itself is not read.
    """
    now = spark.read.parquet(f"{path}/panel").where(F.col(spec.period) == month)
    state = spark.read.parquet(f"{path}/state")
    wide = now.join(state.select(spec.id, F.col("rows").alias("_rows")), spec.id, "left")
    lag = lambda c, k: F.try_element_at(F.col("_rows"), F.lit(-k))[c]
    lags = [lag(c, k).alias(f"{c}_lag{k}") for c in columns for k in steps]
    deltas = [(F.col(c) - lag(c, k)).alias(f"{c}_d{k}") for c in columns for k in steps]
    return wide.select(*now.columns, *lags, *deltas)


def carried_rows(df: DataFrame, spec: PanelSpec, columns: list[str], keep: int = 2) -> DataFrame:
    """The state: ``id, rows``, an entity's last ``keep`` rows as structs, oldest first.

    A partial aggregate per entity; a panel has one row per entity and period, so it is bounded by the
    number of periods.
    """
    row = F.struct(spec.period, *columns)
    rows = df.groupBy(spec.id).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return rows.select(spec.id, F.slice("rows", -F.least(F.lit(keep), F.size("rows")), keep).alias("rows"))


def rolled_rows(state: DataFrame, month: DataFrame, spec: PanelSpec, columns: list[str], keep: int = 2) -> DataFrame:
    """The state after a further month, from the state before and the month's rows alone."""
    new = month.select(spec.id, F.array(F.struct(spec.period, *columns)).alias("_new"))
    both = state.join(new, spec.id, "full").select(spec.id, F.concat(F.coalesce("rows", F.array().cast(new.schema["_new"].dataType)), F.coalesce("_new", F.array().cast(new.schema["_new"].dataType))).alias("rows"))
    return both.select(spec.id, F.slice("rows", -F.least(F.lit(keep), F.size("rows")), keep).alias("rows"))


def write_bucketed(df: DataFrame, table: str, entity: str, order: str, buckets: int = 32) -> DataFrame:
    """A table stored in buckets of the entity, sorted by ``order`` inside; joins and windows by entity
    over such tables need no exchange.  One task writes at most one file per bucket."""
    spark = df.sparkSession
    df.repartition(buckets, entity).write.mode("overwrite").bucketBy(buckets, entity).sortBy(entity, order).format("parquet").saveAsTable(table)
    return spark.table(table)


def use_stored_partitioning(spark: SparkSession) -> None:
    """Let a join by entity and period use buckets of the entity alone (a session setting; it changes
    plans, not results)."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and malformed lines (``line``), of CSV files with a header, plain or gzip.

    The schema is given, so nothing is inferred; a line that does not fit it is kept as text.
    """
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*typed.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path)
    # all columns are parsed, or a line with too few would count as good; the reader refuses a projection of nothing but this column, so a parsed one is named beside it
    line = F.when(F.col(CORRUPT).isNotNull() | F.col(f"`{typed.names[0]}`").isNotNull(), F.col(CORRUPT))
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.select(line.alias("line")).where("line IS NOT NULL")


def write_csv_gzip(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
