"""Output types shared by the queries and the SQL they are checked against.

Whole numbers are 64-bit, fractions are doubles rounded to a number of decimals that floating
point summation order cannot reach.  Both sides round by the same arithmetic, because the
``round`` functions of two engines differ in their last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DEFAULT_DIGITS = 6
#: values in which large terms cancel
COARSE = {
    "spend_slope": 2, "spend_intercept": 2, "spend_std3": 3, "spend_cv3": 5,
    "activity_slope4": 5, "activity_std3": 5, "activity_cv3": 5,
}
#: values whose exact result often ends in a 5 at the rounding position: moved off it
NUDGED = {"spend_slope": 0.00137, "spend_intercept": 0.00137}


def digits(column: str) -> int:
    return COARSE.get(column, DEFAULT_DIGITS)


def rounded_sql(column: str) -> str:
    """SQL text that rounds half up; valid in both engines."""
    name = column.strip('`"')
    scale = f"CAST(1e{digits(name)} AS DOUBLE)"
    half = f"CAST({0.5 + NUDGED.get(name, 0.0) * 10 ** digits(name)!r} AS DOUBLE)"
    return f"floor(CAST({column} AS DOUBLE) * {scale} + {half}) / {scale}"


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        value = name
        if isinstance(f.dataType, T.IntegralType):
            value = f"CAST({name} AS BIGINT)"
        elif isinstance(f.dataType, T.NumericType):
            value = rounded_sql(name)
        columns.append(f"{value} AS {name}")
    return df.selectExpr(*columns)


def comparable_sql(source: str, longs: str = "", doubles: str = "", others: str = "") -> str:
    """The final projection of a SQL text; arguments are blank-separated column names."""
    parts = [f"CAST({c} AS BIGINT) AS {c}" for c in longs.split()]
    parts += [f"{rounded_sql(c)} AS {c}" for c in doubles.split()]
    parts += others.split()
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {source}"
