"""Window definitions over one entity's history."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


class History:
    """Windows over the rows of one entity in period order.

    All of them share partitioning and ordering, so that Catalyst evaluates any number
    of lags, rolling and running aggregates behind a single exchange and a single sort.
    """

    def __init__(self, id_col: str, period_col: str):
        self.rows: WindowSpec = Window.partitionBy(id_col).orderBy(period_col)
        self.so_far: WindowSpec = self.rows.rowsBetween(Window.unboundedPreceding, 0)

    def last(self, n: int) -> WindowSpec:
        """The current row and the ``n - 1`` rows before it."""
        return self.rows.rowsBetween(-(n - 1), 0)

    def lag(self, column: Column | str, k: int = 1) -> Column:
        return F.lag(column, k).over(self.rows)

    def delta(self, column: str, k: int = 1) -> Column:
        return F.col(column) - self.lag(column, k)

    def index(self) -> Column:
        return F.row_number().over(self.rows)
