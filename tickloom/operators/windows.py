"""Window functions over ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def forward_fill(rows: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Nulls take the last value before them."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.last(c, True).over(w) for c in columns})


def first_rows(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each group; with one row, also dropping duplicates in order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def sliding(rows: DataFrame, by: Sequence[str], order: Sequence[str], column: str, n: int) -> DataFrame:
    """Sum, mean and sample deviation (0 below two rows) of the last n rows."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(n - 1), 0)
    dev = F.when(F.count(column).over(w) < 2, 0.0).otherwise(F.stddev_samp(column).over(w))
    return rows.withColumns({f"{column}_sum": F.sum(column).over(w), f"{column}_mean": F.avg(column).over(w), f"{column}_std": dev})


def every_nth(rows: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Each group's n-th, 2n-th, ... row."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") % n == 0).drop("_n")


def cumulative_difference(rows: DataFrame, by: Sequence[str], order: Sequence[str], column: str, default: Column) -> Column:
    """Growth of a cumulative value since the row before, never negative; the first row grows from the default."""
    w = Window.partitionBy(*by).orderBy(*order)
    return F.greatest(F.col(column) - F.coalesce(F.lag(column).over(w), default, F.lit(0)), F.lit(0))


def cross_section(rows: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Rank from 0 to 1, and z-score, within each snapshot."""
    w = Window.partitionBy(*by)
    return rows.withColumns({f"{column}_rank": F.percent_rank().over(w.orderBy(column)), f"{column}_z": F.try_divide(F.col(column) - F.avg(column).over(w), F.stddev_samp(column).over(w))})
