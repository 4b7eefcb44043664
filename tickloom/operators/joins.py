"""Joins that Spark has no single operator for, as plans of built-in ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, take: Sequence[str], tie: str | None = None) -> DataFrame:
    """Each row of left with the columns `take` of the latest row of right that is not later, null if there is none.

    Both sides are put into one table and the last right row is carried forward, so it costs one shuffle by `by` and a
    sort, however many rows match. Rows of right with equal time are ordered by `tie`.
    """
    order, mine = "_time", "_left"
    a = left.withColumns({order: F.col(left_on), mine: F.lit(True), "_tie": F.lit(None).cast("long"), "_taken": F.lit(None).cast("struct<" + ",".join(f"`{c}`:{right.schema[c].dataType.simpleString()}" for c in take) + ">")})
    b = right.select(*by, F.col(right_on).alias(order), F.lit(False).alias(mine), (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("_tie"), F.struct(*take).alias("_taken"))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(order, mine, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last("_taken", True).over(w)).filter(mine)
    return found.select(*left.columns, *[F.col(f"_found.{c}").alias(c) for c in take])


def keyed_update(base: DataFrame, over: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """base with the non-null values of over in their place."""
    new = over.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(new, list(keys), "left")
    return joined.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def with_presence(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Full join: keys, both sides' columns with a suffix, and where each key is: left_only, right_only or both."""
    left = a.select(*keys, *[F.col(c).alias(f"{c}_{names[0]}") for c in columns], F.lit(True).alias("_in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"{c}_{names[1]}") for c in columns], F.lit(True).alias("_in_b"))
    where = F.when(F.col("_in_b").isNull(), "left_only").when(F.col("_in_a").isNull(), "right_only").otherwise("both")
    return left.join(right, list(keys), "full").withColumn("presence", where).drop("_in_a", "_in_b")


def anchor_rows(rows: DataFrame, groups: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The last row of each of the wanted groups."""
    w = Window.partitionBy(*keys).orderBy(order.desc())
    return rows.join(groups.select(*keys).distinct(), list(keys), "left_semi").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def interval_join(rows: DataFrame, intervals: DataFrame, at: str, start: str, end: str, width: int, by: Sequence[str] = ()) -> DataFrame:
    """Each row with each interval (start, end] that it is in, as an equi-join on time buckets of a width, and `by`. Intervals
    are repeated for the buckets that they touch, rows are not; a width of about an interval's length makes that two or three.
    Nulls match nothing. Both sides must differ in their column names but for `by`."""
    bucket = lambda c: F.floor(c / width).cast("long")
    spread = intervals.withColumn("_bucket", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col(end)))))
    found = rows.withColumn("_bucket", bucket(F.col(at))).join(spread, [*by, "_bucket"])
    return found.filter((F.col(at) > F.col(start)) & (F.col(at) <= F.col(end))).drop("_bucket")
