"""Comparison of two datasets with tolerance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import close_to, level
from .joins import with_presence


def differences(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: Mapping[str, float], rtol: float = 1e-9) -> DataFrame:
    """Both sides of each key, its presence, and per column whether the values match and by how much they differ."""
    joined = with_presence(a, b, keys, list(tolerance))
    both = F.col("presence") == "both"
    marks: dict[str, Column] = {}
    for c, atol in tolerance.items():
        x, y = F.col(f"{c}_a").cast("double"), F.col(f"{c}_b").cast("double")
        marks[f"{c}_match"] = both & close_to(x, y, rtol, atol)
        marks[f"{c}_diff"] = F.abs(x - y)
    return joined.withColumns(marks)


def summary(diff: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: keys on each side, and per column mismatches, largest difference and share of matches."""
    both = F.col("presence") == "both"
    out = [F.count_if(F.col("presence") == p).alias(p) for p in ("both", "left_only", "right_only")]
    for c in columns:
        good = F.coalesce(F.col(f"{c}_match"), F.lit(False))
        out += [F.count_if(both & ~good).alias(f"{c}_mismatches"), F.max(f"{c}_diff").alias(f"{c}_max_diff"), F.try_divide(F.count_if(both & good), F.count_if(both)).alias(f"{c}_rate")]
    return diff.agg(*out)


def worst(diff: DataFrame, keys: Sequence[str], columns: Sequence[str], n: int) -> DataFrame:
    """The n keys with the largest difference in any column."""
    most = F.greatest(*[F.col(f"{c}_diff") for c in columns]) if len(columns) > 1 else F.col(f"{columns[0]}_diff")
    return diff.withColumn("worst", most).filter("worst is not null").orderBy(F.desc("worst"), *keys).limit(n)


def key_coverage(a: DataFrame, b: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per group, how many distinct keys both sides, only a, and only b have, and the share of a's that b has."""
    joined = with_presence(a.select(*by, *keys).distinct(), b.select(*by, *keys).distinct(), [*by, *keys], [])
    out = joined.groupBy(*by).agg(*[F.count_if(F.col("presence") == p).alias(k) for k, p in (("common", "both"), ("only_a", "left_only"), ("only_b", "right_only"))])
    return out.withColumn("coverage", F.try_divide(F.col("common"), F.col("common") + F.col("only_a")))


def report(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: Mapping[str, float], n: int = 200) -> dict[str, DataFrame]:
    """The set of a comparison's tables: all differences, the summary, and the worst mismatches."""
    diff = differences(a, b, keys, tolerance)
    return {"diff": diff, "summary": summary(diff, list(tolerance)), "worst": worst(diff, keys, list(tolerance), n)}


def book_fields(rows: DataFrame, sides: Mapping[str, tuple[str, str]], levels: int = 5) -> DataFrame:
    """Adds columns {side}{i}_p and {side}{i}_v for the first levels of a book; sides names the arrays of prices and volumes.
    A level that is missing is 0, as books are padded."""
    return rows.withColumns({f"{side}{i}_{k}": level(F.col(c), i) for side, arrays in sides.items() for k, c in zip("pv", arrays, strict=True) for i in range(1, levels + 1)})


def field_matches(a: DataFrame, b: DataFrame, keys: Sequence[str], below: Mapping[str, float]) -> DataFrame:
    """One row per field: rows that both sides have, how many of them differ by less than the field's bound, the share, and
    the largest difference. A missing value matches nothing. One join and one aggregate, whatever the number of fields."""
    pair = a.select(*keys, *below).alias("a").join(b.select(*keys, *below).alias("b"), list(keys))
    gap = {c: F.abs(F.col(f"a.{c}").cast("double") - F.col(f"b.{c}").cast("double")) for c in below}
    one = pair.agg(F.count("*").alias("total"), *[F.count_if(gap[c] < t).alias(f"{c}_n") for c, t in below.items()], *[F.max(gap[c]).alias(f"{c}_d") for c in below])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{c}_n").alias("matches"), F.col(f"{c}_d").alias("max_diff")) for c in below]))
    return one.select("total", rows.alias("x")).select("x.field", "total", "x.matches", "x.max_diff", F.try_divide("x.matches", "total").alias("rate"))
