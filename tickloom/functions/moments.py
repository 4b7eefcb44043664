"""Mergeable power sums and the statistics that they give.

A set of moments is columns n, s1..s4 of a name; sums of them over any partition of the rows are the moments of all rows,
so partial aggregation, merging of increments and running sums over time are all plain sums. Nulls are not counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: below this share of the squared mean a variance counts as none.
GUARD = 0.0009765625
POWERS = ("n", "s1", "s2", "s3", "s4")


def power_sums(x: Column, name: str, where: Column | None = None) -> list[Column]:
    """Aggregates n and s1..s4 of the rows in `where`."""
    x = x.cast("double") if where is None else F.when(where, x.cast("double"))
    return [F.count(x).alias(f"{name}_n"), *(F.coalesce(F.sum(p), F.lit(0.0)).alias(f"{name}_s{k}") for k, p in enumerate((x, x * x, x * x * x, x * x * x * x), 1))]


def merged(name: str) -> list[Column]:
    """Aggregates that merge rows of moments."""
    return [F.sum(f"{name}_{p}").alias(f"{name}_{p}") for p in POWERS]


# As SQL text: hundreds of factors are made of these, and text costs the driver one call where a tree costs dozens.


def mean(name: str) -> Column:
    """s1 / n, null without rows."""
    return F.expr(f"{name}_s1 / nullif({name}_n, 0)")


def std(name: str) -> Column:
    """Sample standard deviation, null below two rows."""
    n, s1, s2 = (f"{name}_{p}" for p in POWERS[:3])
    return F.expr(f"if({n} >= 2, sqrt(greatest(({s2} - {s1} * {s1} / nullif({n}, 0)) / nullif({n} - 1, 0), 0D)), null)")


def _central(name: str) -> tuple[str, str, str, str, str]:
    n, s1, s2, s3, s4 = (f"{name}_{p}" for p in POWERS)
    n = f"nullif(double({n}), 0D)"
    mu = f"({s1} / {n})"
    m2 = f"({s2} / {n} - {mu} * {mu})"
    m3 = f"({s3} / {n} - 3 * {mu} * {s2} / {n} + 2 * {mu} * {mu} * {mu})"
    m4 = f"({s4} / {n} - 4 * {mu} * {s3} / {n} + 6 * {mu} * {mu} * {s2} / {n} - 3 * {mu} * {mu} * {mu} * {mu})"
    return n, mu, m2, m3, m4


def skew(name: str) -> Column:
    """Population skewness, null below three rows or without variance."""
    n, mu, m2, m3, _ = _central(name)
    return F.expr(f"if({n} >= 3 and {m2} > {GUARD}D * {mu} * {mu}, {m3} / nullif(pow({m2}, 1.5D), 0D), null)")


def kurt(name: str) -> Column:
    """Excess kurtosis of the population, null below four rows or without variance."""
    n, mu, m2, _, m4 = _central(name)
    return F.expr(f"if({n} >= 4 and {m2} > {GUARD}D * {mu} * {mu}, {m4} / nullif({m2} * {m2}, 0D) - 3, null)")


def stats(name: str) -> list[Column]:
    """mean, std, skew and kurt of a name."""
    return [f(name).alias(f"{name}_{k}") for k, f in (("mean", mean), ("std", std), ("skew", skew), ("kurt", kurt))]


def bucketed(vol: Column, money: Column, fields: Mapping[str, Column], buckets: Mapping[str, Column | None]) -> list[Column]:
    """One wide set of aggregates: for each bucket its count, sums of volume and money, and moments of each field."""
    out: list[Column] = []
    for bucket, where in buckets.items():
        tail = f"_{bucket}" if bucket else ""
        pick = (lambda c, w=where: c if w is None else F.when(w, c))
        out.append((F.count(F.lit(1)) if where is None else F.count_if(where)).alias(f"count{tail}"))
        out += [F.sum(pick(vol)).alias(f"vol{tail}"), F.sum(pick(money)).alias(f"money{tail}")]
        for name, x in fields.items():
            out += power_sums(x, f"{name}{tail}", where)
    return out


def vwapx(tail: str = "") -> Column:
    """Mean price of a bucket, null if its volume is not positive."""
    v = F.col(f"vol{tail}")
    return F.when(v > 0, F.col(f"money{tail}") / F.when(v > 0, v))


def ratio_of_means(money: str) -> Column:
    """Mean amount over mean volume, each over the rows that have one; null if the volume is not positive."""
    return F.expr(f"if(vol > 0, ({money}_s1 / nullif({money}_n, 0)) / (vol / nullif(vol_n, 0)), null)")
