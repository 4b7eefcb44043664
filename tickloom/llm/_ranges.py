"""Ranges of a key with about equal weight, for shards that must follow the key's order."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE, MOST, GRAIN = 2048, 1 << 22, 1 << 16


@dataclass(frozen=True)
class Ranges:
    """Shard k holds the keys in (points[k - 1], points[k]]. A key that is a point more than once has the empty ranges
    between these points to itself: they are shards of equal rank, among which a salt chooses."""

    points: np.ndarray
    rank: np.ndarray

    @staticmethod
    def of(points: np.ndarray) -> Ranges:
        """Ranges between some points, ascending, with repeats."""
        rank = np.arange(len(points) + 1)
        for k in range(1, len(points)):
            if points[k] == points[k - 1]:
                rank[k] = rank[k - 1] if k > 1 and points[k - 1] == points[k - 2] else k
        return Ranges(points, rank)

    @staticmethod
    def unordered(shards: int) -> Ranges:
        """Shards whose order means nothing."""
        return Ranges(np.zeros(0, np.int64), np.arange(max(1, shards)))

    @property
    def shards(self) -> int:
        return len(self.rank)

    def place(self, keys: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """The shard of each key."""
        a, b = np.searchsorted(self.points, keys, "left"), np.searchsorted(self.points, keys, "right")
        return np.where(b - a > 1, a + 1 + salt % np.maximum(b - a - 1, 1), a)


def split(rows: DataFrame, key: str, weight: Column, total: int, size: int) -> Ranges:
    """Ranges of a key without nulls of about `size` weight each, MOST at most (8 bytes a range are held, and sent to tasks).
    Points are taken from percentiles, in two levels where there are more than COARSE ranges: of all rows, then within each
    coarse range, so that they stay apart at any number. A row counts as one for each GRAIN of its weight."""
    n = max(1, min(MOST, -(-total // size)))
    if n == 1:
        return Ranges.of(np.zeros(0, np.int64))
    counted = rows.select(F.col(key).cast("long").alias("k"), F.explode(F.sequence(F.lit(0), F.floor(weight / GRAIN)))).select("k")

    def points(m: int) -> Column:
        return F.percentile_approx("k", [i / m for i in range(1, m)], max(10_000, 20 * m)).alias("e")

    coarse = np.array(counted.agg(points(min(n, COARSE))).first()["e"] or [], np.int64)
    if n <= COARSE:
        return Ranges.of(coarse)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(coarse, batch.column(0).to_numpy(), "left")), batch.column(0)], ["c", "k"])

    fine = counted.mapInArrow(numbered, "c long, k long").groupBy("c").agg(points(-(-n // COARSE))).collect()
    return Ranges.of(np.sort(np.concatenate([coarse, *(np.array(r["e"], np.int64) for r in fine)])))
