"""Set operations on keys, retention and replay order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows; columns that a side lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def newest_dates(rows: DataFrame, date: str, n: int) -> DataFrame:
    """Rows of the n newest dates. The dates are few; only they are ordered."""
    keep = rows.select(date).distinct().orderBy(F.desc(date)).limit(n)
    return rows.join(keep, date, "left_semi")


def latest_before(rows: DataFrame, date: str, day: Column) -> DataFrame:
    """Rows of the newest date before a day."""
    last = rows.filter(F.col(date) < day).agg(F.max(date).alias("_last"))  # one row
    return rows.join(F.broadcast(last), rows[date] == last["_last"]).drop("_last")


def replay(channels: Sequence[tuple[int, DataFrame]], time: str, seq: str, after: int | None = None) -> DataFrame:
    """Channels as one stream in order of time, message type and sequence; after: only what comes later."""
    parts = [f.withColumn("msg_type", F.lit(k).cast("smallint")) for k, f in channels]
    out = union_all(*parts)
    if after is not None:
        out = out.filter(F.col(time) > after)
    return out.orderBy(time, "msg_type", seq)


def paced(rows: DataFrame, time: str, speed: float) -> DataFrame:
    """Adds wait_ns: how long after the first row each is due at a speed."""
    first = rows.agg(F.min(time).alias("_first"))  # one row
    return rows.join(F.broadcast(first)).withColumn("wait_ns", ((F.col(time) - F.col("_first")) / speed).cast("long")).drop("_first")


def numbered(rows: DataFrame, by: Sequence[str], key: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(by, key, number): numbers from 1 without gaps for the different keys of each group, which keep bitmaps short. Keys that
    an earlier increment has numbered (known) keep theirs, new ones go on from there."""
    new = rows.select(*by, *key).distinct()
    w = Window.partitionBy(*by).orderBy(*key)
    if known is None:
        return new.withColumn("number", F.row_number().over(w).cast("long"))
    new = new.join(known, [*by, *key], "left_anti")
    last = known.groupBy(*by).agg(F.max("number").alias("_last"))
    own = new.join(last, list(by), "left").withColumn("number", F.row_number().over(w) + F.coalesce("_last", F.lit(0)))
    return known.select(*by, *key, "number").unionByName(own.drop("_last"))


def bitmaps(rows: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """(by, part, bits): exact sets of numbers, 32,768 of them a row, which merge by OR."""
    n = F.col(number)
    return rows.groupBy(*by, F.bitmap_bucket_number(n).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"))


def merged_bitmaps(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sets of several increments as one."""
    return rows.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted_bitmaps(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n): how many numbers each set has."""
    return rows.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))
