"""Readers of landed channels, tick shards, reference bars and small files. All are lazy scans: columns and filters that a
query uses reach the Parquet reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, times, values
from ..operators.sets import latest_before, replay, union_all
from ..schemas import CHANNELS, MSG_TYPES


def channel(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One landed channel. The schema is stated, so no file is opened to find it; file order means nothing."""
    return spark.read.schema(CHANNELS[name]).parquet(path)


def all_channels(spark: SparkSession, root: str) -> DataFrame:
    """Ticks, orders and trades in one table with msg_type; columns that a channel lacks are null."""
    return union_all(*[channel(spark, f"{root}/{name}", name).withColumn("msg_type", F.lit(k).cast("smallint")) for name, k in MSG_TYPES.items()])


def time_range(rows: DataFrame, start: int, end: int, exchange: str | None = None) -> DataFrame:
    """Messages of [start, end) nanoseconds, of one exchange if it is named."""
    out = rows.filter((F.col("nano_timestamp") >= start) & (F.col("nano_timestamp") < end))
    return out if exchange is None else out.filter(F.col("exchange") == exchange)


def tail(spark: SparkSession, path: str, name: str, since: int | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A landed channel as a stream, from the start or from a nanosecond on."""
    reader = spark.readStream.schema(CHANNELS[name])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(path)
    return rows if since is None else rows.filter(F.col("nano_timestamp") > since)


def bar_ticks(ticks: DataFrame, date: Column, seq: str = "BizIndex") -> DataFrame:
    """Channel ticks in the form that bars take: prices de-scaled, cumulative amounts kept as whole numbers."""
    return ticks.select(
        codes.code(F.col("Symbol")).alias("code"), date.alias("date"), F.col("Time").cast("long").alias("tm"), F.col(seq).cast("long").alias("seq"),
        values.price(F.col("Price")).alias("current"), values.price(F.col("High")).alias("high"), values.price(F.col("Low")).alias("low"), F.col("AccVolume").alias("volume"), F.col("AccTurnover").alias("money"),
    )


def tick_shards(spark: SparkSession, root: str, date: str, symbol: int | None = None) -> DataFrame:
    """The tick shards of a date (yyyy-mm-dd, files named by it), of one symbol if it is named."""
    rows = spark.read.schema(CHANNELS["tick"]).parquet(f"{root}/*{date}*")
    if symbol is not None:
        rows = rows.filter(F.col("Symbol") == symbol)
    return bar_ticks(rows, F.lit(date).cast("date"))


def vendor_ticks(spark: SparkSession, path: str, universe: DataFrame | None = None) -> DataFrame:
    """Ticks with datetime, code, current, high, low, volume, money, in the form that bars take; seq orders equal times by
    the cumulative amounts."""
    rows = spark.read.parquet(path)
    if universe is not None:
        rows = rows.join(universe.select("code").distinct(), "code", "left_semi")
    at = F.col("datetime")
    return rows.select("code", F.to_date(at).alias("date"), times.ms_to_tm(times.ms_of_day(at)).alias("tm"), F.col("volume").cast("long").alias("seq"), "current", "high", "low", F.col("volume").cast("long").alias("volume"), F.col("money").cast("long").alias("money"))


def reference_bars(spark: SparkSession, path: str) -> DataFrame:
    """Golden bars with the label (HHMM) of each."""
    return spark.read.parquet(path).withColumn("label", F.hour("datetime") * 100 + F.minute("datetime"))


def previous_close(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Each code's last close on the newest date before a date; bars are partitioned by date."""
    rows = latest_before(spark.read.parquet(path), "date", F.lit(date).cast("date"))
    return rows.groupBy("code").agg(F.max_by("close", "datetime").cast("double").alias("prev_day_close"))


def csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One column of a CSV file with a header; an error names the column if it is missing."""
    rows = spark.read.option("header", True).csv(path)
    if column not in rows.columns:
        raise ValueError(f"{path} has no column {column}")
    return rows.select(column)


def frames(spark: SparkSession, root: str, resume_after: int | None = None, names: Sequence[str] = tuple(MSG_TYPES)) -> DataFrame:
    """All messages in replay order, after a nanosecond if one is given."""
    return replay([(MSG_TYPES[n], channel(spark, f"{root}/{n}", n)) for n in names], "nano_timestamp", "BizIndex", resume_after)
