"""Sinks. Spark's commit protocol publishes whole files or none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import times, values
from ..operators.compare import report
from ..schemas import EST_ROW_BYTES


def archive(rows: DataFrame, path: str, name: str, file_bytes: int = 128 << 20) -> None:
    """A channel as Snappy Parquet in files of about file_bytes, by the estimated width of its rows."""
    rows.write.option("compression", "snappy").option("maxRecordsPerFile", file_bytes // EST_ROW_BYTES[name]).mode("overwrite").parquet(path)


def minute_files(rows: DataFrame) -> DataFrame:
    """Adds the partition columns of per-minute files: date, and the minute that a message is written to."""
    local = times.nanos_to_tm(F.col("nano_timestamp"))
    day = (times.nanos_to_timestamp(F.col("nano_timestamp")) + F.expr("interval 8 hours")).cast("date")
    return rows.withColumns({"date": day, "file_hhmm": times.file_minute(times.div(local, 100_000)).cast("int")})


def minute_sink(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream of messages as per-minute Parquet; each micro-batch commits, so nothing waits for a flush. A
    micro-batch has one file for each minute, however many tasks have read it. The number of tasks is given, as adaptive
    execution would else write a small batch's many files in one."""
    tasks = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return minute_files(stream).repartition(tasks, "date", "file_hhmm").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("date", "file_hhmm")


def bars_csv(bars: DataFrame, path: str, version: bool = False) -> None:
    """Bars as CSV: four decimals for prices, none for amounts; patches carry their version."""
    prices = [F.format_string("%.4f", F.col(c).cast("double")).alias(c) for c in ("open", "close", "high", "low")]
    amounts = [F.format_string("%.0f", c).alias(c) for c in ("money", "volume")]
    bars.select("datetime", "code", *prices, *amounts, *(["version"] if version else [])).write.mode("overwrite").option("header", True).csv(path)


def factors_csv(snapshot: DataFrame, path: str) -> None:
    """A factor snapshot as CSV with ten significant digits; what is not a number is empty."""
    shown = [F.when(values.finite(F.col(c)).isNotNull(), F.format_string("%.10g", c)).alias(c) if kind == "double" else F.col(c) for c, kind in snapshot.dtypes]
    snapshot.select(*shown).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def factors_parquet(snapshot: DataFrame, path: str) -> None:
    """Factor snapshots by the time that they are of."""
    snapshot.write.mode("append").partitionBy("label").parquet(path)


def keyed_ticks(ticks: DataFrame, name: str, buckets: int) -> None:
    """Ticks as a table of the session's catalog, bucketed by (code, date) and sorted in their order, from which bars, their
    comparison and streams' replays need no shuffle of ticks. Buckets should hold some 100 MB, and be as many as shuffle
    partitions at least: Spark would else rather shuffle than run fewer tasks."""
    ticks.repartition(buckets, "code", "date").write.bucketBy(buckets, "code", "date").sortBy("code", "date", "tm", "seq").mode("overwrite").saveAsTable(name)


def append_csv(rows: DataFrame, path: str) -> None:
    """Records as CSV files with a header, added to those that are there."""
    rows.write.mode("append").option("header", True).csv(path)


def landing(rows: DataFrame, path: str, batches: int) -> None:
    """Messages, in order of their original time, as the files of a landing folder, for a stream to read one by one."""
    rows.repartitionByRange(batches, "nano_timestamp").sortWithinPartitions("nano_timestamp").write.mode("append").parquet(path)


def comparison(a: DataFrame, b: DataFrame, keys: list[str], tolerance: dict[str, float], path: str, n: int = 200) -> None:
    """The tables of a comparison: generated, differences, summary and worst mismatches."""
    for name, frame in {"synth": a, **report(a, b, keys, tolerance, n)}.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
