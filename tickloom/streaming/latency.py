"""The latency file: at the end of each interval with messages, one row per channel with its newest message's times."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATE = "channel string, journal_nano long, exchange_time long"


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The channels' newest messages after the batch before."""
    try:
        return spark.read.schema(STATE).parquet(f"{path}-state/batch={batch_id - 1}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # the first batch
            raise
        return spark.createDataFrame([], STATE)


def per_interval(messages: DataFrame, channels: Sequence[str], interval_ns: int, before: DataFrame) -> DataFrame:
    """(interval, channel, journal_nano, exchange_time): for each interval that has messages of any channel, what each
    channel's newest message is at its end; null for a channel without any so far. before: where the channels stood."""
    own = messages.withColumn("interval", F.floor(F.col("journal_nano") / interval_ns).cast("long"))
    last = own.groupBy("interval", "channel").agg(F.max(F.struct("journal_nano", "exchange_time")).alias("m"))
    rack = own.select("interval").distinct().withColumn("channel", F.explode(F.array(*map(F.lit, channels)))).join(last, ["interval", "channel"], "left")
    start = before.select(F.lit(-1).cast("long").alias("interval"), "channel", F.struct("journal_nano", "exchange_time").alias("m"))
    w = Window.partitionBy("channel").orderBy("interval").rowsBetween(Window.unboundedPreceding, 0)
    carried = rack.unionByName(start).withColumn("m", F.last("m", True).over(w)).filter("interval >= 0")
    return carried.select("interval", "channel", F.col("m.journal_nano").alias("journal_nano"), F.col("m.exchange_time").alias("exchange_time"))


def writer(path: str, channels: Sequence[str], interval_ns: int) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over messages (channel, journal_nano, exchange_time) in the order of journal_nano: appends the
    batch's intervals as CSV below path, in a folder for each batch, which a batch that runs again replaces. An interval that
    goes on in the next batch has rows of both; the later ones count."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = per_interval(batch, channels, interval_ns, _before(batch.sparkSession, path, batch_id))
        rows.write.mode("overwrite").option("header", True).csv(f"{path}/batch={batch_id}")
        state = batch.select(*[f.split()[0] for f in STATE.split(", ")]).unionByName(_before(batch.sparkSession, path, batch_id))
        newest = state.groupBy("channel").agg(F.max(F.struct("journal_nano", "exchange_time")).alias("m")).select("channel", "m.*")
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}-state/batch={batch_id}")

    return write


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a latency file: of an interval's rows those of the last batch."""
    rows = spark.read.option("header", True).schema("interval long, channel string, journal_nano long, exchange_time long, batch int").csv(path)
    last = rows.groupBy("interval", "channel").agg(F.max_by(F.struct("journal_nano", "exchange_time"), "batch").alias("m"))
    return last.select("interval", "channel", "m.*")
