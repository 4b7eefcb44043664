"""Bars from a stream of ticks.

versioned(): every micro-batch is landed, the days of the codes in it are synthesised anew from all that has landed, and
what differs from the last publication is published with the next version. So ticks may come in any order and arbitrarily
late within their day, nothing depends on watermarks, and the last versions equal the batch synthesis. What a batch lands or
publishes goes to folders of its own, by date, so a batch that is run again replaces its own output and a batch reads only
the days that it touches.

keyed(): a small accumulator per code for ticks that come in order; it emits a bar when the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import times
from ..plans import bars as batch
from ..plans.bars import Rules, minute_bars

VALUES = ("open", "close", "high", "low", "money", "volume")


def _days_of(spark: SparkSession, root: str, days: Sequence[object]) -> DataFrame | None:
    """What has been written of some days; other days' folders are not even listed."""
    found = []
    for d in days:
        try:
            found.append(spark.read.option("basePath", root).parquet(f"{root}/date={d}"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # a day's first batch; anything else is a fault
                raise
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found) if found else None


def _put(rows: DataFrame, root: str, batch_id: int) -> None:
    """Writes a batch's rows to date=.../batch=... below root, in place of what an earlier run of the batch wrote there."""
    rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(root)


def latest(published: DataFrame) -> DataFrame:
    """The last version of each bar."""
    order = F.struct("version", "batch")
    return published.groupBy("code", "datetime").agg(F.max("version").alias("version"), *[F.max_by(c, order).alias(c) for c in VALUES])


def changes(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Bars that are new (version 1) or differ from their last version (the next one)."""
    if old is None:
        return new.withColumns({"version": F.lit(1), "kind": F.lit("insert")})
    before = old.select("code", "datetime", F.col("version").alias("_v"), *[F.col(c).alias(f"_{c}") for c in VALUES])
    same = F.lit(True)
    for c in VALUES:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = new.join(before, ["code", "datetime"], "left").filter(F.col("_v").isNull() | ~same)
    return out.withColumns({"version": F.coalesce(F.col("_v") + 1, F.lit(1)), "kind": F.when(F.col("_v").isNull(), "insert").otherwise("update")}).select(*new.columns, "version", "kind")


def shown(rows: DataFrame, fill_all: bool, ticks: DataFrame) -> DataFrame:
    """All minutes of the day, or only those up to a code's last tick."""
    if fill_all:
        return rows
    last = ticks.groupBy("code").agg(F.max("tm").alias("_tm"))
    until = times.tm_to_ms(times.next_minute(times.div(F.col("_tm"), 100_000)) * 100_000)
    return rows.join(last, "code").filter(times.ms_of_day(F.col("datetime")) <= until).drop("_tm")


def publisher(prev: DataFrame, state: str, rules: Rules = Rules(), fill_all: bool = True) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: lands the batch in state/landed and publishes versions in state/published, both by date and
    batch. A batch reads the days that its own ticks are of and no others. Ticks without a date are of no day and left out."""

    def publish(ticks: DataFrame, batch_id: int) -> None:
        spark = ticks.sparkSession
        _put(ticks.filter("date is not null"), f"{state}/landed", batch_id)
        days = [r[0] for r in ticks.select("date").filter("date is not null").distinct().collect()]  # as many as a batch has days
        landed = _days_of(spark, f"{state}/landed", days)
        if landed is None:
            return
        landed = landed.filter(F.col("batch") <= batch_id)
        touched = landed.filter(F.col("batch") == batch_id).select("code", "date").distinct()
        every = landed.select(*ticks.columns).join(touched, ["code", "date"], "left_semi")
        new = shown(minute_bars(every, touched, prev, rules), fill_all, every)
        old = _days_of(spark, f"{state}/published", days)
        if old is not None:
            old = latest(old.filter(F.col("batch") < batch_id).join(touched.select("code").distinct(), "code", "left_semi"))
        _put(changes(new, old).withColumn("date", F.to_date("datetime")), f"{state}/published", batch_id)

    return publish


def versioned(stream: DataFrame, prev: DataFrame, state: str, rules: Rules = Rules(), fill_all: bool = True):
    """A writer of versioned bars; start it with the trigger that suits, or with availableNow to finalise what is there."""
    return stream.writeStream.foreachBatch(publisher(prev, state, rules, fill_all)).option("checkpointLocation", f"{state}/checkpoint")


def snapshot(published: DataFrame, minute) -> DataFrame:
    """The last published version of one minute of each code."""
    return latest(published).filter(F.col("datetime") == minute)


def publish_times(ticks: DataFrame) -> DataFrame:
    """(date, label, at): when each minute is published first: at the first Shanghai tick of second 01 after its end."""
    late = ticks.filter(F.col("code").endswith(".XSHG") & (times.div(F.col("tm"), 1000) % 100 == 1))
    label = times.div(F.col("tm"), 100_000)
    return late.withColumn("label", label).filter(F.array_contains(times.labels(), F.col("label").cast("int"))).groupBy("date", "label").agg(F.min("tm").alias("at"))


KEYED = "code string, bar int, open double, high double, low double, close double, volume long"
STATE = "bar int, open double, high double, low double, close double, cum long, base long"


def keyed(stream: DataFrame) -> DataFrame:
    """Finished bars of in-order ticks: (code, bar, open, high, low, close, volume). State is one bar per code."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else None
        out = []
        rows = pd.concat(list(frames)).sort_values(["tm", "seq"])
        for bar, price, cum in zip(rows["bar"], rows["current"], rows["volume"], strict=True):
            if now is None or now[0] != bar:
                if now is not None:
                    out.append((key[0], now[0], *now[1:5], now[5] - now[6]))
                now = (int(bar), price, price, price, price, int(cum), now[5] if now is not None else 0)
            else:
                now = (now[0], now[1], max(now[2], price), min(now[3], price), price, int(cum), now[6])
        if now is not None:
            state.update(now)
        yield pd.DataFrame(out, columns=["code", "bar", "open", "high", "low", "close", "volume"])

    rows = stream.withColumn("bar", times.bar_label(F.col("tm"))).filter((F.col("bar") > 0) & (F.col("current") > 0))
    return rows.select("code", "tm", "seq", "bar", "current", "volume").groupBy("code").applyInPandasWithState(update, KEYED, STATE, "append", GroupStateTimeout.NoTimeout)


def keyed_in_batch(ticks: DataFrame) -> DataFrame:
    """What keyed() has emitted when all ticks have come: every bar of a code but its last."""
    rows = ticks.withColumn("bar", times.bar_label(F.col("tm"))).filter((F.col("bar") > 0) & (F.col("current") > 0))
    one = rows.groupBy("code", "bar").agg(F.min_by("current", batch.order()).alias("open"), F.max("current").alias("high"), F.min("current").alias("low"), F.max_by("current", batch.order()).alias("close"), F.max_by("volume", batch.order()).alias("cum"))
    w = Window.partitionBy("code").orderBy("bar")
    out = one.withColumns({"volume": F.col("cum") - F.coalesce(F.lag("cum").over(w), F.lit(0)), "next": F.lead("bar").over(w)})
    return out.filter("next is not null").select("code", "bar", "open", "high", "low", "close", "volume")
