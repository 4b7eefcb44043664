"""Bars of a running day, with late ticks, released minutes, patches, finalisation, and the bar in progress.

Bars keeps for each (code, date) one small row per minute: its first and last tick by (tm, seq), extremes, and the volume since
the start of the day. A tick merges into its minute, however late it is: it can change the bar of that minute and the volume
of the next one that has ticks, and nothing else. The minutes of a code's day, of which there are 240 at most, are one value of
state (80 bytes a minute), so that a batch asks for state once and writes it once for each code that it has, however many
minutes its ticks are of. What has changed is given out (kind "bar"). A Shanghai tick of second 01 gives out that the minute before is over ("release").
The day of a code ends ("final", all its minutes) by one of two rules:
- "close": the watermark has passed 15:05, that is, some code's tick of that time has come. The day's state is cleared, and
  ticks of that day that come later still are late for Spark, which counts and drops them.
- "idle": no tick of the code has come for a while of the machine's time, except over noon (11:29 to 13:01 by its last tick).
  What comes later reopens it; state expires after `keep_ms`.

publisher() is the stage behind it, a foreachBatch function over tables in the shared folder, by date and ten minutes. A minute is
published for all codes in the batch that releases it, with version 1; what changes in it later is a patch with the minute's
next version, held back until the newest tick is `throttle_ms` of market time past the first of the changes. A batch reads the
ten minutes around those that it releases or patches, and no others. A batch that runs again replaces its own output.

in_progress() reads the state of a running or stopped stream: all minutes, the one in progress too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import times

VALUES = ("open", "high", "low", "close", "volume")
MINUTE = np.dtype([("bar", "<i8"), ("open_tm", "<i8"), ("open_seq", "<i8"), ("open", "<f8"), ("high", "<f8"), ("low", "<f8"), ("close_tm", "<i8"), ("close_seq", "<i8"), ("close", "<f8"), ("cum", "<i8")])
OUT = "kind string, code string, date date, bar int, tm long, open double, high double, low double, close double, volume long"
CLOSE_MS = 54_300_000  # 15:05
NOON = (112_900_000, 130_100_000)
LABELS = {h * 100 + m for h in range(9, 16) for m in range(60) if 931 <= h * 100 + m <= 1130 or 1301 <= h * 100 + m <= 1500}


def _unpacked(minutes: bytes) -> dict[int, tuple]:
    """Minutes as state holds them, by bar in their order."""
    return {m[0]: m[1:] for m in np.frombuffer(minutes, MINUTE).tolist()}


_Out = Row(*[f.split()[0] for f in OUT.split(", ")])


class Bars(StatefulProcessor):
    """One code's day; see the module. rule: "close" or "idle"."""

    def __init__(self, rule: str = "close", idle_ms: int = 60_000, keep_ms: int = 86_400_000):
        self.rule, self.idle_ms, self.keep_ms = rule, idle_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "last_tm long, minutes binary", self.keep_ms if self.rule == "idle" else None)

    def _bars(self, kind: str, key: tuple, minutes: dict[int, tuple], wanted: set[int], tm: int) -> Iterator[Row]:
        before = 0
        for bar, m in minutes.items():
            if bar in wanted:
                yield _Out(kind, *key, bar, tm, m[2], m[3], m[4], m[7], m[8] - before)
            before = m[8]

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = sorted((tuple(r)[2:7] for r in rows), key=itemgetter(0, 1))
        held = self.day.get()
        newest, old = (int(held[0]), _unpacked(bytes(held[1]))) if held is not None else (0, {})
        newest, new = max(newest, came[-1][0]), {}
        for tm, seq, px, vol, bar in came:
            if px is None or not px > 0 or bar is None or bar <= 0:
                continue
            m = new.get(bar) or old.get(bar)
            if m is None:
                new[bar] = (tm, seq, px, px, px, tm, seq, px, vol)
                continue
            first = (tm, seq, px) if (tm, seq) < m[:2] else m[:3]
            last = (tm, seq, px, vol) if (tm, seq) > m[5:7] else m[5:9]
            new[bar] = (*first, max(m[3], px), min(m[4], px), *last)
        changed = {bar for bar, m in new.items() if old.get(bar) != m}
        minutes = dict(sorted((old | new).items()))
        bars = list(minutes)
        after = {b for a, b in zip(bars, bars[1:]) if a in changed}
        self.day.update((newest, np.array([(bar, *m) for bar, m in minutes.items()], MINUTE).tobytes()))
        if self.rule == "close":
            if held is None:  # with the state goes its timer
                self.handle.registerTimer(int(pd.Timestamp(key[1]).value // 1_000_000) + CLOSE_MS - 1)
        else:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._bars("bar", key, minutes, changed | after, newest)
        if key[0].endswith(".XSHG"):
            for bar in dict.fromkeys(tm // 100_000 for tm, *_ in came if tm // 1000 % 100 == 1):
                if bar in LABELS:
                    yield _Out("release", *key, bar, newest, None, None, None, None, None)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.day.get()
        if held is None:
            return
        last, minutes = int(held[0]), _unpacked(bytes(held[1]))
        if self.rule == "idle" and NOON[0] <= last < NOON[1]:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
            return
        if self.rule == "close":
            self.day.clear()
        yield from self._bars("final", key, minutes, set(minutes), last)

    def close(self) -> None:
        pass


def live_bars(stream: DataFrame, rule: str = "close", idle_ms: int = 60_000) -> DataFrame:
    """Rows of OUT of a stream of ticks (code, date, tm, seq, current, volume). Start it within flow.keyed_state()."""
    closed = F.when(times.tm_to_ms(F.col("tm")) >= CLOSE_MS, CLOSE_MS + 1000).otherwise(0)
    rows = stream.select("code", "date", "tm", "seq", "current", "volume", times.bar_label(F.col("tm")).alias("bar"))
    if rule == "close":  # no tick before the day's end is ever late
        rows = rows.withColumn("_at", F.timestamp_millis(F.unix_millis(F.col("date").cast("timestamp")) + closed)).withWatermark("_at", "1 second")
    return rows.groupBy("code", "date").transformWithState(Bars(rule, idle_ms), OUT, "Append", "EventTime" if rule == "close" else "ProcessingTime")


def in_progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(code, date, bar, VALUES) of what a stream's state holds: every minute so far, with what has come of the last one."""
    state = spark.read.format("statestore").option("stateVarName", "day").load(checkpoint)
    value = "value.value" if "ttlExpirationMs" in state.schema["value"].dataType.names else "value"  # by the rule of the stream

    def unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for code, date, minutes in frame.itertuples(index=False):
                own = pd.DataFrame.from_records(np.frombuffer(minutes, MINUTE))[["bar", "open", "high", "low", "close", "cum"]]
                own.insert(0, "code", code)
                own.insert(1, "date", date)
                yield own

    rows = state.select("key.code", "key.date", F.col(f"{value}.minutes").alias("minutes")).mapInPandas(unpacked, "code string, date date, bar int, open double, high double, low double, close double, cum long")
    before = F.lag("cum", 1, 0).over(Window.partitionBy("code", "date").orderBy("bar"))
    return rows.withColumn("volume", F.col("cum") - before).select("code", "date", "bar", *VALUES)


PLACE = "date date, slot int, batch int"
TABLES = {"bars": "code string, bar int, tm long, kind string, open double, high double, low double, close double, volume long", "released": "bar int, tm long", "published": "code string, bar int, open double, high double, low double, close double, volume long, version int, kind string"}


def read_minutes(spark: SparkSession, state: str, table: str, wanted: Sequence[tuple[object, int]]) -> DataFrame:
    """What a table has of some minutes (date, bar). Folders are by date and ten minutes (slot); no others are listed."""
    schema, out = f"{TABLES[table]}, {PLACE}", spark.createDataFrame([], f"{TABLES[table]}, {PLACE}")
    for date in sorted({d for d, _ in wanted}, key=str):
        bars = sorted({b for d, b in wanted if d == date})
        slots = ",".join(map(str, sorted({b // 10 for b in bars})))
        try:
            rows = spark.read.schema(schema).option("basePath", f"{state}/{table}").parquet(f"{state}/{table}/date={date}/slot={{{slots}}}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # the first batch with these minutes
                raise
            continue
        out = out.unionByName(rows.filter(F.col("bar").isin(bars)))
    return out


def _put(rows: DataFrame, state: str, table: str, batch_id: int) -> None:
    placed = rows.withColumns({"slot": times.div(F.col("bar"), 10).cast("int"), "batch": F.lit(batch_id)}).repartition("date", "slot")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "slot", "batch").parquet(f"{state}/{table}")


def _ms(tm: int) -> int:
    return tm // 10_000_000 * 3_600_000 + tm // 100_000 % 100 * 60_000 + tm % 100_000


def publisher(state: str, throttle_ms: int = 0) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function behind live_bars(): keeps state/bars and state/released, and publishes state/published."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{state}/rows/batch={batch_id}")  # the stateful stage runs once
        batch = spark.read.schema(OUT).parquet(f"{state}/rows/batch={batch_id}")
        _put(batch.filter("kind <> 'release'").select("code", "date", "bar", "tm", "kind", *VALUES), state, "bars", batch_id)
        _put(batch.filter("kind <> 'bar'").groupBy("date", "bar").agg(F.min("tm").alias("tm")), state, "released", batch_id)
        seen = batch.groupBy("date", "bar").agg(F.max("tm").alias("tm"), F.bool_or(F.col("kind") == "final").alias("final")).collect()  # 241 a day
        newest = max((_ms(r.tm) for r in seen), default=0)
        pending = _pending(spark, state, batch_id)
        wanted = sorted({(r.date, r.bar) for r in seen} | {(d, b) for d, b, _ in pending}, key=str)
        open_ = read_minutes(spark, state, "released", wanted).filter(F.col("batch") <= batch_id)
        released = {(r.date, r.bar) for r in open_.select("date", "bar").distinct().collect()}
        before = read_minutes(spark, state, "published", sorted(released, key=str)).filter(F.col("batch") < batch_id)
        published = {(r.date, r.bar) for r in before.select("date", "bar").distinct().collect()}
        since = {(d, b): tm for d, b, tm in pending}
        ended = {(r.date, r.bar) for r in seen if r.final}
        own = {(r.date, r.bar): r.tm for r in seen}
        due, wait = [], []
        for k in sorted(released, key=str):
            first = since.get(k, own.get(k, 0))
            late = k in published and k not in ended and newest - _ms(first) < throttle_ms
            (wait if late else due).append((*k, first))
        _keep_pending(spark, state, batch_id, wait)
        if not due:
            return
        held = read_minutes(spark, state, "bars", [(d, b) for d, b, _ in due]).filter(F.col("batch") <= batch_id)
        now = held.groupBy("code", "date", "bar").agg(*[F.max_by(c, "batch").alias(c) for c in VALUES])
        old = before.groupBy("code", "date", "bar").agg(*[F.max_by(c, "version").alias(f"_{c}") for c in VALUES], F.lit(True).alias("_known"))
        version = before.groupBy("date", "bar").agg(F.max("version").alias("_v"))
        same = F.lit(True)
        for c in VALUES:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        joined = now.join(old, ["code", "date", "bar"], "left").filter(F.col("_known").isNull() | ~same).join(version, ["date", "bar"], "left")
        out = joined.select(*now.columns, (F.coalesce("_v", F.lit(0)) + 1).cast("int").alias("version"), F.when(F.col("_known").isNull(), "insert").otherwise("update").alias("kind"))
        _put(out, state, "published", batch_id)

    return publish


PENDING = "date date, bar int, tm long"


def _pending(spark: SparkSession, state: str, batch_id: int) -> list[tuple]:
    """Minutes with changes that the batch before has held back, and the market time of the first."""
    if batch_id == 0:
        return []
    try:
        return [tuple(r) for r in spark.read.schema(PENDING).parquet(f"{state}/pending/batch={batch_id - 1}").collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _keep_pending(spark: SparkSession, state: str, batch_id: int, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, PENDING).coalesce(1).write.mode("overwrite").parquet(f"{state}/pending/batch={batch_id}")
