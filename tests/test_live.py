"""Live bars: late ticks, released minutes, patches and their throttle, both ends of a day, and the bar in progress."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.streaming import flow, live

DAY = datetime.date(2024, 1, 2)
TICKS = "code string, date date, tm long, seq long, current double, volume long"


def put(spark, path, rows):
    spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(str(path))


def bars_of(ticks):
    """Plain bars: (code, bar) to values, volume as difference to the minute before that has ticks."""
    one = {}
    for code, _, tm, seq, px, vol in sorted(ticks, key=lambda t: (t[2], t[3])):
        hhmm = tm // 100_000
        bar = (hhmm + 1 if hhmm % 100 != 59 else (hhmm // 100 + 1) * 100) if tm >= 93_000_000 else 931
        if px > 0:
            a = one.setdefault((code, bar), [px, px, px, px, vol])
            a[1:] = [max(a[1], px), min(a[2], px), px, vol]
    out, last = {}, {}
    for (code, bar), (o, h, low, c, cum) in sorted(one.items()):
        out[code, bar] = (o, h, low, c, cum - last.get(code, 0))
        last[code] = cum
    return out


def made(seed, n=300):
    rng = random.Random(seed)
    rows, vol = [], 0
    for i in range(n):
        vol += rng.randint(0, 3) * 100
        tm = 93_000_000 + i // 60 * 100_000 + i % 60 * 1000
        rows.append((f"60000{i % 2}.XSHG", DAY, tm, i, rng.choice([0.0, 10.0, 10.5, 11.0]), vol))
    return rows


def run(spark, stream, state, trigger, **rule):
    with flow.keyed_state(spark):
        return live.live_bars(stream, **rule).writeStream.foreachBatch(live.publisher(state)).option("checkpointLocation", f"{state}/checkpoint").trigger(**trigger).start()


def test_late_ticks_end_in_the_bars_of_all_ticks(spark, tmp_path):
    ticks = made(1)
    for part in (2, 0, 1):  # the ticks that release come first
        put(spark, tmp_path / "in", [t for t in ticks if t[3] * 7919 % 3 == part])
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    state = str(tmp_path / "state")
    run(spark, stream, state, {"availableNow": True}).awaitTermination()
    got = {(r.code, r.bar): tuple(r[v] for v in live.VALUES) for r in live.in_progress(spark, f"{state}/checkpoint").collect()}
    want = bars_of(ticks)
    assert got == want
    published = spark.read.parquet(f"{state}/published")
    last = published.groupBy("code", "bar").agg(F.max("version").alias("version"), *[F.max_by(v, "version").alias(v) for v in live.VALUES]).collect()
    assert {(r.code, r.bar): tuple(r[v] for v in live.VALUES) for r in last} == {k: v for k, v in want.items() if k[1] in {931, 932, 933, 934}}
    assert max(r.version for r in last) > 1 and published.filter("version = 1").groupBy("bar").agg(F.countDistinct("batch").alias("n")).filter("n > 1").isEmpty()


def out(kind, code, bar, tm, close=None, volume=None):
    return (kind, code, DAY, bar, tm, close, close, close, close, volume)


def versions(spark, state):
    return sorted((r.batch, r.code, r.bar, r.version, r.kind, r.close) for r in spark.read.parquet(f"{state}/published").collect())


def test_a_minute_is_published_when_it_is_released_and_patched_after(spark, tmp_path):
    state = str(tmp_path)
    publish = live.publisher(state)
    batches = [
        [out("bar", "a", 931, 93_010_000, 10.0, 1), out("bar", "b", 931, 93_020_000, 20.0, 1)],
        [out("release", "a", 931, 93_101_000), out("bar", "a", 932, 93_101_000, 11.0, 2)],
        [out("bar", "b", 931, 93_103_000, 21.0, 1), out("bar", "c", 931, 93_103_000, 5.0, 1), out("bar", "a", 931, 93_103_000, 10.0, 1)],
    ]
    for k, rows in enumerate(batches):
        for _ in range(2):  # a batch that runs again replaces what it wrote
            publish(spark.createDataFrame(rows, live.OUT), k)
    assert versions(spark, state) == [(1, "a", 931, 1, "insert", 10.0), (1, "b", 931, 1, "insert", 20.0), (2, "b", 931, 2, "update", 21.0), (2, "c", 931, 2, "insert", 5.0)]


def test_patches_wait_for_the_throttle(spark, tmp_path):
    state = str(tmp_path)
    publish = live.publisher(state, 1000)
    batches = [
        [out("bar", "a", 931, 93_010_000, 10.0, 1), out("release", "a", 931, 93_101_000)],
        [out("bar", "a", 931, 93_101_200, 10.5, 1)],
        [out("bar", "b", 931, 93_101_900, 7.0, 1)],
        [out("bar", "a", 932, 93_102_300, 11.0, 1)],
        [out("bar", "a", 931, 93_102_400, 10.7, 1)],
        [out("final", "a", 931, 93_102_500, 10.8, 1)],
    ]
    for k, rows in enumerate(batches):
        publish(spark.createDataFrame(rows, live.OUT), k)
    assert versions(spark, state) == [(0, "a", 931, 1, "insert", 10.0), (3, "a", 931, 2, "update", 10.5), (3, "b", 931, 2, "insert", 7.0), (5, "a", 931, 3, "update", 10.8)]


def test_only_touched_slots_are_read(spark, tmp_path):
    state = str(tmp_path)
    publish = live.publisher(state)
    for k, bar in enumerate((931, 945, 1001, 1431)):
        publish(spark.createDataFrame([out("bar", "a", bar, bar * 100_000, 1.0, 1), out("release", "a", bar, bar * 100_000)], live.OUT), k)
    for table in ("bars", "published"):
        files = live.read_minutes(spark, state, table, [(DAY, 1431)]).inputFiles()
        assert len(files) == 1 and "slot=143" in files[0]


def test_the_day_ends_at_the_close_and_its_state_goes(spark, tmp_path):
    ticks = made(2, 100)
    put(spark, tmp_path / "in", ticks)
    put(spark, tmp_path / "in", [("600009.XSHG", DAY, 150_501_000, 1, 9.0, 5)])
    put(spark, tmp_path / "in", [("600009.XSHG", DAY + datetime.timedelta(days=1), 93_001_000, 1, 9.0, 5)])
    state = str(tmp_path / "state")
    run(spark, spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), state, {"availableNow": True}).awaitTermination()
    final = spark.read.parquet(f"{state}/bars").filter("kind = 'final'").collect()
    assert {(r.code, r.bar): tuple(r[v] for v in live.VALUES) for r in final} == bars_of(ticks)
    assert [(r.code, str(r.date), r.bar) for r in live.in_progress(spark, f"{state}/checkpoint").collect()] == [("600009.XSHG", "2024-01-03", 931)]


def test_a_code_without_ticks_ends_but_not_over_noon(spark, tmp_path):
    put(spark, tmp_path / "in", [("600001.XSHG", DAY, 100_000_000, 1, 9.0, 5), ("600002.XSHG", DAY, 112_930_000, 1, 9.0, 5)])
    state = str(tmp_path / "state")
    q = run(spark, spark.readStream.schema(TICKS).parquet(str(tmp_path / "in")), state, {"processingTime": "500 milliseconds"}, rule="idle", idle_ms=1500)
    try:
        until = time.time() + 120
        found = []
        while time.time() < until and not found:
            time.sleep(1)
            try:
                found = spark.read.parquet(f"{state}/bars").filter("kind = 'final'").collect()
            except Exception:  # nothing is written yet
                found = []
        time.sleep(3)
    finally:
        q.stop()
    assert [r.code for r in spark.read.parquet(f"{state}/bars").filter("kind = 'final'").collect()] == ["600001.XSHG"]


@pytest.mark.parametrize("tm", [93_059_999, 112_900_123])
def test_market_time_in_milliseconds(spark, tm):
    assert spark.range(1).select(times.tm_to_ms(F.lit(tm))).first()[0] == live._ms(tm)


class Calls:
    """A state and timers that count what is asked of them."""

    def __init__(self):
        self.value, self.map, self.timers, self.n = None, {}, [], 0

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def get(self):
        self.n += 1
        return self.value

    def update(self, value):
        self.n += 1
        self.value = value

    def exists(self):
        self.n += 1
        return bool(self.map)

    def containsKey(self, k):
        self.n += 1
        return k in self.map

    def getValue(self, k):
        self.n += 1
        return self.map[k]

    def updateValue(self, k, v):
        self.n += 1
        self.map[k] = v

    def removeKey(self, k):
        self.n += 1
        del self.map[k]

    def listTimers(self):
        self.n += 1
        return list(self.timers)

    def registerTimer(self, t):
        self.n += 1
        self.timers.append(t)


def test_a_batch_asks_for_a_days_state_once_however_many_minutes_it_has():
    calls, bars = Calls(), live.Bars()
    bars.init(calls)
    for batch in range(2):
        rows = [("600000.XSHG", DAY, (9 + (31 + k) // 60) * 10_000_000 + (31 + k) % 60 * 100_000 + batch, k, 10.0 + batch, k, (9 + (31 + k) // 60) * 100 + (31 + k) % 60 + 1) for k in range(100)]
        before = calls.n
        assert len([r for r in bars.handleInputRows(("600000.XSHG", DAY), iter(rows), None) if r[0] == "bar"]) == 100
        assert calls.n - before <= 3


def test_calls_for_orders_do_not_grow_with_the_orders_of_a_batch():
    import pandas as pd

    calls, orders = Calls(), flow.Orders()
    orders.init(calls)
    names = [f.split()[0] for f in flow.EVENTS.split(", ")]
    for first in (0, 5000):
        rows = pd.DataFrame([("SH", 7, DAY, 93_000_000 + k, k, "order", 66, first + k, 0, 10.0, 100) for k in range(5000)], columns=names)
        before = calls.n
        assert sum(map(len, orders.handleInputRows(("SH", 7), iter([rows]), None))) == 5000
        assert calls.n - before <= 4 * flow.CHUNKS + 4
    gone = pd.DataFrame([("SH", 7, DAY, 94_000_000 + k, k, "withdraw", 66, k, 0, 10.0, 100) for k in range(10_000)], columns=names)
    out = pd.concat(list(orders.handleInputRows(("SH", 7), iter([gone]), None)))
    assert (out["order_vol"] == 100).all() and calls.map == {}
