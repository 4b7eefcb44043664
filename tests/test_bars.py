"""Worked cases of the bar rules."""

import datetime as dt

import pytest

from tickloom.plans.bars import Rules, minute_bars
from tickloom.sources import writers

DAY = dt.date(2026, 3, 17)
SCHEMA = "code string, date date, tm long, seq long, current double, high double, low double, volume long, money long"


def bars(spark, ticks, prev=(), code="X", rules=Rules()):
    rows = [(code, DAY, tm, i, cur, cur if hi is None else hi, cur if lo is None else lo, vol, money) for i, (tm, cur, vol, money, hi, lo) in enumerate((*t, None, None)[:6] for t in ticks)]
    got = minute_bars(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(code, DAY)], "code string, date date"), spark.createDataFrame(list(prev), "code string, prev_day_close double"), rules).collect()
    assert len(got) == 240
    return {r.datetime.strftime("%H%M"): r for r in got}


def ohlc(b):
    return tuple(None if x is None else round(x, 2) for x in (b.open, b.high, b.low, b.close))


def test_morning_end_opens_at_the_quiet_minutes_snapshot(spark):
    got = bars(spark, [(112_939_000, 5.92, 1_618_500, 9), (112_945_000, 5.92, 1_618_500, 9), (113_000_000, 5.94, 1_618_600, 10)])
    assert ohlc(got["1130"]) == (5.92, 5.94, 5.92, 5.94)


def test_opening_zeros_stand_at_the_previous_close(spark):
    got = bars(spark, [(92_435_000, 0.0, 0, 0), (93_200_000, 0.0, 0, 0), (93_429_000, 19.60, 100, 1960)], prev=[("X", 19.73)])
    assert all(ohlc(got[f"093{m}"]) == (19.73,) * 4 and got[f"093{m}"].volume == 0 for m in range(1, 5))
    assert ohlc(got["0935"]) == (19.60,) * 4 and got["0935"].volume == 100 and got["0935"].money == 1960


def test_a_day_without_ticks(spark):
    got = bars(spark, [], prev=[("X", 4.65)])
    assert all(ohlc(b) == (4.65,) * 4 and b.volume == 0 for b in got.values())


def test_close_auction(spark):
    got = bars(spark, [(145_951_000, 406.41, 1000, 406_410), (150_000_000, 405.00, 1100, 446_910)])
    assert ohlc(got["1500"]) == (406.41, 406.41, 405.00, 405.00) and got["1500"].volume == 100 and got["1500"].money == 40_500


def test_close_auction_takes_the_earliest_row_of_either_kind(spark):
    got = bars(spark, [(145_951_000, 10.0, 100, 1000), (150_000_000, 10.5, 100, 1000), (150_010_000, 11.0, 200, 2100)])
    assert ohlc(got["1500"]) == (10.0, 10.5, 10.0, 10.5) and got["1500"].volume == 0


def test_money_keeps_its_last_digit(spark):
    got = bars(spark, [(93_759_000, 10.0, 1, 1_726_481_313), (93_830_000, 10.0, 2, 1_829_881_676)])
    assert got["0939"].money == 103_400_363


def test_opening_auction_is_part_of_the_first_bar(spark):
    ticks = [(92_000_000, 9.0, 50, 450), (92_510_000, 10.0, 150, 1450), (93_010_000, 10.2, 160, 1552)]
    assert ohlc(bars(spark, ticks)["0931"]) == (10.0, 10.2, 10.0, 10.2) and bars(spark, ticks)["0931"].volume == 110
    assert bars(spark, ticks, rules=Rules(merge_auction=False))["0931"].volume == 10


def test_a_bar_of_carried_ticks_hangs_on_the_last_price(spark):
    got = bars(spark, [(112_830_000, 9.9, 100, 990), (112_930_000, 10.0, 100, 990), (113_005_000, 10.4, 120, 1198)], rules=Rules())
    assert got["1130"].close == pytest.approx(10.4) and got["1130"].open == pytest.approx(10.0) and got["1130"].volume == 20


def test_highs_of_snapshots_count_only_when_they_move(spark):
    ticks = [(93_010_000, 10.0, 10, 100, 10.0, 10.0), (93_020_000, 10.0, 20, 200, 10.8, 9.7), (93_110_000, 10.0, 30, 300, 10.8, 9.7)]
    got = bars(spark, ticks)
    assert ohlc(got["0931"]) == (10.0, 10.8, 9.7, 10.0) and ohlc(got["0932"]) == (10.0, 10.0, 10.0, 10.0)
    assert ohlc(bars(spark, ticks, rules=Rules(extrema="current"))["0931"]) == (10.0, 10.0, 10.0, 10.0)


def test_full_minutes_by_boundary_rule(spark):
    ticks = [(93_000_000, 10.0, 10, 100), (93_200_000, 11.0, 20, 210)]
    assert bars(spark, ticks)["0933"].volume == 10 and bars(spark, ticks, rules=Rules(boundary="prev"))["0932"].volume == 10


def test_days_and_codes_do_not_mix(spark):
    other = dt.date(2026, 3, 18)
    ticks = spark.createDataFrame([("A", DAY, 93_010_000, 0, 1.0, 1.0, 1.0, 10, 10), ("A", other, 93_010_000, 0, 2.0, 2.0, 2.0, 30, 60), ("B", DAY, 93_010_000, 0, 9.0, 9.0, 9.0, 1, 9)], SCHEMA)
    universe = spark.createDataFrame([("A", DAY), ("A", other)], "code string, date date")
    got = minute_bars(ticks, universe, spark.createDataFrame([], "code string, prev_day_close double")).filter("volume > 0").orderBy("datetime").collect()
    assert [(r.code, r.volume, r.close) for r in got] == [("A", 10.0, 1.0), ("A", 30.0, 2.0)]


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_ticks_are_shuffled_once_or_not_at_all(spark, tmp_path, broadcast):
    rows = [(f"c{i % 7}", DAY, 93_000_000 + i * 1000, i, 10.0 + i % 3, 12.0, 9.0, i * 100, i * 1000) for i in range(50)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "ticks"))
    plain, prev = spark.read.parquet(str(tmp_path / "ticks")), spark.createDataFrame([("c1", 3.0)], "code string, prev_day_close double")
    universe = spark.createDataFrame([("c1", DAY), ("c2", DAY), ("none", DAY)], "code string, date date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    writers.keyed_ticks(plain, "ticks_of_a_test", 8)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        found = {name: minute_bars(ticks, universe, prev) for name, ticks in (("plain", plain), ("keyed", spark.table("ticks_of_a_test")))}
        tick_side = {}
        for name, bars_ in found.items():
            lines = bars_._jdf.queryExecution().executedPlan().toString().split("\n")
            scan = next(k for k, line in enumerate(lines) if "FileScan" in line and "current" in line)
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            at, above = depth(lines[scan]), []
            for line in reversed(lines[:scan]):
                if depth(line) < at:
                    above.append(line)
                    at = depth(line)
            join = next(k for k, line in enumerate(above) if "Join" in line)
            tick_side[name] = (sum("Exchange" in line for line in above[:join]), sum("Exchange hashpartitioning(code" in line and "date" in line for line in above))
        assert tick_side["plain"] == (1, 1) and tick_side["keyed"] == (0, 0)
        assert sorted(found["plain"].collect(), key=str) == sorted(found["keyed"].collect(), key=str) and found["plain"].count() == 3 * 240
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS ticks_of_a_test")
