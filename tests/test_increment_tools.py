"""Interval joins, mergeable sets, record files and latency rows."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import joins, sets
from tickloom.plans import q_scalars
from tickloom.sources import records
from tickloom.streaming import latency


@pytest.mark.parametrize("width", [3, 60, 10_000])
def test_interval_join_equals_a_comparison_of_all_pairs(spark, width):
    rng = random.Random(width)
    rows = [(i, rng.choice([None, *range(-20, 500)])) for i in range(300)]
    spans = [(k, a := rng.randint(-30, 450), a + rng.randint(0, 90)) for k in range(60)] + [(100, None, 5), (101, 5, None), (102, 7, 7)]
    r, s = spark.createDataFrame(rows, "i int, t long"), spark.createDataFrame(spans, "k int, a long, b long")
    got = joins.interval_join(r, s, "t", "a", "b", width)
    want = sorted((i, k) for i, t in rows for k, a, b in spans if None not in (t, a, b) and a < t <= b)
    assert sorted((x.i, x.k) for x in got.collect()) == want


def test_the_schedule_is_joined_without_a_nested_loop(spark):
    plan = q_scalars.f11(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_numbers_go_on_and_sets_merge(spark):
    first = spark.createDataFrame([(1, 7), (1, 9), (2, 7), (1, 7)], "s int, o long")
    second = spark.createDataFrame([(1, 9), (1, 3), (2, 8), (3, 1)], "s int, o long")
    known = sets.numbered(first, ["s"], ["o"])
    every = sets.numbered(second, ["s"], ["o"], known)
    got = {(r.s, r.o): r.number for r in every.collect()}
    assert got == {(1, 7): 1, (1, 9): 2, (1, 3): 3, (2, 7): 1, (2, 8): 2, (3, 1): 1}
    parts = [sets.bitmaps(x.join(every, ["s", "o"]), ["s"]) for x in (first, second)]
    n = sets.counted_bitmaps(sets.merged_bitmaps(parts[0].unionByName(parts[1]), ["s"]), ["s"])
    assert {r.s: r.n for r in n.collect()} == {1: 3, 2: 2, 3: 1}


def test_sets_of_more_numbers_than_one_row_holds(spark):
    rows = spark.range(100_000).select(F.lit(1).alias("s"), (F.col("id") % 70_000 + 1).alias("number"))
    made = sets.bitmaps(rows, ["s"])
    assert made.count() == 3 and sets.counted_bitmaps(made, ["s"]).first().n == 70_000


@pytest.mark.parametrize("kind", sorted(records.RECORDS))
def test_records_come_back_with_their_columns(spark, tmp_path, kind):
    path, names = str(tmp_path / kind), records.RECORDS[kind].names
    assert len(set(names)) == len(names)
    row = spark.createDataFrame([("600000", 93_000_000)], "htscsecurityid string, mdtime int")
    for _ in range(2):
        records.write(row, kind, path)
    got = records.read(spark, kind, path)
    assert got.columns == names and got.count() == (2 if records.RECORDS[kind].adds else 1)
    assert {(r.htscsecurityid, r.mdtime) for r in got.collect()} == {("600000", 93_000_000)}
    with pytest.raises(ValueError):
        records.write(row.withColumn("other", F.lit(1)), kind, path)


def test_a_stock_tick_has_ten_levels():
    names = records.RECORDS["stock_tick"].names
    assert names.index("buypricequeue0") == 16 and names[26] == "buyorderqtyqueue0" and names[-1] == "receivetime" and len(names) == 83


def test_each_interval_says_where_all_channels_are(spark, tmp_path):
    path = str(tmp_path / "latency")
    write = latency.writer(path, ["tick", "order", "trade"], 100)
    schema = "channel string, journal_nano long, exchange_time long"
    write(spark.createDataFrame([("tick", 10, 1), ("order", 20, 2), ("tick", 250, 3)], schema), 0)
    for _ in range(2):  # the second batch runs twice
        write(spark.createDataFrame([("tick", 260, 4), ("trade", 510, 5)], schema), 1)
    write(spark.createDataFrame([], schema), 2)
    write(spark.createDataFrame([("order", 620, 6)], schema), 3)
    got = sorted(((r.interval, r.channel, r.journal_nano, r.exchange_time) for r in latency.read(spark, path).collect()), key=str)
    assert got == sorted([(0, "tick", 10, 1), (0, "order", 20, 2), (0, "trade", None, None), (2, "tick", 260, 4), (2, "order", 20, 2), (2, "trade", None, None), (5, "tick", 260, 4), (5, "order", 20, 2), (5, "trade", 510, 5), (6, "tick", 260, 4), (6, "order", 620, 6), (6, "trade", 510, 5)], key=str)
