"""Readers, writers, streams, comparison and replay on small hand-made data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import compare, joins, sets, windows
from tickloom.schemas import CHANNELS, ORDER, TICK, TRADE
from tickloom.sources import readers, writers
from tickloom.streaming import bars as sbars

DAY = dt.date(2026, 3, 17)
TICKS = "code string, date date, tm long, seq long, current double, high double, low double, volume long, money long"


def message(spark, schema, **values):
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema)


def landed(spark, tmp_path):
    root = str(tmp_path / "channels")
    writers.archive(message(spark, ORDER, nano_timestamp=100, Symbol=1, BizIndex=11, Channel=22, Price=33.5), f"{root}/order", "order")
    writers.archive(message(spark, TRADE, nano_timestamp=150, Symbol=2, BidOrder=44), f"{root}/trade", "trade")
    writers.archive(message(spark, TICK, nano_timestamp=200, Symbol=3, Price=55.5, AskPx1=56.0, BizIndex=18), f"{root}/tick", "tick")
    return root


def test_schemas_have_their_widths():
    assert {k: len(s) for k, s in CHANNELS.items()} == {"tick": 64, "order": 12, "trade": 14}


def test_replay_merges_and_resumes(spark, tmp_path):
    root = landed(spark, tmp_path)
    rows = readers.frames(spark, root).collect()
    assert [(r.nano_timestamp, r.msg_type) for r in rows] == [(100, 62), (150, 63), (200, 61)]
    assert rows[0].Price == 33.5 and rows[1].BidOrder == 44 and rows[2].AskPx1 == 56.0
    assert [r.nano_timestamp for r in readers.frames(spark, root, resume_after=150).collect()] == [200]


def test_replay_orders_across_files(spark, tmp_path):
    root = landed(spark, tmp_path)
    for name, schema, nano in (("order", ORDER, 450), ("trade", TRADE, 175), ("tick", TICK, 300)):
        message(spark, schema, nano_timestamp=nano).write.mode("append").parquet(f"{root}/{name}")
    assert [r.nano_timestamp for r in readers.frames(spark, root).collect()] == [100, 150, 175, 200, 300, 450]


def test_a_corrupt_file_is_named(spark, tmp_path):
    root = landed(spark, tmp_path)
    (tmp_path / "channels/order/part-bad.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="part-bad"):
        readers.frames(spark, root).collect()


def test_time_range_is_half_open(spark, tmp_path):
    rows = readers.all_channels(spark, landed(spark, tmp_path))
    assert [r.nano_timestamp for r in readers.time_range(rows, 100, 200).orderBy("nano_timestamp").collect()] == [100, 150]


def test_scans_are_pruned(spark, tmp_path):
    plan = readers.channel(spark, f"{landed(spark, tmp_path)}/tick", "tick").filter("Symbol = 3").select("Price")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Symbol:int,Price:float>" in plan and "EqualTo(Symbol,3)" in plan


def test_csv_column(spark, tmp_path):
    writers.append_csv(spark.createDataFrame([("a", 1)], "x string, y int"), str(tmp_path / "csv"))
    assert readers.csv_column(spark, str(tmp_path / "csv"), "x").first()["x"] == "a"
    with pytest.raises(ValueError, match="no column z"):
        readers.csv_column(spark, str(tmp_path / "csv"), "z")


def test_factor_csv_has_empty_for_no_number(spark, tmp_path):
    writers.factors_csv(spark.createDataFrame([(1, 1 / 3, float("nan"))], "symbol int, a double, b double").coalesce(1), str(tmp_path / "f"))
    lines = next((tmp_path / "f").glob("*.csv")).read_text().splitlines()
    assert lines[0] == "symbol,a,b" and lines[1] == "1,0.3333333333,"


def ticks(spark, rows):
    return spark.createDataFrame([("X", DAY, tm, i, px, px, px, vol, vol * 10) for i, (tm, px, vol) in rows], TICKS)


def run(stream, prev, state, **options):
    sbars.versioned(stream, prev, state, **options).trigger(availableNow=True).start().awaitTermination()


def test_a_late_tick_gives_a_new_version_of_what_it_changes(spark, tmp_path):
    rows = list(enumerate([(93_010_000, 10.0, 100), (93_110_000, 11.0, 150), (93_040_000, 12.0, 120)]))
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    prev = spark.createDataFrame([("X", 9.0)], "code string, prev_day_close double")
    ticks(spark, rows[:2]).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(path)
    run(stream, prev, state)
    first = {r.datetime.strftime("%H%M"): r for r in sbars.latest(spark.read.parquet(f"{state}/published")).collect()}
    assert first["0931"].high == 10.0 and first["0932"].volume == 50 and {r.version for r in first.values()} == {1}
    ticks(spark, rows[2:]).coalesce(1).write.mode("append").parquet(path)
    run(stream, prev, state)
    published = spark.read.parquet(f"{state}/published")
    patch = {r.datetime.strftime("%H%M"): r for r in published.filter("batch = 1").collect()}
    assert set(patch) == {"0931", "0932"} and {r.version for r in patch.values()} == {2} and {r.kind for r in patch.values()} == {"update"}
    last = {r.datetime.strftime("%H%M"): r for r in sbars.latest(published).collect()}
    assert (last["0931"].high, last["0931"].close, last["0931"].volume, last["0932"].volume) == (12.0, 12.0, 120, 30) and len(last) == 240
    assert sbars.snapshot(published, F.lit("2026-03-17 09:31:00").cast("timestamp_ntz")).first().version == 2


def test_a_batch_run_again_replaces_its_own_rows_and_reads_only_its_days(spark, tmp_path):
    state = str(tmp_path / "state")
    prev = spark.createDataFrame([("X", 9.0)], "code string, prev_day_close double")
    publish = sbars.publisher(prev, state)
    day1 = ticks(spark, list(enumerate([(93_010_000, 10.0, 100), (93_110_000, 11.0, 150)])))
    day2 = day1.withColumn("date", F.date_add("date", 1))
    publish(day1, 0)
    publish(day2.unionByName(day2.withColumn("date", F.lit(None).cast("date"))), 1)
    publish(day2, 1)
    published = spark.read.parquet(f"{state}/published")
    assert {(r.batch, r.version): r["count"] for r in published.groupBy("batch", "version").count().collect()} == {(0, 1): 240, (1, 1): 240}
    assert published.select("date").distinct().count() == 2 and spark.read.parquet(f"{state}/landed").count() == 4
    for f in (tmp_path / "state" / "landed").glob(f"date={DAY}/batch=0/*.parquet"):
        f.write_bytes(b"no parquet")
    late = ticks(spark, [(5, (93_040_000, 12.0, 120))]).withColumn("date", F.date_add("date", 1))
    publish(late, 2)
    assert {r.datetime.strftime("%H%M") for r in spark.read.parquet(f"{state}/published").filter("batch = 2 and version = 2").collect()} == {"0931", "0932"}
    publish(late.limit(0), 3)
    assert spark.read.parquet(f"{state}/published").agg(F.max("batch")).first()[0] == 2


def test_fields_match_below_their_bounds(spark):
    a = spark.createDataFrame([(1, 1.0, [5.0, 6.0]), (2, 2.0, [5.0]), (3, None, None), (4, 4.0, [])], "k long, v double, p array<double>")
    b = spark.createDataFrame([(1, 1.0, [5.0, 6.5]), (2, 2.5, [5.0, 0.0]), (3, None, [0.0, 0.0]), (5, 4.0, [])], "k long, v double, p array<double>")
    sides = {"a": ("p", "p")}
    got = compare.field_matches(compare.book_fields(a, sides, 2), compare.book_fields(b, sides, 2), ["k"], {"v": 0.5, "a1_p": 0.1, "a2_p": 0.1})
    assert {r.field: (r.total, r.matches, r.max_diff) for r in got.collect()} == {"v": (3, 1, 0.5), "a1_p": (3, 3, 0.0), "a2_p": (3, 2, 0.5)}
    assert compare.field_matches(a.limit(0), b, ["k"], {"v": 0.5}).first().rate is None


def test_only_current_minutes(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    ticks(spark, list(enumerate([(93_210_000, 10.0, 100)]))).coalesce(1).write.parquet(path)
    run(spark.readStream.schema(TICKS).parquet(path), spark.createDataFrame([], "code string, prev_day_close double"), state, fill_all=False)
    assert sbars.latest(spark.read.parquet(f"{state}/published")).count() == 3


def test_keyed_accumulator_equals_batch(spark, tmp_path):
    rows = list(enumerate([(93_010_000, 10.0, 100), (93_020_000, 9.0, 130), (93_110_000, 11.0, 150), (93_500_000, 12.0, 160), (93_610_000, 12.5, 170)]))
    path = str(tmp_path / "in")
    for one in rows:
        ticks(spark, [one]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(path)
    sbars.keyed(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*[c.split()[0] for c in sbars.KEYED.split(", ")]).collect()))
    assert got == sorted(map(tuple, sbars.keyed_in_batch(ticks(spark, rows)).collect())) and len(got) == 3


def test_as_of_takes_equal_times_and_respects_groups(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 4), (3, "b", 10), (4, None, 10)], "id long, g string, t long")
    right = spark.createDataFrame([("a", 5, 1.0, 0), ("a", 10, 2.0, 1), ("a", 10, 3.0, 2), ("a", 11, 4.0, 3)], "g string, u long, v double, seq long")
    got = {r.id: r.v for r in joins.as_of_backward(left, right, ["g"], "t", "u", ["v"], tie="seq").collect()}
    assert got == {1: 3.0, 2: None, 3: None, 4: None}


def test_keyed_update_keeps_what_has_no_news(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k long, v double")
    over = spark.createDataFrame([(1, 9.0), (2, None), (7, 7.0)], "k long, v double")
    assert {r.k: r.v for r in joins.keyed_update(base, over, ["k"], ["v"]).collect()} == {1: 9.0, 2: 2.0, 3: 3.0}


def test_comparison(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 4.0)], "k long, v double")
    b = spark.createDataFrame([(1, 1.0), (2, 2.5), (3, None), (5, 5.0)], "k long, v double")
    out = compare.report(a, b, ["k"], {"v": 1e-6}, 5)
    s = out["summary"].first()
    assert (s.both, s.left_only, s.right_only, s.v_mismatches, s.v_max_diff) == (3, 1, 1, 1, 0.5) and s.v_rate == pytest.approx(2 / 3)
    assert [r.k for r in out["worst"].collect()] == [2, 1]


def test_retention_and_latest_before(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 2, 3, 5)], "day date, x int")
    assert sorted(r.x for r in sets.newest_dates(rows, "day", 2).collect()) == [3, 5]
    assert [r.x for r in sets.latest_before(rows, "day", F.lit(dt.date(2024, 1, 5))).collect()] == [3]


def test_sliding_deviation_starts_at_zero(spark):
    rows = spark.createDataFrame([("a", i, float(i)) for i in range(4)], "g string, t long, x double")
    got = windows.sliding(rows, ["g"], ["t"], "x", 2).orderBy("t").collect()
    assert [r.x_std for r in got] == pytest.approx([0.0, 0.5**0.5, 0.5**0.5, 0.5**0.5]) and [r.x_sum for r in got] == [0, 1, 3, 5]


def test_a_batch_has_one_file_for_each_minute(spark, tmp_path):
    rows = spark.range(800).select(*[(F.lit(1_704_160_000_000_000_000) + F.col("id") % 4 * 60_000_000_000 if f.name == "nano_timestamp" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDER])
    rows.repartition(8).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    writers.minute_sink(readers.tail(spark, str(tmp_path / "in"), "order"), out, f"{out}-c").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 800
    files = got.select("date", "file_hhmm", F.input_file_name().alias("file")).distinct()
    assert files.count() == got.select("date", "file_hhmm").distinct().count() == 4


def test_every_message_of_the_channel_reaches_a_minute_file(spark):
    from tickloom.plans import q_io

    sf = "/root/testdata/sf0.001"
    assert q_io.k2(spark, sf).agg(F.sum("n")).first()[0] == q_io.messages(spark, sf, "order").count()


def test_the_rack_and_the_vendor_ticks_have_all_codes(spark):
    from tickloom.plans import q_io, q_relational

    sf = "/root/testdata/sf0.001"
    e = spark.read.parquet(f"{sf}/events.parquet")
    assert q_relational.j2(spark, sf).count() == 240 * e.select("user_id").distinct().count()
    assert q_io.s9(spark, sf).count() == e.filter("user_id is not null").count()


def test_parts_land_one_a_batch_though_some_tasks_have_none_of_them(spark):
    from tickloom.plans import q_streaming

    rows = spark.range(0, 4000, 1, 32).withColumnRenamed("id", "tm")  # a quarter lies in a few of 32 tasks
    stream, seen = q_streaming._landed(spark, rows, "tm", 4, "test", again=True), []
    stream.writeStream.foreachBatch(lambda batch, k: seen.append(sorted(r.tm for r in batch.collect()))).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4 and sum(seen, []) == list(range(4000))
