"""Cases of the order lifecycle and of the factors."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tickloom.plans import factors, orders
from tickloom.streaming import flow

ORDER = "symbol long, channelid int, orderid long, ordertm long, orderpx double, ordervol long, sideflag smallint, ordertype int, seq long"
TRADE = "symbol long, channelid int, tradebuyid long, tradesellid long, tradetm long, tradepx double, tradevol long, {kind} smallint, seq long"


def inputs(spark, new, traded, kind):
    o = spark.createDataFrame([(*r, i) for i, r in enumerate(new)], ORDER)
    t = spark.createDataFrame([(*r, i) for i, r in enumerate(traded)], TRADE.format(kind=kind))
    return o, t


def test_sh_withdrawal(spark):
    life = orders.sh_lifecycle(*inputs(spark, [(600000, 1, 100, 93_000_000, 10.5, 1000, 66, 65), (600000, 1, 100, 93_001_000, 10.5, 1000, 66, 68)], [], "sideflag"))
    assert life.orders.count() == 1
    w = life.withdraws.first()
    assert w.withdrawvol == 1000 and w.withdrawtmlag == 1000 and w.withdrawmoney == 10_500
    assert orders.still_open(life).count() == 0


def test_sh_order_known_by_its_trades_alone(spark):
    life = orders.sh_lifecycle(*inputs(spark, [(600000, 1, 200, 93_000_000, 10.5, 500, 83, 65)], [(600000, 1, 300, 200, 93_001_000, 10.5, 200, 66), (600000, 1, 300, 200, 93_002_000, 10.6, 100, 66)], "sideflag"))
    known = {r.orderid: r for r in life.orders.collect()}
    assert len(known) == 2 and known[300].ordervol == 300 and known[300].orderpx == 10.6 and known[300].ordertm == 93_001_000
    assert {r.orderid for r in orders.still_open(life).collect()} == {200}


def test_sz_withdrawal_in_the_trade_stream(spark):
    life = orders.sz_lifecycle(*inputs(spark, [(1000, 1, 100, 93_000_000, 10.0, 500, 66, 50)], [(1000, 1, 100, 0, 93_001_000, 0.0, 500, 52)], "tradetype"))
    w = life.withdraws.first()
    assert (w.orderid, w.side, w.withdrawpx) == (100, 66, 10.0) and life.trades.count() == 0


def test_sz_market_order_takes_the_last_opposite_price(spark):
    traded = [(1000, 1, 50, 60, 93_000_000, 10.0, 100, 70)]
    life = orders.sz_lifecycle(*inputs(spark, [(1000, 1, 200, 93_001_000, 0.0, 100, 66, 49), (1000, 1, 201, 92_900_000, 0.0, 100, 66, 49)], traded, "tradetype"))
    px = {r.orderid: r.orderpx for r in life.orders.collect()}
    assert px[200] == pytest.approx(10.01) and px[201] is None


def test_sz_side_of_a_trade(spark):
    new = [(1000, 1, 100, 93_000_000, 10.0, 500, 66, 50), (1000, 1, 200, 93_000_500, 10.0, 500, 83, 50)]
    t = orders.sz_lifecycle(*inputs(spark, new, [(1000, 1, 100, 200, 93_001_000, 10.0, 100, 70)], "tradetype")).trades.first()
    assert t.side == 83 and t.ordertmlag == 500 and t.ordermoneydiff == 0


def test_unmatched_trades_have_no_lag(spark):
    t = orders.sz_lifecycle(*inputs(spark, [], [(1000, 1, 100, 200, 93_001_000, 10.0, 100, 70)], "tradetype")).trades.first()
    assert t.ordertmlag is None and t.ordermoneydiff is None and t.trademoney == 1000


def test_unknown_sides_are_left_out(spark):
    life = orders.sh_lifecycle(*inputs(spark, [(600000, 1, 100, 93_000_000, 10.5, 1000, 0, 65)], [], "sideflag"))
    assert life.orders.count() == 0


def test_snapshot_has_492_factors_in_order(spark):
    names = factors.names()
    assert len(names) == 492 and len(set(names)) == 492
    assert names[0] == "buy_order_count" and names[36] == "buy_withdraw_count" and names[156] == "both_trade_count" and names[-1] == "sell_trade_sellorder_count_sosmall"
    life = orders.sh_lifecycle(*inputs(spark, [(600000, 1, 200, 93_000_000, 10.5, 500, 83, 65)], [(600000, 1, 300, 200, 93_001_000, 10.5, 200, 66), (600000, 1, 301, 200, 93_002_000, 10.5, 100, 78)], "sideflag"))
    row = factors.snapshot(life).first()
    assert list(row.asDict()) == ["symbol", *names]
    assert row.both_trade_count == 2 and row.buy_trade_count == 1 and row.sell_trade_count == 0  # neutral trades count in both_
    assert row.both_trade_buyorder_count == 2 and row.both_trade_sellorder_count == 1 and row.buy_order_count == 1 and row.sell_order_count == 1


def test_streaming_lifecycle(spark, tmp_path):
    rows = [
        ("SH", 600000, datetime.date(2024, 1, 2), 93_000_000, 0, "order", 83, 200, 0, 10.5, 500),
        ("SH", 600000, datetime.date(2024, 1, 2), 93_001_000, 1, "trade", 66, 300, 200, 10.5, 200),
        ("SH", 600000, datetime.date(2024, 1, 2), 93_002_000, 2, "withdraw", 83, 200, 0, 10.5, 300),
        ("SH", 600000, datetime.date(2024, 1, 2), 93_003_000, 3, "trade", 83, 400, 500, 10.4, 100),
    ]
    for r in rows:
        spark.createDataFrame([r], flow.EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(flow.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with flow.keyed_state(spark):
        flow.order_flow(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(flow.FLOW).parquet(str(tmp_path / "out")).orderBy("tm", "kind").collect()
    assert [(r.kind, r.id, r.lag_ms) for r in got] == [("order", 200, None), ("order", 300, None), ("trade", 300, 1000), ("withdraw", 200, 2000), ("order", 500, None), ("trade", 400, None)]


def test_cumulative_distinct_counts_first_appearances(spark):
    t = spark.createDataFrame([(1, 1, 7, 931), (1, 1, 7, 932), (1, 1, 8, 932), (1, 1, 8, 935)], "symbol long, channelid int, tradebuyid long, label int")
    got = {r.label: r.buyorders for r in factors.cumulative_distinct(t, "buy").collect()}
    assert got == {931: 1, 932: 2}


def test_cumulative_factors_have_all_families_at_all_times(spark):
    from tickloom.plans import q_orders

    sf = "/root/testdata/sf0.001"
    got = q_orders.d13_all(spark, sf)
    assert got.columns == ["symbol", "label", *factors.names()]
    day = {r.symbol: r for r in q_orders.d14(spark, sf).collect()}
    rows = got.collect()
    assert len(rows) == 9 * len(day) and {r.label for r in rows} == set(factors.TIMES)
    counts = [c for c in factors.names() if "_count" in c]
    # what depends on an order's size differs, as that is the size known in the minute here, and the day's there
    whole = [c for c in counts if c.endswith(("_trade_count", "_trade_count_large", "_trade_count_small", "_withdraw_count", "order_count")) and c not in ("buy_order_count", "sell_order_count")]
    assert len(whole) == 17 and all(r[c] == day[r.symbol][c] for r in rows if r.label == 1500 for c in whole)
    for symbol in day:
        own = sorted((r for r in rows if r.symbol == symbol), key=lambda r: r.label)
        assert all(x[c] <= y[c] for x, y in zip(own, own[1:]) for c in counts)
    assert any(r[c] for r in rows if r.label == 1130 for c in counts if c.startswith("sell_withdraw"))


def test_a_row_is_added_up_once_for_all_its_buckets(spark):
    """Rows meet their buckets only as sums; counts and distinct orders at two times equal plain ones."""
    rng = random.Random(3)
    traded = [(600000 + rng.randint(0, 1), 1, rng.randint(1, 6), rng.randint(7, 12), rng.choice([93_000_000, 95_500_000, 144_500_000]), 10.0 + rng.randint(0, 200), rng.choice([10, 1000, 20_000, 200_000]), rng.choice([66, 83, 78])) for _ in range(200)]
    o, t = inputs(spark, [(600000, 1, 1, 92_900_000, 10.0, 100, 66, 65)], traded, "sideflag")
    life = orders.sh_lifecycle(o, t)
    rows = factors.stacked(life, {"trade": F.when(F.col("tradetm") < 94_000_000, 0).when(F.col("tradetm") < 100_000_000, 1).otherwise(2)})
    plan = factors.moments(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate") and plan.count("Aggregate") == 2 + factors.stacked(life, {"trade": F.lit(0)})._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")
    got = {(r.symbol, r.label, r.key): r.stats for r in factors.distinct_orders(rows, (0, 1)).collect()}
    at = lambda tm: 0 if tm < 94_000_000 else 1 if tm < 100_000_000 else 2
    for symbol in (600000, 600001):
        for label in (0, 1):
            for prefix, sides in (("both", (66, 83, 78)), ("buy", (66,)), ("sell", (83,))):
                for bucket, test in (("", lambda v, m: True), ("large", lambda v, m: v >= 100_000 or m >= 1_000_000), ("small", lambda v, m: v <= 10_000 and m <= 100_000 or v <= 1000 and m <= 500_000)):
                    own = [x for x in traded if x[0] == symbol and at(x[4]) <= label and x[7] in sides and test(x[6], x[6] * x[5])]
                    want = [len({x[2] for x in own}), len({x[3] for x in own})]
                    assert got.get((symbol, label, f"{prefix}|trade|{bucket}|orders"), [0, 0]) == want
