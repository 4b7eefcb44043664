"""Lifecycles as of each increment against a replay in plain Python, minute by minute, with a dictionary of open orders."""

import datetime
import random
from collections import defaultdict

import pytest

from tickloom.plans import factors, increments, orders, q_orders
from tickloom.session import checkpointed
from tickloom.streaming import flow

from .test_orders import inputs

BUY, SELL = 66, 83


def minute(tm):
    hhmm = tm // 100_000
    return hhmm + 1 if hhmm % 100 != 59 else (hhmm // 100 + 1) * 100


def made(seed, exchange, n=300):
    """Few orders, so that they trade in many minutes, after they were filled, and after they were withdrawn."""
    rng = random.Random(seed)
    tm = lambda: 93_000_000 + rng.randint(0, 11) * 100_000 + rng.randint(0, 59) * 1000
    new, traded = [], []
    for i in range(1, 40):
        side, sent = rng.choice([BUY, SELL]), tm()
        if rng.random() < 0.8:
            new.append((600000 + i % 3, 1, i, sent, 10 + rng.randint(0, 9) / 10, rng.randint(1, 9) * 100, side, 65 if exchange == "SH" else rng.choice([49, 50, 85])))
        if exchange == "SH" and rng.random() < 0.3:
            new.append((600000 + i % 3, 1, i, tm(), 10.5, rng.randint(1, 9) * 100, side, 68))
    for _ in range(n):
        a, b = rng.randint(1, 39), rng.randint(1, 39)
        if exchange == "SH":
            traded.append((600000 + a % 3, 1, a, b, tm(), 10 + rng.randint(0, 9) / 10, rng.randint(1, 3) * 100, rng.choice([BUY, SELL, 78])))
        elif rng.random() < 0.15:
            traded.append((600000 + a % 3, 1, *rng.choice([(a, 0), (0, b)]), tm(), 0.0, rng.randint(1, 9) * 100, 52))
        else:
            traded.append((600000 + a % 3, 1, a, b, tm(), 10 + rng.randint(0, 9) / 10, rng.randint(1, 3) * 100, 70))
    return new, traded


def replay(exchange, new, traded, priced):
    """(orders, withdrawals, trades) with what was known in their minute. priced: prices of Shenzhen's orders."""
    minutes = sorted({minute(r[3]) for r in new} | {minute(r[4]) for r in traded})
    live, out = {}, ([], [], [])
    for m in minutes:
        messages, gone, did, took = {}, defaultdict(int), defaultdict(int), defaultdict(list)
        for symbol, _, i, tm, px, vol, side, kind in new:
            if minute(tm) == m:
                if kind == 68 and exchange == "SH":
                    gone[side, i] = max(gone[side, i], vol)
                else:
                    messages[side, i] = (symbol, tm, px if exchange == "SH" else priced[i], vol)
        pairs = []
        for seq, (symbol, _, a, b, tm, px, vol, kind) in enumerate(traded):
            if minute(tm) != m:
                continue
            if exchange == "SZ" and kind == 52:
                gone[(BUY, a) if b == 0 else (SELL, b)] = max(gone[(BUY, a) if b == 0 else (SELL, b)], vol)
                continue
            side = kind if exchange == "SH" else (BUY if a > b else SELL)
            pairs.append((a, b, tm, vol, side, px))
            did[BUY, a] += vol
            did[SELL, b] += vol
            if exchange == "SH" and side in (BUY, SELL):
                took[(BUY, a) if side == BUY else (SELL, b)].append((tm, seq, symbol, px, vol))
        seen = {}
        for k in set(messages) | set(gone) | set(did):
            state = live.get(k)
            grown = sum(x[4] for x in took[k])
            if k in messages or (took[k] and state is None):
                first = min(took[k]) if took[k] else None
                symbol, tm, px, vol = messages.get(k) or (first[2], first[0], (max if k[0] == BUY else min)(x[3] for x in took[k]), 0)
                state = [symbol, tm, px, vol + grown, 0]
                out[0].append((k[1], k[0], symbol, tm, px, vol + grown, m))
            elif state is not None:
                state[3] += grown
            seen[k] = tuple(state) if state else None
            if state is not None:
                state[4] += did[k]
                if state[4] >= state[3] or (k in gone and gone[k] >= state[3]):
                    live.pop(k, None)
                else:
                    live[k] = state
        for symbol, _, i, tm, _, vol, side, kind in new:
            if exchange == "SH" and kind == 68 and minute(tm) == m:
                x = seen[side, i]
                out[1].append((i, side, tm, vol, x and x[3], x and x[1]))
        for _, _, a, b, tm, _, vol, kind in traded:
            if exchange == "SZ" and kind == 52 and minute(tm) == m:
                k = (BUY, a) if b == 0 else (SELL, b)
                x = seen[k]
                out[1].append((k[1], k[0], tm, vol, x and x[3], x and x[1]))
        for a, b, tm, vol, side, _ in pairs:
            x, y = seen[BUY, a], seen[SELL, b]
            out[2].append((a, b, tm, vol, side, x and x[3], y and y[3]))
    return [sorted(x, key=str) for x in out], live


def rows_of(found):
    life = found.life
    known = [(r.orderid, r.side, r.symbol, r.ordertm, r.orderpx, r.ordervol, r.inc) for r in life.orders.collect()]
    gone = [(r.orderid, r.side, r.withdrawtm, r.withdrawvol, r.ordervol, r.ordertm) for r in life.withdraws.collect()]
    done = [(r.tradebuyid, r.tradesellid, r.tradetm, r.tradevol, r.side, r.ordervol_buy, r.ordervol_sell) for r in life.trades.collect()]
    return [sorted(x, key=str) for x in (known, gone, done)]


@pytest.mark.parametrize(("exchange", "seed"), [("SH", 1), ("SH", 2), ("SZ", 3), ("SZ", 4)])
def test_lifecycle_equals_a_replay(spark, exchange, seed):
    new, traded = made(seed, exchange)
    o, t = inputs(spark, new, traded, "sideflag" if exchange == "SH" else "tradetype")
    priced = {r.orderid: r.orderpx for r in orders.sz_orders(o, orders.sz_trades(t)).collect()} if exchange == "SZ" else {}
    found = increments.as_of(exchange, o, t, q_orders._minute, keep=checkpointed)
    want, live = replay(exchange, new, traded, priced)
    assert rows_of(found) == want
    assert {(r.side, r.orderid): (r.ordertm, r.ordervol, r.traded) for r in found.open.collect()} == {k: (x[1], x[3], x[4]) for k, x in live.items()}
    again = defaultdict(set)
    for i, side, _, _, _, _, m in want[0]:
        again[i, side].add(m)
    if exchange == "SH":
        assert max(map(len, again.values())) > 2  # orders that were filled and came again


def test_a_day_in_several_runs_equals_one(spark):
    o, t = inputs(spark, *made(5, "SH"), "sideflag")
    whole = increments.as_of("SH", o, t, q_orders._minute, keep=checkpointed)
    runs = increments.worked_off("SH", o, t, q_orders._minute, [932, 936, 937, 2400], checkpointed)
    parts = [rows_of(r) for r in runs]
    assert [sorted(sum((p[k] for p in parts), []), key=str) for k in range(3)] == rows_of(whole)
    assert sorted(runs[-1].open.collect()) == sorted(whole.open.collect())
    one = {k: v for k, v in zip(("order", "withdraw", "trade"), (factors.F.col("inc"),) * 3, strict=True)}
    names = ["symbol", "family", "prefix", "bucket", "label"]
    total = lambda x: {tuple(r[n] for n in names): (r["count"], r.vol, r.x0_n) for r in factors.added(x).collect()}
    apart = None
    for r in runs:
        m = factors.moments(factors.stacked(r.life, one).withColumn("label", factors.F.lit(0)))
        apart = m if apart is None else apart.unionByName(m)
    assert total(apart) == total(factors.moments(factors.stacked(whole.life, one).withColumn("label", factors.F.lit(0))))


@pytest.mark.parametrize("upto", [933, 937])
def test_later_rows_change_nothing_before(spark, upto):
    new, traded = made(6, "SH")
    o, t = inputs(spark, new, traded, "sideflag")
    early = increments.as_of("SH", o.filter(q_orders._minute(factors.F.col("ordertm")) <= upto), t.filter(q_orders._minute(factors.F.col("tradetm")) <= upto), q_orders._minute, keep=checkpointed)
    whole = increments.as_of("SH", o, t, q_orders._minute, keep=checkpointed).life
    kept = increments.SoFar(orders.Lifecycle(*[x.filter(f"inc <= {upto}") for x in (whole.orders, whole.withdraws, whole.trades)]), early.open)
    assert rows_of(kept) == rows_of(early)


def test_stream_state_holds_active_orders_only_and_ends_with_the_day(spark, tmp_path):
    day = datetime.date(2024, 1, 2)
    batches = [[("SH", 1, day, 93_000_000 + 1000 * k, k, "order", BUY, 100 * b + k, 0, 10.0, 100) for k in range(40)] for b in range(3)]
    batches.append([("SH", 1, day, 94_000_000, k, "trade", 78, k, 9000 + k, 10.0, 100) for k in range(40)])
    batches += [[("SH", 2, day + datetime.timedelta(days=1), 93_000_000, 0, "order", BUY, 5, 0, 10.0, 100)] for _ in range(2)]
    for rows in batches:
        spark.createDataFrame(rows, flow.EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(flow.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with flow.keyed_state(spark):
        q = flow.order_flow(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
    done = {p["batchId"]: p["stateOperators"][0] for p in q.recentProgress}
    assert [done[k]["numRowsUpdated"] for k in range(4)] == [40, 40, 40, 0]
    assert [done[k]["numRowsTotal"] for k in range(4)] == [40, 80, 120, 80] and done[3]["numRowsRemoved"] == 40
    left = spark.read.format("statestore").option("stateVarName", "orders").load(str(tmp_path / "c")).collect()
    assert [(r.key.symbol, r.user_map_key.id) for r in left] == [(2, 5)]


def test_messages_are_dealt_once_and_folded_in_batches(spark):
    """One shuffle and no array of steps; batches of few rows, which cut orders apart, change nothing."""
    o, t = inputs(spark, *made(7, "SH", 900), "sideflag")
    labelled = lambda rows, tm: rows.withColumn("inc", q_orders._minute(factors.F.col(tm)).cast("long"))
    legs = increments.legs(labelled(orders.sh_new(o), "ordertm"), labelled(orders.sh_withdraws(o), "withdrawtm"), labelled(orders.sh_trades(t), "tradetm"), True)
    found = increments.folded(legs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "collect_list" not in plan
    out = []
    for rows in (3, 50_000):
        with increments._batches(spark, rows):
            out.append(sorted(map(str, increments.folded(legs).collect())))
    assert out[0] == out[1] and len(out[0]) > 500


@pytest.mark.parametrize("relative", [False, True])
def test_trades_are_dealt_twice_and_never_joined_or_written(spark, relative):
    """From messages to statistics there is one job, in which both sums read the shuffle of the second fold; days are broadcast."""
    o, t = inputs(spark, *made(8, "SH", 500), "sideflag")
    days = spark.createDataFrame([(600000, 10.0, 1e6), (600001, None, 2e6)], "symbol long, pre_close double, cap double") if relative else None
    held = []

    def keep(rows):
        held.append(rows)
        return spark.createDataFrame(rows.collect(), rows.schema)

    found = increments.as_of("SH", o, t, q_orders._minute, days, parts=3, left=False)
    how = {"families": factors.RELATIVE} if relative else {}
    assert factors.snapshots_so_far(found.rows, keep=keep, parts=3, **how).count() == 27
    plan = held[0]._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and ("BroadcastHashJoin" in plan) == relative
    assert plan.count("ReusedExchange") >= 1 and plan.count("ShuffleQueryStage") >= 3
    dealt = plan.count("Exchange hashpartitioning(channelid")  # the first fold, the second, and what says that it is read again
    assert dealt == 3 and plan.count("], Exchange hashpartitioning(channelid") == 1


def test_orders_without_channel_are_found_by_nothing(spark):
    o, t = inputs(spark, [(600000, 1, 1, 93_000_000, 10.0, 500, BUY, 65)], [(600000, 1, 1, 2, 93_001_000, 10.0, 100, 78)], "sideflag")
    found = increments.as_of("SH", o.withColumn("channelid", factors.F.lit(None).cast("int")), t.withColumn("channelid", factors.F.lit(None).cast("int")), q_orders._minute)
    assert rows_of(found)[2] == [(1, 2, 93_001_000, 100, 78, None, None)]


def test_a_batch_of_many_orders_is_one_value_of_state_and_equals_one_by_one(spark, tmp_path):
    """Of a symbol, a task holds a chunk of one side's orders; what is known of an order is the same however it is kept."""
    rng, day = random.Random(9), datetime.date(2024, 1, 2)
    rows, n = [], 12_000
    for k in range(n):
        tm = 93_000_000 + k // 600 * 100_000 + k % 600 * 100
        if k < n // 2:
            rows.append(("SH", 1, day, tm, k, "order", BUY if k % 2 == 0 else SELL, k, 0, 10.0, 100 * rng.randint(1, 9)))
        elif rng.random() < 0.1:
            own = rng.randrange(n // 2)
            rows.append(("SH", 1, day, tm, k, "withdraw", BUY if own % 2 == 0 else SELL, own, 0, 10.0, 100 * rng.randint(1, 9)))
        else:
            rows.append(("SH", 1, day, tm, k, "trade", rng.choice([BUY, SELL, 78]), 2 * rng.randrange(n // 4), 2 * rng.randrange(n // 4) + 1, 10.0, 100 * rng.randint(1, 3)))
    cuts = [0, n // 2, n // 2 + 40, n - 2000, n]
    for a, b in zip(cuts, cuts[1:]):
        spark.createDataFrame(rows[a:b], flow.EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(flow.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with flow.keyed_state(spark):
        q = flow.order_flow(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
    held, want = {}, []
    for _, _, _, tm, seq, kind, side, own, other, _, vol in rows:
        if kind == "order":
            held[side, own] = [vol, tm, 0]
            want.append((seq, kind, own, vol, tm, None, None))
        elif kind == "withdraw":
            x = held.get((side, own))
            want.append((seq, kind, own, x and x[0], x and x[1], None, None))
            if x and vol >= x[0] - x[2]:
                del held[side, own]
        else:
            legs = (BUY, own), (SELL, other)
            if side in (BUY, SELL):
                k = legs[side == SELL]
                if k in held:
                    held[k][0] += vol
                else:
                    held[k] = [vol, tm, 0]
                    want.append((seq, "order", k[1], vol, tm, None, None))
            a, b = (held.get(k) for k in legs)
            want.append((seq, kind, own, a and a[0], a and a[1], b and b[0], b and b[1]))
            for k in legs:
                if x := held.get(k):
                    x[2] += vol
                    if x[2] >= x[0]:
                        del held[k]
    got = [(r.seq, r.kind, r.id, r.order_vol, r.order_tm, r.other_vol, r.other_tm) for r in spark.read.schema(flow.FLOW).parquet(str(tmp_path / "out")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    values = spark.read.format("statestore").option("stateVarName", "packed").load(str(tmp_path / "c")).collect()
    single = spark.read.format("statestore").option("stateVarName", "orders").load(str(tmp_path / "c")).collect()
    buys = sum(len(r.user_map_value.orders) // flow.ORDER.itemsize for r in values) + len(single)
    assert buys == sum(side == BUY for side, _ in held) and 1 < len(values) <= flow.CHUNKS
    assert len(q.recentProgress[0]["stateOperators"]) == 2


def test_only_trades_on_arrival_carry_their_number(spark):
    """It says which of them is an order's first, and is of no use else, so a shuffle has it for them alone."""
    o, t = inputs(spark, *made(10, "SH", 200), "sideflag")
    labelled = lambda rows, tm: rows.withColumn("inc", q_orders._minute(factors.F.col(tm)).cast("long"))
    own = increments.legs(labelled(orders.sh_new(o), "ordertm"), labelled(orders.sh_withdraws(o), "withdrawtm"), labelled(orders.sh_trades(t), "tradetm"), True, None, BUY)
    assert own.filter("kind >= 2 AND flag = 78").count() > 0 and own.filter("seq IS NOT NULL").select("flag").distinct().count() == 2
    onward = increments._onward(increments.folded(own), True, False)
    assert {r.flag for r in onward.filter("seq IS NOT NULL").collect()} == {SELL}
