"""Joins, aggregates, windows, sorts and set operations over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import moments as m
from ..functions import times, values
from ..operators import compare, joins, sets, windows
from ..session import table
from .catalog import query
from .q_scalars import EV_SQL, ev

c = F.col


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# --- joins -----------------------------------------------------------------------------------------------------------


@query("j1_left_join", "SELECT e.event_id, s.n, s.top FROM events e LEFT JOIN (SELECT user_id, count(*) AS n, max(value) AS top FROM events WHERE event_type = 'purchase' GROUP BY user_id) s ON s.user_id = e.user_id")
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    s = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").alias("top"))
    return e.join(s, "user_id", "left").select("event_id", "n", "top")


def _rack(codes: DataFrame) -> DataFrame:
    """Each code with each of the 240 labels: rows are made in place, nothing is joined."""
    return codes.select("user_id").distinct().withColumn("label", F.explode(times.labels()))


@query("j2_code_minute_rack", "SELECT u.user_id, CAST(m // 60 * 100 + m % 60 AS INTEGER) AS label FROM (SELECT DISTINCT user_id FROM events) u, (SELECT unnest(range(571, 691)) AS m UNION ALL SELECT unnest(range(781, 901)))")
def j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rack(events(spark, sf_dir))


@query("j3_inner_join", "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate WHERE l_quantity > 40")
def j3(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = table(spark, sf_dir, "lineitem").filter("l_quantity > 40"), table(spark, sf_dir, "orders")
    return l.join(o, (l.l_orderkey == o.o_orderkey) & (l.l_shipdate >= o.o_orderdate)).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query("j4_full_outer_coalesce", "SELECT coalesce(o.o_orderkey, l.k) AS orderid, coalesce(o.o_totalprice, 0) AS price, CAST(coalesce(l.q, 0) AS DOUBLE) AS traded FROM (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) o FULL JOIN (SELECT l_orderkey AS k, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey) l ON o.o_orderkey = l.k")
def j4(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 3 <> 0").select(c("o_orderkey").alias("orderid"), "o_totalprice")
    t = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'").groupBy(c("l_orderkey").alias("orderid")).agg(F.sum("l_quantity").alias("q"))
    return o.join(t, "orderid", "full").select("orderid", F.coalesce("o_totalprice", F.lit(0.0)).alias("price"), F.coalesce("q", F.lit(0.0)).alias("traded"))


@query("j5_trade_with_both_orders", "SELECT l_orderkey, l_linenumber, l_partkey, a.o_totalprice AS buy_price, b.o_totalprice AS sell_price FROM lineitem LEFT JOIN orders a ON a.o_orderkey = l_orderkey AND a.o_orderkey % 4 <> 0 LEFT JOIN orders b ON b.o_orderkey = l_partkey")
def j5(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    buy = o.filter("o_orderkey % 4 <> 0").select(c("o_orderkey").alias("l_orderkey"), c("o_totalprice").alias("buy_price"))
    sell = o.select(c("o_orderkey").alias("l_partkey"), c("o_totalprice").alias("sell_price"))
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return l.join(buy, "l_orderkey", "left").join(sell, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "buy_price", "sell_price")


@query("j6_withdraw_with_order", "SELECT l_orderkey, l_partkey, l_linenumber, o_orderdate, l_quantity = q AS complete FROM lineitem LEFT JOIN (SELECT o_orderkey, o_orderdate, o_orderkey % 50 AS q FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'")
def j6(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(c("o_orderkey").alias("l_orderkey"), "o_orderdate", (c("o_orderkey") % 50).alias("q"))
    w = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return w.join(o, "l_orderkey", "left").select("l_orderkey", "l_partkey", "l_linenumber", "o_orderdate", values.is_complete(c("l_quantity"), c("q")).alias("complete"))


@query("j7_as_of", "SELECT p.event_id, v.value AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts")
def j7(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    views = e.filter("event_type = 'view'").select("user_id", "ts", c("value").alias("last_view"), "event_id")
    return joins.as_of_backward(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, ["user_id"], "ts", "ts", ["last_view"], tie="event_id").select("event_id", "last_view")


@query("j9_base_and_conditional", "SELECT user_id, count(*) AS n, count(*) FILTER (WHERE value > 50) AS n_large, round(sum(value) FILTER (WHERE value > 50), 6) AS money_large FROM events GROUP BY user_id")
def j9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and conditional statistics are one aggregate, so nothing has to be joined."""
    big = c("value") > 50
    return events(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(big).alias("n_large"), F.round(F.sum(F.when(big, c("value"))), 6).alias("money_large"))


@query("j10_universe_rack", "SELECT c.c_custkey, b.n AS n_orders, l.n AS n_events FROM customer c LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey) b ON b.k = c_custkey LEFT JOIN (SELECT user_id AS k, count(*) AS n FROM events GROUP BY user_id) l ON l.k = c_custkey")
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rack = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    e = events(spark, sf_dir).groupBy(c("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events"))
    return rack.join(o, "c_custkey", "left").join(e, "c_custkey", "left")


TWO_SQL = "a AS (SELECT event_id, value FROM events WHERE event_id % 7 <> 0), b AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN value + 0.5 WHEN event_id % 5 = 1 THEN value + 1e-8 ELSE value END AS value FROM events WHERE event_id % 11 <> 0)"


def two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of a dataset that differ in some keys and some values."""
    e = events(spark, sf_dir).select("event_id", "value")
    r = c("event_id") % 5
    return e.filter("event_id % 7 <> 0"), e.filter("event_id % 11 <> 0").withColumn("value", F.when(r == 0, c("value") + 0.5).when(r == 1, c("value") + 1e-8).otherwise(c("value")))


@query("j11_presence", f"WITH {TWO_SQL} SELECT coalesce(a.event_id, b.event_id) AS event_id, CASE WHEN b.event_id IS NULL THEN 'left_only' WHEN a.event_id IS NULL THEN 'right_only' ELSE 'both' END AS presence FROM a FULL JOIN b ON a.event_id = b.event_id")
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.with_presence(*two(spark, sf_dir), ["event_id"], ["value"]).select("event_id", "presence")


@query("j12_only_generated", f"WITH {TWO_SQL} SELECT count(*) FILTER (WHERE b.event_id IS NULL) AS only_a, count(*) FILTER (WHERE a.event_id IS NULL) AS only_b, count(*) FILTER (WHERE abs(a.value - b.value) < 1e-4) AS same FROM a FULL JOIN b ON a.event_id = b.event_id")
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = joins.with_presence(*two(spark, sf_dir), ["event_id"], ["value"])
    return d.agg(F.count_if(c("presence") == "left_only").alias("only_a"), F.count_if(c("presence") == "right_only").alias("only_b"), F.count_if(F.abs(c("value_a") - c("value_b")) < 1e-4).alias("same"))


@query("j13_semi_join", "SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) > 12)")
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    some = e.filter("event_type = 'error'").groupBy("user_id").count().filter("count > 12").select("user_id")
    return e.join(some, "user_id", "left_semi").select("event_id")


@query("j14_anchor_rows", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')) WHERE n = 1")
def j14(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return joins.anchor_rows(e, e.filter("event_type = 'signup'"), ["user_id"], c("ts")).select("user_id", "event_id")


@query("j15_keyed_update", f"WITH {TWO_SQL} SELECT a.event_id, coalesce(CASE WHEN b.event_id % 2 = 0 THEN b.value END, a.value) AS value FROM a LEFT JOIN b ON a.event_id = b.event_id")
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = two(spark, sf_dir)
    return joins.keyed_update(a, b.withColumn("value", F.when(c("event_id") % 2 == 0, c("value"))), ["event_id"], ["value"])


# --- aggregates ------------------------------------------------------------------------------------------------------


@query("a1_first_last", "SELECT user_id, arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_value FROM events GROUP BY user_id")
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    return events(spark, sf_dir).groupBy("user_id").agg(F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"))


@query("a2_basic", "SELECT event_type, min(value) AS low, max(value) AS high, round(sum(value), 4) AS total, bool_or(value > 499) AS any_large, count(*) AS n FROM events GROUP BY event_type")
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.sum("value"), 4).alias("total"), F.bool_or(c("value") > 499).alias("any_large"), F.count("*").alias("n"))


@query("a3_ohlc", "SELECT user_id, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS bar, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close FROM events GROUP BY ALL")
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    return events(spark, sf_dir).groupBy("user_id", (F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.expr(times.ONE_MINUTE)).alias("bar")).agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"))


SCALE = {1: 1.0, 2: 1.0, 3: 1e3, 4: 1e6}
POWERS = "count(value) AS value_n, " + ", ".join(f"round(sum(pow(value, {k})) / {SCALE[k]}, 4) AS value_s{k}" for k in (1, 2, 3, 4))


@query("a4_power_sums", f"SELECT user_id, {POWERS} FROM events GROUP BY user_id")
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = events(spark, sf_dir).groupBy("user_id").agg(*m.power_sums(c("value"), "value"))
    return out.select("user_id", "value_n", *[F.round(c(f"value_s{k}") / SCALE[k], 4).alias(f"value_s{k}") for k in (1, 2, 3, 4)])


BUCKETS_SQL = ", ".join(f"count(*) FILTER (WHERE {w}) AS count{t}, round(sum(vol) FILTER (WHERE {w}), 2) AS vol{t}, round(avg(value) FILTER (WHERE {w}), 9) AS mean{t}" for t, w in (("", "true"), ("_large", "vol >= 100000 OR value >= 1000000"), ("_small", "vol <= 10000 AND value <= 100000 OR vol <= 1000 AND value <= 500000")))


@query("a5_conditional", f"WITH {EV_SQL} SELECT user_id, {BUCKETS_SQL} FROM ev GROUP BY user_id")
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, x = c("vol"), c("value")
    out = ev(spark, sf_dir).groupBy("user_id").agg(*m.bucketed(v, x, {"x": x}, {"": None, "large": values.is_large(v, x), "small": values.is_small(v, x)}))
    return out.select("user_id", *[col for t in ("", "_large", "_small") for col in (c(f"count{t}"), c(f"vol{t}"), F.round(m.mean(f"x{t}"), 9).alias(f"mean{t}"))])


@query("a6_merge_increments", f"SELECT user_id, {POWERS} FROM events GROUP BY user_id")
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of each day, merged."""
    daily = events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(*m.power_sums(c("value"), "value"))
    out = daily.groupBy("user_id").agg(*m.merged("value"))
    return out.select("user_id", "value_n", *[F.round(c(f"value_s{k}") / SCALE[k], 4).alias(f"value_s{k}") for k in (1, 2, 3, 4)])


STATS_SQL = "avg(value) AS mean, stddev_samp(value) AS std, count(value) AS n, sum(value) AS s1, sum(pow(value, 2)) AS s2, sum(pow(value, 3)) AS s3, sum(pow(value, 4)) AS s4"


@query("a7_a10_statistics", f"SELECT user_id, round(mean, 9) AS value_mean, round(std, 5) AS value_std, CASE WHEN n >= 3 AND m2 > 0.0009765625 * mu * mu THEN round((s3 / n - 3 * mu * s2 / n + 2 * mu * mu * mu) / pow(m2, 1.5), 5) END AS value_skew, CASE WHEN n >= 4 AND m2 > 0.0009765625 * mu * mu THEN round((s4 / n - 4 * mu * s3 / n + 6 * mu * mu * s2 / n - 3 * mu * mu * mu * mu) / (m2 * m2) - 3, 5) END AS value_kurt FROM (SELECT *, s1 / n AS mu, s2 / n - (s1 / n) * (s1 / n) AS m2 FROM (SELECT user_id, {STATS_SQL} FROM events GROUP BY user_id))")
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = events(spark, sf_dir).groupBy("user_id").agg(*m.power_sums(c("value"), "value")).select("user_id", *m.stats("value"))
    return out.select("user_id", F.round("value_mean", 9).alias("value_mean"), *[F.round(f"value_{k}", 5).alias(f"value_{k}") for k in ("std", "skew", "kurt")])


@query("a11_vwap", "SELECT l_suppkey, round(CASE WHEN sum(l_quantity) > 0 THEN sum(l_extendedprice) / sum(l_quantity) END, 6) AS vwapx FROM lineitem GROUP BY l_suppkey")
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("vol"), F.sum("l_extendedprice").alias("money"))
    return s.select("l_suppkey", F.round(m.vwapx(), 6).alias("vwapx"))


@query("a12_distinct_orders", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n, count(DISTINCT l_orderkey) FILTER (WHERE l_quantity >= 25) AS n_large, count(DISTINCT l_orderkey) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY l_suppkey")
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags per order, then their sums: no sets, no multiplied rows."""
    flag = lambda cond: F.max(F.coalesce(cond, F.lit(False)).cast("long"))
    per = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(flag(F.lit(True)).alias("n"), flag(c("l_quantity") >= 25).alias("n_large"), flag(c("l_returnflag") == "R").alias("n_returned"))
    return per.groupBy("l_suppkey").agg(*[F.sum(k).alias(k) for k in ("n", "n_large", "n_returned")])


@query("a12_mergeable_orders", "WITH t AS (SELECT l_suppkey % 40 AS symbol, l_linenumber AS inc, l_orderkey, l_quantity >= 25 AS large FROM lineitem), i AS (SELECT DISTINCT symbol, inc FROM t) SELECT i.symbol, i.inc, count(DISTINCT l_orderkey) AS n, count(DISTINCT l_orderkey) FILTER (WHERE large) AS n_large FROM i JOIN t ON t.symbol = i.symbol AND t.inc <= i.inc GROUP BY i.symbol, i.inc")
def a12_mergeable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different orders of each symbol up to each increment: exact sets per increment, merged without the trades."""
    t = table(spark, sf_dir, "lineitem").select((c("l_suppkey") % 40).alias("symbol"), c("l_linenumber").alias("inc"), "l_orderkey", (c("l_quantity") >= 25).alias("large"))
    rows = t.join(sets.numbered(t, ["symbol"], ["l_orderkey"]), ["symbol", "l_orderkey"])
    each = sets.bitmaps(rows, ["symbol", "inc"]).withColumn("bucket", F.lit("n")).unionByName(sets.bitmaps(rows.filter("large"), ["symbol", "inc"]).withColumn("bucket", F.lit("n_large")))
    asked = t.select("symbol", c("inc").alias("upto")).distinct()
    so_far = sets.merged_bitmaps(each.join(asked, "symbol").filter("inc <= upto"), ["symbol", "upto", "bucket"])
    n = sets.counted_bitmaps(so_far, ["symbol", "upto", "bucket"]).groupBy("symbol", c("upto").alias("inc"))
    return n.agg(*[F.coalesce(F.sum(F.when(c("bucket") == k, c("n"))), F.lit(0)).alias(k) for k in ("n", "n_large")])


@query("a15_latest_price", "SELECT user_id, event_type, arg_max(value, ts) AS price FROM events GROUP BY user_id, event_type")
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("price"))


@query("a17_mismatch_summary", f"WITH {TWO_SQL} SELECT count(a.event_id) FILTER (WHERE b.event_id IS NOT NULL) AS \"both\", count(*) FILTER (WHERE b.event_id IS NULL) AS left_only, count(*) FILTER (WHERE a.event_id IS NULL) AS right_only, count(*) FILTER (WHERE abs(a.value - b.value) > 1e-6 + 1e-9 * abs(b.value)) AS value_mismatches, round(max(abs(a.value - b.value)), 6) AS value_max_diff, round(count(*) FILTER (WHERE abs(a.value - b.value) <= 1e-6 + 1e-9 * abs(b.value)) / count(a.event_id) FILTER (WHERE b.event_id IS NOT NULL), 9) AS value_rate FROM a FULL JOIN b ON a.event_id = b.event_id")
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = compare.summary(compare.differences(*two(spark, sf_dir), ["event_id"], {"value": 1e-6}), ["value"])
    return s.withColumns({"value_max_diff": F.round("value_max_diff", 6), "value_rate": F.round("value_rate", 9)})


@query("a18_counts", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("a19_delay", "SELECT event_type, round(avg(millisecond(ts)), 4) AS mean_ms, CAST(max(millisecond(ts)) AS BIGINT) AS max_ms FROM events GROUP BY event_type")
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = times.ms_of_day(c("ts")) % 60_000
    return events(spark, sf_dir).groupBy("event_type").agg(F.round(F.avg(d), 4).alias("mean_ms"), F.max(d).alias("max_ms"))


@query("a20_push_coverage", "SELECT hour(ts) * 100 + minute(ts) AS label, event_id % 2 AS exchange, count(DISTINCT user_id) AS symbols FROM events GROUP BY ALL")
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy((F.hour("ts") * 100 + F.minute("ts")).cast("long").alias("label"), (c("event_id") % 2).alias("exchange")).agg(F.count_distinct("user_id").alias("symbols"))


# --- windows ---------------------------------------------------------------------------------------------------------


def by_user():
    """Each user's events in order."""
    return Window.partitionBy("user_id").orderBy("ts", "event_id")


@query("w1_f9_f10_lag", "SELECT event_id, lag(value) OVER w AS before, value IS DISTINCT FROM lag(value) OVER w AND value > 0 AS moved FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("value").over(by_user())
    return events(spark, sf_dir).select("event_id", before.alias("before"), (values.changed(c("value"), before) & (c("value") > 0)).alias("moved"))


@query("w2_cumulative_difference", "SELECT event_id, greatest(event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY ts), user_id, 0), 0) AS step FROM events")
def w2(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select("event_id", windows.cumulative_difference(e, ["user_id"], ["ts", "event_id"], "event_id", c("user_id")).alias("step"))


@query("w3_forward_fill", "SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value FROM events")
def w3(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("value", F.when(c("event_type") == "view", c("value")))
    return windows.forward_fill(e, ["user_id"], ["ts", "event_id"], ["value"]).select("event_id", "value")


@query("w4_first_and_last_rows", "SELECT user_id, event_id, n = 1 AS is_first FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE n = 1 OR (r = 1 AND n > 1)")
def w4(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumns({"n": F.row_number().over(by_user()), "r": F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))})
    return e.filter("n = 1 or r = 1").select("user_id", "event_id", (c("n") == 1).alias("is_first"))


@query("w5_drop_duplicates", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS n FROM events) WHERE n = 1")
def w5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.first_rows(events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("w6_sliding", "SELECT event_id, round(sum(value) OVER w, 4) AS value_sum, round(avg(value) OVER w, 9) AS value_mean, round(coalesce(stddev_samp(value) OVER w, 0), 5) AS value_std FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS 99 PRECEDING)")
def w6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.sliding(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", 100)
    return out.select("event_id", F.round("value_sum", 4).alias("value_sum"), F.round("value_mean", 9).alias("value_mean"), F.round("value_std", 5).alias("value_std"))


@query("w7_every_tenth", "SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events) WHERE n % 10 = 0")
def w7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.every_nth(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], 10).select("event_id")


@query("w8_mixed_streams", "WITH t AS (SELECT user_id, ts, avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS 199 PRECEDING) AS ratio FROM events WHERE event_type IN ('purchase', 'click')) SELECT e.event_id, round(t.ratio, 9) AS ratio FROM (SELECT * FROM events WHERE event_type = 'view') e ASOF LEFT JOIN t ON t.user_id = e.user_id AND e.ts >= t.ts")
def w8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of active buys in the last 200 trades, as of each tick."""
    e = events(spark, sf_dir)
    t = windows.sliding(e.filter("event_type in ('purchase', 'click')").withColumn("buy", (c("event_type") == "purchase").cast("double")), ["user_id"], ["ts", "event_id"], "buy", 200)
    out = joins.as_of_backward(e.filter("event_type = 'view'").select("event_id", "user_id", "ts"), t.select("user_id", "ts", c("buy_mean").alias("ratio"), "event_id"), ["user_id"], "ts", "ts", ["ratio"], tie="event_id")
    return out.select("event_id", F.round("ratio", 9).alias("ratio"))


@query("w9_cross_section", "SELECT event_id, round(percent_rank() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value), 9) AS value_rank, round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 6) AS value_z FROM events WINDOW w AS (PARTITION BY CAST(ts AS DATE))")
def w9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.cross_section(events(spark, sf_dir).withColumn("day", F.to_date("ts")), ["day"], "value")
    return out.select("event_id", F.round("value_rank", 9).alias("value_rank"), F.round("value_z", 6).alias("value_z"))


# --- sorts, limits, sets ---------------------------------------------------------------------------------------------


@query("o1_stable_sort", "SELECT user_id, ts, event_id FROM events ORDER BY user_id, ts, event_id")
def o1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("user_id", "ts", "event_id").orderBy("user_id", "ts", "event_id")


REPLAY_SQL = "WITH ch AS (SELECT 61 AS t, * FROM events WHERE event_type = 'view' UNION ALL SELECT 62, * FROM events WHERE event_type = 'click' UNION ALL SELECT 63, * FROM events WHERE event_type = 'purchase')"


def channels(spark: SparkSession, sf_dir: str) -> list[tuple[int, DataFrame]]:
    """Three channels of messages: ticks 61, orders 62, trades 63."""
    e = ev(spark, sf_dir).select("event_id", "nanos", "event_type", "value")
    return [(61, e.filter("event_type = 'view'")), (62, e.filter("event_type = 'click'")), (63, e.filter("event_type = 'purchase'"))]


@query("o2_o3_replay_order", f"{REPLAY_SQL} SELECT CAST(t AS SMALLINT) AS msg_type, event_id, CAST(epoch_us(ts) AS BIGINT) * 1000 AS nanos FROM ch ORDER BY nanos, t, event_id")
def o2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.replay(channels(spark, sf_dir), "nanos", "event_id").select("msg_type", "event_id", "nanos")


@query("o4_worst_mismatches", f"WITH {TWO_SQL} SELECT a.event_id, round(abs(a.value - b.value), 9) AS worst FROM a JOIN b ON a.event_id = b.event_id ORDER BY abs(a.value - b.value) DESC, a.event_id LIMIT 50")
def o4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.worst(compare.differences(*two(spark, sf_dir), ["event_id"], {"value": 1e-6}), ["event_id"], ["value"], 50).select("event_id", F.round("worst", 9).alias("worst"))


@query("o5_d18_newest_dates", "SELECT event_id FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 5)")
def o5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.newest_dates(events(spark, sf_dir).withColumn("day", F.to_date("ts")), "day", 5).select("event_id")


@query("o6_samples", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 5")
def o6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "value").orderBy("event_id").limit(5)


@query("u1_union_all", "SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier")
def u1(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_acctbal").alias("balance"), c("c_mktsegment").alias("segment"))
    return sets.union_all(a, table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("id"), c("s_acctbal").alias("balance")))


@query("u2_union_distinct", "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events")
def u2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(c("o_custkey").alias("id")).union(events(spark, sf_dir).select("user_id")).distinct()


@query("u3_intersection", "SELECT o_custkey AS id FROM orders INTERSECT SELECT user_id FROM events")
def u3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(c("o_custkey").alias("id")).intersect(events(spark, sf_dir).select("user_id"))


@query(
    "u4_d15_key_coverage",
    """WITH a AS (SELECT DISTINCT hour(ts) AS period, user_id FROM events WHERE event_id % 3 <> 0), b AS (SELECT DISTINCT hour(ts) AS period, user_id FROM events WHERE event_id % 5 <> 0)
SELECT CAST(coalesce(a.period, b.period) AS INTEGER) AS period, count(*) FILTER (WHERE a.user_id IS NOT NULL AND b.user_id IS NOT NULL) AS common, count(*) FILTER (WHERE b.user_id IS NULL) AS only_a, count(*) FILTER (WHERE a.user_id IS NULL) AS only_b,
       round(count(*) FILTER (WHERE a.user_id IS NOT NULL AND b.user_id IS NOT NULL) / count(a.user_id), 9) AS coverage FROM a FULL JOIN b ON a.period = b.period AND a.user_id = b.user_id GROUP BY 1""",
)
def u4(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("period", F.hour("ts"))
    return compare.key_coverage(e.filter("event_id % 3 <> 0"), e.filter("event_id % 5 <> 0"), ["period"], ["user_id"]).withColumn("coverage", F.round("coverage", 9))


BOOK = 5
_PRICES = ("price", *(f"{s}{i}_p" for s in "ab" for i in range(1, BOOK + 1)))
_AMOUNTS = ("volume", *(f"{s}{i}_v" for s in "ab" for i in range(1, BOOK + 1)))
#: Differences below these count as equal.
TICK_BOUNDS = {**{k: 0.005 for k in _PRICES}, **{k: 1.0 for k in _AMOUNTS}}


def _tick_fields_sql() -> str:
    a = {"price": "round(value, 2)", "volume": "event_id % 1000"}
    b = {"price": "round(value, 2) + CASE WHEN event_id % 11 = 0 THEN 0.01 ELSE 0 END", "volume": "event_id % 1000 + CASE WHEN event_id % 13 = 0 THEN 100 ELSE 0 END"}
    for i in range(1, BOOK + 1):
        for side, sign in (("a", "+"), ("b", "-")):
            a |= {f"{side}{i}_p": f"round(value, 2) {sign} {i} * 0.01", f"{side}{i}_v": f"event_id % {100 + i}"}
            short = f"event_id % 7 = 0 AND {i} > 3"
            b |= {f"{side}{i}_p": f"CASE WHEN {short} THEN 0 ELSE round(value, 2) {sign} {i} * 0.01 END", f"{side}{i}_v": f"CASE WHEN {short} THEN 0 ELSE event_id % {100 + i} END"}
    show = lambda x: ", ".join(f"{v} AS {k}" for k, v in x.items())
    rows = " UNION ALL ".join(
        f"SELECT '{k}' AS field, count(*) AS total, count(*) FILTER (WHERE abs(va.{k} - vb.{k}) < {t}) AS matches, round(max(abs(va.{k} - vb.{k})), 6)::DOUBLE AS max_diff, round(count(*) FILTER (WHERE abs(va.{k} - vb.{k}) < {t}) / nullif(count(*), 0), 9) AS rate FROM va JOIN vb USING (event_id)"
        for k, t in TICK_BOUNDS.items()
    )
    return f"WITH va AS (SELECT event_id, {show(a)} FROM events WHERE event_id % 17 <> 0), vb AS (SELECT event_id, {show(b)} FROM events WHERE event_id % 19 <> 0) {rows}"


@query("d15_tick_fields", _tick_fields_sql())
def d15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of two vendors by field, five levels of both sides of the book too. Each vendor lacks some ticks; the second one
    now and then has another price or volume, or a book of three levels."""
    e, i = events(spark, sf_dir), c("event_id")
    price, steps = F.round("value", 2), [F.lit(k) for k in range(1, BOOK + 1)]
    volumes = F.transform(F.array(*steps), lambda k: i % (k + 100))
    books = {"ap": F.transform(F.array(*steps), lambda k: price + k * 0.01), "bp": F.transform(F.array(*steps), lambda k: price - k * 0.01), "av": volumes, "bv": volumes}
    first = e.filter("event_id % 17 <> 0").select(i, price.alias("price"), (i % 1000).alias("volume"), *[v.alias(k) for k, v in books.items()])
    depth = F.when(i % 7 == 0, 3).otherwise(BOOK)
    second = e.filter("event_id % 19 <> 0").select(i, (price + F.when(i % 11 == 0, 0.01).otherwise(0.0)).alias("price"), (i % 1000 + F.when(i % 13 == 0, 100).otherwise(0)).alias("volume"), *[F.slice(v, F.lit(1), depth).alias(k) for k, v in books.items()])
    sides = {"a": ("ap", "av"), "b": ("bp", "bv")}
    out = compare.field_matches(compare.book_fields(first, sides), compare.book_fields(second, sides), ["event_id"], TICK_BOUNDS)
    return out.withColumns({"max_diff": F.round("max_diff", 6), "rate": F.round("rate", 9)})


@query("d17_latency_state", "SELECT event_type, max(ts) AS last_ts, arg_max(event_id, ts) AS last_id, count(*) AS n FROM events GROUP BY event_type")
def d17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type").agg(F.max("ts").alias("last_ts"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_id"), F.count("*").alias("n"))


@query("r12_paced_replay", f"{REPLAY_SQL} SELECT event_id, CAST((CAST(epoch_us(ts) AS BIGINT) * 1000 - (SELECT min(CAST(epoch_us(ts) AS BIGINT) * 1000) FROM ch)) // 100 AS BIGINT) AS wait_ns FROM ch")
def r12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sets.union_all(*[f for _, f in channels(spark, sf_dir)])
    return sets.paced(rows, "nanos", 100.0).select("event_id", "wait_ns")
