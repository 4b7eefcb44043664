"""Scalar functions, predicates and time bucketing over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, times, values
from ..operators import joins
from ..session import table
from .catalog import query

EV_SQL = """ev AS (
  SELECT *, event_id * 7919 % 750000 AS symbol, CAST(hour(ts) * 10000000 + minute(ts) * 100000 + millisecond(ts) AS BIGINT) AS tm,
         hour(ts) * 100 + minute(ts) AS label, CAST(floor(value * 100) AS BIGINT) AS vol, CAST(epoch_us(ts) AS BIGINT) * 1000 AS nanos, CAST(event_id % 5 AS BIGINT) AS raw
  FROM events)"""
MS = "({t} // 10000000 * 3600000 + {t} // 100000 % 100 * 60000 + {t} // 1000 % 100 * 1000 + {t} % 1000)"
CONT = "CASE WHEN {m} < 34197000 THEN {m} + 300000 WHEN {m} > 46797000 THEN {m} - 5400000 ELSE {m} END"
NEXT = "(CASE WHEN {l} % 100 = 59 THEN ({l} // 100 + 1) * 100 ELSE {l} + 1 END)"


def ms(t: str) -> str:
    return MS.format(t=t)


def cont(t: str) -> str:
    return "(" + CONT.format(m=ms(t)) + ")"


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns that the functions take."""
    e = table(spark, sf_dir, "events")
    day = times.ms_of_day(F.col("ts"))
    micros = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000 + (F.hour("ts") * 3600 + F.minute("ts") * 60).cast("long") * 1_000_000 + (F.date_part(F.lit("SECOND"), F.col("ts")) * 1_000_000).cast("long")
    return e.withColumns({"symbol": F.col("event_id") * 7919 % 750_000, "tm": times.ms_to_tm(day), "label": (F.hour("ts") * 100 + F.minute("ts")).cast("long"), "vol": F.floor(F.col("value") * 100), "nanos": micros * 1000, "raw": F.col("event_id") % 5})


def simple(name: str, sql: str, columns: Callable[[], dict[str, Column]]) -> None:
    """A query of event_id and some expressions, made when it runs, and its SQL: the select list after event_id."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ev(spark, sf_dir).select("event_id", *[c.alias(k) for k, c in columns().items()])

    query(name, f"WITH {EV_SQL} SELECT event_id, {sql} FROM ev")(run)


c = F.col
simple("p1_tm_to_ms", f"{ms('tm')} AS ms", lambda: {"ms": times.tm_to_ms(c("tm"))})
simple("p2_tm_on_date", f"CAST(ts AS DATE) + to_milliseconds({ms('tm')}) AS at", lambda: {"at": times.tm_on_date(c("ts").cast("date"), c("tm"))})
simple("p3_continuous_session", f"{cont('tm')} AS ms", lambda: {"ms": times.continuous_ms(times.tm_to_ms(c("tm")))})
simple("p4_symbol_to_code", "lpad(CAST(symbol AS VARCHAR), 6, '0') || CASE WHEN symbol < 400000 THEN '.XSHE' WHEN symbol < 700000 THEN '.XSHG' ELSE '.OTHER' END AS code", lambda: {"code": codes.code(c("symbol"))})
simple("p5_code_to_symbol", "CAST(symbol AS INTEGER) AS symbol, CASE WHEN length(event_type) < 6 THEN 0 ELSE TRY_CAST(substr(event_type, 1, 6) AS INTEGER) END AS other", lambda: {"symbol": codes.symbol(codes.code(c("symbol"))), "other": codes.symbol(c("event_type"))})
simple("p6_decode_exchange", "CASE WHEN symbol < 400000 THEN 'SZ' WHEN symbol < 700000 THEN 'SH' ELSE '' END AS exchange", lambda: {"exchange": codes.exchange(c("symbol"))})
simple("p7_price_descale", "CAST(vol AS DOUBLE) / 10000 AS price", lambda: {"price": values.price(c("vol"))})
SIDE = "CASE raw WHEN 1 THEN 66 WHEN 2 THEN 83 END"
simple("p8_order_normalise", f"CAST({SIDE} AS SMALLINT) AS side, CAST(CASE event_id % 12 WHEN 2 THEN 65 WHEN 10 THEN 68 WHEN 11 THEN 83 END AS SMALLINT) AS sh_type, CAST(CASE event_id % 12 WHEN 1 THEN 50 WHEN 2 THEN 49 WHEN 3 THEN 85 END AS SMALLINT) AS sz_type", lambda: {"side": codes.side(c("raw")), "sh_type": codes.order_type(c("event_id") % 12, F.lit(True)), "sz_type": codes.order_type(c("event_id") % 12, F.lit(False))})
simple("p9_trade_normalise", "CAST(CASE raw WHEN 0 THEN 78 WHEN 1 THEN 66 WHEN 2 THEN 83 END AS SMALLINT) AS sh_side, CAST(CASE WHEN raw = 0 THEN 70 ELSE 52 END AS SMALLINT) AS sz_type", lambda: {"sh_side": codes.sh_trade_side(c("raw")), "sz_type": codes.sz_trade_type(c("raw"))})
simple("p10_sz_trade_side", "CAST(CASE WHEN user_id > raw THEN 66 ELSE 83 END AS SMALLINT) AS side", lambda: {"side": codes.sz_trade_side(c("user_id"), c("raw"))})
simple("p11_money", "vol * value AS money", lambda: {"money": values.money(c("vol"), c("value"))})
simple("p12_book_levels", "CAST(CASE WHEN raw >= 1 THEN vol ELSE 0 END AS BIGINT) AS l1, CAST(CASE WHEN raw >= 2 THEN vol ELSE 0 END AS BIGINT) AS l2, CAST(vol AS BIGINT) AS top", lambda: {"l1": values.level(F.slice(values.book([c("vol")] * 10), 1, c("raw").cast("int")), 1).cast("long"), "l2": values.level(F.slice(values.book([c("vol")] * 10), 1, c("raw").cast("int")), 2).cast("long"), "top": values.level(values.book([c("vol")] * 10), 10).cast("long")})
simple("p13_px_to_ret", "CASE WHEN user_id % 3 = 0 THEN NULL ELSE greatest(least(value / user_id - 1, 0.2), -0.2) END AS ret", lambda: {"ret": values.px_to_ret(c("value"), F.when(c("user_id") % 3 != 0, c("user_id")))})
simple("p14_turnover", "CASE WHEN raw = 0 THEN NULL ELSE value / raw END AS turnover", lambda: {"turnover": values.turnover(c("value"), c("raw"))})
simple("p15_time_lag", f"{cont('tm')} - {cont('93000000')} AS lag_ms, abs({cont('tm')} - {cont('140000000')}) AS distance_ms", lambda: {"lag_ms": times.time_lag(c("tm"), F.lit(93_000_000)), "distance_ms": F.abs(times.time_lag(c("tm"), F.lit(140_000_000)))})
simple("p16_side_difference", "abs(value - user_id) AS diff", lambda: {"diff": values.side_difference(c("value"), c("user_id"))})
simple("p17_finite", "CASE WHEN raw IN (0, 1) THEN NULL ELSE value END AS x", lambda: {"x": values.finite(F.when(c("raw") == 0, float("nan")).when(c("raw") == 1, float("inf")).otherwise(c("value")))})
simple("p18_next_trading_minute", f"{NEXT.format(l='label')} AS next_minute, CASE WHEN label < 931 THEN 931 WHEN label = 1130 THEN 1301 WHEN label < 1500 THEN {NEXT.format(l='label')} ELSE 0 END AS next_bar", lambda: {"next_minute": times.next_minute(c("label")), "next_bar": times.next_trading_minute(c("label"))})
LABEL = f"CAST(CASE WHEN tm < 92500000 THEN -1 WHEN tm < 93000000 THEN 931 WHEN tm = 113000000 THEN 1130 WHEN tm = 150000000 THEN 1500 WHEN tm > 113000000 AND tm < 130000000 THEN -2 WHEN tm > 150000000 AND tm <= 150500000 THEN -3 WHEN tm > 150500000 THEN -4 ELSE {NEXT.format(l='(tm // 100000)')} END AS INTEGER)"
simple("p19_b1_bar_label", f"{LABEL} AS bar", lambda: {"bar": times.bar_label(c("tm"))})
EDGE = "CASE WHEN {t} = date_trunc('minute', {t}) AND strftime({t}, '%H:%M') IN ('11:30', '15:00') THEN {t} ELSE date_trunc('minute', {t}) + INTERVAL 1 MINUTE END"
simple("p20_minute_edge", f"{EDGE.format(t='ts')} AS edge, {EDGE.format(t='''date_trunc('hour', ts) + INTERVAL 30 MINUTE''')} AS half_edge", lambda: {"edge": times.minute_edge(c("ts")), "half_edge": times.minute_edge(F.date_trunc("hour", c("ts")).cast("timestamp_ntz") + F.expr("interval 30 minute"))})
simple("p21_prev_boundary", f"CAST(CASE WHEN t < 92500000 THEN -1 WHEN t < 93000000 THEN 931 WHEN t = 113000000 THEN 1130 WHEN t = 150000000 THEN 1500 WHEN t > 113000000 AND t < 130000000 THEN -2 WHEN t > 150000000 AND t <= 150500000 THEN -3 WHEN t > 150500000 THEN -4 WHEN t NOT IN (93000000, 130000000) THEN t // 100000 ELSE {NEXT.format(l='(t // 100000)')} END AS INTEGER) AS bar FROM (SELECT event_id, tm // 100000 * 100000 AS t FROM ev) AS ev(event_id, t) --", lambda: {"bar": times.bar_label(times.div(c("tm"), 100_000) * 100_000, "prev")})
simple("p22_output_rounding", "CAST(value AS FLOAT) AS price, CAST(floor(value + 1e-6) AS DOUBLE) AS money", lambda: {"price": c("value").cast("float"), "money": values.out_money(c("value"))})
simple("p23_nanos", "CAST(ts AS TIMESTAMP) AS at, CAST(hour(ts + INTERVAL 8 HOUR) * 10000000 + minute(ts) * 100000 + millisecond(ts) AS BIGINT) AS local_tm", lambda: {"at": times.nanos_to_timestamp(c("nanos")), "local_tm": times.nanos_to_tm(c("nanos"))})
simple("p24_file_minute", f"CASE WHEN label < 926 THEN 926 WHEN label < 931 THEN 931 WHEN label >= 1131 AND label < 1301 THEN 1301 ELSE {NEXT.format(l='label')} END AS file_hhmm", lambda: {"file_hhmm": times.file_minute(c("label"))})
PERIOD = "CASE " + " ".join(f"WHEN label >= {a} THEN '{n}'" for a, n in reversed(times.PERIODS)) + " END"
simple("p25_period_label", f"{PERIOD} AS period", lambda: {"period": times.period_label(c("tm"))})
simple("p26_spread_vwap", "CASE WHEN (value + 2 * raw) / 2 < 1e-9 THEN 0.0 ELSE (2 * raw - value) / ((value + 2 * raw) / 2) END AS spread, CASE WHEN raw = 0 THEN 0.0 ELSE value / raw END AS vwap", lambda: {"spread": values.spread(c("value"), 2 * c("raw")), "vwap": values.vwap(c("value"), c("raw"))})
simple("p28_string_parts", "CASE WHEN raw = 0 THEN '' ELSE event_type || '_' || user_id END AS head, CASE WHEN raw = 0 THEN NULL ELSE CAST(raw AS VARCHAR) END AS third", lambda: {"head": codes.split_part(F.when(c("raw") == 0, c("event_type")).otherwise(F.concat_ws("_", "event_type", c("user_id").cast("string"), c("raw").cast("string")))), "third": codes.split_task(F.when(c("raw") == 0, c("event_type")).otherwise(F.concat_ws("_", "event_type", c("user_id").cast("string"), c("raw").cast("string"))), 3)})
simple("p29_security_type", "CASE raw WHEN 1 THEN 'index' WHEN 2 THEN 'stock' WHEN 3 THEN 'fund' WHEN 4 THEN 'bond' ELSE 'unknown' END AS kind", lambda: {"kind": codes.security_type(c("raw"))})
simple("p30_gateway_delay", f"{ms('CAST(hour(ts + INTERVAL 8 HOUR) * 10000000 + minute(ts) * 100000 + millisecond(ts) AS BIGINT)')} - {ms('tm')} AS delay_ms", lambda: {"delay_ms": times.gateway_delay_ms(c("nanos"), c("tm"))})
simple("p32_vendor_conversion", "CAST(vol AS FLOAT) AS price, CAST(vol // 1000 AS BIGINT) AS total", lambda: {"price": values.packed_price(c("vol")), "total": values.packed_volume(c("vol"))})
simple("p33_exchange_struct", "CASE WHEN symbol < 400000 THEN value END AS sz_value, CASE WHEN symbol >= 400000 THEN value END AS sh_value", lambda: {"sz_value": F.when(codes.exchange(c("symbol")) == "SZ", F.struct("value"))["value"], "sh_value": F.when(codes.exchange(c("symbol")) != "SZ", F.struct("value"))["value"]})


@query("p27_composite_key", "SELECT user_id, event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY user_id, event_type")
def p27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns are the key; nothing is packed into one."""
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


@query("p31_renames", "SELECT event_id, value AS buy_value_cat1, raw AS buy_raw_cat1 FROM (SELECT event_id, value, event_id % 5 AS raw FROM events)")
def p31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.prefixed(ev(spark, sf_dir).select("event_id", "value", "raw"), "buy_", "_cat1", keep=("event_id",))


def kept(name: str, where: str, condition: Callable[[], Column]) -> None:
    """A filter and its SQL."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ev(spark, sf_dir).filter(condition()).select("event_id", "tm")

    query(name, f"WITH {EV_SQL} SELECT event_id, tm FROM ev WHERE {where}")(run)


kept("f1_msg_type", "event_type IN ('view', 'click')", lambda: c("event_type").isin("view", "click"))
kept("f2_universe", "symbol < 700000 AND NOT symbol BETWEEN 200000 AND 201999", lambda: codes.in_universe(c("symbol")))
kept("f3_session", "tm BETWEEN 92500000 AND 92959999 OR tm BETWEEN 93000000 AND 113000000 OR tm BETWEEN 130000000 AND 150000000", lambda: c("tm").between(92_500_000, 92_959_999) | c("tm").between(93_000_000, 113_000_000) | c("tm").between(130_000_000, 150_000_000))
kept("f4_ids", "raw > 0 AND user_id <> 0", lambda: (c("raw") > 0) & (c("user_id") != 0))
kept("f5_large", "vol >= 100000 OR vol * value >= 1000000", lambda: values.is_large(c("vol"), c("vol") * c("value")))
kept("f6_small", "(vol <= 10000 AND vol * 5 <= 100000) OR (vol <= 1000 AND vol * 5 <= 500000)", lambda: values.is_small(c("vol"), c("vol") * 5))
kept("f11_minute_range", f"{ms('tm')} > 34195000 AND {ms('tm')} <= 41405000", lambda: (times.tm_to_ms(c("tm")) > 34_195_000) & (times.tm_to_ms(c("tm")) <= 41_405_000))
simple("f7_withdraw_kind", "raw = 2 AS complete, raw < 2 AS partial, tm BETWEEN 0 AND 3000 AS instant", lambda: {"complete": values.is_complete(c("raw"), F.lit(2)), "partial": values.is_partial(c("raw"), F.lit(2)), "instant": values.is_instant(c("tm"))})
simple("f13_tolerance", "abs(value - (value + raw * 1e-6)) <= 1e-6 + 1e-9 * abs(value + raw * 1e-6) AND raw < 1 OR raw = 4 AS same", lambda: {"same": F.when(c("raw") == 4, values.close_to(F.lit(None).cast("double"), F.lit(None).cast("double"))).otherwise(values.close_to(c("value"), c("value") + c("raw")))})


@query("f8_order_size_of_trade", "SELECT event_id, (vol >= 100000 OR vol * 9 >= 1000000) AS bolarge, (vol <= 10000 AND vol * 9 <= 100000) OR (vol <= 1000 AND vol * 9 <= 500000) AS bosmall FROM (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS vol FROM events)")
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = c("vol") * 9
    return ev(spark, sf_dir).select("event_id", values.is_large(c("vol"), money).alias("bolarge"), values.is_small(c("vol"), money).alias("bosmall"))


@query("f12_resume", "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 3 = 0 AND event_id < 500)")
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes after the last event that was written."""
    e = table(spark, sf_dir, "events")
    seen = e.filter("event_id % 3 = 0 and event_id < 500").agg(F.max("ts").alias("last"))  # one row
    return e.join(F.broadcast(seen), e.ts > seen.last).select("event_id")


@query("b2_calendar", "SELECT user_id, CAST(m // 60 * 100 + m % 60 AS INTEGER) AS label FROM (SELECT DISTINCT user_id FROM events) CROSS JOIN (SELECT 565 AS m UNION ALL SELECT unnest(range(571, 691)) UNION ALL SELECT unnest(range(781, 901)))")
def b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule of a day for every code."""
    return table(spark, sf_dir, "events").select("user_id").distinct().select("user_id", F.explode(times.schedule()).alias("label"))


@query(
    "f11_increments",
    f"""WITH {EV_SQL},
m AS (SELECT CAST(m // 60 * 100 + m % 60 AS INTEGER) AS label, m * 60000 AS e FROM (SELECT 565 AS m UNION ALL SELECT unnest(range(571, 691)) UNION ALL SELECT unnest(range(781, 901)))),
s AS (SELECT label, CASE WHEN label = 925 THEN 33295000 WHEN label IN (931, 1301) THEN e - 65000 ELSE e - 60000 END AS a, CASE WHEN label IN (925, 1130, 1500) THEN e + 5000 ELSE e END AS b FROM m)
SELECT event_id, s.label FROM ev JOIN s ON {ms('tm')} > a AND {ms('tm')} <= b""",
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the increments that take it in; at the ends of sessions that may be two."""
    start, end = times.increment_bounds(F.col("label"))
    schedule = spark.range(1).select(F.explode(times.schedule()).alias("label")).withColumns({"start_ms": start, "end_ms": end})
    rows = ev(spark, sf_dir).select("event_id", times.tm_to_ms(c("tm")).alias("ms"))
    return joins.interval_join(rows, schedule, "ms", "start_ms", "end_ms", 60_000).select("event_id", "label")
