"""Streaming queries: each runs a stream over events until all is read, and returns what it has written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, times
from ..operators import compare
from ..session import checkpointed, find_package, table, work_dir
from ..streaming import bars as sbars
from ..streaming import flow, live
from . import bars, q_bars, q_orders
from .catalog import query
from .q_relational import POWERS, SCALE

c = F.col


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream; the schema is that of the table."""
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _parts(spark: SparkSession, rows: DataFrame, part: Column, parts: int, name: str) -> DataFrame:
    """Rows as a stream of some parts, written one after the other: the stream reads them in that order, one a batch. What
    makes the rows runs once, and each part is read from a folder of its own."""
    path, held = work_dir(spark, name), work_dir(spark, f"{name}-parts")
    rows.withColumn("_part", part).write.partitionBy("_part").parquet(held)
    tasks = max(4, spark.sparkContext.defaultParallelism)
    for k in range(parts):
        own = spark.read.schema(rows.schema).option("basePath", f"{held}/_part={k}").parquet(f"{held}/_part={{{k}}}")  # a part may have no rows
        own.repartition(tasks).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", tasks).parquet(path)


def _landed(spark: SparkSession, rows: DataFrame, order: str, files: int, name: str, again: bool = False) -> DataFrame:
    """_parts() by quantiles of a column. again: rows are no more than columns of a table, so that they are made anew for each
    part, and kept nowhere else."""
    held = rows if again else checkpointed(rows)
    ends = held.approxQuantile(order, [k / files for k in range(1, files)], 0.01)
    part = sum((F.when(c(order) > e, 1).otherwise(0) for e in ends), F.lit(0))
    if not again:
        return _parts(spark, held, part, files, name)
    path, tasks = work_dir(spark, name), max(4, spark.sparkContext.defaultParallelism)
    wide = rows.rdd.getNumPartitions() >= 2 * tasks  # else they are dealt, for small tables
    for k in range(files):
        own = rows.filter(part == k)
        (own.coalesce(tasks) if wide else own.repartition(tasks)).write.mode("append").parquet(path)
        for _ in range((k + 1) * tasks - len(spark.read.schema(rows.schema).parquet(path).inputFiles())):  # a batch has as many files as a part
            rows.limit(0).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", tasks).parquet(path)


def _finished(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Runs a stream to its end; complete results are those of the last batch."""
    spark = stream.sparkSession
    out = work_dir(spark, name)

    def put(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/{'last' if mode == 'complete' else f'batch={batch_id}'}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", work_dir(spark, f"{name}-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/last" if mode == "complete" else out)


@query("r4_streaming_moments", f"SELECT user_id, {POWERS} FROM events GROUP BY user_id")
def r4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments per symbol as a streaming aggregate."""
    out = _finished(flow.streaming_moments(_events(spark, sf_dir), ["user_id"], c("value"), c("value"), {"value": c("value")}, {"": None}), "complete", "moments")
    return out.select("user_id", "value_n", *[F.round(c(f"value_s{k}") / SCALE[k], 4).alias(f"value_s{k}") for k in (1, 2, 3, 4)])


@query("r13_latest_per_channel", "SELECT event_type, max(ts) AS ts, arg_max(event_id, ts) AS event_id, count(*) AS n FROM events GROUP BY event_type")
def r13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _finished(flow.latest_state(_events(spark, sf_dir), ["event_type"], "ts", ["event_id"]), "complete", "latest")
    return out.select("event_type", "ts", c("last.event_id").alias("event_id"), "n")


@query("r2_r6_versioned_bars", q_bars.BARS_SQL.replace("UNION SELECT '999999.XSHE')", ")"))
def r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks come in three batches out of order; the last versions are the bars of the whole day."""
    find_package(spark)
    ticks = q_bars.ticks(spark, sf_dir).withColumn("arrival", F.pmod(c("seq") * 7919, F.lit(1000)))
    state = work_dir(spark, "versioned")
    stream = _landed(spark, ticks, "arrival", 3, "ticks").drop("arrival")
    sbars.versioned(stream, q_bars.previous(spark, sf_dir), state).trigger(availableNow=True).start().awaitTermination()
    return sbars.latest(spark.read.parquet(f"{state}/published")).select("datetime", "code", *sbars.VALUES)


@query(
    "d10_incremental_bars",
    f"""WITH whole AS ({q_bars.BARS_SQL.replace("UNION SELECT '999999.XSHE')", ")")})
SELECT count(*) AS "both", 0::BIGINT AS left_only, 0::BIGINT AS right_only, {', '.join(f'0::BIGINT AS {v}_mismatches' for v in sbars.VALUES)} FROM whole""",
)
def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars that grew in four increments against the synthesis of the whole day: no bar is missing and no value differs."""
    find_package(spark)
    ticks, prev = q_bars.ticks(spark, sf_dir), q_bars.previous(spark, sf_dir)
    state = work_dir(spark, "incremental")
    sbars.versioned(_landed(spark, ticks, "tm", 4, "increments"), prev, state).trigger(availableNow=True).start().awaitTermination()
    whole = bars.minute_bars(ticks, ticks.select("code", "date").distinct(), prev)
    diff = compare.differences(sbars.latest(spark.read.parquet(f"{state}/published")), whole, ["code", "datetime"], {v: 1e-6 for v in sbars.VALUES})
    return compare.summary(diff, sbars.VALUES).select("both", "left_only", "right_only", *[f"{v}_mismatches" for v in sbars.VALUES])


KEYED_SQL = f"""WITH {q_bars.TICKS_SQL},
placed AS (SELECT *, CASE WHEN tm < 92500000 THEN -1 WHEN tm < 93000000 THEN 931 WHEN tm = 113000000 THEN 1130 WHEN tm = 150000000 THEN 1500 WHEN tm > 113000000 AND tm < 130000000 THEN -2 WHEN tm > 150000000 THEN -3
                     WHEN tm // 100000 % 100 = 59 THEN (tm // 10000000 + 1) * 100 ELSE tm // 100000 + 1 END AS bar FROM ticks WHERE current > 0),
one AS (SELECT code, bar, first(current ORDER BY tm, seq) AS open, max(current) AS high, min(current) AS low, last(current ORDER BY tm, seq) AS close, last(volume ORDER BY tm, seq) AS cum FROM placed WHERE bar > 0 GROUP BY code, bar)
SELECT code, CAST(bar AS INTEGER) AS bar, open, high, low, close, CAST(cum - coalesce(lag(cum) OVER w, 0) AS BIGINT) AS volume FROM one WINDOW w AS (PARTITION BY code ORDER BY bar) QUALIFY lead(bar) OVER w IS NOT NULL"""


@query("r1_keyed_bars", KEYED_SQL)
def r1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished bars of ticks that come in order."""
    find_package(spark)
    stream = _landed(spark, q_bars.ticks(spark, sf_dir), "tm", 4, "ticks")
    return _finished(sbars.keyed(stream), "append", "keyed").select("code", "bar", "open", "high", "low", "close", "volume")


FLOW_SQL = f"""WITH RECURSIVE {q_orders.BASE_SQL},
m AS (
  SELECT orderid % 40 AS symbol, ordertm AS tm, orderid AS seq, CASE WHEN ordertype = 65 THEN 'order' ELSE 'withdraw' END AS kind, sideflag AS side, orderid AS id, orderpx AS px, ordervol AS vol FROM sh_o),
t AS (SELECT tradebuyid % 40 AS symbol, tradetm AS tm, seq, sideflag AS side, tradebuyid AS id, tradesellid AS other, tradepx AS px, tradevol AS vol, row_number() OVER () AS n FROM l),
legs AS (
  SELECT symbol, side AS leg, id AS own_id, tm, seq, kind, side, id, 0::BIGINT AS other, px, vol, false AS own, 0::BIGINT AS n FROM m
  UNION ALL SELECT symbol, 66, id, tm, seq, 'trade', side, id, other, px, vol, side = 66, n FROM t
  UNION ALL SELECT symbol, 83, other, tm, seq, 'trade', side, id, other, px, vol, side = 83, n FROM t),
steps AS (SELECT *, row_number() OVER (PARTITION BY symbol, leg, own_id ORDER BY tm, seq, vol, px) AS k FROM legs),
live AS (
  SELECT DISTINCT symbol, leg, own_id, 0::BIGINT AS k, NULL::BIGINT AS tm, NULL::BIGINT AS seq, NULL::VARCHAR AS kind, NULL::INTEGER AS side, NULL::BIGINT AS id, NULL::BIGINT AS other, NULL::DOUBLE AS px, NULL::BIGINT AS vol, 0::BIGINT AS n,
         false AS fresh, NULL::BIGINT AS o_vol, NULL::BIGINT AS o_tm, 0::BIGINT AS traded, false AS open FROM steps
  UNION ALL
  SELECT symbol, leg, own_id, k, tm, seq, kind, side, id, other, px, vol, n, fresh, o_vol, o_tm, CAST(now AS BIGINT),
         CASE kind WHEN 'order' THEN true WHEN 'withdraw' THEN was AND NOT vol >= o_vol - now ELSE (was OR fresh) AND now < o_vol END
  FROM (
    SELECT symbol, leg, own_id, k, tm, seq, kind, side, id, other, px, vol, n, was, fresh, CAST(CASE WHEN fresh THEN vol WHEN was THEN o_vol + CASE WHEN own THEN vol ELSE 0 END END AS BIGINT) AS o_vol, CASE WHEN fresh THEN tm WHEN was THEN o_tm END AS o_tm,
           CASE WHEN fresh THEN 0 ELSE traded END + CASE WHEN kind = 'trade' THEN vol ELSE 0 END AS now
    FROM (SELECT s.*, l.open AS was, l.o_vol, l.o_tm, l.traded, s.kind = 'order' OR (s.own AND NOT l.open) AS fresh
          FROM live l JOIN steps s ON s.symbol = l.symbol AND s.leg = l.leg AND s.own_id = l.own_id AND s.k = l.k + 1)))
SELECT symbol, tm, seq, kind, side, id, 0::BIGINT AS other, px, vol, o_vol AS order_vol, o_tm AS order_tm, NULL::BIGINT AS other_vol, NULL::BIGINT AS other_tm,
       CASE WHEN kind = 'withdraw' THEN {q_orders._cont('tm')} - {q_orders._cont('o_tm')} END AS lag_ms FROM live WHERE kind IN ('order', 'withdraw')
UNION ALL SELECT symbol, tm, seq, 'order', leg, own_id, 0, px, vol, o_vol, o_tm, NULL, NULL, NULL FROM live WHERE kind = 'trade' AND fresh
UNION ALL
SELECT b.symbol, b.tm, b.seq, 'trade', b.side, b.id, b.other, b.px, b.vol, b.o_vol, b.o_tm, s.o_vol, s.o_tm, abs({q_orders._cont('b.o_tm')} - {q_orders._cont('s.o_tm')})
FROM live b JOIN live s ON s.n = b.n AND b.leg = 66 AND s.leg = 83 WHERE b.kind = 'trade' AND s.kind = 'trade'"""


@query("r3_order_state", FLOW_SQL)
def r3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shanghai's orders, withdrawals and trades as one stream of messages in the order of time, matched by keyed state."""
    find_package(spark)
    o, t = q_orders.shanghai_messages(spark, sf_dir)
    none, day = F.lit(0).cast("long"), F.lit(q_bars.DAY).cast("date").alias("date")
    kind = F.when(c("ordertype") == codes.SH_ADD, "order").otherwise("withdraw")
    a = o.select(F.lit("SH").alias("exchange"), (c("orderid") % 40).alias("symbol"), day, c("ordertm").alias("tm"), c("orderid").alias("seq"), kind.alias("kind"), c("sideflag").cast("int").alias("side"), c("orderid").alias("id"), none.alias("other"), c("orderpx").alias("px"), c("ordervol").alias("vol"))
    b = t.select(F.lit("SH"), c("tradebuyid") % 40, day, c("tradetm"), c("seq").cast("long"), F.lit("trade"), c("sideflag").cast("int"), c("tradebuyid"), c("tradesellid"), c("tradepx"), c("tradevol"))
    with flow.keyed_state(spark):
        return _finished(flow.order_flow(_landed(spark, a.union(b), "tm", 4, "flow", again=True)), "append", "flow").drop("batch")


@query(
    "r5_publish_times",
    f"WITH {q_bars.TICKS_SQL} SELECT tm // 100000 AS label, min(tm) AS at FROM ticks WHERE tm // 1000 % 100 = 1 AND (tm // 100000 BETWEEN 931 AND 959 OR tm // 100000 BETWEEN 1000 AND 1059 OR tm // 100000 BETWEEN 1100 AND 1130 OR tm // 100000 BETWEEN 1301 AND 1359 OR tm // 100000 BETWEEN 1400 AND 1500) GROUP BY 1",
)
def r5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code counts as Shanghai's here."""
    return sbars.publish_times(q_bars.ticks(spark, sf_dir).withColumn("code", F.concat(F.substring("code", 1, 6), F.lit(".XSHG")))).select("label", "at")


@query("r7_minute_snapshot", f"SELECT * FROM ({q_bars.BARS_SQL.replace("UNION SELECT '999999.XSHE')", ")")}) WHERE datetime = TIMESTAMP '{q_bars.DAY} 10:30:00'")
def r7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version of one minute of every code, from what a stream has published."""
    find_package(spark)
    state = work_dir(spark, "snapshot")
    ticks = q_bars.ticks(spark, sf_dir).withColumn("arrival", F.pmod(c("seq") * 6007, F.lit(1000)))
    stream = _landed(spark, ticks, "arrival", 2, "snapshot-ticks").drop("arrival")
    sbars.versioned(stream, q_bars.previous(spark, sf_dir), state).trigger(availableNow=True).start().awaitTermination()
    return sbars.snapshot(spark.read.parquet(f"{state}/published"), F.lit(f"{q_bars.DAY} 10:30:00").cast("timestamp_ntz")).select("datetime", "code", *sbars.VALUES)


@query("r11_minute_rotation", "SELECT CAST(CASE WHEN label < 926 THEN 926 WHEN label < 931 THEN 931 WHEN label >= 1131 AND label < 1301 THEN 1301 WHEN label % 100 = 59 THEN (label // 100 + 1) * 100 ELSE label + 1 END AS INTEGER) AS file_hhmm, count(*) AS n FROM (SELECT hour(ts) * 100 + minute(ts) AS label FROM events) GROUP BY 1")
def r11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many messages each minute file would get."""
    label = times.div(times.ms_to_tm(times.ms_of_day(c("ts"))), 100_000)
    return table(spark, sf_dir, "events").groupBy(times.file_minute(label).cast("int").alias("file_hhmm")).agg(F.count("*").alias("n"))


def live_sql(ticks: str = "true", bars_: str = "true") -> str:
    """Bars of all ticks for which one condition holds, where another one does for the bar."""
    return f"""WITH {q_bars.TICKS_SQL},
placed AS (SELECT *, CASE WHEN tm < 92500000 THEN -1 WHEN tm < 93000000 THEN 931 WHEN tm = 113000000 THEN 1130 WHEN tm = 150000000 THEN 1500 WHEN tm > 113000000 AND tm < 130000000 THEN -2 WHEN tm > 150000000 THEN -3
                     WHEN tm // 100000 % 100 = 59 THEN (tm // 10000000 + 1) * 100 ELSE tm // 100000 + 1 END AS bar FROM ticks WHERE {ticks}),
released AS (SELECT DISTINCT tm // 100000 AS bar FROM placed WHERE tm // 1000 % 100 = 1),
one AS (SELECT code, bar, first(current ORDER BY tm, seq) AS open, max(current) AS high, min(current) AS low, last(current ORDER BY tm, seq) AS close, last(volume ORDER BY tm, seq) AS cum FROM placed WHERE bar > 0 AND current > 0 GROUP BY code, bar),
bars AS (SELECT code[:6] || '.XSHG' AS code, CAST(bar AS INTEGER) AS bar, open, high, low, close, CAST(cum - coalesce(lag(cum) OVER w, 0) AS BIGINT) AS volume FROM one WINDOW w AS (PARTITION BY code ORDER BY bar))
SELECT * FROM bars WHERE {bars_}"""


def live_run(spark: SparkSession, ticks: DataFrame, part: Column, parts: int, name: str) -> str:
    """Runs live bars with their publisher over parts of some ticks; returns the folder of state."""
    find_package(spark)
    state, stream = work_dir(spark, name), _parts(spark, ticks, part, parts, f"{name}-ticks")
    with flow.keyed_state(spark):
        live.live_bars(stream).writeStream.foreachBatch(live.publisher(state)).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return state


def _shanghai_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_bars.ticks(spark, sf_dir).withColumn("code", F.concat(F.substring("code", 1, 6), F.lit(".XSHG")))


def _hours(*edges: int) -> Column:
    return sum((F.when(c("tm") >= e, 1).otherwise(0) for e in edges), F.lit(0))


@query("r5_released_minutes", live_sql("tm < 145900000", "bar IN (SELECT bar FROM released)").replace("SELECT * FROM bars", "SELECT *, 1 AS version, 'insert' AS kind FROM bars"))
def r5_released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream in order publishes of each minute that a tick of second 01 has released."""
    state = live_run(spark, _shanghai_ticks(spark, sf_dir).filter("tm < 145900000"), _hours(100_000_000, 130_000_000, 143_000_000), 4, "released")
    return spark.read.parquet(f"{state}/published").select("code", "bar", *live.VALUES, "version", "kind")


@query("r6_patched_bars", live_sql("tm < 150500000", "bar IN (SELECT bar FROM released)"))
def r6_patched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks come in five batches out of order; the last versions of released minutes are the bars of all ticks."""
    state = live_run(spark, _shanghai_ticks(spark, sf_dir).filter("tm < 150500000"), F.pmod(c("seq") * 7919, F.lit(5)), 5, "patched")
    out = spark.read.parquet(f"{state}/published")
    return out.groupBy("code", "bar").agg(*[F.max_by(x, "version").alias(x) for x in live.VALUES])


@query("r7_bar_in_progress", live_sql("tm <= 103020000", "bar >= 1030"))
def r7_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At 10:30:20: the minute before and the one in progress, read from a stream's state."""
    state = live_run(spark, _shanghai_ticks(spark, sf_dir).filter("tm <= 103020000"), _hours(100_000_000), 2, "progress")
    return live.in_progress(spark, f"{state}/checkpoint").filter("bar >= 1030").select("code", "bar", *live.VALUES)


@query("r8_final_bars", live_sql())
def r8_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is given out when the stream has seen 15:05: all bars of each code."""
    state = live_run(spark, _shanghai_ticks(spark, sf_dir), _hours(113_000_000, 150_000_000), 3, "final")
    return spark.read.parquet(f"{state}/bars").filter("kind = 'final'").select("code", "bar", *live.VALUES)
