"""Sources and sinks: what a query writes is read back and compared with what it was made from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, times, values
from ..schemas import CHANNELS
from ..session import kept, table, work_dir
from ..sources import readers, records, writers
from ..streaming import bars as sbars
from ..streaming import latency
from . import factors, q_bars
from .catalog import query
from .q_orders import d13_all, shanghai, snapshot_sql, so_far_sql
from .q_scalars import EV_SQL, ev

c = F.col
PART = {"tick": "view", "order": "click", "trade": "purchase"}


def messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One kind of event as a channel's messages; what events lack is null."""
    e = ev(spark, sf_dir).filter(c("event_type") == PART[name])
    own = {"nano_timestamp": c("nanos"), "exchange": F.when(c("symbol") < 400_000, "SZ").when(c("symbol") < 700_000, "SH").otherwise(""), "Symbol": c("symbol"), "BizIndex": c("event_id"), "Price": c("value"), "Time": c("tm"), "Volume": c("vol"), "AccVolume": c("vol") * 2, "AccTurnover": c("vol") * 3}
    return e.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CHANNELS[name]])


def landed(spark: SparkSession, sf_dir: str) -> str:
    """A folder with all three channels."""
    root = work_dir(spark, "channels")
    for name in CHANNELS:
        writers.archive(messages(spark, sf_dir, name), f"{root}/{name}", name)
    return root


MSG_SQL = f"""WITH {EV_SQL}, msg AS (
  SELECT CASE event_type WHEN 'view' THEN 61 WHEN 'click' THEN 62 ELSE 63 END AS msg_type, nanos AS nano_timestamp, CASE WHEN symbol < 400000 THEN 'SZ' WHEN symbol < 700000 THEN 'SH' ELSE '' END AS exchange,
         symbol AS sym, event_id AS biz, CAST(value AS FLOAT) AS price, tm, vol FROM ev WHERE event_type IN ('view', 'click', 'purchase'))"""


@query("s1_s4_k1_channels", f"{MSG_SQL} SELECT CAST(msg_type AS SMALLINT) AS msg_type, nano_timestamp, CAST(sym AS INTEGER) AS sym, CAST(biz AS INTEGER) AS biz, price FROM msg")
def s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels are archived, then scanned together."""
    return readers.all_channels(spark, landed(spark, sf_dir)).select("msg_type", "nano_timestamp", c("Symbol").alias("sym"), c("BizIndex").alias("biz"), c("Price").alias("price"))


@query("s3_filtered_orders", f"{MSG_SQL} SELECT lpad(CAST(sym AS VARCHAR), 6, '0') || CASE WHEN sym < 400000 THEN '.XSHE' WHEN sym < 700000 THEN '.XSHG' ELSE '.OTHER' END AS code, round(CAST(price AS DOUBLE) / 10000, 9) AS price, CAST(biz AS INTEGER) AS biz FROM msg WHERE msg_type = 62")
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all channels, the messages of one type, with codes and prices as analysts take them."""
    rows = readers.all_channels(spark, landed(spark, sf_dir)).filter(c("msg_type") == 62)
    return rows.select(codes.code(c("Symbol")).alias("code"), F.round(values.price(c("Price").cast("double")), 9).alias("price"), c("BizIndex").alias("biz"))


@query("s5_time_range", f"{MSG_SQL} SELECT CAST(biz AS INTEGER) AS biz FROM msg WHERE msg_type = 61 AND nano_timestamp >= 1704500000000000000 AND nano_timestamp < 1705500000000000000 AND exchange = 'SH'")
def s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.channel(spark, f"{landed(spark, sf_dir)}/tick", "tick")
    return readers.time_range(rows, 1704500000000000000, 1705500000000000000, "SH").select(c("BizIndex").alias("biz"))


@query("s7_s10_s12_tick_shards", f"{MSG_SQL} SELECT lpad(CAST(sym AS VARCHAR), 6, '0') || CASE WHEN sym < 400000 THEN '.XSHE' WHEN sym < 700000 THEN '.XSHG' ELSE '.OTHER' END AS code, tm, round(CAST(price AS DOUBLE) / 10000, 9) AS current, CAST(vol * 2 AS BIGINT) AS volume, CAST(vol * 3 AS BIGINT) AS money FROM msg WHERE msg_type = 61")
def s7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards named by date; only the columns that bars take are read."""
    root = work_dir(spark, "shards")
    rows = messages(spark, sf_dir, "tick")
    for shard in range(3):  # dealt by symbol; the shards of a date are read as one
        writers.archive(rows.filter(F.pmod(c("Symbol"), F.lit(3)) == shard), f"{root}/ticks_2024-01-02_{shard}", "tick")
    writers.archive(rows, f"{root}/ticks_2024-01-03_0", "tick")
    return readers.tick_shards(spark, root, "2024-01-02").select("code", "tm", F.round("current", 9).alias("current"), "volume", "money")


@query("s8_reference_bars", f"SELECT *, CAST(hour(datetime) * 100 + minute(datetime) AS INTEGER) AS label FROM ({q_bars.BARS_SQL})")
def s8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "golden")
    q_bars.d8(spark, sf_dir).write.parquet(path)
    return readers.reference_bars(spark, path)


def _vendor_ticks(spark: SparkSession, sf_dir: str, universe: str) -> DataFrame:
    """Ticks of the codes of the events that a condition holds for."""
    path, x = work_dir(spark, "vendor"), c("value")
    codes = F.concat(F.lpad(c("user_id").cast("string"), 6, "0"), F.lit(".XSHE"))
    e = table(spark, sf_dir, "events")
    e.select(c("ts").alias("datetime"), codes.alias("code"), x.alias("current"), x.alias("high"), x.alias("low"), c("event_id").cast("double").alias("volume"), x.alias("money")).write.parquet(path)
    return readers.vendor_ticks(spark, path, e.filter(universe).select(codes.alias("code"))).select("code", "tm", "current")


@query("s9_vendor_ticks", "SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') || '.XSHE' AS code, CAST(hour(ts) * 10000000 + minute(ts) * 100000 + millisecond(ts) AS BIGINT) AS tm, value AS current FROM events WHERE user_id IS NOT NULL")
def s9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of all codes; a tick without a code is of none."""
    return _vendor_ticks(spark, sf_dir, "user_id IS NOT NULL")


@query("s11_latest_before", "SELECT CAST(user_id AS VARCHAR) AS code, arg_max(value, ts) AS prev_day_close FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events WHERE ts < TIMESTAMP '2024-01-10') GROUP BY user_id")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous closes from the newest partition before a date."""
    path = work_dir(spark, "days")
    e = table(spark, sf_dir, "events")
    e.select(F.to_date("ts").alias("date"), c("user_id").cast("string").alias("code"), c("ts").alias("datetime"), c("value").alias("close")).write.partitionBy("date").parquet(path)
    return readers.previous_close(spark, path, "2024-01-10")


@query("s13_k7_csv", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 2 = 0")
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are appended as CSV; one column is read."""
    path = work_dir(spark, "csv")
    rows = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    writers.append_csv(rows, path)
    writers.append_csv(rows.filter("c_custkey % 2 = 0"), path)
    return readers.csv_column(spark, path, "c_custkey")


@query("s15_replay_resume", f"{MSG_SQL} SELECT CAST(msg_type AS SMALLINT) AS msg_type, nano_timestamp, CAST(biz AS INTEGER) AS biz FROM msg WHERE nano_timestamp > 1705000000000000000")
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.frames(spark, landed(spark, sf_dir), 1705000000000000000).select("msg_type", "nano_timestamp", c("BizIndex").alias("biz"))


@query("s6_k9_tail", f"{MSG_SQL} SELECT CAST(biz AS INTEGER) AS biz FROM msg WHERE msg_type = 63 AND nano_timestamp > 1705000000000000000")
def s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder is tailed from a nanosecond on."""
    path, out = work_dir(spark, "landing"), work_dir(spark, "tail")
    writers.landing(messages(spark, sf_dir, "trade"), path, 4)
    readers.tail(spark, path, "trade", since=1705000000000000000).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(CHANNELS["trade"]).parquet(out).select(c("BizIndex").alias("biz"))


def _minute_counts(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Messages per minute file, counted from the files that a stream of the messages wrote."""
    path, out = work_dir(spark, "minutes-in"), work_dir(spark, "minutes")
    rows.write.parquet(path)
    writers.minute_sink(readers.tail(spark, path, "order"), out, f"{out}-c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy(c("date").cast("string").alias("date"), "file_hhmm").agg(F.count("*").alias("n"))


@query("k2_k3_minute_files", "SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS date, CAST(CASE WHEN label < 926 THEN 926 WHEN label < 931 THEN 931 WHEN label >= 1131 AND label < 1301 THEN 1301 WHEN label % 100 = 59 THEN (label // 100 + 1) * 100 ELSE label + 1 END AS INTEGER) AS file_hhmm, count(*) AS n FROM (SELECT ts, hour(ts + INTERVAL 8 HOUR) * 100 + minute(ts) AS label FROM events WHERE event_type = 'click') GROUP BY ALL")
def k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per minute file, of every message of the channel."""
    return _minute_counts(spark, messages(spark, sf_dir, "order"))


@query("k4_bars_csv", f"SELECT code, CAST(datetime AS VARCHAR) AS at, printf('%.4f', CAST(close AS DOUBLE)) AS close, printf('%.0f', volume) AS volume FROM ({q_bars.BARS_SQL})")
def k4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "bars-csv")
    writers.bars_csv(q_bars.d8(spark, sf_dir), path)
    rows = spark.read.option("header", True).csv(path)
    return rows.select("code", F.regexp_replace(F.substring("datetime", 1, 19), "T", " ").alias("at"), F.when(c("close") != "null", c("close")).alias("close"), "volume")


PLAIN = [n for n in factors.names() if "_count" in n or "vwapx" in n]  # what ten digits of CSV keep to three decimals


@query("k5_k6_factor_files", f"SELECT CAST(symbol AS BIGINT) AS symbol, CAST(493 AS INTEGER) AS columns, {', '.join(PLAIN)} FROM ({snapshot_sql()})")
def k5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as CSV, with a column for each factor, read back."""
    path = work_dir(spark, "factors-csv")
    writers.factors_csv(factors.snapshot(shanghai(spark, sf_dir, kept), keep=kept), path)
    rows = spark.read.option("header", True).csv(path)
    return rows.select(c("symbol").cast("long").alias("symbol"), F.lit(len(rows.columns)).alias("columns"), *[F.round(c(n).cast("double"), 3).alias(n) for n in PLAIN])


@query("k6_factor_parquet", so_far_sql())
def k6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots at nine times of the day as Parquet, a partition for each time, read back."""
    path = work_dir(spark, "factors-parquet")
    writers.factors_parquet(d13_all(spark, sf_dir), path)
    return spark.read.parquet(path).select(c("symbol").cast("long").alias("symbol"), c("label").cast("long").alias("label"), *factors.names())


@query("k8_latency_rows", "SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_delay, max(value) AS max_delay, max(ts) AS last FROM events GROUP BY event_type")
def k8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each channel and interval with its average and largest delay, appended as CSV and read back."""
    path = work_dir(spark, "latency")
    state = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("avg_delay"), F.max("value").alias("max_delay"), F.max("ts").cast("string").alias("last"))  # as text, which CSV does not cut to milliseconds
    writers.append_csv(state, path)
    rows = spark.read.option("header", True).csv(path)
    return rows.select("event_type", c("n").cast("long").alias("n"), F.round(c("avg_delay").cast("double"), 6).alias("avg_delay"), c("max_delay").cast("double").alias("max_delay"), c("last").cast("timestamp_ntz").alias("last"))


KINDS = {
    "stock_tick": ("events", "event_id", "value", "user_id", "lastpx", "totalvolumetrade"), "index_tick": ("events", "event_id", "value", "user_id", "lastpx", "totalvolumetrade"),
    "future_tick": ("events", "event_id", "value", "user_id", "lastpx", "totalvolumetrade"), "kline": ("events", "event_id", "value", "user_id", "closepx", "numtrades"),
    "stock_order": ("orders", "o_orderkey", "o_totalprice", "o_custkey", "orderprice", "orderqty"), "stock_transaction": ("lineitem", "l_orderkey", "l_extendedprice", "l_partkey", "tradeprice", "tradeqty"),
}


def _record_sql(kind: str) -> str:
    source, key, px, qty, _, _ = KINDS[kind]
    one = f"SELECT '{kind}' AS kind, CAST({key} AS VARCHAR) AS id, CAST({key} % 240000 AS INTEGER) AS mdtime, CAST({px} AS DOUBLE) AS px, CAST({qty} AS BIGINT) AS qty FROM {source}"
    again = f"{one} WHERE {key} % 2 = 0"
    return f"{one} UNION ALL {again}" if records.RECORDS[kind].adds else again


@query("k7_record_files", " UNION ALL ".join(f"({_record_sql(k)})" for k in KINDS))
def k7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of record is written twice, all rows and then half of them, and read back."""
    out = []
    for kind, (source, key, px, qty, px_name, qty_name) in KINDS.items():
        path, price, amount = work_dir(spark, kind), c(px).cast("double").alias(px_name), c(qty).cast("long").alias(qty_name)
        rows = table(spark, sf_dir, source).select(c(key).cast("string").alias("htscsecurityid"), (c(key) % 240_000).cast("int").alias("mdtime"), price, amount)
        records.write(rows, kind, path)
        records.write(rows.filter("cast(htscsecurityid as bigint) % 2 = 0"), kind, path)
        out.append(records.read(spark, kind, path).select(F.lit(kind).alias("kind"), c("htscsecurityid").alias("id"), "mdtime", c(px_name).alias("px"), c(qty_name).alias("qty")))
    return reduce(DataFrame.unionByName, out)


@query(
    "k8_latency_intervals",
    """WITH m AS (SELECT event_type AS channel, CAST(epoch_us(ts) AS BIGINT) // 1000 * 1000000 AS nano, event_id AS t, CAST(epoch_us(ts) AS BIGINT) // 3600000000 AS iv FROM events),
i AS (SELECT DISTINCT iv FROM m), ch AS (SELECT DISTINCT channel FROM m)
SELECT i.iv AS interval, ch.channel, max(nano) AS journal_nano, arg_max(t, (nano, t)) AS exchange_time FROM i CROSS JOIN ch LEFT JOIN m ON m.channel = ch.channel AND m.iv <= i.iv GROUP BY i.iv, ch.channel""",
)
def k8_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of messages in order, in four batches: hourly rows of all channels, appended as CSV and read back."""
    from .q_streaming import _landed

    path, nano = work_dir(spark, "latency-intervals"), times.epoch_ms(c("ts")) * 1_000_000
    rows = table(spark, sf_dir, "events").select(c("event_type").alias("channel"), nano.alias("journal_nano"), c("event_id").cast("long").alias("exchange_time"))
    names = [r[0] for r in rows.select("channel").distinct().collect()]  # a handful
    latency_writer = latency.writer(path, names, 3_600_000_000_000)
    _landed(spark, rows, "journal_nano", 4, "latency").writeStream.foreachBatch(latency_writer).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return latency.read(spark, path)


@query("k10_comparison_tables", "SELECT 'summary' AS part, CAST(count(*) FILTER (WHERE event_id % 4 = 0) AS BIGINT) AS n, round(CAST(count(*) FILTER (WHERE event_id % 4 <> 0) AS DOUBLE) / count(*), 9) AS x FROM events UNION ALL SELECT 'worst', least(count(*), 200), 1.0 FROM events WHERE event_id % 4 = 0 UNION ALL SELECT 'diff', event_id, CASE WHEN event_id % 4 = 0 THEN 1.0 ELSE 0.0 END FROM events UNION ALL SELECT 'synth', event_id, round(value, 6) FROM events")
def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of a comparison are written out and read back."""
    path = work_dir(spark, "comparison")
    e = table(spark, sf_dir, "events").select("event_id", c("value").cast("decimal(18,6)").cast("double").alias("value"))
    writers.comparison(e, e.withColumn("value", F.when(c("event_id") % 4 == 0, c("value") + 1).otherwise(c("value"))), ["event_id"], {"value": 1e-6}, path, 200)
    summary = spark.read.parquet(f"{path}/summary").select(F.lit("summary").alias("part"), c("value_mismatches").alias("n"), F.round("value_rate", 9).alias("x"))
    worst = spark.read.parquet(f"{path}/worst").groupBy(F.round("worst", 6).alias("x")).agg(F.count("*").alias("n")).select(F.lit("worst").alias("part"), "n", "x")
    diff = spark.read.parquet(f"{path}/diff").select(F.lit("diff").alias("part"), c("event_id").alias("n"), F.round("value_diff", 6).alias("x"))
    return summary.union(worst).union(diff).union(spark.read.parquet(f"{path}/synth").select(F.lit("synth"), "event_id", F.round("value", 6)))


CURRENT_SQL = f"SELECT b.* FROM ({q_bars.BARS_SQL}) b JOIN (WITH {q_bars.TICKS_SQL} SELECT code, max(tm) // 100000 AS last FROM ticks GROUP BY code) t ON t.code = b.code WHERE hour(b.datetime) * 100 + minute(b.datetime) <= CASE WHEN t.last % 100 = 59 THEN (t.last // 100 + 1) * 100 ELSE t.last + 1 END"


@query("r8_r9_finalise_current", CURRENT_SQL)
def r9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run to the end of the input; minutes after a code's last tick are not filled."""
    state, path = work_dir(spark, "current"), work_dir(spark, "current-in")
    ticks = q_bars.ticks(spark, sf_dir)
    ticks.write.parquet(path)
    stream = spark.readStream.schema(ticks.schema).parquet(path)
    sbars.versioned(stream, q_bars.previous(spark, sf_dir), state, fill_all=False).trigger(availableNow=True).start().awaitTermination()
    return sbars.latest(spark.read.parquet(f"{state}/published")).select("datetime", "code", *sbars.VALUES)


@query("r10_periodic_snapshots", "SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY user_id")
def r10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming aggregate is dumped whole at each trigger; the last dump has everything."""
    path, out = work_dir(spark, "dump-in"), work_dir(spark, "dump")
    rows = table(spark, sf_dir, "events").filter("event_type = 'view'").select("user_id", "ts")
    for part in range(2):
        rows.filter(F.pmod(c("user_id"), F.lit(2)) == part).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(path)
    dump = lambda frame, k: frame.write.mode("overwrite").parquet(f"{out}/dump={k}")
    stream.groupBy("user_id").agg(F.count("*").alias("n")).writeStream.outputMode("complete").foreachBatch(dump).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start().awaitTermination()
    every = spark.read.parquet(out)
    last = every.agg(F.max("dump").alias("last"))  # one row
    return every.join(F.broadcast(last), every["dump"] == last["last"]).select("user_id", "n")
