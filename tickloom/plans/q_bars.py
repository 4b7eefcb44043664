"""Bars over the provided tables. Events stand in for ticks: each user is a security, and the time of each event is folded
into one trading day, 09:20 to 15:06."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes, times
from ..session import table
from ..sources import writers
from . import bars
from .catalog import query

DAY = "2024-01-02"
SPAN_MS = 20_760_000

TICKS_SQL = f"""
folded AS (
  SELECT *, 33600000 + CAST(epoch_us(ts) AS BIGINT) // 1000 % {SPAN_MS} AS ms, CASE WHEN event_type = 'error' THEN 0.0 ELSE round(value, 2) END AS current FROM events),
ordered AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') || '.XSHE' AS code, current, event_id AS seq,
         (ms // 3600000) * 10000000 + (ms // 60000 % 60) * 100000 + (ms // 1000 % 60) * 1000 + ms % 1000 AS tm,
         CASE WHEN event_type IN ('purchase', 'click') THEN 100 ELSE 0 END AS step, CAST(floor(value * 100) AS BIGINT) AS paid
  FROM folded),
ticks AS (
  SELECT code, tm, seq, current, max(current) OVER w AS high, min(CASE WHEN current > 0 THEN current END) OVER w AS low,
         CAST(sum(step) OVER w AS BIGINT) AS volume, CAST(sum(CASE WHEN step > 0 THEN paid ELSE 0 END) OVER w AS BIGINT) AS money
  FROM ordered WINDOW w AS (PARTITION BY code ORDER BY tm, seq ROWS UNBOUNDED PRECEDING))
"""

BARS_SQL = f"""
WITH {TICKS_SQL},
flags AS (
  SELECT *, high IS DISTINCT FROM lag(high) OVER w AS high_moved, low IS DISTINCT FROM lag(low) OVER w AS low_moved,
         CASE WHEN tm < 92500000 THEN -1 WHEN tm < 93000000 THEN 931 WHEN tm = 113000000 THEN 1130 WHEN tm = 150000000 THEN 1500
              WHEN tm > 113000000 AND tm < 130000000 THEN -2 WHEN tm > 150000000 AND tm <= 150500000 THEN -3 WHEN tm > 150500000 THEN -4
              WHEN tm // 100000 % 100 = 59 THEN (tm // 10000000 + 1) * 100 ELSE tm // 100000 + 1 END AS phase
  FROM ticks WINDOW w AS (PARTITION BY code ORDER BY tm, seq)),
placed AS (
  SELECT *, CASE WHEN phase > 0 THEN phase WHEN phase = -2 AND n = 1 THEN 1130 WHEN phase = -3 AND n = 1 THEN 1500 END AS bar, phase IN (-2, -3) AND n = 1 AS carried
  FROM (SELECT *, row_number() OVER (PARTITION BY code, phase ORDER BY tm, seq) AS n FROM flags)),
inbar AS (
  SELECT *, current > 0 AND (volume IS DISTINCT FROM lag(volume) OVER w OR money IS DISTINCT FROM lag(money) OVER w) AS price,
         (tm // 100000 < bar OR tm = bar * 100000) AS in_time
  FROM placed WHERE bar IS NOT NULL WINDOW w AS (PARTITION BY code ORDER BY tm, seq)),
agg AS (
  SELECT code, bar, last(volume ORDER BY tm, seq) AS cv, last(money ORDER BY tm, seq) AS cm, last(current ORDER BY tm, seq) AS lc,
         first(current ORDER BY tm, seq) FILTER (WHERE price) AS po, last(current ORDER BY tm, seq) FILTER (WHERE price) AS pc,
         max(current) FILTER (WHERE price) AS ph, min(current) FILTER (WHERE price) AS pl,
         coalesce(bool_or(price AND in_time), false) AS ok, coalesce(bool_or(price AND carried), false) AS late,
         last(current ORDER BY tm, seq) FILTER (WHERE current > 0 AND in_time) AS anchor,
         max(high) FILTER (WHERE high_moved AND high > 0) AS nh, min(low) FILTER (WHERE low_moved AND low > 0) AS nl
  FROM inbar GROUP BY code, bar),
hung AS (
  SELECT code, bar, cv, cm, lc, pc, CASE WHEN late AND NOT ok AND anchor IS NOT NULL THEN anchor ELSE po END AS po,
         greatest(CASE WHEN late AND NOT ok AND anchor IS NOT NULL THEN greatest(ph, anchor) ELSE ph END, nh) AS ph,
         least(CASE WHEN late AND NOT ok AND anchor IS NOT NULL THEN least(pl, anchor) ELSE pl END, nl) AS pl
  FROM agg),
base AS (
  SELECT code, last(current ORDER BY tm, seq) AS bc, last(volume ORDER BY tm, seq) AS bv, last(money ORDER BY tm, seq) AS bm
  FROM ticks WHERE tm < 92500000 GROUP BY code),
universe AS (SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 6, '0') || '.XSHE' AS code FROM events UNION SELECT '999999.XSHE'),
labels AS (SELECT CAST(m // 60 * 100 + m % 60 AS INTEGER) AS bar FROM (SELECT unnest(range(571, 691)) AS m UNION ALL SELECT unnest(range(781, 901)) AS m)),
rack AS (
  SELECT u.code, l.bar, h.* EXCLUDE (code, bar), b.bc, b.bv, b.bm
  FROM universe u CROSS JOIN labels l LEFT JOIN hung h ON h.code = u.code AND h.bar = l.bar LEFT JOIN base b ON b.code = u.code),
ff AS (
  SELECT *, coalesce(last_value(lc IGNORE NULLS) OVER w, bc) AS anyc, last_value(pc IGNORE NULLS) OVER w AS tc, last_value(cv IGNORE NULLS) OVER w AS fv, last_value(cm IGNORE NULLS) OVER w AS fm
  FROM rack WINDOW w AS (PARTITION BY code ORDER BY bar ROWS UNBOUNDED PRECEDING)),
diffs AS (
  SELECT *, coalesce(tc, anyc) AS close, coalesce(lag(fv) OVER w, bv, 0) AS pv, coalesce(lag(fm) OVER w, bm, 0) AS pm FROM ff WINDOW w AS (PARTITION BY code ORDER BY bar)),
bars AS (
  SELECT code, bar, CASE WHEN po IS NULL THEN close ELSE po END AS open, CASE WHEN po IS NULL THEN close ELSE ph END AS high, CASE WHEN po IS NULL THEN close ELSE pl END AS low, close,
         greatest(coalesce(fv, pv) - pv, 0) AS volume, greatest(coalesce(fm, pm) - pm, 0) AS money
  FROM diffs),
noon AS (
  SELECT code, first(current ORDER BY tm, seq) AS shown FROM ticks WHERE tm BETWEEN 112900000 AND 112959999 AND current > 0
  GROUP BY code HAVING first(volume ORDER BY tm, seq) = last(volume ORDER BY tm, seq)),
noon_bars AS (
  SELECT b.code, b.bar, CASE WHEN u THEN shown ELSE open END AS open, CASE WHEN u THEN greatest(shown, close) ELSE high END AS high, CASE WHEN u THEN least(shown, close) ELSE low END AS low, close, volume, money
  FROM (SELECT b.*, n.shown, coalesce(b.bar = 1130 AND abs(b.open - n.shown) > 1e-6 + 1e-5 * abs(n.shown), false) AS u FROM bars b LEFT JOIN noon n ON n.code = b.code) b),
pre AS (
  SELECT code, last(current ORDER BY tm, seq) AS c, last(volume ORDER BY tm, seq) AS v, last(money ORDER BY tm, seq) AS m FROM ticks WHERE tm < 150000000 AND current > 0 GROUP BY code),
auction AS (
  SELECT t.code, first(t.current ORDER BY tm, seq) AS c, first(t.volume ORDER BY tm, seq) AS v, first(t.money ORDER BY tm, seq) AS m
  FROM ticks t JOIN pre p ON p.code = t.code
  WHERE tm BETWEEN 150000000 AND 150500000 AND current > 0 AND (volume > p.v OR money > p.m OR (tm = 150000000 AND current <> p.c)) GROUP BY t.code),
closed AS (
  SELECT b.code, b.bar, CASE WHEN u THEN pc ELSE open END AS open, CASE WHEN u THEN ac ELSE close END AS close, CASE WHEN u THEN greatest(pc, ac) ELSE high END AS high, CASE WHEN u THEN least(pc, ac) ELSE low END AS low,
         CASE WHEN u THEN greatest(av - pv, 0) ELSE volume END AS volume, CASE WHEN u THEN greatest(am - pm, 0) ELSE money END AS money
  FROM (SELECT b.*, p.c AS pc, p.v AS pv, p.m AS pm, a.c AS ac, a.v AS av, a.m AS am, b.bar = 1500 AND a.code IS NOT NULL AS u FROM noon_bars b LEFT JOIN pre p ON p.code = b.code LEFT JOIN auction a ON a.code = b.code) b),
valid AS (SELECT code, min(tm) // 100000 AS fv FROM ticks WHERE current > 0 OR volume > 0 OR money > 0 GROUP BY code),
prev AS (SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 6, '0') || '.XSHE' AS code, CAST(user_id AS DOUBLE) + 0.5 AS pdc FROM events WHERE user_id % 3 <> 0 UNION ALL SELECT '999999.XSHE', 7.25),
filled AS (
  SELECT c.*, p.pdc, p.pdc IS NOT NULL AND c.volume = 0 AND c.money = 0 AND coalesce(c.open, 0) = 0 AND coalesce(c.close, 0) = 0 AND coalesce(c.high, 0) = 0 AND coalesce(c.low, 0) = 0
         AND (v.fv IS NULL OR c.bar < CASE WHEN v.fv % 100 = 59 THEN (v.fv // 100 + 1) * 100 ELSE v.fv + 1 END) AS u
  FROM closed c LEFT JOIN prev p ON p.code = c.code LEFT JOIN valid v ON v.code = c.code)
SELECT TIMESTAMP '{DAY} 00:00:00' + to_minutes(CAST(bar // 100 * 60 + bar % 100 AS BIGINT)) AS datetime, code,
       CAST(CASE WHEN u THEN pdc ELSE open END AS FLOAT) AS open, CAST(CASE WHEN u THEN pdc ELSE close END AS FLOAT) AS close,
       CAST(CASE WHEN u THEN pdc ELSE high END AS FLOAT) AS high, CAST(CASE WHEN u THEN pdc ELSE low END AS FLOAT) AS low,
       CAST(floor(money + 1e-6) AS DOUBLE) AS money, CAST(volume AS DOUBLE) AS volume
FROM filled
"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks of one trading day."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ms = F.lit(33_600_000) + F.pmod(times.epoch_ms(F.col("ts")), F.lit(SPAN_MS))
    step = F.when(F.col("event_type").isin("purchase", "click"), 100).otherwise(0)
    rows = e.select(codes.code(F.col("user_id")).alias("code"), F.lit(DAY).cast("date").alias("date"), times.ms_to_tm(ms).alias("tm"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", 0.0).otherwise(F.round("value", 2)).alias("current"), step.alias("step"), F.when(step > 0, F.floor(F.col("value") * 100)).otherwise(0).alias("paid"))
    w = Window.partitionBy("code", "date").orderBy("tm", "seq").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("code", "date", "tm", "seq", "current", F.max("current").over(w).alias("high"), F.min(F.when(F.col("current") > 0, F.col("current"))).over(w).alias("low"), F.sum("step").over(w).cast("long").alias("volume"), F.sum("paid").over(w).cast("long").alias("money"))


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's code, and one that never trades."""
    own = table(spark, sf_dir, "events").select(codes.code(F.col("user_id")).alias("code"))
    return own.union(spark.range(1).select(F.lit("999999.XSHE"))).distinct().withColumn("date", F.lit(DAY).cast("date"))


def previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous closes, which a third of the codes lack."""
    own = table(spark, sf_dir, "events").filter("user_id % 3 <> 0").select("user_id").distinct()
    return own.select(codes.code(F.col("user_id")).alias("code"), (F.col("user_id") + 0.5).cast("double").alias("prev_day_close")).union(spark.range(1).select(F.lit("999999.XSHE"), F.lit(7.25)))


@query("d8_bars", BARS_SQL)
def d8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.minute_bars(ticks(spark, sf_dir), universe(spark, sf_dir), previous(spark, sf_dir))


@query("d8_keyed_bars", BARS_SQL)
def d8_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from ticks that are stored by code and date, which are then not shuffled."""
    name = f"ticks_{uuid.uuid4().hex}"
    writers.keyed_ticks(ticks(spark, sf_dir), name, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return bars.minute_bars(spark.table(name), universe(spark, sf_dir), previous(spark, sf_dir))


BODY = BARS_SQL.rsplit("SELECT TIMESTAMP", 1)[0]


@query("d1_baseline", f"{BODY} SELECT code, bc, bv, bm FROM base")
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each code stood at before 09:25."""
    at = F.struct("tm", "seq")
    return ticks(spark, sf_dir).filter("tm < 92500000").groupBy("code").agg(F.max_by("current", at).alias("bc"), F.max_by("volume", at).alias("bv"), F.max_by("money", at).alias("bm"))


@query("d2_session_end_carry", f"{BODY} SELECT code, seq, tm, bar FROM placed WHERE carried")
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tick after each session, put back into its last bar."""
    return bars.with_labels(ticks(spark, sf_dir)).filter("carried").select("code", "seq", "tm", "bar")


@query("d3_price_ticks", f"{BODY} SELECT code, seq, bar FROM inbar WHERE price")
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks that take part in a bar's prices."""
    return bars.with_price_flags(bars.with_labels(ticks(spark, sf_dir))).filter("is_price").select("code", "seq", "bar")


def _steps(spark: SparkSession, sf_dir: str, *rules) -> DataFrame:
    marked = universe(spark, sf_dir).unionByName(ticks(spark, sf_dir), allowMissingColumns=True)
    rows = bars.filled(bars.spine(bars.bar_aggregates(bars.with_auction_flags(bars.with_price_flags(bars.with_labels(marked))))))
    for rule in rules:
        rows = rule(rows)
    return rows.select("code", F.col("label").alias("bar"), "open", "high", "low", "close", "volume", "money")


STEP = "SELECT code, bar, open, high, low, close, CAST(volume AS BIGINT) AS volume, CAST(money AS BIGINT) AS money FROM"


@query("d4_intraday_bars", f"{BODY} {STEP} bars")
def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars before the rules of 11:30, 15:00 and the previous close."""
    return _steps(spark, sf_dir)


@query("d5_morning_end", f"{BODY} {STEP} noon_bars")
def d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir, bars.morning_end)


@query("d6_close_auction", f"{BODY} {STEP} closed")
def d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir, bars.morning_end, bars.close_auction)


@query("d7_previous_close", f"{BODY} SELECT code, count(*) AS filled FROM filled WHERE u GROUP BY code")
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many bars of each code stand at the previous close."""
    marked = universe(spark, sf_dir).unionByName(ticks(spark, sf_dir), allowMissingColumns=True)
    rows = bars.close_auction(bars.morning_end(bars.filled(bars.spine(bars.bar_aggregates(bars.with_auction_flags(bars.with_price_flags(bars.with_labels(marked))))))))
    before = rows.select("code", "label", F.col("close").alias("was"))
    after = bars.previous_close(rows, previous(spark, sf_dir)).select("code", "label", "close", "prev_day_close")
    return after.join(before, ["code", "label"]).filter("close = prev_day_close and coalesce(was, 0) = 0").groupBy("code").agg(F.count("*").alias("filled"))


PLAIN = bars.Rules(boundary="prev", prices="all", carry=False, extrema="current")
PLAIN_SQL = (
    BARS_SQL.replace("WHEN tm // 100000 % 100 = 59", "WHEN tm % 100000 = 0 AND tm NOT IN (93000000, 130000000) THEN tm // 100000 WHEN tm // 100000 % 100 = 59")
    .replace("WHEN phase = -2 AND n = 1 THEN 1130 WHEN phase = -3 AND n = 1 THEN 1500", "")
    .replace("current > 0 AND (volume IS DISTINCT FROM lag(volume) OVER w OR money IS DISTINCT FROM lag(money) OVER w) AS price", "current > 0 AS price")
    .replace("WHEN late AND NOT ok AND anchor IS NOT NULL THEN", "WHEN false THEN")
    .replace("ELSE ph END, nh) AS ph", "ELSE ph END, ph) AS ph")
    .replace("ELSE pl END, nl) AS pl", "ELSE pl END, pl) AS pl")
)


@query("d9_bars_other_rules", PLAIN_SQL)
def d9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All switches the other way: full minutes end a bar, every snapshot counts, nothing is carried back."""
    return bars.minute_bars(ticks(spark, sf_dir), universe(spark, sf_dir), previous(spark, sf_dir), PLAIN)


@query(
    "d10_d16_bar_comparison",
    f"""WITH a AS ({BARS_SQL}), b AS ({PLAIN_SQL})
SELECT count(*) FILTER (WHERE a.code IS NOT NULL AND b.code IS NOT NULL) AS "both", count(*) FILTER (WHERE b.code IS NULL) AS left_only, count(*) FILTER (WHERE a.code IS NULL) AS right_only,
       count(*) FILTER (WHERE NOT coalesce(abs(CAST(a.close AS DOUBLE) - CAST(b.close AS DOUBLE)) <= 1e-6 + 1e-9 * abs(CAST(b.close AS DOUBLE)), a.close IS NULL AND b.close IS NULL)) AS close_mismatches,
       count(*) FILTER (WHERE abs(a.volume - b.volume) > 1e-6 + 1e-9 * abs(b.volume)) AS volume_mismatches, count(*) FILTER (WHERE abs(a.money - b.money) > 1 + 1e-9 * abs(b.money)) AS money_mismatches,
       max(abs(a.volume - b.volume)) AS volume_max_diff, max(abs(a.money - b.money)) AS money_max_diff
FROM a FULL JOIN b ON a.code = b.code AND a.datetime = b.datetime""",
)
def d16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two syntheses of the same day against each other."""
    from ..operators import compare

    inputs = ticks(spark, sf_dir), universe(spark, sf_dir), previous(spark, sf_dir)
    diff = compare.differences(bars.minute_bars(*inputs), bars.minute_bars(*inputs, PLAIN), ["code", "datetime"], {"close": 1e-6, "volume": 1e-6, "money": 1.0})
    return compare.summary(diff, ["close", "volume", "money"]).drop("close_max_diff", "close_rate", "volume_rate", "money_rate")
