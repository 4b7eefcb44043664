"""Order lifecycles and factors over the provided tables: orders are orders, and line items are trades between an order and
a counterpart of the other side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, times
from ..session import kept, table
from . import factors, increments, orders
from .catalog import query

TM = "({ms} // 3600000 * 10000000 + {ms} // 60000 % 60 * 100000 + {ms} // 1000 % 60 * 1000 + {ms} % 1000)"
BASE_SQL = f"""
o AS (
  SELECT 1 AS channelid, o_orderkey AS orderid, {TM.format(ms='(34200000 + o_orderkey * 7919 % 7000000)')} AS ordertm, o_orderkey % 40 AS symbol,
         floor(o_totalprice / 10) / 100 AS orderpx, (o_orderkey % 50 + 1) * 100 AS ordervol, CASE WHEN o_orderkey % 2 = 0 THEN 66 ELSE 83 END AS sideflag, o_orderkey AS seq
  FROM orders),
l AS (
  SELECT 1 AS channelid, CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey ELSE l_partkey * 2 END AS tradebuyid, CASE WHEN l_orderkey % 2 = 1 THEN l_orderkey ELSE l_partkey * 2 + 1 END AS tradesellid,
         {TM.format(ms='(34200000 + (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 7200000)')} AS tradetm, l_suppkey % 40 AS symbol,
         floor(l_extendedprice / l_quantity) / 100 AS tradepx, CAST(l_quantity AS BIGINT) * 100 AS tradevol, CASE l_linenumber % 3 WHEN 0 THEN 78 WHEN 1 THEN 66 ELSE 83 END AS sideflag,
         (l_partkey * 1000 + l_linenumber) * 100000 + l_suppkey AS seq, l_linenumber
  FROM lineitem),
sh_o AS (
  SELECT channelid, orderid, ordertm, symbol, orderpx, ordervol, 65 AS ordertype, sideflag FROM o WHERE orderid % 10 <> 9
  UNION ALL SELECT channelid, orderid, ordertm + 10000000, symbol, orderpx, CASE WHEN orderid % 2 = 0 THEN ordervol ELSE ordervol // 2 END, 68, sideflag FROM o WHERE orderid % 7 = 0),
sz_o AS (SELECT channelid, orderid, ordertm, symbol, orderpx, ordervol, CASE orderid % 5 WHEN 0 THEN 49 WHEN 1 THEN 85 ELSE 50 END AS ordertype, sideflag FROM o),
sz_t AS (
  SELECT channelid, CASE WHEN l_linenumber = 6 THEN 0 ELSE tradebuyid END AS tradebuyid, CASE WHEN l_linenumber = 5 THEN 0 ELSE tradesellid END AS tradesellid,
         tradetm, symbol, CASE WHEN l_linenumber >= 5 THEN 0.0 ELSE tradepx END AS tradepx, tradevol, CASE WHEN l_linenumber >= 5 THEN 52 ELSE 70 END AS tradetype, seq FROM l)
"""
MS = "({t} // 10000000 * 3600000 + {t} // 100000 % 100 * 60000 + {t} // 1000 % 100 * 1000 + {t} % 1000)"


def _cont(t: str) -> str:
    m = MS.format(t=t)
    return f"(CASE WHEN {m} < 34197000 THEN {m} + 300000 WHEN {m} > 46797000 THEN {m} - 5400000 ELSE {m} END)"


SH_SQL = """
t AS (SELECT *, sideflag AS side FROM l WHERE tradebuyid <> 0 AND tradesellid <> 0),
agg AS (
  SELECT channelid, CASE WHEN side = 66 THEN tradebuyid ELSE tradesellid END AS orderid, side, arg_min(symbol, (tradetm, seq)) AS ts, sum(tradevol) AS tv, min(tradetm) AS tt, CASE WHEN side = 66 THEN max(tradepx) ELSE min(tradepx) END AS tp
  FROM t WHERE side IN (66, 83) GROUP BY channelid, CASE WHEN side = 66 THEN tradebuyid ELSE tradesellid END, side),
n AS (SELECT * FROM sh_o WHERE orderid > 0 AND ordertype = 65),
known AS (
  SELECT coalesce(n.channelid, a.channelid) AS channelid, coalesce(n.orderid, a.orderid) AS orderid, coalesce(n.sideflag, a.side) AS side, coalesce(symbol, ts) AS symbol, coalesce(ordertm, tt) AS ordertm,
         coalesce(orderpx, tp) AS orderpx, CAST(coalesce(ordervol, 0) + coalesce(tv, 0) AS BIGINT) AS ordervol
  FROM n FULL JOIN agg a ON n.channelid = a.channelid AND n.orderid = a.orderid AND n.sideflag = a.side),
w AS (SELECT channelid, orderid, sideflag AS side, symbol, ordertm AS withdrawtm, orderpx AS withdrawpx, ordervol AS withdrawvol FROM sh_o WHERE ordertype = 68 AND orderid > 0)
"""
SZ_SQL = """
t AS (SELECT *, CASE WHEN tradebuyid > tradesellid THEN 66 ELSE 83 END AS side FROM sz_t WHERE tradetype = 70 AND tradebuyid <> 0 AND tradesellid <> 0),
n AS (SELECT * REPLACE (CASE WHEN ordertype = 50 THEN orderpx END AS orderpx) FROM sz_o WHERE orderid > 0),
last_t AS (SELECT symbol, side, tradetm, arg_max(tradepx, seq) AS tradepx FROM t GROUP BY ALL),
known AS (
  SELECT n.channelid, n.orderid, n.sideflag AS side, n.symbol, n.ordertm, coalesce(n.orderpx, CASE WHEN ordertype = 49 THEN tradepx * CASE WHEN n.sideflag = 66 THEN 1.001 ELSE 0.999 END ELSE tradepx END) AS orderpx, n.ordervol
  FROM (SELECT *, CASE WHEN sideflag = 66 THEN 83 ELSE 66 END AS opposite FROM n) n ASOF LEFT JOIN last_t ON n.symbol = last_t.symbol AND n.opposite = last_t.side AND n.ordertm >= last_t.tradetm),
w AS (
  SELECT channelid, CASE WHEN tradesellid = 0 THEN tradebuyid ELSE tradesellid END AS orderid, CASE WHEN tradesellid = 0 THEN 66 ELSE 83 END AS side, symbol, tradetm AS withdrawtm, CAST(NULL AS DOUBLE) AS withdrawpx, tradevol AS withdrawvol
  FROM sz_t WHERE tradebuyid + tradesellid <> 0 AND (tradebuyid = 0 OR tradesellid = 0))
"""
RICH_SQL = f"""
rich_o AS (SELECT *, ordervol * orderpx AS ordermoney FROM known),
rich_w AS (
  SELECT channelid, orderid, side, w.symbol, withdrawtm, coalesce(withdrawpx, k.orderpx) AS withdrawpx, withdrawvol, k.ordertm, k.ordervol, withdrawvol * coalesce(withdrawpx, k.orderpx) AS withdrawmoney,
         {_cont('withdrawtm')} - {_cont('k.ordertm')} AS withdrawtmlag
  FROM w LEFT JOIN known k USING (channelid, orderid, side)),
rich_t AS (
  SELECT t.*, t.tradevol * t.tradepx AS trademoney, b.ordervol AS ordervol_buy, b.ordermoney AS ordermoney_buy, s.ordervol AS ordervol_sell, s.ordermoney AS ordermoney_sell,
         abs({_cont('b.ordertm')} - {_cont('s.ordertm')}) AS ordertmlag, abs(b.ordermoney - s.ordermoney) AS ordermoneydiff
  FROM t LEFT JOIN rich_o b ON b.channelid = t.channelid AND b.orderid = t.tradebuyid AND b.side = 66 LEFT JOIN rich_o s ON s.channelid = t.channelid AND s.orderid = t.tradesellid AND s.side = 83)
"""


def _tm(ms) -> F.Column:
    return times.ms_to_tm(F.lit(34_200_000) + ms)


def raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and trades before either exchange's rules."""
    key = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.lit(1).alias("channelid"), key.alias("orderid"), _tm(key * 7919 % 7_000_000).alias("ordertm"), (key % 40).alias("symbol"), (F.floor(F.col("o_totalprice") / 10) / 100).alias("orderpx"), ((key % 50 + 1) * 100).cast("long").alias("ordervol"), F.when(key % 2 == 0, codes.BUY).otherwise(codes.SELL).cast("smallint").alias("sideflag"), key.alias("seq"))
    k, p, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    trades = table(spark, sf_dir, "lineitem").select(
        F.lit(1).alias("channelid"), F.when(k % 2 == 0, k).otherwise(p * 2).alias("tradebuyid"), F.when(k % 2 == 1, k).otherwise(p * 2 + 1).alias("tradesellid"), _tm((k * 31 + p * 17 + n) % 7_200_000).alias("tradetm"),
        (F.col("l_suppkey") % 40).alias("symbol"), (F.floor(F.col("l_extendedprice") / F.col("l_quantity")) / 100).alias("tradepx"), (F.col("l_quantity").cast("long") * 100).alias("tradevol"),
        F.when(n % 3 == 0, codes.NEUTRAL).when(n % 3 == 1, codes.BUY).otherwise(codes.SELL).cast("smallint").alias("sideflag"), ((p * 1000 + n) * 100_000 + F.col("l_suppkey")).alias("seq"), n.alias("n"),
    )
    return o, trades


def shanghai_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and trades as Shanghai would report them: one order in ten is only known by its trades, one in seven is withdrawn."""
    o, t = raw(spark, sf_dir)
    new = o.filter("orderid % 10 <> 9").withColumn("ordertype", F.lit(codes.SH_ADD))
    gone = o.filter("orderid % 7 = 0").withColumns({"ordertype": F.lit(codes.SH_CANCEL), "ordertm": F.col("ordertm") + 10_000_000, "ordervol": F.when(F.col("orderid") % 2 == 0, F.col("ordervol")).otherwise(times.div(F.col("ordervol"), 2))})
    return new.unionByName(gone), t


def shanghai(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> orders.Lifecycle:
    """The lifecycle of Shanghai's messages."""
    return orders.sh_lifecycle(*shanghai_messages(spark, sf_dir), keep=keep)


def shenzhen_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and trades as Shenzhen would report them: some without a limit, withdrawals among the trades."""
    o, t = raw(spark, sf_dir)
    kind = F.when(F.col("orderid") % 5 == 0, codes.SZ_MARKET).when(F.col("orderid") % 5 == 1, codes.SZ_BEST).otherwise(codes.SZ_LIMIT)
    late = F.col("n") >= 5
    t = t.withColumns({"tradebuyid": F.when(F.col("n") == 6, 0).otherwise(F.col("tradebuyid")), "tradesellid": F.when(F.col("n") == 5, 0).otherwise(F.col("tradesellid")), "tradepx": F.when(late, 0.0).otherwise(F.col("tradepx")), "tradetype": F.when(late, codes.SZ_WITHDRAW).otherwise(codes.SZ_TRADE)})
    return o.withColumn("ordertype", kind), t


def shenzhen(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> orders.Lifecycle:
    """The lifecycle of Shenzhen's messages."""
    return orders.sz_lifecycle(*shenzhen_messages(spark, sf_dir), keep=keep)


def _r(c: str, k: int = 6) -> F.Column:
    return F.round(c, k).alias(c)


O_COLS = "orderid, CAST(side AS INTEGER) AS side, symbol, ordertm, round(orderpx, 6) AS orderpx, ordervol"
W_COLS = "orderid, CAST(side AS INTEGER) AS side, symbol, withdrawtm, round(withdrawpx, 6) AS withdrawpx, withdrawvol, ordervol, withdrawtmlag"
T_COLS = "tradebuyid, tradesellid, tradetm, CAST(side AS INTEGER) AS side, round(trademoney, 6) AS trademoney, ordervol_buy, ordervol_sell, ordertmlag, round(ordermoneydiff, 6) AS ordermoneydiff"


def _lifecycle(name: str, rules: str, life) -> None:
    head = f"WITH {BASE_SQL}, {rules}, {RICH_SQL}"

    @query(f"{name}_orders", f"{head} SELECT {O_COLS} FROM rich_o")
    def known(spark: SparkSession, sf_dir: str) -> DataFrame:
        return life(spark, sf_dir).orders.select("orderid", F.col("side").cast("int").alias("side"), "symbol", "ordertm", _r("orderpx"), "ordervol")

    @query(f"{name}_withdraws", f"{head} SELECT {W_COLS} FROM rich_w")
    def withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return life(spark, sf_dir).withdraws.select("orderid", F.col("side").cast("int").alias("side"), "symbol", "withdrawtm", _r("withdrawpx"), "withdrawvol", "ordervol", "withdrawtmlag")

    @query(f"{name}_trades", f"{head} SELECT {T_COLS} FROM rich_t")
    def traded(spark: SparkSession, sf_dir: str) -> DataFrame:
        return life(spark, sf_dir).trades.select("tradebuyid", "tradesellid", "tradetm", F.col("side").cast("int").alias("side"), _r("trademoney"), "ordervol_buy", "ordervol_sell", "ordertmlag", _r("ordermoneydiff"))


_lifecycle("d11_sh", SH_SQL, shanghai)
_lifecycle("d12_sz", SZ_SQL, shenzhen)


@query(
    "j8_a16_open_orders",
    f"""WITH {BASE_SQL}, {SH_SQL}, {RICH_SQL},
gone AS (
  SELECT tradebuyid AS orderid, 66 AS side FROM rich_t GROUP BY tradebuyid HAVING max(ordervol_buy) <= sum(tradevol)
  UNION SELECT tradesellid, 83 FROM rich_t GROUP BY tradesellid HAVING max(ordervol_sell) <= sum(tradevol)
  UNION SELECT orderid, side FROM rich_w WHERE ordervol <= withdrawvol)
SELECT orderid, CAST(side AS INTEGER) AS side, ordervol FROM rich_o o WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.orderid = o.orderid AND g.side = o.side)""",
)
def j8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.still_open(shanghai(spark, sf_dir)).select("orderid", F.col("side").cast("int").alias("side"), "ordervol")


@query("w10_traded_so_far", f"WITH {BASE_SQL} SELECT tradebuyid, tradetm, seq, CAST(sum(tradevol) OVER (PARTITION BY tradebuyid ORDER BY tradetm, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far FROM l")
def w10(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = raw(spark, sf_dir)[1]
    return t.select("tradebuyid", "tradetm", "seq", orders.traded_so_far(t, "buy").alias("so_far"))


@query("a14_aggressive_orders", f"WITH {BASE_SQL}, {SH_SQL} SELECT orderid, CAST(side AS INTEGER) AS side, ts AS symbol, CAST(tv AS BIGINT) AS vol, tt AS tm, tp AS px FROM agg")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = orders.sh_trades(raw(spark, sf_dir)[1])
    return orders.aggressive(t).select("orderid", F.col("side").cast("int").alias("side"), F.col("t_symbol").alias("symbol"), F.col("t_vol").alias("vol"), F.col("t_tm").alias("tm"), F.col("t_px").alias("px"))


LARGE = "({v} >= 100000 OR {m} >= 1000000)"
SMALL = "(({v} BETWEEN 0 AND 10000 AND {m} BETWEEN 0 AND 100000) OR ({v} BETWEEN 0 AND 1000 AND {m} BETWEEN 0 AND 500000))"


def _conditions(family: str) -> dict[str, str]:
    if family == "order":
        pairs = {"": ("ordervol", "ordermoney")}
    elif family == "withdraw":
        pairs = {"": ("withdrawvol", "withdrawmoney")}
    else:
        pairs = {"": ("tradevol", "trademoney"), "bo": ("ordervol_buy", "ordermoney_buy"), "so": ("ordervol_sell", "ordermoney_sell")}
    out = {"": "true"}
    for k, (v, m) in pairs.items():
        out |= {f"{k}large": LARGE.format(v=v, m=m), f"{k}small": SMALL.format(v=v, m=m)}
    if family == "withdraw":
        out |= {"complete": "withdrawvol = ordervol", "partial": "withdrawvol < ordervol", "instant": "withdrawtmlag BETWEEN 0 AND 3000"}
    return out


def _digits(name: str) -> int:
    """Decimals at which a factor is compared: means of returns and turnovers are small."""
    return 3 if "_skew" in name or "_kurt" in name else 9 if "turnover" in name else 6 if "ret" in name else 3


def _moment_sql(x: str, where: str, name: str) -> list[str]:
    f = f"FILTER (WHERE {where})"
    n, s = f"count({x}) {f}", [f"sum(pow(CAST({x} AS DOUBLE), {k})) {f}" for k in (1, 2, 3, 4)]
    mu = f"({s[0]} / {n})"
    m2 = f"({s[1]} / {n} - {mu} * {mu})"
    m3 = f"({s[2]} / {n} - 3 * {mu} * {s[1]} / {n} + 2 * {mu} * {mu} * {mu})"
    m4 = f"({s[3]} / {n} - 4 * {mu} * {s[2]} / {n} + 6 * {mu} * {mu} * {s[1]} / {n} - 3 * {mu} * {mu} * {mu} * {mu})"
    ok = f"{m2} > 0.0009765625 * {mu} * {mu}"
    return [f"CASE WHEN {n} > 0 THEN round({mu}, {_digits(name)}) END AS {name.format('mean')}", f"CASE WHEN {n} >= 2 THEN round(sqrt(greatest(({s[1]} - {s[0]} * {s[0]} / {n}) / ({n} - 1), 0)), {_digits(name)}) END AS {name.format('std')}", f"CASE WHEN {n} >= 3 AND {ok} THEN round({m3} / pow({m2}, 1.5) + {factors.TIE}, 3) END AS {name.format('skew')}", f"CASE WHEN {n} >= 4 AND {ok} THEN round({m4} / ({m2} * {m2}) - 3 + {factors.TIE}, 3) END AS {name.format('kurt')}"]


def _family_sql(family: str, prefix: str, families: factors.Families = factors.FAMILIES, source: str = "rich") -> str:
    _, vol, money, fields, by_means = families[family]
    side = {"buy": "side = 66", "sell": "side = 83", "both": "true"}[prefix]
    out, price = [], "avg" if by_means else "sum"
    for bucket, condition in _conditions(family).items():
        where, tail = f"{side} AND coalesce({condition}, false)", f"_{bucket}" if bucket else ""
        out.append(f"CAST(count(*) FILTER (WHERE {where}) AS DOUBLE) AS {prefix}_{family}_count{tail}")
        out.append(f"CASE WHEN sum({vol}) FILTER (WHERE {where}) > 0 THEN round({price}({money}) FILTER (WHERE {where}) / {price}({vol}) FILTER (WHERE {where}), 3) END AS {prefix}_{family}vwapx{tail}")
        for f in fields:
            out += _moment_sql(f, where, f"{prefix}_{f}_{{}}{tail}")
        if family == "trade":
            out += [f"CAST(count(DISTINCT trade{w}id) FILTER (WHERE {where}) AS DOUBLE) AS {prefix}_trade_{w}order_count{tail}" for w in ("buy", "sell")]
    return f"SELECT symbol, {', '.join(out)} FROM {source}_{family[0]} GROUP BY symbol"


def _three(name: str) -> int:
    """Decimals at which the 492 factors are compared."""
    return 3


def _snapshot_sql(families: list[tuple[str, str]], columns: list[str], rules: str = SH_SQL, first: int = 0) -> str:
    parts = [f"(SELECT DISTINCT symbol FROM rich_o UNION SELECT DISTINCT symbol FROM rich_w UNION SELECT DISTINCT symbol FROM rich_t) rack", *(f"({_family_sql(f, p)}) {f}_{p} USING (symbol)" for f, p in families)]
    shown = ", ".join(f"coalesce({c}, 0.0) AS {c}" if "_count" in c else c for c in columns)
    return f"WITH {BASE_SQL}, {rules}, {RICH_SQL} SELECT symbol + {first} AS symbol, {shown} FROM {' LEFT JOIN '.join(parts)}"


ALL_FAMILIES = [("order", "buy"), ("order", "sell"), ("withdraw", "buy"), ("withdraw", "sell"), ("trade", "both"), ("trade", "buy"), ("trade", "sell")]


def snapshot_sql() -> str:
    """All factors of Shanghai's symbols."""
    return _snapshot_sql(ALL_FAMILIES, factors.names())


SHANGHAI = 600_000  # Shanghai's symbols begin here, so the two exchanges have none in common
_BOTH = f"SELECT * FROM ({_snapshot_sql(ALL_FAMILIES, factors.names(), SH_SQL, SHANGHAI)}) UNION ALL SELECT * FROM ({_snapshot_sql(ALL_FAMILIES, factors.names(), SZ_SQL)})"


@query("d14_all_market_snapshot", _BOTH)
def d14_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 492 factors of every symbol of both exchanges, from one lifecycle."""
    sh = shanghai(spark, sf_dir, keep=kept)
    own = lambda rows: rows.withColumn("symbol", F.col("symbol") + SHANGHAI)
    every = orders.both(orders.Lifecycle(own(sh.orders), own(sh.withdraws), own(sh.trades)), shenzhen(spark, sf_dir, kept))
    return factors.snapshot(every, _three, kept)


@query("d14_factor_snapshot", snapshot_sql())
def d14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 492 factors of every symbol."""
    return factors.snapshot(shanghai(spark, sf_dir, keep=kept), _three, kept)


for _family in ("order", "withdraw", "trade"):
    _own = [c for c in factors.names() if c.startswith("buy_") and (c.split("_")[1].startswith(_family) or c.split("_")[1] in ("ordertmlag", "ordermoneydiff") and _family == "trade")]
    if _family == "order":
        _own = [c for c in _own if not c.startswith(("buy_ordertmlag", "buy_ordermoneydiff"))]

    def _one(spark: SparkSession, sf_dir: str, family: str = _family, own: tuple[str, ...] = tuple(_own)) -> DataFrame:
        life = shanghai(spark, sf_dir, keep=kept)
        buy = orders.Lifecycle(*[rows.filter(F.col("side") == codes.BUY) for rows in (life.orders, life.withdraws, life.trades)])
        return factors.snapshot(buy, _three, kept, [family]).select("symbol", *own)

    query(f"a13_buy_{_family}_factors", f"WITH {BASE_SQL}, {SH_SQL}, {RICH_SQL} SELECT symbol, {', '.join(_own)} FROM ({_family_sql(_family, 'buy')}) WHERE buy_{_family}_count > 0")(_one)


LABEL_SQL = "CASE WHEN tradetm // 100000 % 100 = 59 THEN (tradetm // 10000000 + 1) * 100 ELSE tradetm // 100000 + 1 END"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = raw(spark, sf_dir)[1]
    return t.withColumns({"trademoney": F.col("tradevol") * F.col("tradepx"), "label": times.next_minute(times.div(F.col("tradetm"), 100_000)).cast("long")})


@query(
    "d13_cumulative_factors",
    f"""WITH {BASE_SQL}, t AS (SELECT *, {LABEL_SQL} AS lab FROM l), asked AS (SELECT unnest([925, 1000, 1030, 1100, 1130, 1330, 1400, 1430, 1500]) AS label), s AS (SELECT DISTINCT symbol FROM t)
SELECT s.symbol, CAST(asked.label AS BIGINT) AS label, CASE WHEN count(t.symbol) > 0 THEN count(t.symbol) END AS trades, round(avg(tradevol * tradepx), 6) AS trademoney_mean, round(stddev_samp(tradevol * tradepx), 2) AS trademoney_std, round(sum(tradevol * tradepx) / sum(tradevol), 4) AS tradevwapx,
       CASE WHEN count(t.symbol) > 0 THEN count(DISTINCT tradebuyid) END AS buyorders
FROM s CROSS JOIN asked LEFT JOIN t ON t.symbol = s.symbol AND t.lab <= asked.label GROUP BY s.symbol, asked.label""",
)
def d13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments and distinct orders of all trades so far, at nine times of the day; d13_cumulative_factors_all has all factors."""
    from ..functions import moments as m

    t = _labelled(spark, sf_dir)
    bucket = t.groupBy("symbol", "label").agg(*m.bucketed(F.col("tradevol"), F.col("trademoney"), {"trademoney": F.col("trademoney")}, {"": None}))
    from pyspark.sql import Window

    w = Window.partitionBy("symbol").orderBy("label").rowsBetween(Window.unboundedPreceding, 0)
    sums = [c for c in bucket.columns if c not in ("symbol", "label")]
    so_far = bucket.select("symbol", "label", *[F.sum(c).over(w).alias(c) for c in sums]).join(factors.cumulative_distinct(t, "buy"), ["symbol", "label"], "left")
    out = factors.at_times(so_far, [*sums, "buyorders"])
    return out.select("symbol", F.col("label").cast("long").alias("label"), F.col("count").alias("trades"), F.round(m.mean("trademoney"), 6).alias("trademoney_mean"), F.round(m.std("trademoney"), 2).alias("trademoney_std"), F.round(m.vwapx(), 4).alias("tradevwapx"), "buyorders")


INC = LABEL_SQL.replace("tradetm", "{tm}")


def live_sql(legs: str) -> str:
    """CTEs legs, steps and live: each increment's view of each order, by recursion over its increments."""
    return f"""legs AS ({legs}),
steps AS (
  SELECT channelid, orderid, side, inc, min(tm) FILTER (kind = 'n') AS n_tm, min(px) FILTER (kind = 'n') AS n_px, sum(vol) FILTER (kind = 'n') AS n_vol,
         coalesce(min(symbol) FILTER (kind = 'n'), arg_min(symbol, (tm, seq)) FILTER (own)) AS sym, min(tm) FILTER (own) AS a_tm, CASE WHEN side = 66 THEN max(px) FILTER (own) ELSE min(px) FILTER (own) END AS a_px,
         sum(vol) FILTER (own) AS a_vol, coalesce(sum(vol) FILTER (kind = 't'), 0) AS t_vol, max(vol) FILTER (kind = 'w') AS w_vol,
         row_number() OVER (PARTITION BY channelid, orderid, side ORDER BY inc) AS k FROM legs GROUP BY channelid, orderid, side, inc),
live AS (
  SELECT DISTINCT channelid, orderid, side, 0::BIGINT AS k, NULL::BIGINT AS inc, false AS fresh, NULL::BIGINT AS symbol, NULL::BIGINT AS ordertm, NULL::DOUBLE AS orderpx, NULL::BIGINT AS ordervol, 0::BIGINT AS traded, false AS open FROM steps
  UNION ALL
  SELECT channelid, orderid, side, k, inc, fresh, symbol, ordertm, orderpx, ordervol, traded, (fresh OR was) AND NOT (traded >= ordervol OR coalesce(w_vol >= ordervol, false)) AS open
  FROM (
    SELECT channelid, orderid, side, k, inc, fresh, was, w_vol, CASE WHEN fresh THEN sym WHEN was THEN symbol END AS symbol, CASE WHEN fresh THEN coalesce(n_tm, a_tm) WHEN was THEN ordertm END AS ordertm,
           CASE WHEN fresh THEN coalesce(n_px, a_px) WHEN was THEN orderpx END AS orderpx, CAST(CASE WHEN fresh THEN coalesce(n_vol, 0) + coalesce(a_vol, 0) WHEN was THEN ordervol + coalesce(a_vol, 0) END AS BIGINT) AS ordervol,
           CAST(CASE WHEN fresh THEN 0 ELSE traded END + t_vol AS BIGINT) AS traded
    FROM (SELECT s.*, l.open AS was, l.symbol, l.ordertm, l.orderpx, l.ordervol, l.traded, (n_vol IS NOT NULL OR a_vol IS NOT NULL) AND (NOT l.open OR n_vol IS NOT NULL) AS fresh
          FROM live l JOIN steps s ON s.channelid = l.channelid AND s.orderid = l.orderid AND s.side = l.side AND s.k = l.k + 1)))"""


def as_of_sql(rules: str, grows: bool) -> str:
    """CTEs up to rich_o, rich_w and rich_t with inc: the lifecycle as of each increment (minute)."""
    own = "side = {}" if grows else "false"
    orders_ = "SELECT channelid, orderid, sideflag AS side, ordertm, orderpx, ordervol, symbol FROM sh_o WHERE orderid > 0 AND ordertype = 65" if grows else "SELECT channelid, orderid, side, ordertm, orderpx, ordervol, symbol FROM known"
    legs = f"""SELECT channelid, orderid, side, {INC.format(tm='ordertm')} AS inc, 'n' AS kind, ordertm AS tm, 0 AS seq, orderpx AS px, ordervol AS vol, symbol, false AS own FROM ({orders_})
  UNION ALL SELECT channelid, orderid, side, {INC.format(tm='withdrawtm')}, 'w', withdrawtm, 0, NULL, withdrawvol, symbol, false FROM w
  UNION ALL SELECT channelid, tradebuyid, 66, {INC.format(tm='tradetm')}, 't', tradetm, seq, tradepx, tradevol, symbol, {own.format(66)} FROM t
  UNION ALL SELECT channelid, tradesellid, 83, {INC.format(tm='tradetm')}, 't', tradetm, seq, tradepx, tradevol, symbol, {own.format(83)} FROM t"""
    return f"""WITH RECURSIVE {BASE_SQL}, {rules}, {live_sql(legs)},
seen AS (SELECT *, ordervol * orderpx AS ordermoney FROM live WHERE k > 0),
rich_o AS (SELECT * FROM seen WHERE fresh),
rich_w AS (
  SELECT channelid, orderid, side, w.symbol, withdrawtm, coalesce(withdrawpx, k.orderpx) AS withdrawpx, withdrawvol, k.ordertm, k.ordervol, withdrawvol * coalesce(withdrawpx, k.orderpx) AS withdrawmoney,
         {_cont('withdrawtm')} - {_cont('k.ordertm')} AS withdrawtmlag, w.inc
  FROM (SELECT *, {INC.format(tm='withdrawtm')} AS inc FROM w) w LEFT JOIN seen k USING (channelid, orderid, side, inc)),
rich_t AS (
  SELECT t.*, t.tradevol * t.tradepx AS trademoney, b.ordervol AS ordervol_buy, b.ordermoney AS ordermoney_buy, s.ordervol AS ordervol_sell, s.ordermoney AS ordermoney_sell,
         abs({_cont('b.ordertm')} - {_cont('s.ordertm')}) AS ordertmlag, abs(b.ordermoney - s.ordermoney) AS ordermoneydiff
  FROM (SELECT *, {INC.format(tm='tradetm')} AS inc FROM t) t
  LEFT JOIN seen b ON b.channelid = t.channelid AND b.orderid = t.tradebuyid AND b.side = 66 AND b.inc = t.inc
  LEFT JOIN seen s ON s.channelid = t.channelid AND s.orderid = t.tradesellid AND s.side = 83 AND s.inc = t.inc)"""


def so_far_sql(families: factors.Families = factors.FAMILIES, source: str = "rich", more: str = "", tail: str = "") -> str:
    """_snapshot_sql() as of each of the nine times."""
    head = f"{as_of_sql(SH_SQL, True)}{more}, asked AS (SELECT CAST(unnest([{', '.join(map(str, factors.TIMES))}]) AS BIGINT) AS label)"
    parts = ["(SELECT symbol, label FROM (SELECT symbol FROM rich_o UNION SELECT symbol FROM rich_w UNION SELECT symbol FROM rich_t) CROSS JOIN asked) rack"]
    for family in ("order", "withdraw", "trade"):
        head += f", {family}_so_far AS (SELECT x.*, asked.label FROM {source}_{family[0]} x JOIN asked ON x.inc <= asked.label)"
    for family, prefix in ALL_FAMILIES:
        one = _family_sql(family, prefix, families, source).replace("SELECT symbol,", "SELECT symbol, label,").replace(f"FROM {source}_{family[0]} GROUP BY symbol", f"FROM {family}_so_far GROUP BY symbol, label")
        parts.append(f"({one}) {family}_{prefix} USING (symbol, label)")
    shown = ", ".join(f"coalesce({c}, 0.0) AS {c}{tail}" if "_count" in c else f"{c} AS {c}{tail}" for c in factors.names(families))
    return f"{head} SELECT symbol, label, {shown} FROM {' LEFT JOIN '.join(parts)}"


@query("d13_cumulative_factors_all", so_far_sql())
def d13_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 492 factors of every symbol so far, at nine times of the day, of what was known in each minute up to then."""
    return _so_far(spark, sf_dir, digits=_three)


PART = 500_000  # messages a task sorts, so that it has no need of the disk


def _so_far(spark: SparkSession, sf_dir: str, days: DataFrame | None = None, **how) -> DataFrame:
    """Factors at the nine times. Only statistics are written; all up to there is one job."""
    messages = sum(table(spark, sf_dir, name).count() for name in ("orders", "lineitem"))  # from the files' footers
    parts = messages // PART + 1
    parts = parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None

    def keep(stats: DataFrame) -> DataFrame:
        with increments.batches(spark):
            return kept(stats)

    found = increments.as_of("SH", *shanghai_messages(spark, sf_dir), _minute, days, parts=parts, left=False)
    return factors.snapshots_so_far(found.rows, keep=keep, parts=parts, **how)


def _minute(tm: F.Column) -> F.Column:
    return times.next_minute(times.div(tm, 100_000))


def _ret_sql(px: str) -> str:
    return f"CASE WHEN {px} / nullif(pre_close, 0) IS NOT NULL THEN greatest(least({px} / nullif(pre_close, 0) - 1, 0.2), -0.2) END"


DAYS_SQL = "days AS (SELECT c_custkey % 40 AS symbol, CASE WHEN c_custkey % 40 <> 5 THEN 10 + max(CAST(c_acctbal AS DOUBLE)) / 1000 END AS pre_close, count(*) * 97654321.0::DOUBLE AS cap FROM customer WHERE c_custkey % 40 <> 7 GROUP BY c_custkey % 40)"
RELATIVE_SQL = f""", {DAYS_SQL},
rel_o AS (SELECT o.*, {_ret_sql('orderpx')} AS orderret, ordermoney / cap AS orderturnover FROM rich_o o LEFT JOIN days USING (symbol)),
rel_w AS (SELECT w.*, {_ret_sql('withdrawpx')} AS withdrawret, withdrawmoney / cap AS withdrawturnover FROM rich_w w LEFT JOIN days USING (symbol)),
rel_seen AS (SELECT o.*, {_ret_sql('orderpx')} AS orderret, ordermoney / cap AS orderturnover FROM seen o LEFT JOIN days USING (symbol)),
rel_t AS (
  SELECT t.*, {_ret_sql('tradepx')} AS traderet, trademoney / cap AS tradeturnover, abs(b.orderret - s.orderret) AS orderretdiff, abs(b.orderturnover - s.orderturnover) AS orderturnoverdiff
  FROM rich_t t LEFT JOIN days USING (symbol)
  LEFT JOIN rel_seen b ON b.channelid = t.channelid AND b.orderid = t.tradebuyid AND b.side = 66 AND b.inc = t.inc
  LEFT JOIN rel_seen s ON s.channelid = t.channelid AND s.orderid = t.tradesellid AND s.side = 83 AND s.inc = t.inc)"""


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous close and market value by symbol; symbol 5 has no close, symbol 7 neither."""
    own = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 40).alias("symbol")).agg((F.max(F.col("c_acctbal").cast("double")) / 1000 + 10).alias("pre_close"), (F.count("*") * 97_654_321.0).alias("cap"))
    return own.filter("symbol <> 7").withColumn("pre_close", F.when(F.col("symbol") != 5, F.col("pre_close")))


@query("d13_relative_factors", so_far_sql(factors.RELATIVE, "rel", RELATIVE_SQL, "_cat1"))
def d13_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 888 factors with returns and turnovers, at nine times of the day, of what was known in each minute up to then."""
    return _so_far(spark, sf_dir, _days(spark, sf_dir), families=factors.RELATIVE, digits=_digits, tail="_cat1")


def _sanity_sql() -> str:
    """Faults counted over all columns of the snapshot."""
    bad = lambda kind, test: " + ".join(f"CAST(coalesce({test.format(n)}, false) AS INTEGER)" for n in factors.names() if kind in n)
    return f"SELECT count(*) AS symbols, CAST(sum({bad('_count', '{0} < 0')}) AS BIGINT) AS negative_counts, CAST(sum({bad('vwapx', '({0} <= 0 OR {0} > 5000)')}) AS BIGINT) AS odd_prices FROM ({snapshot_sql()})"


@query("d19_factor_sanity", _sanity_sql())
def d19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are never negative, prices stay within (0, 5000]."""
    return factors.sane(factors.snapshot(shanghai(spark, sf_dir, keep=kept), keep=kept))
