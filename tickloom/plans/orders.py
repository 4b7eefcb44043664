"""Lifecycle of orders: which orders there were, which were withdrawn, and the trades with what both their orders were.

Orders: channelid, orderid, ordertm, symbol, orderpx, ordervol, ordertype, sideflag, seq. Trades: channelid, tradebuyid,
tradesellid, tradetm, symbol, tradepx, tradevol, sideflag (Shanghai) or tradetype (Shenzhen), seq. A day is one increment:
(channelid, orderid) is unique, nothing depends on the order of rows but ties of time (seq) and the price of a market order,
and buy and sell are one table with a side, so each step is one join rather than two.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.times import time_lag
from ..functions.values import px_to_ret, side_difference, turnover
from ..operators.joins import as_of_backward

ID = ("channelid", "orderid", "side")


@dataclass(frozen=True)
class Lifecycle:
    """orders: ID, symbol, ordertm, orderpx, ordervol, ordermoney. withdraws: these with id, withdrawtm, withdrawpx,
    withdrawvol, withdrawmoney, withdrawtmlag. trades: side, trademoney, ordertmlag, and both orders' values."""

    orders: DataFrame
    withdraws: DataFrame
    trades: DataFrame


def aggressive(trades: DataFrame) -> DataFrame:
    """The orders that took the initiative, as their trades show them: volume, first time, and furthest price."""
    own = trades.filter(F.col("side").isin(codes.BUY, codes.SELL)).withColumn("orderid", F.when(F.col("side") == codes.BUY, F.col("tradebuyid")).otherwise(F.col("tradesellid")))
    out = own.groupBy(*ID).agg(F.min_by("symbol", F.struct("tradetm", "seq")).alias("t_symbol"), F.sum("tradevol").alias("t_vol"), F.min("tradetm").alias("t_tm"), F.max("tradepx").alias("_high"), F.min("tradepx").alias("_low"))
    return out.select(*ID, "t_symbol", "t_vol", "t_tm", F.when(F.col("side") == codes.BUY, F.col("_high")).otherwise(F.col("_low")).alias("t_px"))


def _priced(orders: DataFrame) -> DataFrame:
    return orders.select(*ID, "symbol", "ordertm", "orderpx", "ordervol", (F.col("ordervol") * F.col("orderpx")).alias("ordermoney"))


def sh_new(orders: DataFrame) -> DataFrame:
    """Orders as sent."""
    new = orders.filter((F.col("orderid") > 0) & (F.col("ordertype") == codes.SH_ADD) & F.col("sideflag").isin(codes.BUY, codes.SELL))
    return new.select("channelid", "orderid", F.col("sideflag").alias("side"), "symbol", "ordertm", "orderpx", "ordervol")


def sh_orders(orders: DataFrame, trades: DataFrame) -> DataFrame:
    """Orders as sent, with what they traded on arrival; orders that traded at once in full are known by trades alone."""
    full = sh_new(orders).join(aggressive(trades), list(ID), "full")
    zero = F.lit(0).cast("long")
    return _priced(full.select(*ID, F.coalesce("symbol", "t_symbol").alias("symbol"), F.coalesce("ordertm", "t_tm").alias("ordertm"), F.coalesce("orderpx", "t_px").alias("orderpx"), (F.coalesce("ordervol", zero) + F.coalesce("t_vol", zero)).alias("ordervol")))


def sz_orders(orders: DataFrame, trades: DataFrame) -> DataFrame:
    """Orders; one without a limit takes the last price on the other side, a market order 0.1 % further."""
    new = orders.filter((F.col("orderid") > 0) & F.col("sideflag").isin(codes.BUY, codes.SELL))
    new = new.select("channelid", "orderid", F.col("sideflag").alias("side"), "symbol", "ordertm", F.when(F.col("ordertype") == codes.SZ_LIMIT, F.col("orderpx")).alias("orderpx"), "ordervol", "ordertype")
    other = trades.select("symbol", F.when(F.col("side") == codes.BUY, codes.SELL).otherwise(codes.BUY).cast("smallint").alias("side"), "tradetm", "tradepx", "seq")
    found = as_of_backward(new, other, ["symbol", "side"], "ordertm", "tradetm", ["tradepx"], tie="seq")
    further = F.when(F.col("side") == codes.BUY, 1.001).otherwise(0.999)
    filled = F.when(F.col("ordertype") == codes.SZ_MARKET, F.col("tradepx") * further).otherwise(F.col("tradepx"))
    return _priced(found.withColumn("orderpx", F.coalesce("orderpx", filled)))


def sh_trades(trades: DataFrame) -> DataFrame:
    """Trades between two orders."""
    return trades.filter((F.col("tradebuyid") != 0) & (F.col("tradesellid") != 0)).withColumn("side", F.col("sideflag").cast("smallint"))


def sz_trades(trades: DataFrame) -> DataFrame:
    """Trades between two orders; the later order's side."""
    own = trades.filter((F.col("tradetype") == codes.SZ_TRADE) & (F.col("tradebuyid") != 0) & (F.col("tradesellid") != 0))
    return own.withColumn("side", codes.sz_trade_side(F.col("tradebuyid"), F.col("tradesellid")))


def sh_withdraws(orders: DataFrame) -> DataFrame:
    """Withdrawals in the order stream."""
    own = orders.filter((F.col("orderid") > 0) & (F.col("ordertype") == codes.SH_CANCEL) & F.col("sideflag").isin(codes.BUY, codes.SELL))
    return own.select("channelid", "orderid", F.col("sideflag").alias("side"), F.col("symbol").alias("w_symbol"), F.col("ordertm").alias("withdrawtm"), F.col("orderpx").alias("withdrawpx"), F.col("ordervol").alias("withdrawvol"))


def sz_withdraws(trades: DataFrame) -> DataFrame:
    """Withdrawals in the trade stream, where one of both ids is 0; they have no price of their own."""
    own = trades.filter(((F.col("tradebuyid") == 0) | (F.col("tradesellid") == 0)) & (F.col("tradebuyid") + F.col("tradesellid") != 0))
    buy = F.col("tradesellid") == 0
    return own.select("channelid", F.when(buy, F.col("tradebuyid")).otherwise(F.col("tradesellid")).alias("orderid"), F.when(buy, codes.BUY).otherwise(codes.SELL).cast("smallint").alias("side"), F.col("symbol").alias("w_symbol"), F.col("tradetm").alias("withdrawtm"), F.lit(None).cast("double").alias("withdrawpx"), F.col("tradevol").alias("withdrawvol"))


def enrich_withdraws(withdraws: DataFrame, orders: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Withdrawals with their orders; unknown orders leave nulls. A price of the withdrawal's own comes first. also: more
    columns that an order must have in common."""
    out = withdraws.join(orders.select(*ID, *also, "ordertm", "ordervol", "orderpx"), [*ID, *also], "left").withColumn("withdrawpx", F.coalesce("withdrawpx", "orderpx"))
    return out.select(*ID, *also, F.col("w_symbol").alias("symbol"), "withdrawtm", "withdrawpx", "withdrawvol", "ordertm", "ordervol", (F.col("withdrawvol") * F.col("withdrawpx")).alias("withdrawmoney"), time_lag(F.col("withdrawtm"), F.col("ordertm")).alias("withdrawtmlag"))


def enrich_trades(trades: DataFrame, orders: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Trades with both orders; unknown orders leave nulls in what needs them. also: as for withdrawals."""

    def of(side: int, name: str) -> DataFrame:
        return orders.filter(F.col("side") == side).select("channelid", *also, F.col("orderid").alias(f"trade{name}id"), F.col("ordertm").alias(f"ordertm_{name}"), F.col("ordervol").alias(f"ordervol_{name}"), F.col("ordermoney").alias(f"ordermoney_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in ("orderret", "orderturnover") if c in orders.columns])

    out = trades.join(of(codes.BUY, "buy"), ["tradebuyid", "channelid", *also], "left").join(of(codes.SELL, "sell"), ["tradesellid", "channelid", *also], "left")
    return traded(out)


def traded(rows: DataFrame) -> DataFrame:
    """Adds a trade's amount, and how far its two orders are apart in time and amount."""
    return rows.withColumns({"trademoney": F.col("tradevol") * F.col("tradepx"), "ordertmlag": F.abs(time_lag(F.col("ordertm_buy"), F.col("ordertm_sell"))), "ordermoneydiff": F.abs(F.col("ordermoney_buy") - F.col("ordermoney_sell"))})


def _matched(known: DataFrame, withdraws: DataFrame, trades: DataFrame, days: DataFrame | None, keep: Callable[[DataFrame], DataFrame] | None) -> Lifecycle:
    known = keep(known) if keep else known
    if days is None:
        return Lifecycle(known, enrich_withdraws(withdraws, known), enrich_trades(trades, known))
    known = relative(known, days, "orderpx", "ordermoney", "orderret", "orderturnover")
    gone = relative(enrich_withdraws(withdraws, known), days, "withdrawpx", "withdrawmoney", "withdrawret", "withdrawturnover")
    done = relative(enrich_trades(trades, known), days, "tradepx", "trademoney", "traderet", "tradeturnover")
    return Lifecycle(known, gone, with_differences(done))


def with_differences(trades: DataFrame) -> DataFrame:
    """Adds how far both orders of a trade are apart in return and turnover."""
    return trades.withColumns({f"order{k}diff": side_difference(F.col(f"order{k}_buy"), F.col(f"order{k}_sell")) for k in ("ret", "turnover")})


def sh_lifecycle(orders: DataFrame, trades: DataFrame, days: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> Lifecycle:
    """Shanghai: withdrawals are in the order stream, and what traded on arrival is not. With days (symbol, pre_close, cap:
    a row for each symbol) returns and turnovers are added to all three. keep() may write the orders, which all three use."""
    own = sh_trades(trades)
    return _matched(sh_orders(orders, own), sh_withdraws(orders), own, days, keep)


def sz_lifecycle(orders: DataFrame, trades: DataFrame, days: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> Lifecycle:
    """Shenzhen: all orders are in the order stream, withdrawals in the trade stream. days and keep as for Shanghai."""
    own = sz_trades(trades)
    return _matched(sz_orders(orders, own), sz_withdraws(trades), own, days, keep)


def both(a: Lifecycle, b: Lifecycle) -> Lifecycle:
    """Two exchanges as one."""
    join = lambda x, y: x.unionByName(y, allowMissingColumns=True)
    return Lifecycle(join(a.orders, b.orders), join(a.withdraws, b.withdraws), join(a.trades, b.trades))


def still_open(life: Lifecycle) -> DataFrame:
    """Orders that were neither traded nor withdrawn in full."""
    t = life.trades

    def traded(side: int, name: str) -> DataFrame:
        done = t.groupBy("channelid", F.col(f"trade{name}id").alias("orderid")).agg(F.sum("tradevol").alias("tv"), F.max(f"ordervol_{name}").alias("ov")).filter("ov <= tv")
        return done.select("channelid", "orderid", F.lit(side).cast("smallint").alias("side"))

    gone = traded(codes.BUY, "buy").union(traded(codes.SELL, "sell")).union(life.withdraws.filter("ordervol <= withdrawvol").select(*ID)).distinct()
    return life.orders.join(gone, list(ID), "left_anti")


def relative(rows: DataFrame, days: DataFrame, px: str, money: str, ret: str, turn: str) -> DataFrame:
    """Adds the return of a price and the turnover of an amount; days has pre_close and cap of each symbol."""
    out = rows.join(days.select("symbol", "pre_close", "cap"), "symbol", "left")
    return out.withColumns({ret: px_to_ret(F.col(px), F.col("pre_close")), turn: turnover(F.col(money), F.col("cap"))}).drop("pre_close", "cap")


def traded_so_far(trades: DataFrame, side: str) -> Column:
    """Running volume of each order's trades, by which a completed order is known."""
    from pyspark.sql import Window

    return F.sum("tradevol").over(Window.partitionBy("channelid", f"trade{side}id").orderBy("tradetm", "seq").rowsBetween(Window.unboundedPreceding, 0))
