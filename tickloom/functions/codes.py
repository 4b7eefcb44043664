"""Security codes, exchanges and the codes of order and trade messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First symbol above those of Shenzhen, and above those of Shanghai.
SZ_END, SH_END = 400_000, 700_000
#: Sides and order types as ASCII codes.
BUY, SELL, NEUTRAL = 66, 83, 78
SH_ADD, SH_CANCEL, SH_STATUS = 65, 68, 83
SZ_LIMIT, SZ_MARKET, SZ_BEST = 50, 49, 85
SZ_TRADE, SZ_WITHDRAW = 70, 52
SECURITY_TYPES = {0: "unknown", 1: "index", 2: "stock", 3: "fund", 4: "bond", 5: "option", 6: "future"}


def exchange(symbol: Column) -> Column:
    """SZ, SH, or empty."""
    return F.when(symbol < SZ_END, "SZ").when(symbol < SH_END, "SH").otherwise("")


def code(symbol: Column) -> Column:
    """Six digits and the exchange's suffix."""
    suffix = F.when(symbol < SZ_END, ".XSHE").when(symbol < SH_END, ".XSHG").otherwise(".OTHER")
    digits = symbol.cast("string")
    return F.concat(F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits), suffix)


def symbol(code_: Column) -> Column:
    """The number in a code's first six characters; 0 if it is shorter, null if they are no number."""
    return F.when(F.length(code_) < 6, 0).otherwise(F.substring(code_, 1, 6).try_cast("int"))


def in_universe(symbol_: Column) -> Column:
    """Listed shares: below the end of Shanghai's, without the B shares of Shenzhen."""
    return (symbol_ >= 0) & (symbol_ < SH_END) & ~symbol_.between(200_000, 201_999)


def side(raw: Column) -> Column:
    """Raw side 1 or 2 as ASCII; null for others."""
    return F.when(raw == 1, BUY).when(raw == 2, SELL).cast("smallint")


def order_type(raw: Column, sh: Column) -> Column:
    """Raw order kind as ASCII, by exchange; null for others."""
    at_sh = F.when(raw == 2, SH_ADD).when(raw == 10, SH_CANCEL).when(raw == 11, SH_STATUS)
    return F.when(sh, at_sh).otherwise(F.when(raw == 1, SZ_LIMIT).when(raw == 2, SZ_MARKET).when(raw == 3, SZ_BEST)).cast("smallint")


def sh_trade_side(flag: Column) -> Column:
    """Raw flag 0, 1, 2 of a Shanghai trade as ASCII; null for others."""
    return F.when(flag == 0, NEUTRAL).when(flag == 1, BUY).when(flag == 2, SELL).cast("smallint")


def sz_trade_type(function_code: Column) -> Column:
    """Function code of a Shenzhen trade: 0 is a trade, all else a withdrawal."""
    return F.when(function_code == 0, SZ_TRADE).otherwise(SZ_WITHDRAW).cast("smallint")


def sz_trade_side(buy_id: Column, sell_id: Column) -> Column:
    """The later of both orders took the initiative."""
    return F.when(buy_id > sell_id, BUY).otherwise(SELL).cast("smallint")


def split_part(text: Column) -> Column:
    """What stands before the second underscore; empty if there is none."""
    return F.when(F.size(F.split(text, "_")) > 2, F.substring_index(text, "_", 2)).otherwise("")


def split_task(text: Column, part: int) -> Column:
    """Part (from 1) of an id whose parts are joined by underscores; null beyond the last."""
    return F.get(F.split(text, "_"), F.lit(part - 1))


def security_type(kind: Column) -> Column:
    """Name of a security type's number."""
    table = F.create_map(*[F.lit(x) for pair in SECURITY_TYPES.items() for x in pair])
    return F.coalesce(table[kind.cast("int")], F.lit(SECURITY_TYPES[0]))
