"""Factors of order flow per symbol.

Orders, withdrawals and trades are stacked to one table of (symbol, kind, mask, values), which is aggregated
once: counts, sums and power sums. A kind is a family and a side; a mask has a bit for each bucket that a row is in, so a row
counts once, and only the sums of masks, of which there are few, are dealt to buckets. Both sides together are sums of these
rows, and so are factors of all that was before a time. Distinct orders are counted in two steps, the buckets of an order up to
each time as bits, then how many orders have which, which needs no sets. Statistics stay arrays in the fixed order of factors until one
projection names them, for some thousands of symbols. sums() has the buckets as columns instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, times
from ..functions import moments as m
from ..functions.values import is_complete, is_instant, is_large, is_partial, is_small
from .orders import Lifecycle

SIDES = {"buy": codes.BUY, "sell": codes.SELL}
PREFIXES = (*SIDES, "neutral")
#: HHMM at which cumulative factors are given.
TIMES = (925, 1000, 1030, 1100, 1130, 1330, 1400, 1430, 1500)


def order_buckets() -> dict[str, Column | None]:
    v, money = F.col("ordervol"), F.col("ordermoney")
    return {"": None, "large": is_large(v, money), "small": is_small(v, money)}


def withdraw_buckets() -> dict[str, Column | None]:
    v, money, o = F.col("withdrawvol"), F.col("withdrawmoney"), F.col("ordervol")
    return {"": None, "large": is_large(v, money), "small": is_small(v, money), "complete": is_complete(v, o), "partial": is_partial(v, o), "instant": is_instant(F.col("withdrawtmlag"))}


def trade_buckets() -> dict[str, Column | None]:
    own = {"": ("tradevol", "trademoney"), "bo": ("ordervol_buy", "ordermoney_buy"), "so": ("ordervol_sell", "ordermoney_sell")}
    out: dict[str, Column | None] = {"": None}
    for k, (v, money) in own.items():
        out |= {f"{k}large": is_large(F.col(v), F.col(money)), f"{k}small": is_small(F.col(v), F.col(money))}
    return out


NEVER = 1 << 40  # a label after all times
TIE = 1e-9
#: Buckets of each family in their fixed order.
BUCKETS = {"order": ("", "large", "small"), "withdraw": ("", "large", "small", "complete", "partial", "instant"), "trade": ("", "large", "small", "bolarge", "bosmall", "solarge", "sosmall")}
class Family(NamedTuple):
    """What a family's rows are put into, their volume and amount, the fields that moments are taken of, and whether the mean
    price is a ratio of means."""

    buckets: Callable[[], dict[str, Column | None]]
    vol: str
    money: str
    fields: tuple[str, ...]
    by_means: bool = False


FAMILIES = {
    "order": Family(order_buckets, "ordervol", "ordermoney", ("ordermoney",)),
    "withdraw": Family(withdraw_buckets, "withdrawvol", "withdrawmoney", ("withdrawmoney", "withdrawtmlag")),
    "trade": Family(trade_buckets, "tradevol", "trademoney", ("trademoney", "ordertmlag", "ordermoneydiff")),
}
#: The families with returns and turnovers, for lifecycles that have them.
RELATIVE = {
    "order": Family(order_buckets, "ordervol", "ordermoney", ("ordermoney", "orderret", "orderturnover"), True),
    "withdraw": Family(withdraw_buckets, "withdrawvol", "withdrawmoney", ("withdrawmoney", "withdrawret", "withdrawtmlag", "withdrawturnover"), True),
    "trade": Family(trade_buckets, "tradevol", "trademoney", ("trademoney", "traderet", "ordertmlag", "orderretdiff", "tradeturnover", "orderturnoverdiff"), True),
}
Families = Mapping[str, Family]


def sums(rows: DataFrame, family: str, by: Sequence[str] = ("symbol", "side")) -> DataFrame:
    """Counts, sums and power sums of a family's buckets; every column can be added up."""
    buckets, vol, money, fields, _ = FAMILIES[family]
    return rows.groupBy(*by).agg(*m.bucketed(F.col(vol), F.col(money), {f: F.col(f) for f in fields}, buckets()))


def _width(families: Families) -> int:
    return max(len(f.fields) for f in families.values())


def _kind(family: str, prefix: str) -> int:
    return list(BUCKETS).index(family) * len(PREFIXES) + PREFIXES.index(prefix)


def _named(names_: Sequence[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names_)), at + 1)


def _stack(family: str, when: Column, families: Families) -> dict[str, Column]:
    """The columns that a family's rows have in one table; when: their time."""
    own = families[family]
    mask = reduce(Column.bitwiseOR, [F.lit(1 << j) if where is None else F.when(where, 1 << j).otherwise(0) for j, where in enumerate(own.buckets().values())])
    kind = F.when(F.col("side") == SIDES["buy"], _kind(family, "buy")).when(F.col("side") == SIDES["sell"], _kind(family, "sell")).otherwise(_kind(family, "neutral"))
    x = {f"x{j}": (F.col(own.fields[j]) if j < len(own.fields) else F.lit(None)).cast("double") for j in range(_width(families))}
    key = {c: (F.col(c) if family == "trade" else F.lit(None)).cast("long") for c in ("channelid", "tradebuyid", "tradesellid")}
    return {"symbol": F.col("symbol").cast("long"), "kind": kind, "label": when.cast("long"), "mask": mask, "vol": F.col(own.vol).cast("long"), "money": F.col(own.money).cast("double")} | x | key


def stacked(life: Lifecycle, label: Mapping[str, Column], families: Families = FAMILIES) -> DataFrame:
    """All rows of a lifecycle as one table; label has the time of each family that takes part."""
    frames = {"order": life.orders, "withdraw": life.withdraws, "trade": life.trades}
    return reduce(DataFrame.unionByName, [frames[k].select(*[c.alias(n) for n, c in _stack(k, when, families).items()]) for k, when in label.items()])


def stacked_rows(rows: DataFrame, label: Column, families: Families = FAMILIES) -> DataFrame:
    """stacked() of a lifecycle that is one table with a family already, each row of which is read once."""
    own = {k: _stack(k, label, families) for k in families}
    return rows.select(*[reduce(lambda c, k, n=n: c.when(F.col("family") == k, own[k][n]), own, F).alias(n) for n in own["trade"]])


def _so_far(rows: DataFrame, by: Sequence[str], times: Sequence[int]) -> DataFrame:
    """Sums of all that was up to each time, from sums of what came between them (label: the first time that has it)."""
    if len(times) == 1:
        return rows
    own = [c for c in rows.columns if c not in (*by, "label")]
    w = Window.partitionBy(*by).orderBy("label")
    run = rows.select(*by, *[F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in own], "label", F.lead("label").over(w).alias("_next"))
    until = F.filter(F.array(*[F.lit(t).cast("long") for t in times]), lambda t: (t >= F.col("label")) & (F.col("_next").isNull() | (t < F.col("_next"))))
    return run.withColumn("label", F.explode(until)).drop("_next")


def _bits(mask: Column, n: int) -> Column:
    """The numbers of the bits that are set, of n."""
    return F.filter(F.array(*map(F.lit, range(n))), lambda j: F.getbit(mask, j) == 1)


def moments(rows: DataFrame, families: Families = FAMILIES) -> DataFrame:
    """(symbol, family, prefix, bucket, label) with counts, sums and power sums; every column can be added up."""
    power = [c for j in range(_width(families)) for c in m.power_sums(F.col(f"x{j}"), f"x{j}")]
    own = rows.groupBy("symbol", "kind", "mask", "label").agg(F.count("*").alias("count"), F.sum("vol").alias("vol"), F.count("vol").alias("vol_n"), F.sum("money").alias("money"), *power)
    added_up = [c for c in own.columns if c not in ("symbol", "kind", "mask", "label")]
    family, prefix = times.div(F.col("kind"), len(PREFIXES)).cast("int"), F.col("kind") % len(PREFIXES)
    bucket = F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, b)) for b in BUCKETS.values()]), family + 1), F.col("_bit") + 1)
    own = own.withColumn("_bit", F.explode(_bits(F.col("mask"), max(map(len, BUCKETS.values())))))
    return own.groupBy("symbol", _named(list(BUCKETS), family).alias("family"), _named(PREFIXES, prefix).alias("prefix"), bucket.alias("bucket"), "label").agg(*[F.sum(c).alias(c) for c in added_up])


def added(sums_: DataFrame) -> DataFrame:
    """Rows of moments() of several increments as one, and for trades both sides as a further prefix."""
    by = ["symbol", "family", "prefix", "bucket", "label"]
    prefix = F.when(F.col("family") == "trade", F.array("prefix", F.lit("both"))).otherwise(F.array("prefix"))
    return sums_.withColumn("prefix", F.explode(prefix)).groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums_.columns if c not in by])


def distinct_orders(rows: DataFrame, times_: Sequence[int], parts: int | None = None) -> DataFrame:
    """(symbol, label, key, stats): how many different buy and sell orders had traded in each bucket up to each time. An order
    counts in a bucket from its first trade there on. An order's buckets at three times are the bits of one number. parts: how
    many tasks orders are dealt to; a trade goes there as four numbers, as few of an order's trades meet before."""
    wide, each = len(BUCKETS["trade"]), 3 * len(BUCKETS["trade"])
    keys = [f"{p}|trade|{bucket}|orders" for p in ("both", *SIDES) for bucket in BUCKETS["trade"]]
    mask, at = F.col("mask").cast("long"), F.array_position(F.array(*[F.lit(t).cast("long") for t in times_]), F.col("label")).cast("int") - 1
    bits = mask.bitwiseOR(F.when(F.col("kind") == _kind("trade", "buy"), F.shiftleft(mask, wide)).when(F.col("kind") == _kind("trade", "sell"), F.shiftleft(mask, 2 * wide)).otherwise(F.lit(0).cast("long")))
    trades = rows.filter(F.col("kind").isin([_kind("trade", p) for p in PREFIXES]) & F.col("label").isin(list(times_)))
    said = F.shiftleft(at.cast("long"), each).bitwiseOR(bits).alias("said")
    legs = trades.select("symbol", "channelid", said, F.explode(F.array(*[F.struct(F.lit(k).alias("sells"), F.col(c).alias("id")) for k, c in ((0, "tradebuyid"), (1, "tradesellid"))])).alias("leg")).select("symbol", "channelid", "leg.id", "said", "leg.sells").filter("id <> 0")
    legs = legs.select("symbol", "channelid", "id", F.shiftleft("said", 1).bitwiseOR(F.col("sells").cast("long")).alias("said"))
    legs = legs.repartition(*([parts] if parts else []), "symbol", "channelid", "id")
    legs = legs.select("symbol", "channelid", "id", (F.col("said") % 2 == 1).alias("sells"), F.shiftright("said", 1 + each).alias("at"), F.shiftright("said", 1).bitwiseAND((1 << each) - 1).alias("bits"))
    words = range((len(times_) + 2) // 3)
    held = [F.bit_or(F.when((F.col("at") >= 3 * k) & (F.col("at") < 3 * k + 3), F.expr(f"shiftleft(bits, CAST(at % 3 AS INT) * {each})")).otherwise(F.lit(0).cast("long"))).alias(f"b{k}") for k in words]
    first = legs.groupBy("symbol", "channelid", "sells", "id").agg(*held)
    found, before = [], F.lit(0).cast("long")
    for k, t in enumerate(times_):
        now = F.shiftright(F.col(f"b{k // 3}"), k % 3 * each).bitwiseAND((1 << each) - 1)
        found.append(F.struct(F.lit(t).cast("long").alias("label"), now.bitwiseAND(F.bitwise_not(before)).alias("bits")))
        before = before.bitwiseOR(now)
    new = first.select("symbol", "sells", F.explode(F.array(*found)).alias("new")).select("symbol", "sells", "new.*").filter("bits <> 0").groupBy("symbol", "sells", "label", "bits").agg(F.count("*").alias("n"))
    new = new.select("symbol", "sells", "label", "n", F.explode(_bits(F.col("bits"), each)).alias("_bit")).withColumn("key", _named(keys, F.col("_bit")))
    counts = new.groupBy("symbol", "key", "label").agg(*[F.sum(F.when(F.col("sells") == which, F.col("n")).otherwise(0)).cast("double").alias(name) for name, which in (("buy", False), ("sell", True))])
    return _so_far(counts, ["symbol", "key"], times_).select("symbol", "label", "key", F.array("buy", "sell").alias("stats"))


def statistics(sums_: DataFrame, families: Families = FAMILIES) -> DataFrame:
    """(symbol, label, key, stats): the factors of each bucket in their fixed order."""
    by_means = F.col("family").isin([k for k, f in families.items() if f.by_means])
    price = F.when(by_means, m.ratio_of_means("x0")).otherwise(m.vwapx())  # an amount is the first field of each family
    every = F.array(F.col("count").cast("double"), price, *(f(f"x{j}") for j in range(_width(families)) for f in (m.mean, m.std, m.skew, m.kurt)))
    size = reduce(lambda c, k: c.when(F.col("family") == k, 2 + 4 * len(families[k].fields)), families, F).otherwise(0)
    return sums_.select("symbol", "label", F.concat_ws("|", "prefix", "family", "bucket").alias("key"), F.slice(every, 1, size).alias("stats"))


def positions(families: Families = FAMILIES) -> list[tuple[str, list[str]]]:
    """The keys of statistics in the fixed order of factors, with the factors of each."""
    out = []
    for family, prefixes in (("order", ("buy", "sell")), ("withdraw", ("buy", "sell")), ("trade", ("both", "buy", "sell"))):
        for p in prefixes:
            for bucket in BUCKETS[family]:
                tail = f"_{bucket}" if bucket else ""
                out.append((f"{p}|{family}|{bucket}", [f"{p}_{family}_count{tail}", f"{p}_{family}vwapx{tail}", *(f"{p}_{f}_{k}{tail}" for f in families[family].fields for k in ("mean", "std", "skew", "kurt"))]))
                if family == "trade":
                    out.append((f"{p}|trade|{bucket}|orders", [f"{p}_trade_{w}order_count{tail}" for w in ("buy", "sell")]))
    return out


def names(families: Families = FAMILIES) -> list[str]:
    """All 492 factors (888 with returns and turnovers) in their fixed order: orders and withdrawals of both sides, then trades of all, buy and sell."""
    return [name for _, own in positions(families) for name in own]


def spread_out(stats: DataFrame, times: Sequence[int], families: Families = FAMILIES, digits: Callable[[str], int] | None = None, tail: str = "") -> DataFrame:
    """(symbol, label, factors): a row for each symbol and time; counts are 0 where there is nothing. digits() rounds factors
    other than counts. Skewness and kurtosis of few values are often fractions that end in a 5 (one odd value among 17 has
    12.0625), so TIE is added to these first, which is more than sums in another order differ by."""
    every = names(families)
    kinds = [-1 if "_count" in n else -2 if not digits else 100 + digits(n) if "_skew" in n or "_kurt" in n else digits(n) for n in every]
    rounded = " ".join(f"WHEN {k} THEN round(x{f' + {TIE}D' if k >= 100 else ''}, {k % 100})" for k in sorted({k for k in kinds if k >= 0}))
    wanted = ", ".join(f"named_struct('key', '{k}', 'n', {len(own)})" for k, own in positions(families))
    one = stats.groupBy("symbol").agg(F.collect_list(F.struct("label", "key", "stats")).alias("all"))
    one = one.select("symbol", F.explode(F.array(*[F.lit(t).cast("long") for t in times])).alias("label"), "all")
    one = one.withColumn("at", F.expr("map_from_entries(transform(filter(all, e -> e.label = label), e -> struct(e.key, e.stats)))"))
    flat = one.select("symbol", "label", F.expr(f"flatten(transform(array({wanted}), k -> coalesce(try_element_at(at, k.key), array_repeat(CAST(NULL AS DOUBLE), k.n))))").alias("v"))
    case = f"CASE element_at(array({', '.join(map(str, kinds))}), i + 1) WHEN -1 THEN coalesce(x, 0D) {rounded} ELSE x END"
    return flat.select("symbol", "label", F.expr(f"transform(v, (x, i) -> {case})").alias("v")).selectExpr("symbol", "label", *[f"v[{i}] AS {n}{tail}" for i, n in enumerate(every)])


def of_rows(rows: DataFrame, times: Sequence[int], families: Families = FAMILIES, digits: Callable[[str], int] | None = None, tail: str = "", keep: Callable[[DataFrame], DataFrame] = lambda stats: stats, parts: int | None = None) -> DataFrame:
    """(symbol, label, factors) of stacked rows up to each time. keep() may write the statistics, a few thousand rows a symbol;
    parts as for distinct_orders()."""
    later = F.filter(F.array(*[F.lit(t).cast("long") for t in (*times, NEVER)]), lambda t: t >= F.col("label"))
    own = rows.withColumn("label", F.element_at(later, 1))
    sums_ = _so_far(added(moments(own, families)), ["symbol", "family", "prefix", "bucket"], times)
    return spread_out(keep(statistics(sums_, families).unionByName(distinct_orders(own, times, parts))), times, families, digits, tail)


def snapshot(life: Lifecycle, digits: Callable[[str], int] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows, only: Sequence[str] = ("order", "withdraw", "trade")) -> DataFrame:
    """One row per symbol: symbol and the 492 factors. keep() may write the stacked rows; only: families that take part."""
    return of_rows(keep(stacked(life, {k: F.lit(0) for k in only})), (0,), digits=digits).drop("label")


def snapshots_so_far(rows: DataFrame, times: Sequence[int] = TIMES, families: Families = FAMILIES, digits: Callable[[str], int] | None = None, tail: str = "", keep: Callable[[DataFrame], DataFrame] = lambda stats: stats, parts: int | None = None) -> DataFrame:
    """snapshot() as of several times of the day: one row per symbol and time, with all factors of what was ordered,
    withdrawn and traded in increments up to then. The lifecycle is one table (SoFar.rows of plans/increments); keep() and
    parts as for of_rows()."""
    return of_rows(stacked_rows(rows, F.col("inc"), families), times, families, digits, tail, keep, parts)


def cumulative_distinct(trades: DataFrame, which: str, label: str = "label") -> DataFrame:
    """Per symbol and label, how many different orders have traded so far: orders are counted where they appear first."""
    first = trades.groupBy("symbol", "channelid", f"trade{which}id").agg(F.min(label).alias(label))
    new = first.groupBy("symbol", label).agg(F.count("*").alias("n"))
    w = Window.partitionBy("symbol").orderBy(label).rowsBetween(Window.unboundedPreceding, 0)
    return new.select("symbol", label, F.sum("n").over(w).alias(f"{which}orders"))


def at_times(rows: DataFrame, columns: Sequence[str], label: str = "label", times: Sequence[int] = TIMES) -> DataFrame:
    """Cumulative rows as of each of a few times of the day."""
    wanted = rows.select("symbol").distinct().withColumn(label, F.explode(F.array(*map(F.lit, times))))
    both = rows.withColumn("_ask", F.lit(False)).unionByName(wanted.withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy("symbol").orderBy(label, "_ask").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("symbol", label, "_ask", *[F.last(c, True).over(w).alias(c) for c in columns]).filter("_ask").drop("_ask")


def sane(snapshot_: DataFrame) -> DataFrame:
    """One row: how many counts are negative and how many prices are out of range."""
    counts = [c for c in snapshot_.columns if "_count" in c]
    prices = [c for c in snapshot_.columns if "vwapx" in c]
    bad = lambda cs, f: F.sum(sum(((F.coalesce(f(F.col(c)), F.lit(False))).cast("int") for c in cs[1:]), F.coalesce(f(F.col(cs[0])), F.lit(False)).cast("int")))
    return snapshot_.agg(F.count("*").alias("symbols"), bad(counts, lambda c: c < 0).alias("negative_counts"), bad(prices, lambda c: (c <= 0) | (c > 5000)).alias("odd_prices"))
