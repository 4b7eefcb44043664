"""Orders as of each increment of a day, without looking ahead, with the open orders of earlier increments carried on.

An increment is a minute's label, or any number that ascends through the day. What an increment has of an order (its own
message, trades on arrival, all its trades, withdrawals) is summed to one step. An order that is not open begins with its message or with the trades by
which it took the initiative; one that is open grows by further such trades; it ends with the increment in which its trades so
far, or one withdrawal, reach its volume. What later trades of it find then is nothing, or a new order. So what is said of an
increment depends on rows up to that increment only.

Trades are dealt twice: with buy orders first, from which they come back with what their buy order was, and then with sell orders. A
task sorts its messages by order and takes them as Arrow batches of whole orders, sums them to steps, and takes the first step
of all its orders, then the second ones, and so on, of which there are no more than increments. Nothing is joined, and nothing
between messages and factors is written but these two shuffles.

The fold may begin with the open orders that an earlier run has left (`carried`), and gives back those that are open at its
end: a day may be worked off in one run or in many, with the same rows. Moments of increments add up to those of the day.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import codes
from ..functions.times import time_lag
from ..functions.values import px_to_ret, turnover
from .orders import ID, Lifecycle, traded, with_differences

OPEN = ("symbol", "ordertm", "orderpx", "ordervol", "traded")
#: What a message is: the order's own, a withdrawal, a trade, or a trade on arrival.
NEW, GONE, TRADE, ARRIVAL = range(4)
#: What the fold gives out beside trades: an order as it begins, a withdrawal, and an order that is open at the end.
BEGUN, WITHDRAWN, LEFT = range(8, 11)
#: Columns in this order as those that differ little from row to row are short together in a shuffle. flag: the side that a
#: trade took the initiative on; other: its other order.
LEGS = "channelid int, step int, kind tinyint, side smallint, flag smallint, symbol long, inc long, vol long, tm long, orderid long, other long, seq long, px double"
#: What a trade's first order was.
FIRST = "o_vol long, o_tm long, o_px double"
FIRST_SYMBOL = "o_symbol long"
VIEW = "v_symbol long, v_tm long, v_px double, v_vol long"


class SoFar(NamedTuple):
    """The lifecycle with the increment of each row (inc), the orders that are open at the end, and the rows of the lifecycle
    as one table (family: order, withdraw or trade), which has the columns of all three."""

    life: Lifecycle
    open: DataFrame
    rows: DataFrame | None = None


def _leg(rows: DataFrame, kind: int | Column, step: int = 1, **own: str) -> DataFrame:
    """Messages of one kind in the columns of LEGS; step is 0 for what an earlier run has left."""
    own = {c: c for c in (*ID, "inc")} | own
    kinds = {"step": F.lit(step), "kind": kind if isinstance(kind, Column) else F.lit(kind)}
    return rows.select(*[kinds.get(c, F.col(own[c]) if c in own else F.lit(None)).cast(t).alias(c) for c, t in (x.split() for x in LEGS.split(", "))])


def legs(new: DataFrame, withdraws: DataFrame, trades: DataFrame | None, grows: bool, carried: DataFrame | None = None, only: int | None = None) -> DataFrame:
    """One row for each message of an order; a trade is one of either side, or of one (only), with all messages of that side's
    orders. grows: trades on arrival are not in the orders' own messages. All have inc; new: ID, symbol, ordertm, orderpx,
    ordervol. A carried order is a message and what it traded. Only trades on arrival have seq, as it says which of them is an
    order's first."""
    order = {"tm": "ordertm", "px": "orderpx", "vol": "ordervol", "symbol": "symbol"}
    mine = (lambda rows: rows) if only is None else (lambda rows: rows.filter(F.col("side") == only))
    out = [_leg(mine(new), NEW, **order), _leg(mine(withdraws), GONE, tm="withdrawtm", px="withdrawpx", vol="withdrawvol", symbol="w_symbol")]
    if trades is not None:
        ids = [(code, key, other) for code, key, other in ((codes.BUY, "tradebuyid", "tradesellid"), (codes.SELL, "tradesellid", "tradebuyid")) if only in (None, code)]
        sides = F.explode(F.array(*[F.struct(F.lit(code).cast("smallint").alias("leg"), F.col(key).alias("orderid"), F.col(other).alias("other")) for code, key, other in ids]))
        both = trades.withColumn("_leg", sides).select("*", "_leg.*").withColumns({"flag": F.col("side"), "_own": F.lit(grows) & (F.col("leg") == F.col("side")), "_seq": F.when(F.lit(grows) & F.col("side").isin(codes.BUY, codes.SELL), F.col("seq"))}).withColumn("side", F.col("leg"))
        out.append(_leg(both, F.when(F.col("_own"), ARRIVAL).otherwise(TRADE), tm="tradetm", seq="_seq", px="tradepx", vol="tradevol", symbol="symbol", flag="flag", other="other"))
    if carried is not None:
        before = mine(carried).withColumn("inc", F.lit(None))
        out += [_leg(before, NEW, 0, **order), _leg(before, TRADE, 0, vol="traded")]
    return reduce(DataFrame.unionByName, out)


def _onward(seen: DataFrame, grows: bool, with_symbol: bool) -> DataFrame:
    """What the fold of buy orders gave out as messages to sell orders; what is no trade goes through."""
    trade = F.col("kind") < BEGUN
    turned = {"seq": F.when(F.lit(grows) & (F.col("flag") == codes.SELL), F.col("seq")), "orderid": F.when(trade, F.col("other")).otherwise(F.col("orderid")), "other": F.when(trade, F.col("orderid")), "side": F.when(trade, codes.SELL).otherwise(F.col("side")), "kind": F.when(trade, F.when(F.lit(grows) & (F.col("flag") == codes.SELL), ARRIVAL).otherwise(TRADE)).otherwise(F.col("kind"))}
    columns = [x.split() for x in ", ".join([LEGS, FIRST, *([FIRST_SYMBOL] if with_symbol else [])]).split(", ")]
    return seen.select(*[turned.get(c, F.col(c.replace("o_", "v_"))).cast(t).alias(c) for c, t in columns])


def _changes(rows: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Where any of the columns, null or not, differs from the row before."""
    new = np.ones(rows.num_rows, bool)
    new[1:] = False
    for c in columns:
        ok, v = rows[c].is_valid().to_numpy(), rows[c].fill_null(0).to_numpy()
        new[1:] |= (ok[1:] != ok[:-1]) | (v[1:] != v[:-1])
    return np.flatnonzero(new)


def _steps(rows: pa.Table, at: np.ndarray) -> dict[str, np.ndarray]:
    """What each step has of its order: values, and for those that may be none, ok_ and whether there are any."""
    kind, ok, vol = rows["kind"].to_numpy(), rows["vol"].is_valid().to_numpy(), rows["vol"].fill_null(0).to_numpy()
    new, mine = kind == NEW, kind == ARRIVAL
    total = lambda where: np.add.reduceat(np.where(where & ok, vol, 0), at)
    any_ = lambda where: np.logical_or.reduceat(where, at)
    out = {"new": any_(new & ok), "own": any_(mine & ok), "n_vol": total(new), "a_vol": total(mine), "t_vol": total(mine | (kind == TRADE)), "gone": any_((kind == GONE) & ok), "w_vol": np.maximum.reduceat(np.where((kind == GONE) & ok, vol, np.iinfo(np.int64).min), at)}

    def least(name: str, none: float, where: np.ndarray, f: np.ufunc = np.fmin) -> tuple[np.ndarray, np.ndarray]:
        there, v = where & rows[name].is_valid().to_numpy(), rows[name].fill_null(0).to_numpy()
        return f.reduceat(np.where(there, v, none), at), any_(there)

    big = np.iinfo(np.int64).max
    (n_tm, ok_n), (a_tm, ok_a) = least("tm", big, new, np.minimum), least("tm", big, mine, np.minimum)
    out |= {"ordertm": np.where(ok_n, n_tm, a_tm), "ok_ordertm": ok_n | ok_a}
    (n_px, ok_n), (low, ok_a), (high, _) = least("px", np.nan, new), least("px", np.nan, mine), least("px", -np.inf, mine, np.maximum)
    out |= {"orderpx": np.where(ok_n, n_px, np.where(rows["side"].fill_null(0).to_numpy()[at] == codes.BUY, high, low)), "ok_orderpx": ok_n | ok_a}
    # rows are in the order of time and seq: an order that is known by its trades has the symbol of the first
    (symbol, ok_n), (first, there) = least("symbol", big, new & ok, np.minimum), _first(mine & ok, at)
    own, valid = rows["symbol"].fill_null(0).to_numpy(), rows["symbol"].is_valid().to_numpy()
    return out | {"symbol": np.where(ok_n, symbol, own[first]), "ok_symbol": ok_n | (there & valid[first])}


def _first(where: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each step that is in `where` (0 without one), and whether there is one."""
    n = len(where)
    first = np.minimum.reduceat(np.where(where, np.arange(n), n), at)
    return np.where(first < n, first, 0), first < n


def _views(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """What the fold gives out of the sorted messages of whole orders."""
    at = _changes(rows, (*ID, "step", "inc"))
    s, held = _steps(rows, at), rows.take(at)
    start = _changes(held, ID)
    size, n = np.diff(np.append(start, len(at))), len(at)
    start, size = start[np.argsort(-size, kind="stable")], np.sort(size)[::-1]
    vol, traded, src, fresh, open_ = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, bool), np.zeros(n, bool)
    carried = held["step"].to_numpy() == 0
    for k in range(size[0]):
        i = start[: np.searchsorted(-size, -k)] + k  # the step k of all orders that have it
        j = i - 1
        was = open_[j] if k else np.zeros(len(i), bool)
        new = fresh[i] = (s["new"][i] | s["own"][i]) & (~was | s["new"][i])
        vol[i] = np.where(new, s["n_vol"][i], np.where(was, vol[j], 0)) + s["a_vol"][i]
        traded[i] = np.where(new | ~was, 0, traded[j]) + s["t_vol"][i]
        src[i] = np.where(new, i, np.where(was, src[j], -1))
        ended = (traded[i] >= vol[i]) | (s["gone"][i] & (s["w_vol"][i] >= vol[i]))
        open_[i] = (new | was) & (~ended | carried[i])
    # an order is found by channel and increment: without them nothing is known
    sound = held["channelid"].is_valid().to_numpy() & held["inc"].is_valid().to_numpy()
    named = {c: (pa.array(s[k][src], t), (src >= 0) & s[f"ok_{k}"][src]) for c, k, t in (("v_symbol", "symbol", pa.int64()), ("v_tm", "ordertm", pa.int64()), ("v_px", "orderpx", pa.float64()))} | {"v_vol": (pa.array(vol), src >= 0)}

    def given(where: np.ndarray, of: np.ndarray, kind: np.ndarray, there: np.ndarray | None, **own: pa.Array) -> pa.RecordBatch:
        """Messages `where` with the view of their step `of`; those that there is none of for lack of a key."""
        view = {c: pc.if_else(pa.array(ok[of] if there is None else ok[of] & there), v.take(pa.array(of)), None) for c, (v, ok) in named.items()}
        rides = {c: rows[c].combine_chunks().take(pa.array(where)) for c in rows.column_names} | view
        rides |= {"kind": pa.array(kind, pa.int8())} | {c: view[v] for c, v in own.items()}
        return pa.RecordBatch.from_pydict(rides)

    of = np.repeat(np.arange(n), np.diff(np.append(at, rows.num_rows)))
    kind, step = rows["kind"].to_numpy(), rows["step"].to_numpy()
    said = np.flatnonzero((step == 1) & (kind != NEW))
    yield given(said, of[said], np.where(kind[said] == GONE, WITHDRAWN, kind[said]), sound[of[said]])
    begun, last = np.flatnonzero(fresh & ~carried), start + size - 1
    yield _with(given(at[begun], begun, np.full(len(begun), BEGUN), None, symbol="v_symbol"))
    last = last[open_[last]]
    yield _with(given(at[last], last, np.full(len(last), LEFT), None, symbol="v_symbol"), vol=pa.array(traded[last]))


def _with(rows: pa.RecordBatch, **own: pa.Array) -> pa.RecordBatch:
    """Rows that say what an order is, without what its first message has of its own."""
    said = {c: pa.nulls(rows.num_rows, rows.schema.field(c).type) for c in rows.schema.names if c in ("flag", "vol", "tm", "other", "seq", "px") or c.startswith("o_")} | own
    return pa.RecordBatch.from_pydict({c: said.get(c, rows[c]) for c in rows.schema.names})


def _passed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """What an earlier fold has given out, as it is."""
    for c, t in (("v_symbol", pa.int64()), ("v_tm", pa.int64()), ("v_px", pa.float64()), ("v_vol", pa.int64())):
        rows = rows.append_column(c, pa.nulls(rows.num_rows, t))
    yield from rows.to_batches()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the last order of a batch may go on in the next one
    for batch in batches:
        done = np.asarray(batch.column("kind")) >= BEGUN
        if done.any():
            yield from _passed(pa.Table.from_batches([batch]).filter(pa.array(done)))
        rows = pa.Table.from_batches([batch])
        rows = rows.filter(pa.array(~done)) if done.any() else rows
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if rows.num_rows:
            cut = int(_changes(rows, ID)[-1])
            held = rows.slice(cut)
            if cut:
                yield from _views(rows.slice(0, cut).combine_chunks())
    if held is not None:
        yield from _views(held.combine_chunks())


def folded(legs_: DataFrame, parts: int | None = None) -> DataFrame:
    """The columns of legs and VIEW: withdrawals and trades with their order as its increment sees it, a row for each order that
    begins, and one for each that is open at the end, whose vol is what it has traded. parts: how many tasks messages are
    dealt to, if not Spark's own number."""
    dealt = legs_.repartition(*([parts] if parts else []), *ID).sortWithinPartitions("orderid", "channelid", "side", "step", "inc", "tm", "seq")
    schema = StructType([StructField(f.name, f.dataType) for f in (*legs_.schema.fields, *StructType.fromDDL(VIEW).fields)])
    return dealt.mapInArrow(_folded, schema)


@contextmanager
def batches(spark: SparkSession, rows: int = 50_000) -> Iterator[None]:
    """Arrow batches by rows alone while messages are folded: these are narrow, and the bytes of a batch are else counted at
    each row."""
    own = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str((1 << 31) - 1)}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_batches = batches  # its name in tests


def _priced(rows: DataFrame, days: DataFrame | None) -> DataFrame:
    """The table of a lifecycle from what both folds gave out."""
    own = lambda c: F.when(F.col("side") == codes.BUY, F.col(f"o_{c}")).otherwise(F.col(f"v_{c}"))
    trade = F.col("kind") < BEGUN
    out = rows.filter(F.col("kind") != LEFT).withColumns({"family": F.when(trade, "trade").when(F.col("kind") == BEGUN, "order").otherwise("withdraw"), "ordertm": own("tm"), "orderpx": own("px"), "ordervol": own("vol")})
    out = out.withColumns({"tradebuyid": F.col("other"), "tradesellid": F.col("orderid"), "tradetm": F.col("tm"), "tradepx": F.col("px"), "tradevol": F.col("vol"), "withdrawtm": F.col("tm"), "withdrawpx": F.coalesce("px", "orderpx"), "withdrawvol": F.col("vol"), "side": F.when(trade, F.col("flag")).otherwise(F.col("side"))})
    out = out.withColumns({f"order{c}_{name}": F.col(f"{k}_{c}") for name, k in (("buy", "o"), ("sell", "v")) for c in ("tm", "px", "vol")})
    out = out.withColumns({f"ordermoney{name}": F.col(f"ordervol{name}") * F.col(f"orderpx{name}") for name in ("", "_buy", "_sell")})
    out = traded(out.withColumns({"withdrawmoney": F.col("withdrawvol") * F.col("withdrawpx"), "withdrawtmlag": time_lag(F.col("withdrawtm"), F.col("ordertm"))}))
    if days is None:
        return out
    for name, symbol in (("", "symbol"), ("_buy", "o_symbol"), ("_sell", "v_symbol")):
        found = F.broadcast(days.select(F.col("symbol").alias(symbol), F.col("pre_close").alias(f"_close{name}"), F.col("cap").alias(f"_cap{name}")))  # a row for each symbol
        out = out.join(found, symbol, "left")
    ret = {f"{k}ret{name}": px_to_ret(F.col(f"{k}px{name}"), F.col(f"_close{name}")) for k, name in (("order", ""), ("order", "_buy"), ("order", "_sell"), ("withdraw", ""), ("trade", ""))}
    turn = {f"{k}turnover{name}": turnover(F.col(f"{k}money{name}"), F.col(f"_cap{name}")) for k, name in (("order", ""), ("order", "_buy"), ("order", "_sell"), ("withdraw", ""), ("trade", ""))}
    return with_differences(out.withColumns(ret | turn))


def _life(new: DataFrame, withdraws: DataFrame, trades: DataFrame, grows: bool, days: DataFrame | None, carried: DataFrame | None, keep, parts: int | None, left: bool) -> SoFar:
    buys = folded(legs(new, withdraws, trades, grows, carried, codes.BUY), parts)
    sells = legs(new, withdraws, None, grows, carried, codes.SELL)
    onward = _onward(buys if left else buys.filter(F.col("kind") != LEFT), grows, days is not None)
    with batches(new.sparkSession):
        done = keep(folded(onward.unionByName(sells, allowMissingColumns=True), parts))
    rows = _priced(done, days)
    more = lambda k: [f"{k}ret", f"{k}turnover"] if days is not None else []
    of = lambda family, *columns: rows.filter(F.col("family") == family).select(*columns)
    known = of("order", *ID, "inc", "symbol", "ordertm", "orderpx", "ordervol", "ordermoney", *more("order"))
    gone = of("withdraw", *ID, "inc", "symbol", "withdrawtm", "withdrawpx", "withdrawvol", "ordertm", "ordervol", "withdrawmoney", "withdrawtmlag", *more("withdraw"))
    pairs = [f"{c}_{name}" for name in ("buy", "sell") for c in ("ordertm", "ordervol", "ordermoney", *more("order"))]
    done_ = of("trade", "channelid", "tradebuyid", "tradesellid", "inc", "symbol", "side", "tradetm", "tradepx", "tradevol", "trademoney", *pairs, "ordertmlag", "ordermoneydiff", *more("trade"), *(["orderretdiff", "orderturnoverdiff"] if days is not None else []))
    own = lambda c: F.when(F.col("side") == codes.BUY, F.col(f"o_{c}")).otherwise(F.col(f"v_{c}"))
    still = done.filter(F.col("kind") == LEFT).select(*ID, "symbol", own("tm").alias("ordertm"), own("px").alias("orderpx"), own("vol").alias("ordervol"), F.col("vol").alias("traded"))
    return SoFar(Lifecycle(known, gone, done_), still, rows)


def as_of(exchange: str, orders: DataFrame, trades: DataFrame, increment, days: DataFrame | None = None, carried: DataFrame | None = None, keep=lambda rows: rows, parts: int | None = None, left: bool = True) -> SoFar:
    """The lifecycle of "SH" or "SZ" as of each increment. increment() makes an increment of a time; days as for the day's
    lifecycle; carried: open orders of an earlier run; keep() may write what the folds give out, where it is used more than
    once; parts: how many tasks messages are dealt to; left: whether open buy orders are wanted at the end. What is not
    kept is best run within batches()."""
    from . import orders as o

    labelled = lambda rows, tm: rows.withColumn("inc", increment(F.col(tm)).cast("long"))
    if exchange == "SH":
        new = labelled(o.sh_new(orders), "ordertm")
        return _life(new, labelled(o.sh_withdraws(orders), "withdrawtm"), labelled(o.sh_trades(trades), "tradetm"), True, days, carried, keep, parts, left)
    own = o.sz_trades(trades)
    new = labelled(o.sz_orders(orders, own), "ordertm")
    return _life(new, labelled(o.sz_withdraws(trades), "withdrawtm"), labelled(own, "tradetm"), False, days, carried, keep, parts, left)


def worked_off(exchange: str, orders: DataFrame, trades: DataFrame, increment, upto: Sequence[int], keep) -> list[SoFar]:
    """A day in several runs, each of which has only the messages of its increments and the open orders of the run before."""
    out: list[SoFar] = []
    for a, b in zip((None, *upto[:-1]), upto, strict=True):
        part = lambda rows, tm, a=a, b=b: rows.filter((increment(F.col(tm)) <= b) & (F.lit(True) if a is None else increment(F.col(tm)) > a))
        out.append(as_of(exchange, part(orders, "ordertm"), part(trades, "tradetm"), increment, carried=keep(out[-1].open) if out else None, keep=keep))
    return out
