"""Order flow and latency from streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import codes
from ..functions import moments as m

EVENTS = "exchange string, symbol long, date date, tm long, seq long, kind string, side int, id long, other long, px double, vol long"
FLOW = "symbol long, tm long, seq long, kind string, side int, id long, other long, px double, vol long, order_vol long, order_tm long, other_vol long, other_tm long, lag_ms long"


def streaming_moments(stream: DataFrame, by: Sequence[str], vol: Column, money: Column, fields: dict[str, Column], buckets: dict[str, Column | None]) -> DataFrame:
    """The wide aggregate of a family as a streaming one: its state is the power sums of each key."""
    return stream.groupBy(*by).agg(*m.bucketed(vol, money, fields, buckets))


def latest_state(stream: DataFrame, by: Sequence[str], time: str, columns: Sequence[str]) -> DataFrame:
    """Per channel, the newest message and how many there were."""
    return stream.groupBy(*by).agg(F.max(time).alias(time), F.max_by(F.struct(*columns), time).alias("last"), F.count("*").alias("n"))


def _session(tm: np.ndarray) -> np.ndarray:
    """Session milliseconds of HHMMSSmmm."""
    ms = tm // 10_000_000 * 3_600_000 + tm // 100_000 % 100 * 60_000 + tm // 1000 % 100 * 1000 + tm % 1000
    return np.where(ms < 34_197_000, ms + 300_000, np.where(ms > 46_797_000, ms - 5_400_000, ms))


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSE_MS = 15 * 3_600_000 + 300_000  # of the day: when what is still open is forgotten


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state by key in RocksDB, as processors with map state need, with one bound on its
    memory for all parts that an executor holds."""
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


CHUNKS = 32  # fixed by what is in a state
ORDER = np.dtype([("side", "<i8"), ("id", "<i8"), ("vol", "<i8"), ("tm", "<i8"), ("traded", "<i8")])
FEW = 64  # orders of a key that a batch may change one by one
FRAME = 50_000  # rows given out at once
HELD = 250_000  # messages that a task deals at once
PACKED = (0,)
KINDS = ("order", "withdraw", "trade")
NEW, GONE, TRADE = range(3)
NONE = np.iinfo(np.int64).min
VIEW = ("order_vol", "order_tm", "other_vol", "other_tm", "lag_ms")
MESSAGE = pa.schema([("tm", pa.int64()), ("seq", pa.int64()), ("kind", pa.int8()), ("side", pa.int32()), ("id", pa.int64()), ("other", pa.int64()), ("px", pa.float64()), ("vol", pa.int64()), *((c, pa.int64()) for c in VIEW)])
#: Messages of a key and day as one row: Python is asked once for many of them.
PACK = "exchange string, symbol long, chunk int, at timestamp, body binary"


def _body(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, MESSAGE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(rows)
    return out.getvalue().to_pybytes()


def _rows(bodies: Sequence[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in bodies])


def _chunks(own: np.ndarray) -> np.ndarray:
    return (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % CHUNKS


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of some keys, and where these begin anew in that order."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = reduce(np.logical_or, [k[order][1:] != k[order][:-1] for k in keys])
    return order, np.append(np.flatnonzero(new), len(order))


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages as packs for sell orders: trades by the chunk of their sell order, the rest by its own."""

    def packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        own = np.where(rows["kind"].to_numpy() == TRADE, rows["other"].fill_null(0).to_numpy(), rows["id"].fill_null(0).to_numpy())
        chunk, where = _chunks(own), rows["exchange"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        order, at = _runs(where, rows["symbol"].fill_null(NONE).to_numpy(), chunk, rows["at"].cast(pa.int64()).fill_null(NONE).to_numpy())
        rows, chunk, first = rows.take(order), chunk[order], at[:-1]
        said = pa.Table.from_arrays([rows[f.name].cast(f.type) if f.name in rows.column_names else pa.nulls(len(order), f.type) for f in MESSAGE], schema=MESSAGE)
        bodies = pa.array([_body(said.slice(a, b - a)) for a, b in zip(first.tolist(), at[1:].tolist(), strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([*(rows[c].combine_chunks().take(pa.array(first)) for c in ("exchange", "symbol")), pa.array(chunk[first], pa.int32()), rows["at"].combine_chunks().take(pa.array(first)), bodies], ["exchange", "symbol", "chunk", "at", "body"])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= HELD:
            yield packs(held)
            held, n = [], 0
    if held:
        yield packs(held)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in FLOW.split(", ")]
    for batch in batches:
        for symbol, body in zip(batch.column("symbol"), batch.column("body"), strict=True):
            rows = _rows([body.as_py()])
            kind = pa.array(KINDS).take(rows["kind"].combine_chunks())
            yield from rows.set_column(2, "kind", kind).append_column("symbol", pa.repeat(symbol, rows.num_rows)).select(names).combine_chunks().to_batches()


class Orders(StatefulProcessor):
    """The active orders of a key by (side, id), each with the volume, time and traded volume so far: those of one side, or of
    both. Messages to orders of the other side go through as they are. Rows are messages, or packs of them.

    An order has a row of state while batches change few; from the first batch that changes more than FEW, all orders of the
    key are one value (40 bytes an order), read and written once a batch, until none is left. So a batch neither writes a key's
    whole state for one message nor asks for each of many orders. A timer clears what is left when the watermark has passed the
    day's end."""

    def __init__(self, *sides: int) -> None:
        self.sides = sides or (codes.BUY, codes.SELL)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.orders = handle.getMapState("orders", "side int, id long", "vol long, tm long, traded long")
        self.packed = handle.getMapState("packed", "part int", "orders binary")

    def _mine(self, side: int) -> bool:
        return (codes.SELL if side == codes.SELL else codes.BUY) in self.sides

    def _held(self, named: Callable[[], set[tuple[int, int]]]) -> tuple[dict[tuple[int, int], list[int]], bool]:
        """Orders of the key, at least those that are named, and whether they are one value."""
        if self.packed.exists():
            found = self.packed.getValue(PACKED)
            return {(side, k): rest for side, k, *rest in np.frombuffer(bytes(found[0]), ORDER).tolist()}, True
        if not self.orders.exists():
            return {}, False
        keys = named()
        if len(keys) > FEW:
            return {tuple(k): list(v) for k, v in self.orders.iterator()}, False
        return {k: list(self.orders.getValue(k)) for k in keys if self.orders.containsKey(k)}, False

    def _put(self, before: dict[tuple[int, int], tuple[int, ...]], held: dict[tuple[int, int], list[int]], packed: bool) -> None:
        """Writes what is held; before: what it was, if it is not one value."""
        changed = [] if packed else [k for k, x in held.items() if before.get(k) != tuple(x)]
        gone = [k for k in before if k not in held]
        if not packed and len(changed) + len(gone) <= FEW:
            for k in gone:
                self.orders.removeKey(k)
            for k in changed:
                self.orders.updateValue(k, tuple(held[k]))
            return
        if before:
            self.orders.clear()
        if held:
            self.packed.updateValue(PACKED, (np.array([(*k, *x) for k, x in held.items()], ORDER).tobytes(),))
        elif packed:
            self.packed.removeKey(PACKED)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))
        if "body" in came:
            day = came["at"].max()
            out = self._matched(key[0], _rows(came["body"].tolist()), day)
            chunk = _chunks(out["id"].to_numpy())
            order, at = _runs(chunk)  # as buy orders want them
            out = out.take(order)
            cuts = [(k, min(k + FRAME, b)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) for k in range(a, b, FRAME)]
            yield pd.DataFrame({"exchange": key[0], "symbol": key[1], "chunk": [int(chunk[order[a]]) for a, _ in cuts], "at": day, "body": [_body(out.slice(a, b - a)) for a, b in cuts]})
            return
        said = came.assign(kind=came["kind"].map(KINDS.index))
        out = self._matched(key[0], pa.Table.from_arrays([pa.array(said[f.name], f.type) if f.name in said else pa.nulls(len(said), f.type) for f in MESSAGE], schema=MESSAGE), came["date"].max())
        yield out.to_pandas(integer_object_nulls=True).assign(symbol=key[1], kind=[KINDS[k] for k in out["kind"].to_pylist()])

    def _matched(self, exchange: str, came: pa.Table, day) -> pa.Table:
        """Messages, with orders that their trades make, and what was known of the orders when they came."""
        came = came.sort_by([(c, "ascending") for c in ("tm", "seq", "vol", "px")]).combine_chunks()
        kinds = came["kind"].to_numpy()
        said = [came[c].fill_null(0).to_numpy().tolist() for c in ("tm", "kind", "side", "id", "other", "vol")]
        order_vol, order_tm, other_vol, other_tm = views = [came[c].fill_null(NONE).to_numpy().tolist() for c in VIEW[:4]]
        named = lambda: {k for _, kind, side, own, other, _ in zip(*said, strict=True) for k in (((codes.BUY, own), (codes.SELL, other)) if kind == TRADE else ((side, own),)) if self._mine(k[0])}
        held, packed = self._held(named)
        before = {} if packed else {k: tuple(x) for k, x in held.items()}
        begun: list[tuple[int, int, int]] = []
        for i, (tm, kind, side, own, other, vol) in enumerate(zip(*said, strict=True)):
            if kind != TRADE:
                if not self._mine(side):
                    continue
                if kind == NEW:
                    held[side, own] = [vol, tm, 0]
                    order_vol[i], order_tm[i] = vol, tm
                elif x := held.get((side, own)):
                    order_vol[i], order_tm[i] = x[0], x[1]
                    if vol >= x[0] - x[2]:
                        del held[side, own]
                continue
            if exchange == "SH" and side in self.sides:
                k = (side, own if side == codes.BUY else other)
                if x := held.get(k):
                    x[0] += vol
                else:
                    held[k] = [vol, tm, 0]
                    begun.append((i, *k))
            for k, vols, tms in (((codes.BUY, own), order_vol, order_tm), ((codes.SELL, other), other_vol, other_tm)):
                if x := held.get(k):
                    vols[i], tms[i] = x[0], x[1]
                    x[2] += vol
                    if x[2] >= x[0]:
                        del held[k]
        self._put(before, held, packed)
        if held or packed:
            end = int(pd.Timestamp(day).value // 1_000_000) + CLOSE_MS
            if end not in set(self.handle.listTimers()):
                self.handle.registerTimer(end)
        known = dict(zip(VIEW, (np.array(v, np.int64) for v in views)))
        own_tm, to, trades = known["order_tm"], np.where(kinds == TRADE, known["other_tm"], came["tm"].fill_null(NONE).to_numpy()), kinds == TRADE
        lag = np.where((kinds != NEW) & (own_tm != NONE) & (to != NONE), _session(to) - _session(own_tm), NONE)
        known["lag_ms"] = np.where(trades & (lag != NONE), np.abs(lag), lag)
        known = {c: pa.array(v, pa.int64(), mask=v == NONE) for c, v in known.items()}
        plain = pa.array(np.where(kinds == TRADE, came["other"].fill_null(0).to_numpy(), 0))
        out = pa.Table.from_pydict({c: came[c] for c in MESSAGE.names} | {"other": plain} | known, schema=MESSAGE)
        if not begun:
            return out
        at, sides, ids = (np.array(x, np.int64) for x in zip(*begun, strict=True))  # an order that is known by its trade is given out beside it
        first, n = came.take(at), len(at)
        own = {"kind": np.full(n, NEW), "side": sides, "id": ids, "other": np.zeros(n, np.int64), "order_vol": first["vol"], "order_tm": first["tm"]}
        none = {c: pa.nulls(n, pa.int64()) for c in VIEW}
        return pa.concat_tables([out, pa.Table.from_arrays([pa.chunked_array([pa.array(x)]).cast(f.type) if isinstance(x, np.ndarray) else x for f in MESSAGE for x in [(none | own).get(f.name, first[f.name])]], schema=MESSAGE)])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.orders.clear()
        self.packed.clear()
        return iter(())

    def close(self) -> None:
        pass


def order_flow(stream: DataFrame) -> DataFrame:
    """Orders, withdrawals and trades with what was known of the orders when they came, in any order.

    kind is order, withdraw or trade. An order is kept from its arrival until it is traded or withdrawn in full, or until the
    day's end. In Shanghai (SH) an order that trades on arrival first shows up in its trade: it is made from that trade, given
    out, and kept if anything is left of it; one that is known already grows by the trade. What becomes of an order depends on
    its own messages only, so messages are dealt by (exchange, symbol) and a chunk of the ids: first to sell orders,
    with trades by theirs, then to buy orders, where a trade has its sell order with it. A task holds a chunk of a symbol at
    a time. Messages go as packs, as Python is else asked for each of them. Start it within keyed_state(). The watermark is the date of
    what has come: messages of a day may be late within it, and end with the first batch after one that has the next day.
    """
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("tinyint") - F.lit(1).cast("tinyint")
    said = stream.select("exchange", "symbol", F.col("date").cast("timestamp").alias("at"), "tm", "seq", kind.alias("kind"), "side", "id", "other", "px", "vol")
    packs = said.mapInArrow(_dealt, PACK).withWatermark("at", "1 second")  # rows at the watermark itself count as late
    sold = packs.groupBy("exchange", "symbol", "chunk").transformWithStateInPandas(Orders(codes.SELL), PACK, "Append", "EventTime", eventTimeColumnName="at")
    bought = sold.groupBy("exchange", "symbol", "chunk").transformWithStateInPandas(Orders(codes.BUY), PACK, "Append", "EventTime", eventTimeColumnName="at")
    return bought.mapInArrow(_unpacked, FLOW)
