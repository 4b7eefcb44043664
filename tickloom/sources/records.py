"""Record files: six kinds of CSV with a header, their columns, and whether a write adds to what is there."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Record(NamedTuple):
    """Columns in order, as names and types, and whether files are added to."""

    fields: str
    adds: bool

    @property
    def names(self) -> list[str]:
        return [f.split()[0] for f in self.fields.split(", ")]


def _queue(name: str, kind: str, levels: int) -> str:
    return ", ".join(f"{name}{i} {kind}" for i in range(levels))


def _queues(levels: int) -> str:
    return ", ".join([_queue("buypricequeue", "double", levels), _queue("buyorderqtyqueue", "bigint", levels), _queue("sellpricequeue", "double", levels), _queue("sellorderqtyqueue", "bigint", levels)])


_HEAD = "htscsecurityid string, mddate int, mdtime int, securityidsource string"
#: The columns of each kind, in their order.
RECORDS = {
    "stock_tick": Record(f"{_HEAD}, preclosepx double, totalvolumetrade bigint, totalvaluetrade bigint, lastpx double, openpx double, highpx double, lowpx double, diffpx1 double, totalbuyqty bigint, totalsellqty bigint, weightedavgbuypx double, weightedavgsellpx double, {_queues(10)}, {_queue('buyorderqueue', 'bigint', 10)}, {_queue('sellorderqueue', 'bigint', 10)}, tradingphasecode string, numtrades bigint, afterprice double, afterturnover bigint, aftervolume bigint, afternumtrades bigint, receivetime bigint", True),
    "index_tick": Record("mddate int, mdtime int, htscsecurityid string, lastpx double, highpx double, lowpx double, totalvolumetrade bigint, totalvaluetrade bigint, tradingphasecode string, receivetime bigint", False),
    "future_tick": Record(f"{_HEAD}, preclosepx double, totalvolumetrade bigint, totalvaluetrade bigint, lastpx double, openpx double, highpx double, lowpx double, preopeninterest bigint, presettleprice double, openinterest bigint, {_queues(5)}, tradingphasecode string, receiveTime bigint", True),
    "kline": Record("htscsecurityid string, mddate int, mdtime int, openpx double, closepx double, highpx double, lowpx double, numtrades bigint, totalvolumetrade bigint, totalvaluetrade bigint, receivetime bigint", True),
    "stock_order": Record(f"{_HEAD}, securitytype string, orderindex bigint, ordertype int, orderprice double, orderqty bigint, orderbsflag int, orderno bigint, applseqnum bigint, channelno int, receivetime bigint", True),
    "stock_transaction": Record(f"{_HEAD}, tradeindex bigint, tradebuyno bigint, tradesellno bigint, tradebsflag int, tradeprice double, tradeqty bigint, trademoney double, applseqnum bigint, tradetype int, channelno int, receivetime bigint", True),
}


def write(rows: DataFrame, kind: str, path: str) -> None:
    """Rows as record files. Columns that the rows lack are empty, others than the kind's are an error. Kinds that add leave
    earlier files, the index's are replaced."""
    record = RECORDS[kind]
    if unknown := set(rows.columns) - set(record.names):
        raise ValueError(f"{kind} has no columns {sorted(unknown)}")
    shown = [(F.col(name) if name in rows.columns else F.lit(None)).cast(t).alias(name) for name, t in (f.split() for f in record.fields.split(", "))]
    rows.select(*shown).write.mode("append" if record.adds else "overwrite").option("header", True).csv(path)


def read(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Record files, typed; a header that differs is an error."""
    return spark.read.schema(RECORDS[kind].fields).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
