"""Schemas of the message channels and of bars. `seq` is our own: it resolves ties of time, since rows have no order."""

from __future__ import annotations

from pyspark.sql import types as T

def _levels(name: str, kind: str) -> str:
    return ", ".join(f"{name}{i} {kind}" for i in range(1, 11))


_KINDS = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "TINYINT": T.ByteType(), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "TIMESTAMP_NTZ": T.TimestampNTZType()}


def _ddl(text: str) -> T.StructType:
    """Names and types, without asking a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (f.split() for f in text.split(", "))])


#: Names, kinds and order of the columns.
TICK = _ddl(f"nano_timestamp BIGINT, exchange STRING, Symbol INT, Time INT, AccTurnover BIGINT, AccVolume BIGINT, AfterMatchItem INT, AfterPrice FLOAT, AfterTurnover BIGINT, AfterVolume INT, AskAvgPrice FLOAT, {_levels('AskPx', 'FLOAT')}, {_levels('AskVol', 'DOUBLE')}, BSFlag TINYINT, BidAvgPrice FLOAT, {_levels('BidPx', 'FLOAT')}, {_levels('BidVol', 'DOUBLE')}, High FLOAT, Low FLOAT, MatchItem INT, Open FLOAT, PreClose FLOAT, Price FLOAT, TotalAskVolume BIGINT, TotalBidVolume BIGINT, Turnover BIGINT, Volume INT, BizIndex INT")
ORDER = _ddl("nano_timestamp BIGINT, exchange STRING, Symbol INT, BizIndex INT, Channel BIGINT, FunctionCode TINYINT, OrderKind TINYINT, OrderNumber INT, OrderOriNo INT, Price FLOAT, Time INT, Volume INT")
TRADE = _ddl("nano_timestamp BIGINT, exchange STRING, Symbol INT, AskOrder INT, BSFlag TINYINT, BidOrder INT, BizIndex INT, Channel INT, FunctionCode TINYINT, Index INT, OrderKind TINYINT, Price FLOAT, Time INT, Volume INT")
BAR = _ddl("datetime TIMESTAMP_NTZ, code STRING, open FLOAT, close FLOAT, high FLOAT, low FLOAT, money DOUBLE, volume DOUBLE")
#: Message types of the three channels: fixed values.
MSG_TYPES = {"tick": 61, "order": 62, "trade": 63}
CHANNELS = {"tick": TICK, "order": ORDER, "trade": TRADE}
EST_ROW_BYTES = {"tick": 110, "order": 30, "trade": 36}
