"""Scalars of prices and sizes, and the predicates of size and behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of large and small orders (shares, money), and of an instant withdrawal (milliseconds).
LARGE_VOL, LARGE_MONEY = 100_000, 1_000_000
SMALL_VOL_1, SMALL_MONEY_1, SMALL_VOL_2, SMALL_MONEY_2 = 10_000, 100_000, 1_000, 500_000
INSTANT_MS = 3000


def price(raw: Column) -> Column:
    """Stored prices are scaled by 10000; widened before the division."""
    return raw.cast("double") / 10_000


def book(levels: list[Column]) -> Column:
    """Ten scalar levels as an array."""
    return F.array(*levels)


def level(levels: Column, i: int) -> Column:
    """Level i (from 1) of a book, 0 where it is missing."""
    return F.coalesce(F.get(levels, F.lit(i - 1)), F.lit(0))


def px_to_ret(px: Column, pre_close: Column) -> Column:
    """Return against the previous close, within 20 %; null if either is missing or the close is 0."""
    ret = F.try_divide(px, pre_close) - 1
    return F.when(ret.isNotNull(), F.greatest(F.least(ret, F.lit(0.2)), F.lit(-0.2)))


def turnover(money: Column, cap: Column) -> Column:
    """Share of the market value that changed hands."""
    return F.try_divide(money, cap)


def finite(c: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def all_finite(frame: DataFrame) -> DataFrame:
    """finite() on every float column."""
    return frame.withColumns({c: finite(F.col(c)) for c, kind in frame.dtypes if kind in ("float", "double")})


def prefixed(frame: DataFrame, prefix: str, suffix: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns with a prefix and a suffix, but for those to keep."""
    return frame.select(*[F.col(c) if c in keep else F.col(c).alias(f"{prefix}{c}{suffix}") for c in frame.columns])


def out_money(money: Column) -> Column:
    """Whole money as it is written out."""
    return F.floor(money + 1e-6).cast("double")


def spread(bid: Column, ask: Column) -> Column:
    """Relative spread, 0 if the mid price is next to nothing."""
    mid = (bid + ask) / 2
    return F.when(mid < 1e-9, 0.0).otherwise((ask - bid) / F.when(mid >= 1e-9, mid))


def vwap(money: Column, vol: Column) -> Column:
    """Mean price, 0 if the volume is next to nothing."""
    return F.when(vol < 1e-9, 0.0).otherwise(money / F.when(vol >= 1e-9, vol))


def is_large(vol: Column, money: Column) -> Column:
    return (vol >= LARGE_VOL) | (money >= LARGE_MONEY)


def is_small(vol: Column, money: Column) -> Column:
    return (vol.between(0, SMALL_VOL_1) & money.between(0, SMALL_MONEY_1)) | (vol.between(0, SMALL_VOL_2) & money.between(0, SMALL_MONEY_2))


def is_complete(withdrawn: Column, ordered: Column) -> Column:
    return withdrawn == ordered


def is_partial(withdrawn: Column, ordered: Column) -> Column:
    return withdrawn < ordered


def is_instant(lag_ms: Column) -> Column:
    return lag_ms.between(0, INSTANT_MS)


def close_to(a: Column, b: Column, rtol: float = 1e-9, atol: float = 1e-6) -> Column:
    """Equal within a tolerance; two nulls are equal, one null is not."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a - b) <= atol + rtol * F.abs(b))


def changed(now: Column, before: Column) -> Column:
    """Differs from what was before, where the first value always does."""
    return ~now.eqNullSafe(before)


def money(volume: Column, price: Column) -> Column:
    """What a volume is worth at a price."""
    return volume * price


def side_difference(buy: Column, sell: Column) -> Column:
    """How far two orders' money, turnover or return are apart, whichever is larger."""
    return F.abs(buy - sell)


def packed_price(vendor: Column) -> Column:
    """A vendor's integer price (x 10000) as the float that channels keep."""
    return vendor.cast("float")


def packed_volume(vendor: Column) -> Column:
    """A vendor's volume in thousandths as whole units."""
    return F.floor(vendor / 1000).cast("long")
