"""Exchange times, session rules and the bar calendar, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ONE_MINUTE = "interval 1 minute"


def div(c: Column, n: int) -> Column:
    """Whole quotient of non-negative integers."""
    return F.call_function("div", c.cast("long"), F.lit(n))


def tm_to_ms(tm: Column) -> Column:
    """HHMMSSmmm to milliseconds of the day: what an hour and a minute have less than their places in the number is taken off."""
    t = tm.cast("long")
    return t - div(t, 10_000_000) * 2_400_000 - div(t, 100_000) * 40_000


def ms_to_tm(ms: Column) -> Column:
    """Milliseconds of the day to HHMMSSmmm."""
    m = ms.cast("long")
    return div(m, 3_600_000) * 10_000_000 + div(m, 60_000) % 60 * 100_000 + div(m, 1000) % 60 * 1000 + m % 1000


def tm_on_date(date: Column, tm: Column) -> Column:
    """HHMMSSmmm on a date as TIMESTAMP_NTZ."""
    return timestamp_of(date, tm_to_ms(tm))


def timestamp_of(date: Column, ms: Column) -> Column:
    """Milliseconds of a date's day as TIMESTAMP_NTZ."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms / 1000).cast("decimal(18,6)"))


def continuous_ms(ms: Column) -> Column:
    """Session clock without gaps: the opening auction is moved up to the open, the lunch break is cut out."""
    return F.when(ms < 34_197_000, ms + 300_000).when(ms > 46_797_000, ms - 5_400_000).otherwise(ms)


def time_lag(a: Column, b: Column) -> Column:
    """Session milliseconds from b to a, both HHMMSSmmm."""
    return continuous_ms(tm_to_ms(a)) - continuous_ms(tm_to_ms(b))


def ms_of_day(ts: Column) -> Column:
    """Milliseconds since midnight of a TIMESTAMP_NTZ."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * 1000 + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("long")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a TIMESTAMP_NTZ, whatever the session's time zone."""
    return F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000 + ms_of_day(ts)


def hhmm(ms: Column) -> Column:
    """Milliseconds of the day to HHMM."""
    return div(ms, 3_600_000) * 100 + div(ms, 60_000) % 60


def next_minute(label: Column) -> Column:
    """HHMM one minute later."""
    m = label % 100 + 1
    return F.when(m >= 60, (div(label, 100) + 1) * 100 + m - 60).otherwise(div(label, 100) * 100 + m)


def next_trading_minute(label: Column) -> Column:
    """The next bar label after HHMM; 0 after the last."""
    return F.when(label < 931, 931).when(label == 1130, 1301).when(label < 1500, next_minute(label)).otherwise(0)


#: Labels that stand for no bar.
BASELINE, MIDDAY, CLOSE, IGNORED = -1, -2, -3, -4


def bar_label(tm: Column, boundary: str = "next", merge_auction: bool = True) -> Column:
    """The bar (HHMM of its right edge) that a tick at HHMMSSmmm belongs to, or one of the labels above.

    boundary "prev" leaves a tick on the full minute in the bar that ends then, but for the starts of sessions. Without
    merge_auction the opening auction is part of the baseline.
    """
    usual = next_minute(div(tm, 100_000))
    if boundary == "prev":
        full = (tm % 100_000 == 0) & ~tm.isin(93_000_000, 130_000_000)
        usual = F.when(full, div(tm, 100_000)).otherwise(usual)
    return (
        F.when(tm < 92_500_000, BASELINE)
        .when(tm < 93_000_000, 931 if merge_auction else BASELINE)
        .when(tm == 113_000_000, 1130)
        .when(tm == 150_000_000, 1500)
        .when((tm > 113_000_000) & (tm < 130_000_000), MIDDAY)
        .when((tm > 150_000_000) & (tm <= 150_500_000), CLOSE)
        .when(tm > 150_500_000, IGNORED)
        .otherwise(usual)
        .cast("int")
    )


def minute_edge(ts: Column) -> Column:
    """Right edge of a timestamp's minute; the ends of sessions stay where they are."""
    floor = F.date_trunc("minute", ts).cast("timestamp_ntz")
    return F.when((ts == floor) & F.date_format(ts, "HH:mm").isin("11:30", "15:00"), ts).otherwise(floor + F.expr(ONE_MINUTE))


def file_minute(label: Column) -> Column:
    """The minute file (HHMM) that an event at HHMM is written to."""
    return F.when(label < 926, 926).when(label < 931, 931).when(label < 1131, next_minute(label)).when(label < 1301, 1301).otherwise(next_minute(label))


#: Names of the trading periods, by the HHMM at which they begin.
PERIODS = ((0, "08_盘前_"), (925, "09_竞价_"), (930, "09_早盘_"), (1000, "10_早盘_"), (1100, "11_早盘_"), (1130, "11_竞价_"), (1200, "12_午间_"), (1300, "13_下午_"), (1400, "14_尾盘_"), (1457, "14_竞价_"), (1500, "15_收盘_"))


def period_label(tm: Column) -> Column:
    """Name of the trading period at HHMMSSmmm."""
    at, out = div(tm, 100_000), F.lit(PERIODS[0][1])
    for begin, name in PERIODS[1:]:
        out = F.when(at >= begin, name).otherwise(out)
    return out


def labels() -> Column:
    """The 240 bar labels of a day as an array of HHMM."""
    run = lambda a, b: F.transform(F.sequence(F.lit(a), F.lit(b)), lambda m: (F.floor(m / 60) * 100 + m % 60).cast("int"))
    return F.concat(run(9 * 60 + 31, 11 * 60 + 30), run(13 * 60 + 1, 15 * 60))


def schedule() -> Column:
    """Labels of the factor schedule: the auction's, then those of the bars."""
    return F.concat(F.array(F.lit(925)), labels())


def nanos_to_timestamp(nanos: Column) -> Column:
    """Nanoseconds since the epoch, UTC, as TIMESTAMP_NTZ (to the microsecond)."""
    return F.timestamp_micros(div(nanos, 1000)).cast("timestamp_ntz")


def nanos_to_tm(nanos: Column, offset_hours: int = 8) -> Column:
    """Nanoseconds since the epoch to local HHMMSSmmm."""
    return ms_to_tm(F.pmod(div(nanos, 1_000_000) + offset_hours * 3_600_000, F.lit(86_400_000)))


def gateway_delay_ms(nanos: Column, tm: Column, offset_hours: int = 8) -> Column:
    """Milliseconds from the exchange's time to the journal's."""
    return tm_to_ms(nanos_to_tm(nanos, offset_hours)) - tm_to_ms(tm)


def increment_bounds(label: Column) -> tuple[Column, Column]:
    """Milliseconds of the day (start, end] of the increment that a minute's label closes: a minute, with five seconds more at
    both ends of a session. The first one begins at 09:14:55."""
    end = tm_to_ms(label.cast("long") * 100_000)
    start = F.when(label == 925, 33_295_000).when(label.isin(931, 1301), end - 65_000).otherwise(end - 60_000)
    return start, F.when(label.isin(925, 1130, 1500), end + 5_000).otherwise(end)
