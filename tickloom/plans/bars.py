"""One-minute bars from cumulative tick snapshots.

Input ticks: code, date, tm (HHMMSSmmm), seq (breaks ties of tm), current, high, low, and volume and money since the start
of the day. The whole plan is keyed by (code, date): ticks and the universe are joined by it with one shuffle, a code of the
universe without ticks is a row without a time, and windows, the aggregate of each bar, the spine of 240 labels and the forward fill all reuse that partitioning. Windows over ticks share one
sort, which numbers the ticks of a day; by that number the aggregate of each bar finds first and last values, so that its
buffers have a fixed width and it hashes instead of sorting again. What a group holds is one code's day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions import times
from ..functions.values import changed, out_money

KEY = ("code", "date")
PRICES = ("open", "high", "low", "close")
TRADED = ("current", "volume", "money")


@dataclass(frozen=True)
class Rules:
    """Switches of the synthesis. boundary: "next" or "prev"; prices: "trade" (only ticks that changed volume or money) or
    "all"; extrema: "updates" (also new highs and lows of the snapshot) or "current"."""

    boundary: str = "next"
    merge_auction: bool = True
    prices: str = "trade"
    positive_only: bool = True
    carry: bool = True
    extrema: str = "updates"


def order() -> Column:
    """What orders a code's ticks of a day."""
    return F.struct("tm", "seq")


def day() -> WindowSpec:
    """A code's day."""
    return Window.partitionBy(*KEY)


def in_order() -> WindowSpec:
    """A code's day, tick by tick."""
    return day().orderBy("tm", "seq")


def with_labels(ticks: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds the bar of each tick (null: none), its number in the day, whether it is carried back to a session's end, and
    whether the snapshot's high or low moved. Of ticks after a session's end, which follow one another, the first is carried."""
    phase, w = times.bar_label(F.col("tm"), rules.boundary, rules.merge_auction), in_order()
    ticks = ticks.withColumn("phase", phase)
    ticks = ticks.withColumns({
        "pos": F.row_number().over(w), "high_moved": changed(F.col("high"), F.lag("high").over(w)), "low_moved": changed(F.col("low"), F.lag("low").over(w)),
        "carried": F.col("phase").isin(times.MIDDAY, times.CLOSE) & changed(F.col("phase"), F.lag("phase").over(w)) & F.lit(rules.carry),
    })
    label = F.when(F.col("phase") > 0, F.col("phase")).when(F.col("carried") & (F.col("phase") == times.MIDDAY), 1130).when(F.col("carried") & (F.col("phase") == times.CLOSE), 1500)
    return ticks.withColumn("bar", label)


def with_price_flags(labelled: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds is_price: whether a tick takes part in open, high, low and close of its bar."""
    earlier = in_order().rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("bar").isNotNull(), F.struct("volume", "money")), True).over(earlier)  # of ticks in bars
    labelled = labelled.withColumn("_last", last)
    moved = changed(F.col("volume"), F.col("_last.volume")) | changed(F.col("money"), F.col("_last.money"))
    good = F.col("bar").isNotNull() & F.col("current").isNotNull()
    if rules.positive_only:
        good &= F.col("current") > 0
    return labelled.withColumn("is_price", good & (moved if rules.prices == "trade" else F.lit(True))).drop("_last")


def _first(x: str, where: Column) -> Column:
    return F.min_by(x, F.when(where & F.col(x).isNotNull(), F.col("pos")))


def _last(x: str, where: Column) -> Column:
    return F.max_by(x, F.when(where & F.col(x).isNotNull(), F.col("pos")))


def bar_aggregates(flagged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per (code, date, bar): cumulative volume and money, prices, and what the rules of session ends need."""
    every, price = F.col("bar").isNotNull(), F.col("is_price")
    # carried ticks come after the bar's end
    end_ms = times.tm_to_ms(F.col("bar").cast("long") * 100_000)
    in_time = times.tm_to_ms(F.col("tm")) <= end_ms
    valid = F.col("current").isNotNull() & ((F.col("current") > 0) if rules.positive_only else F.lit(True))
    before_noon = F.col("tm").between(112_900_000, 112_959_999) & valid
    before_open = F.col("phase") == times.BASELINE
    out = flagged.groupBy(*KEY, "bar").agg(
        _last("volume", every).alias("cum_volume"), _last("money", every).alias("cum_money"), _last("current", every).alias("last_current"),
        _first("current", price).alias("p_open"), _last("current", price).alias("p_close"),
        F.max(F.when(price, F.col("current"))).alias("p_high"), F.min(F.when(price, F.col("current"))).alias("p_low"),
        F.coalesce(F.bool_or(price & in_time), F.lit(False)).alias("has_in_time"), F.coalesce(F.bool_or(price & F.col("carried")), F.lit(False)).alias("has_carried"),
        _last("current", every & valid & in_time).alias("anchor"),
        F.max(F.when(every & F.col("high_moved") & (F.col("high") > 0), F.col("high"))).alias("new_high"),
        F.min(F.when(every & F.col("low_moved") & (F.col("low") > 0), F.col("low"))).alias("new_low"),
        _first("volume", before_noon).alias("noon_first"), _last("volume", before_noon).alias("noon_last"), _first("current", before_noon).alias("noon_open"),
        _last("current", before_open).alias("base_close"), _last("volume", before_open).alias("base_volume"), _last("money", before_open).alias("base_money"),
        F.min(F.when((F.col("current") > 0) | (F.col("volume") > 0) | (F.col("money") > 0), F.col("tm"))).alias("first_valid"),
        F.min(F.when(F.col("is_auction"), F.col("pos"))).alias("auction_pos"),
        *[F.min_by(x, F.when(F.col("is_auction"), F.col("pos"))).alias(f"auction_{x}") for x in TRADED],
        *[F.max(f"before_{x}").alias(f"before_{x}") for x in TRADED],
    )
    if rules.prices == "trade":
        hang = F.col("has_carried") & ~F.col("has_in_time") & F.col("anchor").isNotNull()
        out = out.withColumns({"p_open": F.when(hang, F.col("anchor")).otherwise(F.col("p_open")), "p_high": F.when(hang, F.greatest("p_high", "anchor")).otherwise(F.col("p_high")), "p_low": F.when(hang, F.least("p_low", "anchor")).otherwise(F.col("p_low"))})
    if rules.extrema == "updates":
        out = out.withColumns({"p_high": F.greatest("p_high", "new_high"), "p_low": F.least("p_low", "new_low")})
    return out


def with_auction_flags(flagged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds what the last valid tick before 15:00 of the code's day shows, and whether a tick may be the closing auction's:
    the first one from 15:00 on that traded since then, or that is at 15:00 sharp with another price."""
    valid = F.col("current") > 0
    before = F.max_by(F.struct(*TRADED), F.when(valid & (F.col("tm") < 150_000_000), F.col("pos"))).over(day())
    out = flagged.withColumn("_before", before).withColumns({f"before_{x}": F.col(f"_before.{x}") for x in TRADED}).drop("_before")
    traded = (F.col("volume") > F.col("before_volume")) | (F.col("money") > F.col("before_money"))
    sharp = (F.col("tm") == 150_000_000) & (F.col("current") != F.col("before_current"))
    return out.withColumn("is_auction", F.coalesce(valid & F.col("tm").between(150_000_000, 150_500_000) & (F.coalesce(traded, F.lit(False)) | sharp), F.lit(False)))


def spine(bars: DataFrame) -> DataFrame:
    """All 240 labels of each code's day, with the aggregates of those that have ticks and the day's own values."""
    per_bar = ("cum_volume", "cum_money", "last_current", "p_open", "p_high", "p_low", "p_close", "noon_first", "noon_last", "noon_open")
    days = bars.groupBy(*KEY).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("bar").isNotNull(), F.struct(F.col("bar").cast("int").alias("k"), F.struct(*per_bar).alias("v"))))).alias("at"),
        F.max("base_close").alias("base_close"), F.max("base_volume").alias("base_volume"), F.max("base_money").alias("base_money"),
        F.min("first_valid").alias("first_valid"), F.min("auction_pos").alias("auction_pos"), *[F.min_by(f"auction_{x}", "auction_pos").alias(f"auction_{x}") for x in TRADED], *[F.max(f"before_{x}").alias(f"before_{x}") for x in TRADED],
    )
    own = [f"{k}_{x}" for k in ("auction", "before") for x in TRADED]
    full = days.select(*KEY, "at", "base_close", "base_volume", "base_money", "first_valid", "auction_pos", *own, F.explode(times.labels()).alias("label"))
    return full.withColumn("v", F.try_element_at("at", F.col("label"))).select("*", *[F.col(f"v.{c}").alias(c) for c in per_bar]).drop("at", "v")


def filled(rows: DataFrame) -> DataFrame:
    """Forward-filled prices, and volume and money as differences of the filled cumulative values."""
    w = day().orderBy("label")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    carry = lambda c: F.last(c, True).over(so_far)
    rows = rows.withColumns({"any_close": F.coalesce(carry("last_current"), F.col("base_close")), "trade_close": carry("p_close"), "cv": carry("cum_volume"), "cm": carry("cum_money")})
    rows = rows.withColumn("close", F.coalesce("trade_close", "any_close"))
    rows = rows.withColumns({"pv": F.coalesce(F.lag("cv").over(w), F.col("base_volume"), F.lit(0)), "pm": F.coalesce(F.lag("cm").over(w), F.col("base_money"), F.lit(0))})
    none = F.col("p_open").isNull()
    prices = {c: F.when(none, F.col("close")).otherwise(F.col(f"p_{c}")) for c in ("open", "high", "low")}
    amounts = {"volume": F.greatest(F.coalesce("cv", "pv") - F.col("pv"), F.lit(0)), "money": F.greatest(F.coalesce("cm", "pm") - F.col("pm"), F.lit(0))}
    return rows.withColumns(prices | amounts)


def morning_end(rows: DataFrame) -> DataFrame:
    """11:30: without a trade in the minute before, the bar opens at that minute's first snapshot."""
    shown = F.col("noon_open")
    far = F.abs(F.col("open") - shown) > 1e-6 + 1e-5 * F.abs(shown)
    use = (F.col("label") == 1130) & (F.col("noon_first") == F.col("noon_last")) & far
    return rows.withColumns({"high": F.when(use, F.greatest(shown, F.col("close"))).otherwise(F.col("high")), "low": F.when(use, F.least(shown, F.col("close"))).otherwise(F.col("low")), "open": F.when(use, shown).otherwise(F.col("open"))})


def close_auction(rows: DataFrame) -> DataFrame:
    """15:00: from the last price before the auction to the auction's own."""
    use = (F.col("label") == 1500) & F.col("auction_pos").isNotNull()
    a, b = F.col("before_current"), F.col("auction_current")
    over = {"open": a, "close": b, "high": F.greatest(a, b), "low": F.least(a, b), "volume": F.greatest(F.col("auction_volume") - F.col("before_volume"), F.lit(0)), "money": F.greatest(F.col("auction_money") - F.col("before_money"), F.lit(0))}
    return rows.withColumns({c: F.when(use, F.coalesce(x, F.col(c))).otherwise(F.col(c)) for c, x in over.items()})


def previous_close(rows: DataFrame, prev: DataFrame) -> DataFrame:
    """Bars without prices, before the first valid tick or on a day without one, stand at the previous day's close."""
    rows = rows.join(prev.select("code", "prev_day_close"), "code", "left")
    blank = F.lit(True)
    for c in PRICES:
        blank &= F.coalesce(F.col(c), F.lit(0.0)) == 0
    from_ms = times.tm_to_ms(times.next_minute(times.div(F.col("first_valid"), 100_000)) * 100_000)
    early = F.col("first_valid").isNull() | (times.tm_to_ms(F.col("label").cast("long") * 100_000) < from_ms)
    use = F.col("prev_day_close").isNotNull() & (F.col("volume") == 0) & (F.col("money") == 0) & blank & early
    return rows.withColumns({c: F.when(use, F.col("prev_day_close")).otherwise(F.col(c)) for c in PRICES})


def minute_bars(ticks: DataFrame, universe: DataFrame, prev: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(datetime, code, open, close, high, low, money, volume): 240 bars for each (code, date) of the universe. Ticks of
    other codes are left out; prev has one row per code. Ticks that are stored by key (writers.keyed_ticks) are not shuffled."""
    marked = universe.select(*KEY).distinct().hint("shuffle_hash").join(ticks, list(KEY), "left")
    flagged = with_auction_flags(with_price_flags(with_labels(marked, rules), rules), rules)
    rows = close_auction(morning_end(filled(spine(bar_aggregates(flagged, rules)))))
    rows = previous_close(rows, prev)
    at = times.timestamp_of(F.col("date"), times.tm_to_ms(F.col("label").cast("long") * 100_000))
    return rows.select(at.alias("datetime"), "code", *[F.col(c).cast("float").alias(c) for c in ("open", "close", "high", "low")], out_money(F.coalesce("money", F.lit(0))).alias("money"), F.coalesce("volume", F.lit(0)).cast("double").alias("volume"))
