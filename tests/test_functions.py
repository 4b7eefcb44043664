"""Hand-checked cases of the column functions."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import codes, moments, times, values


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def moments_of(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    sums = df.agg(*moments.power_sums(F.col("x"), "x"))
    return sums.select("*", *moments.stats("x")).first()


def test_no_rows(spark):
    r = moments_of(spark, [])
    assert r.x_n == 0 and r.x_mean is r.x_std is r.x_skew is r.x_kurt is None


def test_single_value(spark):
    r = moments_of(spark, [5])
    assert r.x_mean == 5 and r.x_std is None and r.x_skew is None and r.x_kurt is None


def test_known_sequence(spark):
    r = moments_of(spark, [1, 2, 3, 4, 5])
    assert (r.x_s1, r.x_s2, r.x_s3, r.x_s4) == (15, 55, 225, 979)
    assert r.x_mean == 3 and r.x_std == pytest.approx(math.sqrt(2.5)) and r.x_skew == pytest.approx(0, abs=1e-12) and r.x_kurt == pytest.approx(-1.3)


def test_constant_has_no_shape(spark):
    r = moments_of(spark, [42] * 10)
    assert r.x_skew is None and r.x_kurt is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=12), st.lists(st.integers(-50, 50), max_size=12))
def test_merge_equals_all(spark, a, b):
    df = spark.createDataFrame([(0, float(x)) for x in a] + [(1, float(x)) for x in b], "part int, x double")
    parts = df.groupBy("part").agg(*moments.power_sums(F.col("x"), "x"))
    whole = df.agg(*moments.power_sums(F.col("x"), "x")).first()
    merged = parts.agg(*moments.merged("x")).first()
    assert [v or 0 for v in merged] == list(whole)


def test_vwapx(spark):
    df = spark.createDataFrame([(100, 1000.0), (200, 2200.0)], "v long, m double").agg(F.sum("v").alias("vol"), F.sum("m").alias("money"))
    assert df.select(moments.vwapx().alias("x")).first()["x"] == pytest.approx(3200 / 300)


@pytest.mark.parametrize(("tm", "ms", "session"), [(93_000_000, 34_200_000, 34_200_000), (145_959_999, 53_999_999, 53_999_999 - 5_400_000), (92_500_000, 33_900_000, 34_200_000), (130_000_000, 46_800_000, 41_400_000), (100_000_000, 36_000_000, 36_000_000)])
def test_times(spark, tm, ms, session):
    assert one(spark, times.tm_to_ms(F.lit(tm))) == ms
    assert one(spark, times.continuous_ms(times.tm_to_ms(F.lit(tm)))) == session
    assert one(spark, times.ms_to_tm(F.lit(ms))) == tm


@pytest.mark.parametrize(
    ("tm", "label"),
    [(92_459_999, times.BASELINE), (92_500_000, 931), (92_959_999, 931), (93_000_000, 931), (93_059_999, 931), (93_100_000, 932), (112_900_000, 1130), (112_959_999, 1130), (113_000_000, 1130), (113_000_001, times.MIDDAY), (125_959_999, times.MIDDAY), (130_000_000, 1301), (145_959_999, 1500), (150_000_000, 1500), (150_000_001, times.CLOSE), (150_500_000, times.CLOSE), (150_500_001, times.IGNORED)],
)
def test_bar_labels(spark, tm, label):
    assert one(spark, times.bar_label(F.lit(tm))) == label


def test_calendar(spark):
    labels = one(spark, times.labels())
    assert len(labels) == 240 and labels[0] == 931 and labels[119] == 1130 and labels[120] == 1301 and labels[-1] == 1500
    assert len(one(spark, times.schedule())) == 241


@pytest.mark.parametrize(("vol", "money", "large"), [(100_000, 0, True), (0, 1_000_000, True), (200_000, 2_000_000, True), (99_999, 999_999, False)])
def test_large(spark, vol, money, large):
    assert one(spark, values.is_large(F.lit(vol), F.lit(money))) is large


@pytest.mark.parametrize(("vol", "money", "small"), [(10_000, 100_000, True), (1000, 500_000, True), (500, 50_000, True), (10_001, 100_001, False), (50_000, 50_000, False)])
def test_small(spark, vol, money, small):
    assert one(spark, values.is_small(F.lit(vol), F.lit(money))) is small


def test_withdrawals(spark):
    assert one(spark, values.is_complete(F.lit(100), F.lit(100))) and not one(spark, values.is_complete(F.lit(50), F.lit(100)))
    assert one(spark, values.is_partial(F.lit(50), F.lit(100))) and not one(spark, values.is_partial(F.lit(100), F.lit(100)))
    assert [one(spark, values.is_instant(F.lit(x))) for x in (0, 3000, 3001, -1)] == [True, True, False, False]


@pytest.mark.parametrize(("symbol", "code", "exchange", "listed"), [(1, "000001.XSHE", "SZ", True), (199_999, "199999.XSHE", "SZ", True), (200_000, "200000.XSHE", "SZ", False), (201_999, "201999.XSHE", "SZ", False), (202_000, "202000.XSHE", "SZ", True), (399_999, "399999.XSHE", "SZ", True), (400_000, "400000.XSHG", "SH", True), (699_999, "699999.XSHG", "SH", True), (700_000, "700000.OTHER", "", False)])
def test_codes(spark, symbol, code, exchange, listed):
    s = F.lit(symbol)
    assert one(spark, codes.code(s)) == code and one(spark, codes.exchange(s)) == exchange and one(spark, codes.in_universe(s)) is listed
    assert one(spark, codes.symbol(F.lit(code))) == symbol


def test_guards(spark):
    assert one(spark, values.px_to_ret(F.lit(12.0), F.lit(None).cast("double"))) is None
    assert one(spark, values.px_to_ret(F.lit(13.0), F.lit(10.0))) == pytest.approx(0.2)
    assert one(spark, values.finite(F.lit(float("nan")))) is None and one(spark, values.finite(F.lit(float("-inf")))) is None
    assert one(spark, values.close_to(F.lit(1.0), F.lit(None).cast("double"))) is False
    assert one(spark, codes.side(F.lit(3))) is None
