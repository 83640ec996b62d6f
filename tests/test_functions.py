import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as cols, kpi


def one(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize(
    "num, den, expected",
    [
        (6.0, 3.0, 2.0),
        (6.0, -3.0, -2.0),
        (6.0, 0.0, 0.0),
        (6.0, None, 0.0),
        (None, 3.0, None),
        (None, 0.0, 0.0),
    ],
)
def test_guarded_ratio(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "num double, den double")
    assert one(df.select(kpi.guarded_ratio(F.col("num"), F.col("den")))) == [expected]


@pytest.mark.parametrize(
    "den, expected", [(1e-7, 0.0), (1e-6, 0.0), (-2.0, -1.0), (2e-6, 1e6), (None, 0.0), (0.0, 0.0)]
)
def test_guarded_ratio_with_epsilon(spark, den, expected):
    df = spark.createDataFrame([(2.0, den)], "num double, den double")
    got = one(df.select(kpi.guarded_ratio(F.col("num"), F.col("den"), eps=kpi.EPSILON)))[0]
    assert got == pytest.approx(expected)


def test_guarded_ratio_requires_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 2.0, 5.0)], "num double, den double, other double")
    got = one(df.select(kpi.guarded_ratio(F.col("num"), F.col("den"), require=[F.col("other")], default=None)))
    assert got == [None, 0.5]


def test_guarded_ratio_on_integers_is_exact_division(spark):
    df = spark.createDataFrame([(1, 2)], "num int, den int")
    assert one(df.select(kpi.guarded_ratio(F.col("num"), F.col("den")))) == [0.5]


def test_diff_product_and_flag(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, None), (2.0, 2.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert one(df.select(kpi.guarded_diff(a, b))) == [2.0, 0.0, 0.0]
    assert one(df.select(kpi.guarded_product(a, b, default=None))) == [3.0, None, 4.0]
    assert one(df.select(kpi.is_meaningful(kpi.guarded_diff(a, b)))) == [True, False, False]
    assert one(df.select(kpi.is_meaningful(b))) == [True, None, True]


def test_supply_kpis_follow_their_guards(spark):
    rows = [(10.0, 4.0, 0.0), (None, 4.0, 8.0), (10.0, None, 8.0), (0.0, 4.0, None)]
    df = spark.createDataFrame(rows, "total_supply double, circulating_supply double, max_supply double")
    nothing = F.lit(None).cast("double")
    df = df.withColumns(
        dict.fromkeys(("volume_24h_usd", "market_cap_usd", "fully_diluted_market_cap_usd"), nothing)
    ).withColumns(kpi.market_kpis())
    assert one(df.select("missing_supply_ratio")) == [0.6, 0.0, 0.0, 0.0]
    assert one(df.select("supply_utilization")) == [0.0, 0.5, 0.0, 0.0]


def test_casts_give_null_not_errors(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-math.inf,), (3.9,), (None,)], "x double")
    assert one(df.select(cols.to_int("x"))) == [None, None, None, 3, None]
    big = spark.createDataFrame([(2**31,), (2**31 - 1,)], "x bigint")
    assert one(big.select(cols.to_int("x"))) == [None, 2**31 - 1]
    text = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "x string")
    assert one(text.select(cols.to_double("x"))) == [1.5, None, None]


def test_times(spark):
    rows = [("2025-05-07T12:34:56.789+00:00",), ("2025-05-07T12:34:56+02:00",), ("junk",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    assert one(df.select(cols.time_text(cols.to_time("x")))) == [
        "2025-05-07 12:34:56", "2025-05-07 10:34:56", None, None,
    ]
    assert one(df.select(cols.to_day(cols.to_time("x")))) == [dt.date(2025, 5, 7)] * 2 + [None] * 2
    epochs = spark.createDataFrame([("1700000000",), ("soon",), (None,)], "x string")
    assert one(epochs.select(cols.time_text(cols.epoch_to_time("x")))) == ["2023-11-14 22:13:20", None, None]


def test_lists(spark):
    df = spark.createDataFrame([(None,), ("",), ("USD",), ("USD, EUR,GBP ",)], "x string")
    assert one(df.select(cols.split_trimmed("x"))) == [None, [""], ["USD"], ["USD", "EUR", "GBP"]]
    assert one(df.select(cols.split_trimmed("x", drop_empty=True))) == [None, [], ["USD"], ["USD", "EUR", "GBP"]]
    assert one(df.select(cols.split_plain("x"))) == [None, [""], ["USD"], ["USD", " EUR", "GBP "]]
    arrays = spark.createDataFrame([(None,), ([],), (["a"],), (["a", "b"],)], "x array<string>")
    assert one(arrays.select(cols.first_of("x"))) == [None, None, "a", "a"]
    assert one(arrays.select(cols.joined("x", ","))) == [None, None, "a", "a,b"]


def test_delay_keeps_fractions(spark):
    df = spark.sql("SELECT TIMESTAMP'2025-01-01 00:05:00.5' AS b, TIMESTAMP'2025-01-01 00:00:00' AS a")
    assert one(df.select(kpi.delay_seconds(F.col("b"), F.col("a")))) == [300.5]
