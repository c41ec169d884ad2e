"""The semantic traps: each helper against the behaviour it pins down."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from parcelworks.functions import compat as C


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


def test_day_diff_counts_calendar_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 1, 1, 23, 0), dt.datetime(2018, 1, 2, 1, 0)),
         (dt.datetime(2018, 1, 5, 0, 0), dt.datetime(2018, 1, 3, 23, 0))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    out = df.select(C.day_diff("a", "b").alias("d"))
    assert [r.d for r in out.collect()] == [1, -2]
    assert dict(out.dtypes)["d"] == "bigint"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2018-01-02 03:04:05", dt.datetime(2018, 1, 2, 3, 4, 5)),
        ("2018-01-02", dt.datetime(2018, 1, 2)),
        (" 2018-1-2 10:00:00", dt.datetime(2018, 1, 2, 10)),
        ("2018", None),
        ("2018-01", None),
        ("2018-13-01", None),
        ("", None),
        ("not a date", None),
        (None, None),
    ],
)
def test_lenient_timestamp(spark, text, expected):
    assert one(spark, C.lenient_timestamp("s"), text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("1.5", 1.5), (" 2 ", 2.0), ("1.5d", None), ("1f", None), ("2.0F", None),
     ("abc", None), ("", None), (None, None), ("-3.25", -3.25), ("1e3", 1000.0),
     ("1_000", 1000.0), ("1_000.5", 1000.5), ("1__000", None), ("_1", None), ("1_", None)],
)
def test_lenient_double(spark, text, expected):
    assert one(spark, C.lenient_double("s"), text) == expected


def test_lenient_double_keeps_infinity(spark):
    assert math.isinf(one(spark, C.lenient_double("s"), "inf"))


@pytest.mark.parametrize(
    "text,expected",
    [("7", 7), (" 12 ", 12), ("1.6", 2), ("2.5", 3), ("-2.5", -3), ("1_000", 1000), ("0x10", 16),
     ("0XfF", 255), ("0b101", 5), (None, None)],
)
def test_strict_int_accepts_numbers(spark, text, expected):
    assert one(spark, C.strict_int("s"), text) == expected


@pytest.mark.parametrize("text", ["five", "-0x10", "0x80000000", "2147483648", ""])
def test_strict_int_raises_on_text(spark, text):
    with pytest.raises(Exception, match="cannot cast"):
        one(spark, C.strict_int("s", "review_score"), text)


def test_trim_spaces_strips_nbsp_keeps_tab(spark):
    assert one(spark, C.trim_spaces("s"), "  DELIVERED  ") == "DELIVERED"
    assert one(spark, C.trim_spaces("s"), "\tx\t") == "\tx\t"
    assert one(spark, C.normalise_lower("s"), " Delivered ") == "delivered"
    assert one(spark, C.normalise_upper("s"), " sp ") == "SP"


def test_month_start_is_zone_less(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 3, 31, 23, 30),)], "t timestamp_ntz")
    out = df.select(C.month_start("t").alias("m"))
    assert out.first().m == dt.datetime(2018, 3, 1)
    assert dict(out.dtypes)["m"] == "timestamp_ntz"


@pytest.mark.parametrize(
    "pairs,expected",
    [
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0), (None, 1.0)], "value"),
        ([(1.0, 2.0), (1.0, 3.0)], "nan"),          # constant x
        ([(1.0, 2.0), (2.0, 2.0)], "nan"),          # constant y
        ([(1.0, 2.0)], "nan"),                      # one pair
        ([(None, 2.0), (1.0, None)], None),         # no pair
        ([(5.0, 1.0), (5.0, 2.0), (9.0, None)], "nan"),  # constant after dropping NULL pairs
    ],
)
def test_guarded_corr(spark, pairs, expected):
    df = spark.createDataFrame(pairs, "x double, y double")
    got = df.agg(C.guarded_corr("x", "y").alias("c")).first().c
    if expected is None:
        assert got is None
    elif expected == "nan":
        assert math.isnan(got)
    else:
        import numpy as np

        full = [(x, y) for x, y in pairs if x is not None and y is not None]
        want = np.corrcoef([p[0] for p in full], [p[1] for p in full])[0, 1]
        assert got == pytest.approx(want, rel=1e-12)


def test_corr_builtin_raises_which_is_why_we_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    with pytest.raises(Exception):
        df.agg(F.corr("x", "y")).collect()


def test_low_review_rate_is_double(spark):
    from parcelworks.operators.analysis import delivery_review

    df = spark.createDataFrame(
        [(dt.datetime(2018, 1, 1), 1, 1.5, 2, 10.0), (dt.datetime(2018, 1, 2), 1, 4.0, 3, 20.0)],
        "order_purchase_timestamp timestamp_ntz, late_delivery int, avg_review_score double, "
        "delivery_days long, order_value double",
    )
    out = delivery_review(df)
    assert dict(out.dtypes)["low_review_rate"] == "double"
    assert out.first().low_review_rate == 0.5


def test_nulls_sort_last(spark):
    from parcelworks.operators.analysis import monthly

    df = spark.createDataFrame(
        [(dt.datetime(2018, 2, 1), 1, 5.0, 1, 1.0), (dt.datetime(2018, 1, 1), 0, None, 1, 1.0)],
        "order_purchase_timestamp timestamp_ntz, late_delivery int, avg_review_score double, "
        "delivery_days long, order_value double",
    )
    assert [r.month.month for r in monthly(df).collect()] == [1, 2]


def test_divide_by_zero_seller_count_is_null(spark):
    from parcelworks.operators.marts import fct_seller_performance, order_seller_facts

    pairs = spark.createDataFrame([("o1", None)], "order_id string, seller_id string")
    fct = spark.createDataFrame(
        [("o1", 10.0, 0, None, None)],
        "order_id string, order_value double, seller_count long, late_delivery int, avg_review_score double",
    )
    row = fct_seller_performance(order_seller_facts(pairs, fct)).first()
    assert row.seller_id is None and row.order_count == 1
    assert row.allocated_gross_item_freight_value is None


@pytest.mark.parametrize(
    "cp,stripped",
    [(0x20, True), (0xA0, True), (0x1680, True), (0x2000, True), (0x200A, True), (0x202F, True),
     (0x205F, True), (0x3000, True), (0x09, False), (0x0A, False), (0x85, False), (0x200B, False),
     (0xFEFF, False), (0x2028, False)],
)
def test_trim_strips_exactly_space_separators(spark, cp, stripped):
    ch = chr(cp)
    out = one(spark, C.trim_spaces("s"), f"{ch}x{ch}")
    assert (out == "x") == stripped
