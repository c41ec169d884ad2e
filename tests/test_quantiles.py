"""Distributed exact quantiles equal SQL quantile_cont."""

import math

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parcelworks.operators.quantiles import exact_quantiles

PROBS = {"q0": 0.0, "q10": 0.1, "median": 0.5, "q90": 0.9, "q100": 1.0}


def _duck(values):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (x DOUBLE)")
    if values:
        con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    cols = ", ".join(f"quantile_cont(x, {p}) AS {n}" for n, p in PROBS.items())
    return con.execute(f"SELECT {cols} FROM t").fetchone()


def _check(spark, values, splitters, levels=1):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", PROBS, splitters, levels).first()
    want = _duck([v for v in values if v is not None])
    for name, w in zip(PROBS, want):
        g = got[name]
        if w is None:
            assert g is None, name
        else:
            assert math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-12), (name, g, w)


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_fixed_cases(spark, buckets):
    _check(spark, [0.5], buckets)
    _check(spark, [0.1, 0.9], buckets)
    _check(spark, [0.2, 0.2, 0.2, 0.7, None, 1.0, 0.0], buckets)
    _check(spark, [], buckets)
    _check(spark, [None, None], buckets)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(
    values=st.lists(
        st.one_of(st.none(), st.sampled_from([0.0, 0.25, 1 / 3, 0.5, 0.5000001, 0.75, 1.0]),
                  st.floats(min_value=0.0, max_value=1.0)),
        max_size=25,
    ),
    buckets=st.sampled_from([2, 3, 64]),
)
def test_random_inputs(spark, values, buckets):
    _check(spark, values, buckets)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(
    values=st.lists(
        st.one_of(
            st.floats(allow_nan=False, allow_infinity=False, width=32),  # any range
            st.floats(min_value=1.0, max_value=1.0 + 1e-13),  # a crowd in one place
            st.sampled_from([-1e300, 0.0, 1e-300, 5e8]),
        ),
        max_size=60,
    ),
    levels=st.sampled_from([1, 2]),
)
def test_any_range_and_crowds(spark, values, levels):
    _check(spark, values, 4, levels)


def test_no_task_ranks_more_than_a_small_share(spark):
    """Values of very different sizes, nearly all crowded together: the ranked buckets stay small."""
    from pyspark.sql import functions as F

    from parcelworks.operators import quantiles

    n = 200_000
    crowd = F.when(F.col("id") % 1000 == 0, F.col("id") * F.lit(1e12)).otherwise(F.lit(1.0) + F.col("id") * F.lit(1e-13))
    df = spark.range(n).select(crowd.alias("x"))
    values = df.groupBy(F.col("x").alias("v")).agg(F.count("*").alias("c"))
    largest = quantiles._placed(values, 64).groupBy("g").count().agg(F.max("count")).first()[0]
    assert largest <= 3 * n / 64
    got = quantiles.exact_quantiles(df, "x", PROBS, 64, levels=2).first()
    want = sorted(r.x for r in df.collect())
    for name, p in PROBS.items():
        at = (n - 1) * p
        lo, hi = want[int(at)], want[min(int(at) + 1, n - 1)]
        assert math.isclose(got[name], lo + (hi - lo) * (at - int(at)), rel_tol=1e-12)


def test_seller_summary_uses_exact_quantiles(spark):
    from parcelworks.operators.analysis import seller_summary

    base = spark.createDataFrame(
        [("a", 10, 0.1, 4.0), ("b", 10, 0.2, 3.0), ("c", 10, 0.4, 2.0), ("d", 10, 0.8, 1.0)],
        "seller_id string, eligible_orders long, late_delivery_rate double, average_review_score double",
    )
    row = seller_summary(base).first()
    assert row.eligible_sellers == 4
    assert row.median_late_delivery_rate == pytest.approx(0.3)
    assert row.p90_late_delivery_rate == pytest.approx(0.68)
    approx = seller_summary(base, approximate=True).first()
    assert approx.median_late_delivery_rate in (0.2, 0.4)
