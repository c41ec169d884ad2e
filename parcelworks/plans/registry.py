"""Registered queries: one callable per operator, run on the star-schema
test tables (``sf_dir``) through the full raw -> staging -> marts path.

Each callable is ``(spark, sf_dir) -> DataFrame`` and returns the library
frame with the column names the DuckDB oracle (``tools/duckdb_oracle.py``)
uses.  Sums and averages are rounded identically on both sides (money to
2 or 4 decimals, rates to 6) because floating-point sums depend on
summation order.  Display strings and findings are part of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelworks.operators import analysis as A
from parcelworks.operators import quality as Q
from parcelworks.operators import report as R
from parcelworks.operators.marts import build_marts
from parcelworks.operators.staging import stage_all
from parcelworks.sources.manifest import file_fingerprints
from parcelworks.sources.starschema import (
    FAULTY,
    MALFORMED,
    STAR_TABLES,
    altered_facts,
    raw_tables_from_star,
    with_rules,
)

# Thresholds of the registered queries: the test tables have fewer orders than the published snapshot.
MONTH_MIN = 50
STATE_MIN = 160
SELLER_MIN = 150


@dataclass
class LazyWarehouse:
    stg: dict[str, DataFrame]
    marts: dict[str, DataFrame]

    @property
    def fct(self) -> DataFrame:
        return self.marts["fct_orders"]

    def seller_base(self) -> DataFrame:
        return A.seller_base(self.marts["order_seller_facts"], SELLER_MIN)


def lazy_warehouse(spark: SparkSession, sf_dir: str, rules: dict | None = None) -> LazyWarehouse:
    """Staging and marts as lazy frames; ``rules`` change the raw tables, which are text then."""
    raw = raw_tables_from_star(spark, sf_dir, as_text=rules is not None)
    stg = stage_all(with_rules(raw, rules or {}))
    return LazyWarehouse(stg=stg, marts=build_marts(stg))


def _round(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(
        *[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def _q(build: Callable[[LazyWarehouse], DataFrame], digits: dict[str, int] | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _round(build(lazy_warehouse(spark, sf_dir)), digits or {})

    return run


RATE = 6


def _rates(columns: list[str]) -> dict[str, int]:
    return {c: RATE for c in columns}


def _metric_value() -> Column:
    return (
        F.when(F.col("metric") == "gross_item_freight_value", F.round("value", 2))
        .otherwise(F.round("value", RATE))
        .alias("value")
    )


def _checked(run: Callable[..., DataFrame]):
    """A check on raw tables with faulty rows, and on facts with wrong flags."""

    def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = lazy_warehouse(spark, sf_dir, FAULTY)
        return run(w.stg["orders"], w.stg["order_items"], w.stg["reviews"], altered_facts(w.fct))

    return checked


FAULTY_QUERIES = (*(f"quality_q{place + 1}" for place in range(len(Q.CHECK_NAMES))), "quality_report")
TABLES = ("orders", "order_items", "payments", "reviews", "customers", "products", "sellers")


def _staged_from_text(table: str):
    """Staging of raw tables whose every value is text, much of it malformed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lazy_warehouse(spark, sf_dir, MALFORMED).stg[table]

    return run


def _build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for table in TABLES:
        q[f"stg_{table}"] = _q(lambda w, t=table: w.stg[t])
    for table in TABLES:
        q[f"stg_{table}_from_text"] = _staged_from_text(table)
    q["item_rollup"] = _q(lambda w: w.marts["item_rollup"], {"order_value": 4})
    q["review_rollup"] = _q(lambda w: w.marts["review_rollup"], {"avg_review_score": RATE})
    q["fct_orders"] = _q(lambda w: w.fct, {"order_value": 4, "avg_review_score": RATE})
    q["order_seller_bridge"] = _q(lambda w: w.marts["order_seller_bridge"])
    q["order_seller_facts"] = _q(
        lambda w: w.marts["order_seller_facts"], {"order_value": 4, "avg_review_score": RATE}
    )
    q["fct_seller_performance"] = _q(
        lambda w: w.marts["fct_seller_performance"],
        {"allocated_gross_item_freight_value": 2, **_rates(["late_delivery_rate", "average_review_score"])},
    )
    for place, name in enumerate(Q.CHECK_NAMES, 1):
        q[f"quality_q{place}"] = _checked(lambda *tables, name=name: Q.check_frames(*tables)[name])
    q["quality_report"] = _checked(Q.quality_results)
    q["analysis_metrics"] = _q(
        lambda w: A.metrics(w.fct),
        {"gross_item_freight_value": 2,
         **_rates(["late_delivery_rate", "average_review_score", "average_delivery_days"])},
    )
    q["analysis_monthly"] = _q(
        lambda w: A.monthly(w.fct), _rates(["late_delivery_rate", "average_review_score"])
    )
    q["analysis_delivery_review"] = _q(
        lambda w: A.delivery_review(w.fct),
        {"average_order_value": 2,
         **_rates(["average_review_score", "low_review_rate", "average_delivery_days"])},
    )
    q["analysis_states"] = _q(
        lambda w: A.states(w.fct, w.stg["customers"]),
        _rates(["late_delivery_rate", "average_review_score", "average_delivery_days"]),
    )
    q["analysis_seller_base"] = _q(
        lambda w: w.seller_base(), _rates(["late_delivery_rate", "average_review_score"])
    )
    q["analysis_seller_summary"] = _q(
        lambda w: A.seller_summary(w.seller_base()),
        _rates([
            "min_late_delivery_rate", "median_late_delivery_rate", "p90_late_delivery_rate",
            "max_late_delivery_rate", "late_review_correlation",
        ]),
    )
    q["analysis_seller_watchlist"] = _q(
        lambda w: A.seller_watchlist(w.seller_base()),
        _rates(["late_delivery_rate", "average_review_score"]),
    )
    q["report_review_gap"] = _q(
        lambda w: R.review_gap(A.delivery_review(w.fct)),
        _rates([
            "on_time_average_review_score", "late_average_review_score",
            "on_time_low_review_rate", "late_low_review_rate", "review_gap", "low_review_gap",
        ]),
    )
    q["report_peak_month"] = _q(
        lambda w: R.peak_month(A.monthly(w.fct), MONTH_MIN), _rates(["peak_late_delivery_rate"])
    )
    q["report_state_spread"] = _q(
        lambda w: R.state_spread(A.states(w.fct, w.stg["customers"]), STATE_MIN),
        _rates(["highest_late_delivery_rate", "lowest_late_delivery_rate", "late_rate_spread"]),
    )
    q["report_state_table"] = _q(
        lambda w: R.state_table(A.states(w.fct, w.stg["customers"]), STATE_MIN),
        _rates(["late_delivery_rate", "average_review_score", "average_delivery_days"]),
    )
    q["report_watchlist"] = _q(
        lambda w: R.watchlist_table(A.seller_watchlist(w.seller_base())),
        _rates(["late_delivery_rate", "average_review_score"]),
    )
    q["report_monthly_series"] = _q(
        lambda w: R.monthly_series(A.monthly(w.fct), MONTH_MIN), _rates(["late_delivery_rate"])
    )
    q["report_review_series"] = _q(
        lambda w: R.review_series(A.delivery_review(w.fct)), _rates(["average_review_score"])
    )
    q["report_metric_list"] = lambda spark, sf_dir: R.metric_list(
        A.metrics(lazy_warehouse(spark, sf_dir).fct)
    ).withColumn("value", _metric_value())
    q["report_coverage"] = _q(lambda w: R.coverage(A.metrics(w.fct)))
    q["report_state_series"] = _q(
        lambda w: R.state_series(A.states(w.fct, w.stg["customers"]), STATE_MIN),
        _rates(["late_delivery_rate"]),
    )
    q["report_seller_finding"] = _q(
        lambda w: R.seller_finding(A.seller_summary(w.seller_base()), SELLER_MIN),
        _rates(["median_late_delivery_rate", "p90_late_delivery_rate", "late_review_correlation"]),
    )
    q["snapshot_fingerprints"] = snapshot_fingerprints
    return q


def snapshot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3 on the given input files: table, file name, bytes, SHA-256."""
    files = {name: f"{sf_dir.rstrip('/')}/{name}.parquet" for name in STAR_TABLES}
    return file_fingerprints(spark, files).drop("position")


QUERIES = _build_queries()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum end-to-end slice: delivery timeliness vs review score."""
    return QUERIES["analysis_delivery_review"](spark, sf_dir)
