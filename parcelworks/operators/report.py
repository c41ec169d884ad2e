"""The data behind the published report, as small DataFrames.

Inputs are the analysis frames (already one row per month / state /
seller), so every operator here is a global aggregate, a filter or a top-k
over a bounded table.  Ties that the original report left to an unstable
sort are broken by the key column, so results are deterministic.

Numeric columns carry full precision; ``*_display`` / ``finding`` columns
carry the strings the report shows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelworks.functions import display as D
from parcelworks.operators.analysis import (
    MONTH_MIN_ORDERS,
    SELLER_MIN_ORDERS,
    STATE_MIN_ORDERS,
    AnalysisFrames,
)
from parcelworks.sources.manifest import DATASET, LICENSE, SOURCE_URL

TOP_STATES = 12

# Metric keys and labels, in report order.
METRIC_LABELS = (
    ("orders", "Orders in warehouse"),
    ("late_delivery_eligible_orders", "Orders eligible for late-delivery rate"),
    ("gross_item_freight_value", "Gross item + freight value"),
    ("late_delivery_rate", "Late-delivery rate (eligible orders)"),
    ("average_review_score", "Average review score"),
    ("average_delivery_days", "Average delivery days"),
)

# The two review-series points.
REVIEW_SERIES_POINTS = ((0, "On time"), (1, "Late"))


def _pick(flag_value: int, column: str) -> Column:
    return F.max(F.when(F.col("late_delivery") == F.lit(flag_value), F.col(column)))


def _first_by(value: Column | str, *keys: Column) -> Column:
    """Value of the row with the smallest (keys...) tuple."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.struct(*keys))


def review_gap(delivery_review: DataFrame) -> DataFrame:
    """One row with its finding sentence; gaps are NULL when either group is absent."""
    wide = delivery_review.agg(
        _pick(0, "average_review_score").alias("on_time_average_review_score"),
        _pick(1, "average_review_score").alias("late_average_review_score"),
        _pick(0, "low_review_rate").alias("on_time_low_review_rate"),
        _pick(1, "low_review_rate").alias("late_low_review_rate"),
    )
    score_gap = F.col("on_time_average_review_score") - F.col("late_average_review_score")
    low_gap = F.col("late_low_review_rate") - F.col("on_time_low_review_rate")
    # fixed wording of the published finding
    sentence = F.concat(
        F.lit("among reviewed eligible orders, late deliveries averaged "),
        D.fixed("late_average_review_score", 3),
        F.lit(" stars versus "),
        D.fixed("on_time_average_review_score", 3),
        F.lit(" on time, a "),
        D.fixed(score_gap, 3),
        F.lit("-point gap. The 1-2 star review rate was "),
        D.fixed(low_gap * 100, 1),
        F.lit(" percentage points higher in the late group."),
    )
    finding = F.when(score_gap.isNotNull() & low_gap.isNotNull(), sentence).otherwise(
        F.lit("Late and on-time reviews cannot be compared: one of the groups has none.")
    )
    return wide.select(
        "*", score_gap.alias("review_gap"), low_gap.alias("low_review_gap"), finding.alias("finding")
    )


def stable_months(monthly: DataFrame, min_orders: int = MONTH_MIN_ORDERS) -> DataFrame:
    return monthly.where(F.col("eligible_orders") >= F.lit(min_orders))


def peak_month(monthly: DataFrame, min_orders: int = MONTH_MIN_ORDERS) -> DataFrame:
    """R2: one row - number of stable months and the one with the highest
    late rate (earliest month on ties), with its finding sentence."""
    rate, month = F.col("late_delivery_rate"), F.col("month")
    key = (-rate, month)
    agg = stable_months(monthly, min_orders).agg(
        F.count(F.lit(1)).alias("stable_months"),
        _first_by("month", *key).alias("peak_month"),
        _first_by("eligible_orders", *key).alias("peak_eligible_orders"),
        _first_by("late_delivery_rate", *key).alias("peak_late_delivery_rate"),
    )
    finding = F.when(
        F.col("stable_months") > 0,
        F.concat(
            D.long_month_label("peak_month"),
            F.lit(
                " had the highest late-delivery rate among months with at least "
                f"{min_orders:,} eligible orders: "
            ),
            D.percent("peak_late_delivery_rate"),
            F.lit(" across "),
            D.thousands("peak_eligible_orders"),
            F.lit(" orders."),
        ),
    ).otherwise(F.lit("No month met the minimum volume threshold."))
    return agg.select(
        "*", D.long_month_label("peak_month").alias("peak_month_label"), finding.alias("finding")
    )


def qualified_states(states: DataFrame, min_orders: int = STATE_MIN_ORDERS) -> DataFrame:
    return states.where(F.col("eligible_orders") >= F.lit(min_orders))


def state_spread(states: DataFrame, min_orders: int = STATE_MIN_ORDERS) -> DataFrame:
    """One row - highest and lowest late rate among qualified states
    (state name breaks ties) and the spread between them."""
    rate, state = F.col("late_delivery_rate"), F.col("customer_state")
    high, low = (-rate, state), (rate, state)
    agg = qualified_states(states, min_orders).agg(
        F.count(F.lit(1)).alias("qualified_states"),
        _first_by("customer_state", *high).alias("highest_state"),
        _first_by("late_delivery_rate", *high).alias("highest_late_delivery_rate"),
        _first_by("customer_state", *low).alias("lowest_state"),
        _first_by("late_delivery_rate", *low).alias("lowest_late_delivery_rate"),
    )
    spread = F.col("highest_late_delivery_rate") - F.col("lowest_late_delivery_rate")
    finding = F.when(
        F.col("qualified_states") > 0,
        F.concat(
            F.lit(f"Among states with at least {min_orders:,} eligible orders, "),
            F.col("highest_state"),
            F.lit(" had a "),
            D.percent("highest_late_delivery_rate"),
            F.lit(" late rate versus "),
            D.percent("lowest_late_delivery_rate"),
            F.lit(" in "),
            F.col("lowest_state"),
            F.lit(", a descriptive gap of "),
            D.percent(spread),
            F.lit("."),
        ),
    ).otherwise(F.lit("No state met the minimum volume threshold."))
    return agg.select("*", spread.alias("late_rate_spread"), finding.alias("finding"))


def _ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Position 1..n over an already-limited (bounded) frame."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def state_table(
    states: DataFrame, min_orders: int = STATE_MIN_ORDERS, top: int = TOP_STATES
) -> DataFrame:
    """The ``top`` qualified states by volume, with display strings."""
    order = (F.desc("eligible_orders"), F.asc_nulls_last("customer_state"))
    top_rows = qualified_states(states, min_orders).orderBy(*order).limit(top)
    return _ranked(top_rows, *order).select(
        "position",
        "customer_state",
        "eligible_orders",
        "late_delivery_rate",
        "average_review_score",
        "average_delivery_days",
        D.thousands("eligible_orders").alias("eligible_orders_display"),
        D.percent("late_delivery_rate").alias("late_delivery_rate_display"),
        D.fixed("average_review_score", 3).alias("average_review_display"),
        D.fixed("average_delivery_days", 2).alias("average_delivery_days_display"),
    )


def watchlist_table(watchlist: DataFrame) -> DataFrame:
    """Watchlist with shortened ids and display strings."""
    order = (
        F.desc_nulls_last("late_delivery_rate"),
        F.desc_nulls_last("eligible_orders"),
        F.asc_nulls_last("seller_id"),
    )
    return _ranked(watchlist, *order).select(
        "position",
        "seller_id",
        D.short_id("seller_id").alias("seller_id_display"),
        "eligible_orders",
        "late_delivery_rate",
        "average_review_score",
        D.thousands("eligible_orders").alias("eligible_orders_display"),
        D.percent("late_delivery_rate").alias("late_delivery_rate_display"),
        D.or_not_available(D.fixed("average_review_score", 3), "average_review_score").alias(
            "average_review_display"
        ),
    )


def monthly_series(monthly: DataFrame, min_orders: int = MONTH_MIN_ORDERS) -> DataFrame:
    """Stable months, 'yyyy-MM' label and late rate (chart series)."""
    return (
        stable_months(monthly, min_orders)
        .select(
            "month",
            D.month_label("month").alias("month_label"),
            "eligible_orders",
            "late_delivery_rate",
        )
        .orderBy("month")
    )


def review_series(delivery_review: DataFrame) -> DataFrame:
    """Exactly the two points (On time, Late) when any group exists;
    an absent group plots as 0.0.  No rows when the input is empty."""
    wide = delivery_review.agg(
        F.count(F.lit(1)).alias("groups"),
        *[_pick(flag, "average_review_score").alias(f"score_{flag}") for flag, _ in REVIEW_SERIES_POINTS],
    )
    points = F.array(
        *[
            F.struct(
                F.lit(flag).alias("late_delivery"),
                F.lit(label).alias("label"),
                F.coalesce(F.col(f"score_{flag}"), F.lit(0.0)).alias("average_review_score"),
            )
            for flag, label in REVIEW_SERIES_POINTS
        ]
    )
    return wide.where(F.col("groups") > 0).select(F.inline(points))


def metric_list(metrics: DataFrame) -> DataFrame:
    """One row per headline metric - key, label, value, display."""
    entries = []
    for pos, (key, label) in enumerate(METRIC_LABELS):
        value = F.col(key).cast("double")
        if key in ("orders", "late_delivery_eligible_orders"):
            text = D.thousands(key)
        elif key == "gross_item_freight_value":
            text = D.money(key)
        elif key == "late_delivery_rate":
            text = D.percent(key)
        else:
            text = D.fixed(key, 3)
        entries.append(
            F.struct(
                F.lit(pos + 1).alias("position"),
                F.lit(key).alias("metric"),
                F.lit(label).alias("label"),
                value.alias("value"),
                D.or_not_available(text, value).alias("display"),
            )
        )
    return metrics.select(F.inline(F.array(*entries)))


def coverage(metrics: DataFrame) -> DataFrame:
    """Purchase coverage window as text."""
    start, end = F.col("purchase_start"), F.col("purchase_end")
    text = F.when(
        start.isNotNull() & end.isNotNull(),
        F.concat(D.day_label(start), F.lit(" to "), D.day_label(end)),
    ).otherwise(F.lit(D.NOT_AVAILABLE))
    return metrics.select("purchase_start", "purchase_end", text.alias("coverage"))


def header(metrics: DataFrame) -> DataFrame:
    """The line above the report: source and licence of the data, purchase coverage, time of generation."""
    made = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm")
    return coverage(metrics).select(
        F.lit(DATASET).alias("dataset"),
        F.lit(SOURCE_URL).alias("source_url"),
        F.lit(LICENSE).alias("license"),
        F.col("coverage").alias("purchase_coverage"),
        F.concat(made, F.lit(" UTC")).alias("generated_at"),  # the session's zone is UTC
    )


def state_series(
    states: DataFrame, min_orders: int = STATE_MIN_ORDERS, top: int = TOP_STATES
) -> DataFrame:
    """The ``top`` highest-rate qualified states, shown ascending
    (position 1 = lowest rate of the selection)."""
    pick = (F.desc("late_delivery_rate"), F.desc("customer_state"))
    chosen = qualified_states(states, min_orders).orderBy(*pick).limit(top)
    return _ranked(chosen, F.asc("late_delivery_rate"), F.asc("customer_state")).select(
        "position",
        "customer_state",
        "late_delivery_rate",
        D.percent("late_delivery_rate").alias("late_delivery_rate_display"),
    )


def seller_finding(seller_summary: DataFrame, min_orders: int = SELLER_MIN_ORDERS) -> DataFrame:
    """Seller dispersion numbers and sentence, or 'too small'."""
    median = F.col("median_late_delivery_rate")
    corr = F.col("late_review_correlation")
    corr_text = F.when(F.isnan(corr), F.lit("nan")).otherwise(D.fixed(corr, 3))
    sentence = F.concat(
        F.lit("Across "),
        D.thousands("eligible_sellers"),
        F.lit(f" sellers with at least {min_orders} eligible orders, the median late rate was "),
        D.percent(median),
        F.lit(", the 90th percentile was "),
        D.percent("p90_late_delivery_rate"),
        F.lit(", and the seller-level late-rate/review correlation was "),
        F.coalesce(corr_text, F.lit("nan")),
        F.lit("."),
    )
    enough = median.isNotNull()
    return seller_summary.select(
        "eligible_sellers",
        "median_late_delivery_rate",
        "p90_late_delivery_rate",
        "late_review_correlation",
        enough.alias("has_distribution"),
        F.when(enough, sentence)
        .otherwise(F.lit("The fixture is too small for a seller distribution."))
        .alias("finding"),
    )


@dataclass(frozen=True)
class ReportFrames:
    header: DataFrame
    review_gap: DataFrame
    peak_month: DataFrame
    state_spread: DataFrame
    state_table: DataFrame
    watchlist: DataFrame
    monthly_series: DataFrame
    review_series: DataFrame
    metric_list: DataFrame
    coverage: DataFrame
    state_series: DataFrame
    seller_finding: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def build_report_frames(
    analysis: AnalysisFrames,
    month_min_orders: int = MONTH_MIN_ORDERS,
    state_min_orders: int = STATE_MIN_ORDERS,
    seller_min_orders: int = SELLER_MIN_ORDERS,
) -> ReportFrames:
    a = analysis
    return ReportFrames(
        header=header(a.metrics),
        review_gap=review_gap(a.delivery_review),
        peak_month=peak_month(a.monthly, month_min_orders),
        state_spread=state_spread(a.states, state_min_orders),
        state_table=state_table(a.states, state_min_orders),
        watchlist=watchlist_table(a.seller_watchlist),
        monthly_series=monthly_series(a.monthly, month_min_orders),
        review_series=review_series(a.delivery_review),
        metric_list=metric_list(a.metrics),
        coverage=coverage(a.metrics),
        state_series=state_series(a.states, state_min_orders),
        seller_finding=seller_finding(a.seller_summary, seller_min_orders),
    )
