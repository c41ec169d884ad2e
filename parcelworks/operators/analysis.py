"""Delivery-reliability analyses over the order facts.

All are grouped aggregations that combine map-side, so each shuffles at
most one row per group per task.  Metrics, monthly and delivery-review
frames come from one small "order cube" (one scan of the facts).  The state analysis pre-aggregates the
facts per customer before joining customers, so a customer with a huge
number of orders never skews the join.  Seller analyses read the
pre-joined ``order_seller_facts``.

``late_delivery`` is 1 / 0 / NULL; NULL (not eligible) leaves every rate's
denominator.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions.compat import guarded_corr, month_start
from parcelworks.operators.quantiles import exact_quantiles

# Reporting thresholds (defaults of the public report).
SELLER_MIN_ORDERS = 100
STATE_MIN_ORDERS = 1000
MONTH_MIN_ORDERS = 1000


def _eligible() -> Column:
    return F.col("late_delivery").isNotNull()


def order_cube(fct: DataFrame) -> DataFrame:
    """One scan of the order facts -> a small additive summary keyed by
    (purchase month, late flag, reviewed?).  Metrics, monthly and
    delivery-review frames all derive from it exactly (sums, counts, min and
    max recombine), so the fact table is read once for the three of them.
    Size: months x 3 x 2 rows, whatever the number of orders."""
    review = F.col("avg_review_score")
    return fct.groupBy(
        month_start("order_purchase_timestamp").alias("month"),
        F.col("late_delivery"),
        review.isNotNull().alias("reviewed"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("order_value").alias("value_sum"),
        F.sum("late_delivery").alias("late_sum"),
        F.sum(review).alias("review_sum"),
        F.count(review).alias("review_n"),
        F.count_if(review <= 2).alias("low_n"),
        F.sum("delivery_days").alias("days_sum"),
        F.count("delivery_days").alias("days_n"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    )


def _ratio(num: str, den: str) -> Column:
    """sum(num) / sum(den) as DOUBLE; NULL when the denominator is 0/NULL."""
    return F.try_divide(F.sum(num).cast("double"), F.sum(den))


def metrics_from_cube(cube: DataFrame) -> DataFrame:
    eligible_n = F.when(_eligible(), F.col("n"))
    return cube.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("orders"),
        F.coalesce(F.sum(eligible_n), F.lit(0).cast("long")).alias("late_delivery_eligible_orders"),
        F.coalesce(F.sum("value_sum"), F.lit(0.0)).alias("gross_item_freight_value"),
        F.try_divide(F.sum("late_sum").cast("double"), F.sum(eligible_n)).alias("late_delivery_rate"),
        _ratio("review_sum", "review_n").alias("average_review_score"),
        _ratio("days_sum", "days_n").alias("average_delivery_days"),
        F.min("first_purchase").alias("purchase_start"),
        F.max("last_purchase").alias("purchase_end"),
    )


def monthly_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.where(_eligible() & F.col("month").isNotNull())
        .groupBy("month")
        .agg(
            F.sum("n").alias("eligible_orders"),
            _ratio("late_sum", "n").alias("late_delivery_rate"),
            _ratio("review_sum", "review_n").alias("average_review_score"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def delivery_review_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.where(_eligible() & F.col("reviewed"))
        .groupBy("late_delivery")
        .agg(
            F.sum("n").alias("reviewed_orders"),
            _ratio("review_sum", "n").alias("average_review_score"),
            _ratio("low_n", "n").alias("low_review_rate"),
            _ratio("days_sum", "days_n").alias("average_delivery_days"),
            _ratio("value_sum", "n").alias("average_order_value"),
        )
        .orderBy(F.asc_nulls_last("late_delivery"))
    )


def metrics(fct: DataFrame) -> DataFrame:
    """A1: one row, also on empty input: orders, eligible orders, gross
    item + freight value (0 when empty), late rate over eligible orders,
    average review and delivery days, purchase window."""
    return metrics_from_cube(order_cube(fct))


def monthly(fct: DataFrame) -> DataFrame:
    """A2: eligible orders with a purchase time, by purchase month."""
    return monthly_from_cube(order_cube(fct))


def delivery_review(fct: DataFrame) -> DataFrame:
    """A3: reviewed eligible orders, late vs on time (at most two rows);
    low review = order average <= 2."""
    return delivery_review_from_cube(order_cube(fct))


def states(fct: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """A4: eligible orders by customer state (inner join drops unknown
    customers).  Averages are carried as (sum, count) through a
    per-customer pre-aggregate, which is exact for the counts and equal to
    the row-level average up to floating-point summation order."""
    per_customer = (
        fct.where(_eligible())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("late_delivery").alias("late_sum"),
            F.sum("avg_review_score").alias("review_sum"),
            F.count("avg_review_score").alias("review_n"),
            F.sum("delivery_days").alias("days_sum"),
            F.count("delivery_days").alias("days_n"),
        )
    )
    joined = per_customer.join(
        stg_customers.select("customer_id", "customer_state"), "customer_id", "inner"
    )
    return (
        joined.groupBy("customer_state")
        .agg(
            F.sum("n").alias("eligible_orders"),
            F.sum("late_sum").alias("late_sum"),
            F.sum("review_sum").alias("review_sum"),
            F.sum("review_n").alias("review_n"),
            F.sum("days_sum").alias("days_sum"),
            F.sum("days_n").alias("days_n"),
        )
        .select(
            "customer_state",
            "eligible_orders",
            (F.col("late_sum") / F.col("eligible_orders")).alias("late_delivery_rate"),
            F.try_divide(F.col("review_sum"), F.col("review_n")).alias("average_review_score"),
            F.try_divide(F.col("days_sum").cast("double"), F.col("days_n")).alias(
                "average_delivery_days"
            ),
        )
        .orderBy(F.desc("eligible_orders"), F.asc_nulls_last("customer_state"))
    )


def seller_base(order_seller_facts: DataFrame, min_orders: int = SELLER_MIN_ORDERS) -> DataFrame:
    """Per seller over eligible orders; kept when >= ``min_orders``."""
    return (
        order_seller_facts.where(_eligible())
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("eligible_orders"),
            F.avg("late_delivery").alias("late_delivery_rate"),
            F.avg("avg_review_score").alias("average_review_score"),
        )
        .where(F.col("eligible_orders") >= F.lit(min_orders))
    )


def seller_summary(base: DataFrame, approximate: bool = False, accuracy: int = 100000) -> DataFrame:
    """A5: distribution of seller late rates (one row, also when empty).

    Count, min, max and correlation are constant-size aggregates.  Median
    and 90th percentile are exact ``quantile_cont`` values computed by
    ``exact_quantiles`` (distributed: no task holds all sellers' rates);
    ``approximate=True`` uses the bounded ``percentile_approx`` sketch
    instead.  The two one-row frames are combined by union + aggregate."""
    rate = F.col("late_delivery_rate")
    stats = base.agg(
        F.count(F.lit(1)).alias("eligible_sellers"),
        F.min(rate).alias("min_late_delivery_rate"),
        F.max(rate).alias("max_late_delivery_rate"),
        guarded_corr(rate, F.col("average_review_score")).alias("late_review_correlation"),
    )
    if approximate:
        quantiles = base.agg(
            F.percentile_approx(rate, 0.5, accuracy).cast("double").alias("median_late_delivery_rate"),
            F.percentile_approx(rate, 0.9, accuracy).cast("double").alias("p90_late_delivery_rate"),
        )
    else:
        quantiles = exact_quantiles(
            base,
            "late_delivery_rate",
            {"median_late_delivery_rate": 0.5, "p90_late_delivery_rate": 0.9},
        )
    both = stats.unionByName(quantiles, allowMissingColumns=True)
    return both.agg(
        F.max("eligible_sellers").alias("eligible_sellers"),
        F.max("min_late_delivery_rate").alias("min_late_delivery_rate"),
        F.max("median_late_delivery_rate").alias("median_late_delivery_rate"),
        F.max("p90_late_delivery_rate").alias("p90_late_delivery_rate"),
        F.max("max_late_delivery_rate").alias("max_late_delivery_rate"),
        F.max("late_review_correlation").alias("late_review_correlation"),
    )


def seller_watchlist(base: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` sellers by late rate, then volume, then id."""
    return base.orderBy(
        F.desc_nulls_last("late_delivery_rate"),
        F.desc_nulls_last("eligible_orders"),
        F.asc_nulls_last("seller_id"),
    ).limit(top)


@dataclass(frozen=True)
class AnalysisFrames:
    metrics: DataFrame
    monthly: DataFrame
    delivery_review: DataFrame
    states: DataFrame
    seller_summary: DataFrame
    seller_watchlist: DataFrame
    seller_base: DataFrame
    cube: DataFrame

    def frames(self) -> dict[str, DataFrame]:
        """The six published frames (base and cube are shared inputs)."""
        return {k: v for k, v in self.__dict__.items() if k not in ("seller_base", "cube")}

    def materialize(self) -> None:
        """Compute the persisted shared inputs (three independent jobs)."""
        with ThreadPoolExecutor(max_workers=3) as pool:
            list(pool.map(DataFrame.count, (self.cube, self.states, self.seller_base)))

    def release(self) -> None:
        for df in (self.cube, self.states, self.seller_base):
            df.unpersist()


def order_inputs(fct: DataFrame, stg_customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The analyses' shared inputs from the order facts (cube, states), computed and kept."""
    kept = (order_cube(fct).persist(), states(fct, stg_customers).persist())
    for df in kept:
        df.count()
    return kept


def seller_inputs(order_seller_facts: DataFrame, seller_min_orders: int = SELLER_MIN_ORDERS) -> DataFrame:
    """The seller base, computed and kept."""
    base = seller_base(order_seller_facts, seller_min_orders).persist()
    base.count()
    return base


def frames_from(cube: DataFrame, state_frame: DataFrame, base: DataFrame) -> AnalysisFrames:
    """All six frames, lazily, from the shared inputs."""
    return AnalysisFrames(
        metrics=metrics_from_cube(cube),
        monthly=monthly_from_cube(cube),
        delivery_review=delivery_review_from_cube(cube),
        states=state_frame,
        seller_summary=seller_summary(base),
        seller_watchlist=seller_watchlist(base),
        seller_base=base,
        cube=cube,
    )


def collect_analysis(
    fct: DataFrame,
    stg_customers: DataFrame,
    order_seller_facts: DataFrame,
    seller_min_orders: int = SELLER_MIN_ORDERS,
) -> AnalysisFrames:
    """All six frames, lazily, from three scans: the order facts once (the
    cube), the facts again for states, the order-seller facts once.  The
    small shared inputs (cube, states, seller base) are persisted; they are
    recomputable from lineage if an executor is lost."""
    return frames_from(
        order_cube(fct).persist(),
        states(fct, stg_customers).persist(),
        seller_base(order_seller_facts, seller_min_orders).persist(),
    )
