"""Q1-Q9, QR, QG: data-quality checks that gate publication.

Each check is a count; it passes at 0.  Two ways to run them:

* ``check_frames`` - one small DataFrame per check (``name``, ``failures``),
  each a standalone aggregation (anti joins for orphans).
* ``quality_results`` - the runner: the four key checks from one shuffle of
  ``order_id`` with four counts (combined map-side, so a hot order id costs
  one row per task); the five row checks are aggregates without a key, whose
  scans read only their columns.  Orphans are keys with items/reviews but no
  order row; a NULL key never matches an order, exactly like the anti join.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# The accepted order-status vocabulary.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "invoiced",
    "processing", "unavailable", "approved", "created",
)

# Check names and their descriptions, in report order.
CHECKS = (
    ("duplicate_order_ids", "stg_orders.order_id must be unique"),
    ("orphan_order_items", "every order item must reference an order"),
    ("orphan_reviews", "every review must reference an order"),
    ("negative_item_amounts", "price and freight value must be non-negative"),
    ("invalid_order_status", "order status must use the Olist status vocabulary"),
    ("delivery_before_purchase", "delivery cannot precede purchase"),
    ("duplicate_fct_orders", "fct_orders must have one row per order"),
    ("invalid_review_score", "review scores must be between one and five"),
    (
        "invalid_late_delivery_eligibility",
        "late-delivery flags require both actual and estimated delivery timestamps",
    ),
)
CHECK_NAMES = tuple(name for name, _ in CHECKS)
CHECK_DETAILS = dict(CHECKS)

RESULT_SCHEMA = "name string, passed boolean, failures bigint, detail string"


# Row predicates (NULL = not a failure, as in a SQL WHERE clause).
def negative_amount(items_price: Column, items_freight: Column) -> Column:
    return (items_price < 0) | (items_freight < 0)


def invalid_status(status: Column) -> Column:
    return ~status.isin(*ORDER_STATUSES)


def delivered_before_purchase(delivered: Column, purchased: Column) -> Column:
    return delivered < purchased


def invalid_score(score: Column) -> Column:
    return score.isNotNull() & ((score < 1) | (score > 5))


def invalid_eligibility(delivered: Column, estimated: Column, flag: Column) -> Column:
    both = delivered.isNotNull() & estimated.isNotNull()
    return (both & flag.isNull()) | (~both & flag.isNotNull())


# ---- standalone checks -------------------------------------------------------

def _one(name: str, failures: DataFrame) -> DataFrame:
    return failures.select(F.lit(name).alias("name"), F.col("failures").cast("long"))


def _duplicate_keys(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("order_id").count().where(F.col("count") > 1)
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def _orphans(child: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        child.select("order_id")
        .join(orders.select("order_id"), "order_id", "left_anti")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def _count_where(df: DataFrame, pred: Column) -> DataFrame:
    return df.agg(F.count_if(F.coalesce(pred, F.lit(False))).alias("failures"))


def check_frames(
    stg_orders: DataFrame, stg_items: DataFrame, stg_reviews: DataFrame, fct: DataFrame
) -> dict[str, DataFrame]:
    """Q1-Q9 as separate one-row frames (name, failures)."""
    o, i, r, f = stg_orders, stg_items, stg_reviews, fct
    frames = {
        "duplicate_order_ids": _duplicate_keys(o),
        "orphan_order_items": _orphans(i, o),
        "orphan_reviews": _orphans(r, o),
        "negative_item_amounts": _count_where(i, negative_amount(i.price, i.freight_value)),
        "invalid_order_status": _count_where(o, invalid_status(o.order_status)),
        "delivery_before_purchase": _count_where(
            o, delivered_before_purchase(o.order_delivered_customer_date, o.order_purchase_timestamp)
        ),
        "duplicate_fct_orders": _duplicate_keys(f),
        "invalid_review_score": _count_where(r, invalid_score(r.review_score)),
        "invalid_late_delivery_eligibility": _count_where(
            f,
            invalid_eligibility(
                f.order_delivered_customer_date, f.order_estimated_delivery_date, f.late_delivery
            ),
        ),
    }
    return {name: _one(name, df) for name, df in frames.items()}


# ---- fused runner ------------------------------------------------------------

_SIDES = ("orders", "items", "reviews", "facts")


def _keyed(df: DataFrame, side: str) -> DataFrame:
    return df.select("order_id", *[F.lit(int(name == side)).cast("long").alias(name) for name in _SIDES])


def _counted(df: DataFrame, **preds: Column) -> DataFrame:
    """One row of all nine counts; the checks not named are 0."""
    return df.agg(
        *[
            (F.count_if(F.coalesce(preds[name], F.lit(False))) if name in preds else F.lit(0).cast("long")).alias(name)
            for name in CHECK_NAMES
        ]
    )


def quality_counts(
    stg_orders: DataFrame, stg_items: DataFrame, stg_reviews: DataFrame, fct: DataFrame
) -> DataFrame:
    """One row, one column per check: the key checks (Q1, Q2, Q3, Q7) from one
    shuffle of order ids, the row checks from aggregates without a key."""
    o, i, r, f = stg_orders, stg_items, stg_reviews, fct
    rows = _keyed(o, "orders")
    for df, side in ((i, "items"), (r, "reviews"), (f, "facts")):
        rows = rows.unionByName(_keyed(df, side))
    per_key = rows.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in _SIDES])
    unmatched = F.col("order_id").isNull() | (F.col("orders") == 0)
    orphans = {
        name: F.coalesce(F.sum(F.when(unmatched, F.col(side))), F.lit(0)).alias(name)
        for name, side in (("orphan_order_items", "items"), ("orphan_reviews", "reviews"))
    }
    twice = {
        name: F.count_if(F.col(side) > 1).alias(name)
        for name, side in (("duplicate_order_ids", "orders"), ("duplicate_fct_orders", "facts"))
    }
    by_key = orphans | twice
    counts = per_key.agg(
        *[by_key[name] if name in by_key else F.lit(0).cast("long").alias(name) for name in CHECK_NAMES]
    )
    for part in (
        _counted(
            o,
            invalid_order_status=invalid_status(o.order_status),
            delivery_before_purchase=delivered_before_purchase(
                o.order_delivered_customer_date, o.order_purchase_timestamp
            ),
        ),
        _counted(i, negative_item_amounts=negative_amount(i.price, i.freight_value)),
        _counted(r, invalid_review_score=invalid_score(r.review_score)),
        _counted(
            f,
            invalid_late_delivery_eligibility=invalid_eligibility(
                f.order_delivered_customer_date, f.order_estimated_delivery_date, f.late_delivery
            ),
        ),
    ):
        counts = counts.unionByName(part)
    return counts.agg(*[F.sum(name).alias(name) for name in CHECK_NAMES])


def quality_results(
    stg_orders: DataFrame, stg_items: DataFrame, stg_reviews: DataFrame, fct: DataFrame
) -> DataFrame:
    """QR: nine result rows (name, passed, failures, detail) in report order."""
    counts = quality_counts(stg_orders, stg_items, stg_reviews, fct)
    entries = F.array(
        *[
            F.struct(
                F.lit(pos).alias("pos"),
                F.lit(name).alias("name"),
                F.col(name).cast("long").alias("failures"),
                F.lit(detail).alias("detail"),
            )
            for pos, (name, detail) in enumerate(CHECKS)
        ]
    )
    return (
        counts.select(F.inline(entries))
        .select(
            "pos",
            "name",
            (F.col("failures") == 0).alias("passed"),
            "failures",
            "detail",
        )
        .orderBy("pos")
        .drop("pos")
    )


def run_quality_checks(
    stg_orders: DataFrame, stg_items: DataFrame, stg_reviews: DataFrame, fct: DataFrame
) -> list[Row]:
    """QR + one action: nine result rows (name, passed, failures, detail) on the driver."""
    return quality_results(stg_orders, stg_items, stg_reviews, fct).collect()


class QualityGateError(ValueError):
    """Raised when any quality check fails."""


def assert_quality(results: list[Row]) -> None:
    """QG: publication stops unless every check counted zero; the error names each other count."""
    counts = {r["name"]: r["failures"] for r in results if r["failures"]}
    if counts:
        # fixed text of the published gate
        raise QualityGateError("Data quality checks failed: " + "; ".join(map("{0[0]}={0[1]}".format, counts.items())))
