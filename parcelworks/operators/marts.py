"""M1-M5: order facts and the seller mart.

Plan shape (everything keyed on ``order_id``):

* ``order_seller_items`` aggregates items by (order_id, seller_id): partial
  aggregation before the shuffle, and hashing on both keys spreads an order
  with very many items over many tasks.  It is the order-seller bridge (M4)
  and the input of the item rollup (M1), so COUNT(DISTINCT seller_id) needs
  no separate distinct pass.
* M1 re-aggregates the bridge by order_id; M2 aggregates reviews by order_id
  (partial aggregation again, so a hot order never lands whole in one task).
* M3 = orders LEFT JOIN one per-order rollup (M1 and M2 together, unique per
  key).  The build stores the rollup first, so both sides of the join are
  plain exchanges and AQE can split an order id that is duplicated many
  times; as one lazy plan, hot ids are found by a sketch and spread over
  ``SALTS`` tasks.  Orders without an id go around the join.
* ``order_seller_facts`` joins the bridge to the order facts once; M5 (and
  the seller analyses) are then a single grouped aggregation by seller,
  combined map-side, so a seller holding a third of all orders is fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions.compat import day_diff

FCT_ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "item_count", "order_value", "seller_count", "avg_review_score",
    "review_count", "late_delivery", "delivery_days",
)


# A key with more than one in HOT_SHARE of the rows is hot, so there are at most HOT_SHARE of them.
HOT_SHARE = 200
SALTS = 32


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """The hot values of ``key``, from a frequent-items sketch (combined map-side): at most HOT_SHARE rows.

    The sketch decides only which keys are spread, never which rows match."""
    top = F.expr(f"approx_top_k({key}, {HOT_SHARE}, {64 * HOT_SHARE})")
    found = df.where(F.col(key).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("rows"))
    often = found.select("rows", F.inline("top")).where(F.col("count") * HOT_SHARE > F.col("rows"))
    return often.select(F.col("item").alias(key))


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key``; the left rows of a hot key are dealt to SALTS
    tasks, and each of these has the right rows of that key.  Without ``hot`` a plain join.
    A column ``salt`` of ``left`` (any long) decides the task, else a hash of the whole row."""
    if hot is None:
        return left.join(right, key, how)
    marked = F.broadcast(hot.withColumn("salts", F.lit(SALTS)))  # at most HOT_SHARE rows
    salts = F.coalesce("salts", F.lit(1))
    one = left if "salt" in left.columns else left.withColumn("salt", F.xxhash64(*left.columns))
    one = one.join(marked, key, "left").withColumn("salt", F.pmod("salt", salts).cast("int")).drop("salts")
    two = right.join(marked, key, "left")
    two = two.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return one.join(two, [key, "salt"], how).drop("salt")


def order_seller_items(stg_items: DataFrame) -> DataFrame:
    """One row per distinct (order_id, seller_id) with its item count and
    item + freight value.  A NULL seller is its own row."""
    line_value = F.coalesce(F.col("price"), F.lit(0.0)) + F.coalesce(
        F.col("freight_value"), F.lit(0.0)
    )
    return stg_items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("pair_items"),
        F.sum(line_value).alias("pair_value"),
    )


def order_seller_bridge(pairs: DataFrame) -> DataFrame:
    """M4: DISTINCT (order_id, seller_id)."""
    return pairs.select("order_id", "seller_id")


def item_rollup(pairs: DataFrame) -> DataFrame:
    """M1: per order item_count, order_value, seller_count (non-NULL sellers)."""
    return pairs.groupBy("order_id").agg(
        F.sum("pair_items").alias("item_count"),
        F.sum("pair_value").alias("order_value"),
        F.count("seller_id").alias("seller_count"),
    )


def review_rollup(stg_reviews: DataFrame) -> DataFrame:
    """M2: per order average score (NULL-skipping) and review count."""
    return stg_reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def late_delivery_flag(delivered: Column, estimated: Column) -> Column:
    """1 late, 0 on time, NULL when either timestamp is missing."""
    return (
        F.when(delivered.isNull() | estimated.isNull(), F.lit(None).cast("int"))
        .when(delivered > estimated, F.lit(1))
        .otherwise(F.lit(0))
    )


def delivery_days(purchased: Column, delivered: Column) -> Column:
    return F.when(purchased.isNotNull() & delivered.isNotNull(), day_diff(purchased, delivered))


def order_rollup(pairs: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    """M1 and M2 in one row per order id, from one shuffle of both inputs."""
    no_review = stg_reviews.schema["review_score"].dataType
    items = pairs.select(
        "order_id", "seller_id", "pair_items", "pair_value",
        F.lit(None).cast(no_review).alias("review_score"), F.lit(None).cast("int").alias("review"),
    )
    reviews = stg_reviews.select("order_id", "review_score", F.lit(1).alias("review"))
    return items.unionByName(reviews, allowMissingColumns=True).groupBy("order_id").agg(
        F.sum("pair_items").alias("item_count"),
        F.sum("pair_value").alias("order_value"),
        F.count("seller_id").alias("seller_count"),
        F.avg("review_score").alias("avg_review_score"),
        F.count("review").alias("review_count"),
    )


def fct_orders(stg_orders: DataFrame, rollup: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """M3: one row per source order row (duplicates are kept, only checked).

    ``rollup`` is the per-order rollup, ``hot`` the order ids to spread.  Orders
    without an id match nothing; they go around the join, so that they never
    meet in one task (the IS NULL scan skips every row group that has none)."""
    keyed = spread_join(stg_orders.where(F.col("order_id").isNotNull()), rollup, "order_id", hot, "left")
    unkeyed = stg_orders.where(F.col("order_id").isNull())
    joined = keyed.unionByName(unkeyed, allowMissingColumns=True)
    delivered = F.col("order_delivered_customer_date")
    return joined.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce(F.col("item_count"), F.lit(0).cast("long")).alias("item_count"),
        F.coalesce(F.col("order_value"), F.lit(0.0)).alias("order_value"),
        F.coalesce(F.col("seller_count"), F.lit(0).cast("long")).alias("seller_count"),
        F.col("avg_review_score"),
        F.coalesce(F.col("review_count"), F.lit(0).cast("long")).alias("review_count"),
        late_delivery_flag(delivered, F.col("order_estimated_delivery_date")).alias(
            "late_delivery"
        ),
        delivery_days(F.col("order_purchase_timestamp"), delivered).alias("delivery_days"),
    )


def order_seller_facts(pairs: DataFrame, fct: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Bridge joined once to the order facts: one row per (order, seller)
    pair and matching fact row, with the columns seller analyses need."""
    f = fct.select(
        "order_id", "order_value", "seller_count", "late_delivery", "avg_review_score"
    )
    if hot is None:
        return pairs.select("order_id", "seller_id").join(f, "order_id", "inner")
    # the five columns of an order's rows may be alike; the whole rows are not
    salted = fct.select(*f.columns, F.xxhash64(*fct.columns).alias("salt"))
    return spread_join(salted, pairs.select("order_id", "seller_id"), "order_id", hot).select("order_id", "seller_id", *f.columns[1:])


def allocated_value() -> Column:
    """An order's value split evenly over its sellers; NULL when the order
    has no non-NULL seller."""
    return F.col("order_value") / F.nullif(F.col("seller_count"), F.lit(0))


def fct_seller_performance(facts: DataFrame) -> DataFrame:
    """M5: per seller (NULL seller is a group): all orders, allocated value,
    late rate over eligible orders, average review."""
    return facts.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(allocated_value()).alias("allocated_gross_item_freight_value"),
        F.avg("late_delivery").alias("late_delivery_rate"),
        F.avg("avg_review_score").alias("average_review_score"),
    )


def build_marts(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Lazy marts from staging tables (no writes; see ``plans.jobs`` for the
    materialised build).  Adaptive execution cannot split a hot order id between
    an aggregate and a join, so the plan spreads it by itself."""
    hot = hot_keys(stg["orders"], "order_id")
    pairs = order_seller_items(stg["order_items"])
    fct = fct_orders(stg["orders"], order_rollup(pairs, stg["reviews"]), hot)
    facts = order_seller_facts(pairs, fct, hot)
    return {
        "order_seller_items": pairs,
        "order_seller_bridge": order_seller_bridge(pairs),
        "item_rollup": item_rollup(pairs),
        "review_rollup": review_rollup(stg["reviews"]),
        "fct_orders": fct,
        "order_seller_facts": facts,
        "fct_seller_performance": fct_seller_performance(facts),
    }
