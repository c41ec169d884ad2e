"""Adapter: derive the seven raw order tables from the TPC-H-style test tables.

The test tables (orders, lineitem, customer, supplier, part, nation, events)
carry no delivery or review columns, so those are derived by fixed rules.
By default the derived columns keep their Parquet types (staging casts
typed columns directly); ``as_text=True`` renders every column as text,
exactly like a raw CSV table, so the staging text parsers run on it.  Both
give the same staging tables.

Rules (the DuckDB oracle in ``tools`` spells the same ones):

* orders: status F/O/P -> delivered/shipped/processing; purchase = order
  date; approved = +1 hour; for delivered orders carrier / customer delivery
  = first / last line ship date; estimated delivery = order date + 360 /
  540 / 720 / 900 days by priority 1..4, none for 5-LOW.
* order_items: one per line item; freight = price * tax, NULL when zero.
* payments: one per order; type = priority; instalments = 1 + key % 12.
* reviews: one per event; order = 4 * (event_id >> 1), so two reviews per
  order and some orphans; score by event type; answered one day later.
* customers / sellers: nation name is the state; products: size for every
  dimension.

Two variants of the text form, both by rules on a row's key: ``malformed``
writes values as careless exports do (partial dates, number suffixes,
exponents, no-break spaces, rows cut short), ``faulty`` adds and changes rows
that the quality checks must count.  ``altered_facts`` does the same to the
late flag of the order facts, which no raw value can make wrong.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelworks.sources.schemas import RAW_COLUMNS

# Fixed values of the mapping.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
ESTIMATE_DAYS_BY_PRIORITY = {
    "1-URGENT": 360,
    "2-HIGH": 540,
    "3-MEDIUM": 720,
    "4-NOT SPECIFIED": 900,
}
SCORE_BY_EVENT = {"error": 1, "signup": 2, "view": 3, "click": 4, "purchase": 5}


@dataclass(frozen=True)
class Rules:
    """SQL texts (the same in Spark and DuckDB) that a row gets where its key leaves a remainder.

    changed: (modulus, remainder, column, new value);
    added: (modulus, remainder, {column: value}), a copy of the row with other values."""

    key: str
    changed: tuple = ()
    added: tuple = ()

    def hits(self, modulus: int, remainder: int) -> str:
        return f"CAST({self.key} AS BIGINT) % {modulus} = {remainder}"


def _dates(column: str, first: int) -> tuple:
    """A month only, a word, a date only, nothing and an empty text."""
    forms = (f"substr({column}, 1, 7)", "'soon'", f"substr({column}, 1, 10)", "NULL", "''")
    return tuple((23, first + n, column, form) for n, form in enumerate(forms))


def _numbers(column: str) -> tuple:
    # the digit separator stands before few digits: DuckDB reads one before 17 digits or more as the end of the number
    forms = (
        f"{column} || 'd'", f"{column} || 'F'", f"'1_0' || substr({column}, 1, 8)", f"{column} || 'e-1'", f"'  ' || {column} || ' '",
        f"'1,' || {column}", "'-'", "''", f"'+' || {column}", "'abc'",
    )
    return tuple((19, n, column, form) for n, form in enumerate(forms, 1))


def _whole(column: str) -> tuple:
    forms = (
        f"{column} || '.4999999'", f"{column} || '.5'", f"{column} || '5e-1'", "'4.9999999999e-1'", "'2.4999999999999e0'",
        "'0x1F'", f"' ' || {column} || 'e0 '", f"'00' || {column}", f"'-' || {column} || '.50'", "'0.000000000000000000000000000015e29'",
    )
    return tuple((17, n, column, form) for n, form in enumerate(forms, 1))


def _words(column: str) -> tuple:
    forms = (f"'\u00a0 ' || upper({column}) || ' \u2003'", f"'\u3000' || lower({column})", "'\u00a0'", f"{column} || '\t'")
    return tuple((13, n, column, form) for n, form in enumerate(forms, 1))


MALFORMED = {
    "orders": Rules(
        "order_id",
        _words("order_status")
        + _dates("order_purchase_timestamp", 1)
        + _dates("order_approved_at", 3)
        + _dates("order_delivered_carrier_date", 6)
        + _dates("order_delivered_customer_date", 9)
        + _dates("order_estimated_delivery_date", 14),
    ),
    "order_items": Rules(
        "order_id",
        _whole("order_item_id") + _dates("shipping_limit_date", 2) + _numbers("price") + _numbers("freight_value"),
    ),
    "payments": Rules(
        "order_id",
        _whole("payment_sequential") + _words("payment_type") + _whole("payment_installments") + _numbers("payment_value"),
    ),
    "reviews": Rules(
        "review_id",
        _whole("review_score") + _dates("review_creation_date", 1) + _dates("review_answer_timestamp", 4),
    ),
    "customers": Rules("customer_id", _whole("customer_zip_code_prefix") + _words("customer_city") + _words("customer_state")),
    "products": Rules(
        "product_id",
        _words("product_category_name")
        + _numbers("product_weight_g")
        + _numbers("product_length_cm")
        + _numbers("product_height_cm")
        + _numbers("product_width_cm"),
    ),
    "sellers": Rules("seller_id", _whole("seller_zip_code_prefix") + _words("seller_city") + _words("seller_state")),
}

FAULTY = {
    "orders": Rules("order_id", ((89, 2, "order_status", "'lost'"),), ((97, 1, {}),)),
    "order_items": Rules(
        "order_id",
        ((79, 4, "price", "'-' || price"), (79, 5, "freight_value", "'-1'")),
        ((83, 3, {"order_id": "'none-' || order_id"}),),
    ),
    "reviews": Rules("review_id", ((73, 6, "review_score", "'0'"), (73, 7, "review_score", "'9'"))),
}

ALTERED_FACTS = "CAST(order_id AS BIGINT) % 71 = 8"


def with_rules(raw: dict[str, DataFrame], rules: dict[str, Rules]) -> dict[str, DataFrame]:
    """Text raw tables with the rules applied."""
    out = dict(raw)
    for table, own in rules.items():
        plain = raw[table]
        shown = {name: F.col(name) for name in plain.columns}
        for modulus, remainder, column, value in reversed(own.changed):  # the first rule that hits applies
            shown[column] = F.when(F.expr(own.hits(modulus, remainder)), F.expr(value)).otherwise(shown[column])
        out[table] = plain.select(*[c.alias(name) for name, c in shown.items()])
        for modulus, remainder, values in own.added:
            copies = plain.where(own.hits(modulus, remainder))
            out[table] = out[table].unionByName(copies.select(*[F.expr(values.get(c, c)).alias(c) for c in plain.columns]))
    return out


def altered_facts(fct: DataFrame) -> DataFrame:
    """Order facts with the late flag set where it must be missing, and missing where it must be set, by a key rule."""
    swapped = F.when(F.col("late_delivery").isNull(), F.lit(1))
    flag = F.when(F.expr(ALTERED_FACTS), swapped).otherwise(F.col("late_delivery"))
    return fct.withColumn("late_delivery", flag)


STAR_TABLES = ("orders", "lineitem", "customer", "supplier", "part", "nation", "events")


def _case(column: Column, mapping: dict, default: Column | None = None) -> Column:
    expr = None
    for key, value in mapping.items():
        cond = column == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr if default is None else expr.otherwise(default)


def _as_raw(df: DataFrame, table: str, columns: dict[str, Column], as_text: bool) -> DataFrame:
    """Project to the raw header order; columns the rules do not produce are
    NULL text (staging drops them anyway)."""
    out = []
    for name in RAW_COLUMNS[table]:
        c = columns[name] if name in columns else F.lit(None).cast("string")
        out.append((c.cast("string") if as_text else c).alias(name))
    return df.select(*out)


def read_star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = sf_dir.rstrip("/")
    return {name: spark.read.parquet(f"{root}/{name}.parquet") for name in STAR_TABLES}


def raw_tables_from_star(
    spark: SparkSession, sf_dir: str, as_text: bool = False
) -> dict[str, DataFrame]:
    star = read_star_tables(spark, sf_dir)
    return raw_tables_from_frames(star, as_text)


def raw_tables_from_frames(star: dict[str, DataFrame], as_text: bool = False) -> dict[str, DataFrame]:
    orders, lineitem = star["orders"], star["lineitem"]
    nation = star["nation"].select("n_nationkey", "n_name")

    # First / last ship date per order: partial aggregation before the
    # shuffle keeps one row per order per map task, even for a hot order.
    shipping = lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )
    o = orders.join(shipping, orders.o_orderkey == shipping.l_orderkey, "left")
    delivered = o.o_orderstatus == F.lit("F")
    estimate_days = _case(o.o_orderpriority, ESTIMATE_DAYS_BY_PRIORITY)
    raw_orders = _as_raw(o, "orders", {
        "order_id": o.o_orderkey,
        "customer_id": o.o_custkey,
        "order_status": _case(o.o_orderstatus, STATUS_BY_CODE, o.o_orderstatus),
        "order_purchase_timestamp": o.o_orderdate,
        "order_approved_at": o.o_orderdate + F.expr("INTERVAL 1 HOUR"),
        "order_delivered_carrier_date": F.when(delivered, o.first_ship),
        "order_delivered_customer_date": F.when(delivered, o.last_ship),
        "order_estimated_delivery_date": o.o_orderdate + F.make_dt_interval(days=estimate_days),
    }, as_text)

    li = lineitem
    raw_items = _as_raw(li, "order_items", {
        "order_id": li.l_orderkey,
        "order_item_id": li.l_linenumber,
        "product_id": li.l_partkey,
        "seller_id": li.l_suppkey,
        "shipping_limit_date": li.l_shipdate,
        "price": li.l_extendedprice,
        "freight_value": F.nullif(li.l_extendedprice * li.l_tax, F.lit(0.0)),
    }, as_text)

    raw_payments = _as_raw(orders, "payments", {
        "order_id": orders.o_orderkey,
        "payment_sequential": F.lit(1),
        "payment_type": orders.o_orderpriority,
        "payment_installments": F.lit(1) + orders.o_orderkey % 12,
        "payment_value": orders.o_totalprice,
    }, as_text)

    ev = star["events"]
    raw_reviews = _as_raw(ev, "reviews", {
        "review_id": ev.event_id,
        "order_id": F.shiftright(ev.event_id, 1) * 4,
        "review_score": _case(ev.event_type, SCORE_BY_EVENT),
        "review_creation_date": ev.ts,
        "review_answer_timestamp": ev.ts + F.expr("INTERVAL 1 DAY"),
    }, as_text)

    c = star["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    raw_customers = _as_raw(c, "customers", {
        "customer_id": F.col("c_custkey"),
        "customer_unique_id": F.col("c_name"),
        "customer_zip_code_prefix": F.col("c_nationkey"),
        "customer_city": F.col("c_mktsegment"),
        "customer_state": F.col("n_name"),
    }, as_text)

    p = star["part"]
    raw_products = _as_raw(p, "products", {
        "product_id": p.p_partkey,
        "product_category_name": p.p_type,
        "product_weight_g": p.p_size,
        "product_length_cm": p.p_size,
        "product_height_cm": p.p_size,
        "product_width_cm": p.p_size,
    }, as_text)

    s = star["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    raw_sellers = _as_raw(s, "sellers", {
        "seller_id": F.col("s_suppkey"),
        "seller_zip_code_prefix": F.col("s_nationkey"),
        "seller_city": F.col("s_name"),
        "seller_state": F.col("n_name"),
    }, as_text)

    return {
        "orders": raw_orders,
        "order_items": raw_items,
        "payments": raw_payments,
        "reviews": raw_reviews,
        "customers": raw_customers,
        "products": raw_products,
        "sellers": raw_sellers,
    }
