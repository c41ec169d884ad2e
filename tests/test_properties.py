"""Property tests: random small tables with NULL keys, duplicate orders,
orphans and out-of-range values; Spark results must equal DuckDB running
the plain SQL definitions on the same rows."""

import datetime as dt
import math

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parcelworks.operators import analysis as A
from parcelworks.operators import marts as M
from parcelworks.operators import quality as Q
from tools.duckdb_oracle import check_sql

SETTINGS = settings(
    max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)

IDS = st.sampled_from(["o1", "o2", "o3", "o4", None])
SELLERS = st.sampled_from(["s1", "s2", "s3", None])
TIMES = st.sampled_from(
    [None, dt.datetime(2018, 1, 1, 9), dt.datetime(2018, 1, 3, 23), dt.datetime(2018, 1, 4, 1),
     dt.datetime(2018, 2, 10, 12), dt.datetime(2017, 12, 31, 23, 59)]
)
STATUS = st.sampled_from(["delivered", "shipped", "lost", None])
MONEY = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 10.25, 99.99, 100.0]))
SCORES = st.one_of(st.none(), st.integers(min_value=0, max_value=6))

ORDERS = st.lists(st.tuples(IDS, st.sampled_from(["c1", "c2", "c3"]), STATUS, TIMES, TIMES, TIMES), max_size=8)
ITEMS = st.lists(st.tuples(IDS, SELLERS, MONEY, MONEY), max_size=10)
REVIEWS = st.lists(st.tuples(IDS, SCORES), max_size=8)

ORDER_SCHEMA = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
ITEM_SCHEMA = (
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price double, freight_value double"
)
REVIEW_SCHEMA = (
    "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz, "
    "review_answer_timestamp timestamp_ntz"
)


def _frames(spark, orders, items, reviews):
    o = spark.createDataFrame([(i, c, s, p, None, None, d, e) for i, c, s, p, d, e in orders], ORDER_SCHEMA)
    it = spark.createDataFrame([(i, 1, "p", s, None, pr, fr) for i, s, pr, fr in items], ITEM_SCHEMA)
    r = spark.createDataFrame([(f"r{n}", i, sc, None, None) for n, (i, sc) in enumerate(reviews)], REVIEW_SCHEMA)
    return o, it, r


def _duck(**frames):
    con = duckdb.connect()
    for name, df in frames.items():
        pdf = df.toPandas()
        con.register(f"{name}_pdf", pdf)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_pdf")
    return con


def _close(a, b):
    if a is None or b is None or (isinstance(a, float) and math.isnan(a)):
        return (a is None or (isinstance(a, float) and math.isnan(a))) == (
            b is None or (isinstance(b, float) and math.isnan(b))
        )
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, pd.Timestamp):
        a = a.to_pydatetime()
    if isinstance(b, pd.Timestamp):
        b = b.to_pydatetime()
    return a == b


def _norm_rows(rows):
    def key(t):
        return tuple((v is None, str(v)) for v in t)

    return sorted(rows, key=key)


def _same(spark_rows, duck_rows):
    a = _norm_rows([tuple(r) for r in spark_rows])
    b = _norm_rows([tuple(None if (isinstance(v, float) and math.isnan(v)) or v is pd.NaT else v for v in r) for r in duck_rows])
    assert len(a) == len(b), (a, b)
    for x, y in zip(a, b):
        assert all(_close(u, v) for u, v in zip(x, y)), (x, y)


FCT_SQL = """
WITH i AS (
  SELECT order_id, count(*) n, sum(coalesce(price, 0) + coalesce(freight_value, 0)) v,
         count(DISTINCT seller_id) s
  FROM stg_order_items GROUP BY order_id),
r AS (SELECT order_id, avg(review_score) a, count(*) n FROM stg_reviews GROUP BY order_id)
SELECT o.order_id, coalesce(i.n, 0), coalesce(i.v, 0), coalesce(i.s, 0), r.a, coalesce(r.n, 0),
  CASE WHEN o.order_delivered_customer_date IS NULL OR o.order_estimated_delivery_date IS NULL THEN NULL
       WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date THEN 1 ELSE 0 END,
  CASE WHEN o.order_purchase_timestamp IS NOT NULL AND o.order_delivered_customer_date IS NOT NULL
       THEN date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) END
FROM stg_orders o LEFT JOIN i ON i.order_id = o.order_id LEFT JOIN r ON r.order_id = o.order_id
"""

SELLER_SQL = """
WITH b AS (SELECT DISTINCT order_id, seller_id FROM stg_order_items)
SELECT b.seller_id, count(*), sum(f.order_value / nullif(f.seller_count, 0)),
       avg(f.late_delivery), avg(f.avg_review_score)
FROM b JOIN fct_orders f ON f.order_id = b.order_id GROUP BY b.seller_id
"""


@SETTINGS
@given(orders=ORDERS, items=ITEMS, reviews=REVIEWS)
def test_marts_and_quality_match_sql(spark, orders, items, reviews):
    o, it, r = _frames(spark, orders, items, reviews)
    pairs = M.order_seller_items(it)
    fct = M.fct_orders(o, M.order_rollup(pairs, r))
    con = _duck(stg_orders=o, stg_order_items=it, stg_reviews=r, fct_orders=fct)

    cols = ("order_id", "item_count", "order_value", "seller_count", "avg_review_score",
            "review_count", "late_delivery", "delivery_days")
    _same(fct.select(*cols).collect(), con.execute(FCT_SQL).fetchall())

    facts = M.order_seller_facts(pairs, fct)
    _same(M.fct_seller_performance(facts).collect(), con.execute(SELLER_SQL).fetchall())

    fused = Q.quality_counts(o, it, r, fct).first().asDict()
    expected = {name: con.execute(sql).fetchone()[0] for name, sql in check_sql().items()}
    assert fused == expected


FACTS = st.lists(
    st.tuples(
        st.sampled_from(["c1", "c2", "c3", "c9"]), TIMES,
        st.sampled_from([None, 0, 1]),
        st.one_of(st.none(), st.sampled_from([1.0, 1.5, 2.0, 3.0, 4.5, 5.0])),
        st.one_of(st.none(), st.integers(min_value=-2, max_value=40)),
        st.sampled_from([0.0, 10.5, 99.25]),
    ),
    max_size=12,
)
CUSTOMERS = st.lists(st.tuples(st.sampled_from(["c1", "c2", "c3", None]), st.sampled_from(["SP", "RJ", None])), max_size=5)


@SETTINGS
@given(facts=FACTS, customers=CUSTOMERS)
def test_analysis_frames_match_sql(spark, facts, customers):
    fct = spark.createDataFrame(
        facts,
        "customer_id string, order_purchase_timestamp timestamp_ntz, late_delivery int, "
        "avg_review_score double, delivery_days long, order_value double",
    )
    cust = spark.createDataFrame(customers, "customer_id string, customer_state string")
    con = _duck(fct_orders=fct, stg_customers=cust)

    _same(A.metrics(fct).collect(), con.execute("""
        SELECT count(*), count(*) FILTER (WHERE late_delivery IS NOT NULL), coalesce(sum(order_value), 0),
               avg(late_delivery), avg(avg_review_score), avg(delivery_days),
               min(order_purchase_timestamp), max(order_purchase_timestamp) FROM fct_orders""").fetchall())
    _same(A.monthly(fct).collect(), con.execute("""
        SELECT CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP), count(*),
               avg(late_delivery), avg(avg_review_score)
        FROM fct_orders WHERE late_delivery IS NOT NULL AND order_purchase_timestamp IS NOT NULL
        GROUP BY 1""").fetchall())
    _same(A.delivery_review(fct).collect(), con.execute("""
        SELECT late_delivery, count(*), avg(avg_review_score),
               avg(CASE WHEN avg_review_score <= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END),
               avg(delivery_days), avg(order_value)
        FROM fct_orders WHERE late_delivery IS NOT NULL AND avg_review_score IS NOT NULL
        GROUP BY 1""").fetchall())
    _same(A.states(fct, cust).collect(), con.execute("""
        SELECT c.customer_state, count(*), avg(f.late_delivery), avg(f.avg_review_score), avg(f.delivery_days)
        FROM fct_orders f JOIN stg_customers c ON c.customer_id = f.customer_id
        WHERE f.late_delivery IS NOT NULL GROUP BY 1""").fetchall())


RATES = st.lists(
    st.tuples(
        st.sampled_from(["s1", "s2", "s3", "s4", "s5"]),
        st.sampled_from([0, 1]),
        st.one_of(st.none(), st.sampled_from([1.0, 2.0, 3.5, 5.0])),
    ),
    max_size=14,
)


@SETTINGS
@given(rows=RATES, min_orders=st.integers(min_value=1, max_value=3))
def test_seller_summary_matches_sql(spark, rows, min_orders):
    facts = spark.createDataFrame(
        [("o", s, 0.0, 1, late, rev) for s, late, rev in rows],
        "order_id string, seller_id string, order_value double, seller_count long, "
        "late_delivery int, avg_review_score double",
    )
    con = _duck(facts=facts)
    base_sql = f"""
        SELECT seller_id, count(*) n, avg(late_delivery) rate, avg(avg_review_score) rev
        FROM facts WHERE late_delivery IS NOT NULL GROUP BY 1 HAVING count(*) >= {min_orders}"""
    base = A.seller_base(facts, min_orders)
    _same(base.collect(), con.execute(base_sql).fetchall())
    _same(A.seller_summary(base).collect(), con.execute(f"""
        SELECT count(*), min(rate), median(rate), quantile_cont(rate, 0.9), max(rate), corr(rate, rev)
        FROM ({base_sql})""").fetchall())
