"""Hand-derived values for the clean fixture (tests/fixtures/clean)."""

import datetime as dt

import pytest

from parcelworks.operators import analysis as A
from parcelworks.sources.csv import read_raw_tables
from tests.conftest import rows


def test_raw_tables_are_text_and_keep_ragged_rows(spark, clean_dir):
    raw = read_raw_tables(spark, clean_dir)
    assert all(t == "string" for _, t in raw["orders"].dtypes)
    orders = {r.order_id: r for r in raw["orders"].collect()}
    # a3 / a4 carry 9 fields under an 8-column header: estimate is shifted out
    assert orders["a3"].order_estimated_delivery_date is None
    assert orders["a4"].order_estimated_delivery_date is None
    assert orders["a4"].order_delivered_carrier_date == "2019-04-05 10:00:00"
    # the quoted newline stays inside one review
    assert raw["reviews"].count() == 4


def test_staging_types_and_normalisation(built):
    stg = built.stg
    assert dict(stg["orders"].dtypes) == {
        "order_id": "string", "customer_id": "string", "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz", "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    }
    assert dict(stg["order_items"].dtypes)["order_item_id"] == "int"
    assert dict(stg["order_items"].dtypes)["price"] == "double"
    assert rows(stg["orders"], "order_id", "order_status") == [
        ("a1", "delivered"), ("a2", "delivered"), ("a3", "canceled"), ("a4", "shipped")
    ]
    assert rows(stg["customers"], "customer_id", "customer_city", "customer_state") == [
        ("k1", "porto alegre", "RS"), ("k2", "curitiba", "PR"), ("k3", "recife", "PE")
    ]
    assert rows(stg["products"], "product_id", "product_category_name") == [
        ("pr1", "garden"), ("pr2", None), ("pr3", "toys")
    ]
    assert rows(stg["payments"], "order_id", "payment_type")[1] == ("a2", "boleto")
    assert rows(stg["sellers"], "seller_id", "seller_state") == [("v1", "RS"), ("v2", "PR"), ("v3", "PE")]
    assert stg["reviews"].columns == [
        "review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"
    ]


def test_fct_orders(built):
    got = rows(
        built.fct_orders, "order_id", "item_count", "order_value", "seller_count",
        "avg_review_score", "review_count", "late_delivery", "delivery_days",
    )
    assert got == [
        ("a1", 2, 200.0, 2, 1.0, 1, 1, 7),
        ("a2", 1, 99.0, 1, 4.5, 2, 0, 3),
        ("a3", 1, 50.0, 1, 3.0, 1, None, None),
        ("a4", 1, 33.0, 1, None, 0, None, None),
    ]
    types = dict(built.fct_orders.dtypes)
    assert (types["late_delivery"], types["delivery_days"], types["item_count"]) == ("int", "bigint", "bigint")
    assert built.fct_orders.columns == list(__import__("parcelworks.operators.marts", fromlist=["x"]).FCT_ORDER_COLUMNS)


def test_seller_performance(built):
    assert rows(built.fct_seller_performance) == [
        ("v1", 2, 199.0, 0.5, 2.75),
        ("v2", 2, 133.0, 1.0, 1.0),
        ("v3", 1, 50.0, None, 3.0),
    ]


def test_bridge_is_distinct_pairs(built):
    assert rows(built.order_seller_items, "order_id", "seller_id") == [
        ("a1", "v1"), ("a1", "v2"), ("a2", "v1"), ("a3", "v3"), ("a4", "v2")
    ]


def test_metrics(built):
    m = A.metrics(built.fct_orders).first().asDict()
    assert m["orders"] == 4 and m["late_delivery_eligible_orders"] == 2
    assert m["gross_item_freight_value"] == 382.0
    assert m["late_delivery_rate"] == 0.5
    assert m["average_review_score"] == pytest.approx(8.5 / 3)
    assert m["average_delivery_days"] == 5.0
    assert m["purchase_start"] == dt.datetime(2019, 3, 1, 8)
    assert m["purchase_end"] == dt.datetime(2019, 4, 4, 12)


def test_monthly_delivery_review_states(built):
    assert rows(A.monthly(built.fct_orders)) == [(dt.datetime(2019, 3, 1), 2, 0.5, 2.75)]
    assert rows(A.delivery_review(built.fct_orders)) == [
        (0, 1, 4.5, 0.0, 3.0, 99.0),
        (1, 1, 1.0, 1.0, 7.0, 200.0),
    ]
    assert rows(A.states(built.fct_orders, built.stg["customers"])) == [
        ("PR", 1, 0.0, 4.5, 3.0),
        ("RS", 1, 1.0, 1.0, 7.0),
    ]


def test_seller_frames_empty_at_default_threshold(built):
    base = A.seller_base(built.order_seller_facts)
    summary = A.seller_summary(base).first().asDict()
    assert summary["eligible_sellers"] == 0
    assert all(v is None for k, v in summary.items() if k != "eligible_sellers")
    assert A.seller_watchlist(base).count() == 0


def test_seller_frames_with_low_threshold(built):
    base = A.seller_base(built.order_seller_facts, 1)
    assert rows(base) == [("v1", 2, 0.5, 2.75), ("v2", 1, 1.0, 1.0)]
    s = A.seller_summary(base).first()
    assert (s.eligible_sellers, s.min_late_delivery_rate, s.max_late_delivery_rate) == (2, 0.5, 1.0)
    assert s.median_late_delivery_rate == 0.75
    assert s.p90_late_delivery_rate == pytest.approx(0.95)
    assert s.late_review_correlation == pytest.approx(-1.0)
    assert [r.seller_id for r in A.seller_watchlist(base).collect()] == ["v2", "v1"]


def test_empty_input_metrics(spark, built):
    empty = built.fct_orders.limit(0)
    m = A.metrics(empty).first().asDict()
    assert m["orders"] == 0 and m["gross_item_freight_value"] == 0.0
    assert m["late_delivery_rate"] is None and m["purchase_start"] is None
