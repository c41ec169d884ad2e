"""Quality checks: clean input passes; each dirty row trips its check."""

import pytest
from pyspark.sql import functions as F

from parcelworks.operators import quality as Q
from parcelworks.operators.marts import build_marts
from parcelworks.operators.staging import stage_all
from parcelworks.session import configure
from parcelworks.sources.csv import read_raw_tables


def _add(spark, raw, table, *records):
    extra = spark.createDataFrame(list(records), raw[table].schema)
    out = dict(raw)
    out[table] = raw[table].unionByName(extra)
    return out


def _dirty_raw(spark, clean_dir):
    raw = read_raw_tables(spark, clean_dir)
    raw = _add(
        spark, raw, "orders",
        # duplicate order id (Q1, Q7)
        ("a2", "k2", "delivered", "2019-03-02 22:00:00", None, None, None, None),
        # unknown status; NULL status passes
        ("b1", "k1", "lost", "2019-05-01 10:00:00", None, None, None, None),
        ("b2", "k1", None, "2019-05-01 10:00:00", None, None, None, None),
        # delivered before purchase (Q6)
        ("b3", "k2", " DELIVERED ", "2019-05-03 10:00:00", None, None, "2019-05-02 10:00:00", "2019-05-09 10:00:00"),
    )
    raw = _add(
        spark, raw, "order_items",
        ("zz", "1", "pr1", "v1", None, "1.0", "1.0"),      # unknown order (Q2)
        (None, "1", "pr1", "v1", None, "1.0", "1.0"),      # NULL order id (Q2)
        ("b1", "1", "pr1", "v1", None, "-1", "0"),         # negative price (Q4)
        ("b2", "1", "pr1", "v1", None, "1", "-1"),         # negative freight (Q4)
    )
    raw = _add(
        spark, raw, "reviews",
        ("w9", "zz", "3", None, None, None, None),         # orphan review (Q3)
        ("w10", "b1", "0", None, None, None, None),        # score 0 (Q8)
        ("w11", "b1", "6", None, None, None, None),        # score 6 (Q8)
        ("w12", "b2", None, None, None, None, None),       # NULL score passes
    )
    return raw


EXPECTED_DIRTY = {
    "duplicate_order_ids": 1,
    "orphan_order_items": 2,
    "orphan_reviews": 1,
    "negative_item_amounts": 2,
    "invalid_order_status": 1,
    "delivery_before_purchase": 1,
    "duplicate_fct_orders": 1,
    "invalid_review_score": 2,
    "invalid_late_delivery_eligibility": 0,
}


def test_clean_fixture_passes_nine_checks(built):
    from parcelworks.plans.jobs import quality_of

    results = quality_of(built)
    assert [r.name for r in results] == list(Q.CHECK_NAMES)
    assert len(results) == 9
    assert all(r.passed for r in results), results
    Q.assert_quality(results)


@pytest.fixture(scope="module")
def dirty(spark, clean_dir):
    stg = stage_all(_dirty_raw(spark, clean_dir))
    marts = build_marts(stg)
    return stg, marts["fct_orders"]


def test_fused_runner_counts_each_dirty_row(dirty):
    stg, fct = dirty
    counts = Q.quality_counts(stg["orders"], stg["order_items"], stg["reviews"], fct).first().asDict()
    assert counts == EXPECTED_DIRTY


def test_standalone_checks_agree_with_runner(dirty):
    stg, fct = dirty
    frames = Q.check_frames(stg["orders"], stg["order_items"], stg["reviews"], fct)
    got = {name: df.first().failures for name, df in frames.items()}
    assert got == EXPECTED_DIRTY


def test_eligibility_check_on_hand_made_mart(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    t = dt.datetime(2019, 1, 1)
    fct = spark.createDataFrame(
        [("m1", t, None, 1), ("m2", t, t, None), ("m3", t, t, 0), ("m4", None, None, None)],
        "order_id string, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz, late_delivery int",
    )
    pred = Q.invalid_eligibility(
        F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"), F.col("late_delivery")
    )
    assert fct.where(pred).count() == 2


def test_gate_lists_every_failure(dirty):
    stg, fct = dirty
    results = Q.run_quality_checks(stg["orders"], stg["order_items"], stg["reviews"], fct)
    with pytest.raises(Q.QualityGateError) as err:
        Q.assert_quality(results)
    msg = str(err.value)
    assert msg.startswith("Data quality checks failed: duplicate_order_ids=1; orphan_order_items=2")
    assert "invalid_late_delivery_eligibility" not in msg


def test_quality_job_writes_report_before_gate(spark, clean_dir, tmp_path):
    from parcelworks.plans.jobs import run_quality

    raw = _dirty_raw(spark, clean_dir)
    report = str(tmp_path / "quality")
    printed = []
    with pytest.raises(Q.QualityGateError):
        run_quality(spark, str(tmp_path / "wh"), report, raw=raw, echo=printed.append)
    written = spark.read.json(report)
    assert written.count() == 9
    assert {r.name: r.failures for r in written.collect()} == EXPECTED_DIRTY
    assert printed[0] == "check 1 of 9, duplicate_order_ids: 1 failing"


def test_a_small_shuffle_is_spread_over_the_cores(spark):
    own = spark.newSession()
    configure(own)
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    own.conf.set("spark.sql.shuffle.partitions", "32")
    keys = own.range(2_000_000).selectExpr("md5(cast(id as string)) AS order_id").groupBy("order_id").count()
    used = keys.select(F.spark_partition_id().alias("task")).distinct().count()
    assert used >= min(4, own.sparkContext.defaultParallelism)
