"""Report operators (R1-R11), display formats and the batch jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelworks.functions import display as D
from parcelworks.operators import analysis as A
from parcelworks.operators import report as R
from tests.conftest import rows


@pytest.fixture(scope="module")
def frames(built):
    analysis = A.collect_analysis(built.fct_orders, built.stg["customers"], built.order_seller_facts, 1)
    yield analysis, R.build_report_frames(analysis, 1, 1, 1)
    analysis.release()


def test_review_gap_and_series(frames):
    _, rep = frames
    g = rep.review_gap.first()
    assert (g.review_gap, g.low_review_gap) == (3.5, 1.0)
    assert "a 3.500-point gap. The 1-2 star review rate was 100.0 percentage points higher" in g.finding
    assert rows(rep.review_series) == [(0, "On time", 4.5), (1, "Late", 1.0)]


def test_review_series_zero_fill_and_empty(spark):
    one_group = spark.createDataFrame(
        [(1, 2.0, 1.0)], "late_delivery int, average_review_score double, low_review_rate double"
    )
    assert rows(R.review_series(one_group)) == [(0, "On time", 0.0), (1, "Late", 2.0)]
    g = R.review_gap(one_group).first()
    assert g.review_gap is None and g.low_review_gap is None
    assert "cannot be compared" in g.finding
    assert R.review_series(one_group.limit(0)).count() == 0


def test_peak_month_and_series(frames):
    _, rep = frames
    p = rep.peak_month.first()
    assert (p.stable_months, p.peak_month, p.peak_month_label) == (1, dt.datetime(2019, 3, 1), "March 2019")
    assert p.finding == (
        "March 2019 had the highest late-delivery rate among months with at least "
        "1 eligible orders: 50.0% across 2 orders."
    )
    assert rows(rep.monthly_series, "month_label", "late_delivery_rate") == [("2019-03", 0.5)]


def test_no_stable_month(built):
    p = R.peak_month(A.monthly(built.fct_orders), 1000).first()
    assert p.stable_months == 0 and p.peak_month is None
    assert p.finding == "No month met the minimum volume threshold."


def test_state_spread_table_series(frames):
    _, rep = frames
    s = rep.state_spread.first()
    assert (s.highest_state, s.lowest_state, s.late_rate_spread) == ("RS", "PR", 1.0)
    assert s.finding.endswith("RS had a 100.0% late rate versus 0.0% in PR, a descriptive gap of 100.0%.")
    assert rows(rep.state_table, "position", "customer_state", "eligible_orders_display",
                "late_delivery_rate_display", "average_review_display") == [
        (1, "PR", "1", "0.0%", "4.500"), (2, "RS", "1", "100.0%", "1.000")
    ]
    assert rows(rep.state_series, "position", "customer_state") == [(1, "PR"), (2, "RS")]


def test_state_ties_broken_by_name(spark):
    states = spark.createDataFrame(
        [("B", 10, 0.5, 4.0, 2.0), ("A", 10, 0.5, 4.0, 2.0), ("C", 5, 0.1, 4.0, 2.0)],
        "customer_state string, eligible_orders long, late_delivery_rate double, "
        "average_review_score double, average_delivery_days double",
    )
    s = R.state_spread(states, 1).first()
    assert (s.highest_state, s.lowest_state) == ("A", "C")
    assert [r.customer_state for r in R.state_table(states, 1, 2).orderBy("position").collect()] == ["A", "B"]
    # ascending display of the top-2 by rate: ties keep the later name
    assert [r.customer_state for r in R.state_series(states, 1, 2).orderBy("position").collect()] == ["A", "B"]


def test_watchlist_metric_list_coverage(frames):
    _, rep = frames
    assert rows(rep.watchlist, "position", "seller_id_display", "late_delivery_rate_display") == [
        (1, "v2...", "100.0%"), (2, "v1...", "50.0%")
    ]
    metrics = {r.metric: (r.position, r.label, r.display) for r in rep.metric_list.collect()}
    assert metrics["orders"] == (1, "Orders in warehouse", "4")
    assert metrics["gross_item_freight_value"][2] == "382.00"
    assert metrics["late_delivery_rate"][2] == "50.0%"
    assert metrics["average_review_score"][2] == "2.833"
    assert rep.coverage.first().coverage == "2019-03-01 to 2019-04-04"


def test_seller_finding(frames, built):
    _, rep = frames
    f = rep.seller_finding.first()
    assert f.has_distribution
    assert f.finding == (
        "Across 2 sellers with at least 1 eligible orders, the median late rate was 75.0%, "
        "the 90th percentile was 95.0%, and the seller-level late-rate/review correlation was -1.000."
    )
    small = R.seller_finding(A.seller_summary(A.seller_base(built.order_seller_facts)), 100).first()
    assert not small.has_distribution
    assert small.finding == "The fixture is too small for a seller distribution."


@pytest.mark.parametrize(
    "fn,value,expected",
    [
        (D.thousands, 1234567, "1,234,567"),
        (D.money, 15843553.245, "15,843,553.24"),
        (lambda c: D.percent(c, 1), 0.0811, "8.1%"),
        (lambda c: D.percent(c, 1), 0.12345, "12.3%"),
        (lambda c: D.fixed(c, 3), 4.0867, "4.087"),
        (lambda c: D.fixed(c, 3), 12345.6789, "12345.679"),
        (lambda c: D.fixed(c, 2), 0.125, "0.12"),
    ],
)
def test_display_formats_match_python(spark, fn, value, expected):
    got = spark.createDataFrame([(float(value),)], "v double").select(fn(F.col("v")).alias("s")).first().s
    assert got == expected


def test_display_not_available(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "v double")
    got = [r.s for r in df.select(D.or_not_available(D.fixed("v", 3), "v").alias("s")).collect()]
    assert got == ["not available", "not available", "1.000"]


def test_report_job_writes_datasets(spark, clean_dir, tmp_path):
    from parcelworks.plans.jobs import run_report

    out = run_report(spark, str(tmp_path / "wh"), str(tmp_path / "site"), data_dir=clean_dir,
                     month_min_orders=1, state_min_orders=1, seller_min_orders=1)
    assert len(out) == 6 + 12  # six analyses, eleven report frames and the header
    metric_list = spark.read.json(out["report_metric_list"])
    assert "Orders eligible for late-delivery rate" in {r.label for r in metric_list.collect()}
    assert spark.read.json(out["report_state_table"]).count() == 2
    assert spark.read.json(out["analysis_metrics"]).first().orders == 4


def test_report_job_gates_before_output(spark, clean_dir, tmp_path):
    from parcelworks.operators.quality import QualityGateError
    from parcelworks.plans.jobs import run_report
    from parcelworks.sources.csv import read_raw_tables

    raw = read_raw_tables(spark, clean_dir)
    raw["orders"] = raw["orders"].unionByName(raw["orders"])
    site = tmp_path / "site"
    with pytest.raises(QualityGateError, match="duplicate_order_ids=4"):
        run_report(spark, str(tmp_path / "wh"), str(site), raw=raw)
    assert not site.exists()


def test_reopen_reads_stored_tables(spark, built, tmp_path):
    from parcelworks.plans.jobs import open_warehouse

    root = built.fct_orders.inputFiles()[0].rsplit("/versions/", 1)[0]
    again = open_warehouse(spark, root)
    assert again.fct_orders.count() == 4
    assert again.fct_seller_performance.count() == 3


def test_reader_keeps_its_tables_during_and_after_a_rebuild(spark, clean_dir, tmp_path):
    from parcelworks.plans import jobs, versions
    from parcelworks.sources.csv import read_raw_tables

    out = str(tmp_path / "wh")
    with pytest.raises(FileNotFoundError):
        jobs.open_warehouse(spark, out)
    jobs.build_warehouse(spark, out, data_dir=clean_dir)
    old = jobs.open_warehouse(spark, out)
    raw = read_raw_tables(spark, clean_dir)
    raw["orders"] = raw["orders"].unionByName(raw["orders"].withColumn("order_id", F.concat("order_id", F.lit("-2"))))
    build = jobs.start_build(spark, out, raw=raw)
    build.finish("fct_orders")
    assert build.read("fct_orders").count() == 8
    # the new facts are stored, the build is not finished: readers still get the old tables, all of them
    assert jobs.open_warehouse(spark, out).fct_orders.count() == 4
    jobs.finish_build(build, out)
    assert jobs.open_warehouse(spark, out).fct_orders.count() == 8
    assert old.fct_orders.count() == 4 and old.fct_seller_performance.count() == 3
    assert [r["number"] for r in versions.commits(spark, out).orderBy("number").collect()] == [1, 2]
    gone = versions.retire_versions(spark, out, keep=1)
    assert len(gone) == 1 and versions.retire_versions(spark, out, keep=1) == []
    assert jobs.open_warehouse(spark, out).fct_orders.count() == 8


def test_build_that_fails_midway_changes_nothing(spark, clean_dir, tmp_path):
    from parcelworks.plans import jobs, versions
    from parcelworks.sources.csv import read_raw_tables

    out = str(tmp_path / "wh")
    jobs.build_warehouse(spark, out, data_dir=clean_dir)
    raw = read_raw_tables(spark, clean_dir)
    raw["reviews"] = raw["reviews"].withColumn("review_score", F.lit("five"))  # a strict integer: staging stops
    with pytest.raises(Exception, match="review_score"):
        jobs.build_warehouse(spark, out, raw=raw)
    again = jobs.open_warehouse(spark, out)
    assert again.fct_orders.count() == 4 and again.stg["reviews"].count() > 0
    assert versions.commits(spark, out).count() == 1


def test_tables_start_when_their_inputs_are_stored(spark, clean_dir, tmp_path):
    """The checks and the seller facts both begin after the order facts, without waiting for each other."""
    import threading

    from parcelworks.plans import jobs

    build = jobs.start_build(spark, str(tmp_path / "wh"), data_dir=clean_dir)
    both = threading.Barrier(2, timeout=120)
    one = build.then("one", jobs.QUALITY_INPUTS, lambda *tables: both.wait())
    two = build.then("two", ("order_seller_items", "fct_orders"), lambda *tables: both.wait())
    assert {one.result(), two.result()} == {0, 1}  # neither could pass alone
    jobs.finish_build(build, str(tmp_path / "wh"))
    build.close()
    stored = {name: end for name, (_, end) in build.times.items()}
    began = {name: begin for name, (begin, _) in build.times.items()}
    assert began["order_seller_items"] >= stored["stg_order_items"]
    assert began["fct_orders"] >= max(stored["order_rollup"], stored["stg_orders"])
    assert min(began["one"], began["order_seller_facts"]) >= stored["fct_orders"]


def test_shuffles_are_sized_for_each_build_and_table(spark, clean_dir, tmp_path):
    from parcelworks.plans import jobs
    from parcelworks.sources.csv import read_raw_tables

    raw = read_raw_tables(spark, clean_dir)
    numbers = []
    for copies in (1, 40):
        more = {name: df for name, df in raw.items()}
        more["order_items"] = raw["order_items"].withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
        build = jobs.start_build(spark, str(tmp_path / f"wh{copies}"), raw=more, partition_bytes=200)
        jobs.finish_build(build, str(tmp_path / f"wh{copies}"))
        build.close()
        numbers.append(build.partitions)
        assert build.rows["stg_order_items"] == copies * raw["order_items"].count()
    assert numbers[1]["order_seller_items"] > 10 * numbers[0]["order_seller_items"]
    assert numbers[0]["fct_orders"] != numbers[1]["order_seller_items"]
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(key, None) is None  # the caller's session stays as it is


def test_confirming_inputs(spark, clean_dir, tmp_path):
    import shutil

    from parcelworks.plans.jobs import run_confirm, run_snapshot

    raw = tmp_path / "raw"
    shutil.copytree(clean_dir, raw)
    for document in (False, True):
        kept = run_snapshot(spark, str(raw), str(tmp_path / f"kept{document}"), document=document)
        assert run_confirm(spark, str(raw), kept, str(tmp_path / "none")) == []
        assert spark.read.schema("status string").json(str(tmp_path / "none")).count() == 0
    orders, items = raw / "olist_orders_dataset.csv", raw / "olist_order_items_dataset.csv"
    orders.write_text(orders.read_text() + "\n")
    parts = items.read_text()
    items.unlink()
    items.mkdir()
    for n in (1, 2):
        (items / f"part-{n}.csv").write_text(parts)
    said = []
    found = run_confirm(spark, str(raw), kept, str(tmp_path / "out"), echo=said.append)
    assert sorted((r.status, r.filename) for r in found) == [
        ("added", "part-1.csv"), ("added", "part-2.csv"), ("changed", orders.name), ("missing", items.name)
    ]
    assert len(said) == 4 and spark.read.json(str(tmp_path / "out")).count() == 4


def test_changes_of_files_that_share_a_name(spark):
    from parcelworks.sources.manifest import manifest_changes

    files = "logical_table string, filename string, bytes long, sha256 string"
    before = spark.createDataFrame([("t", "p", 1, "a"), ("t", "p", 1, "a"), ("t", "p", 2, "b"), ("u", "p", 1, "a")], files)
    after = spark.createDataFrame([("t", "p", 1, "a"), ("t", "p", 3, "c"), ("t", "p", 4, "d"), ("t", "p", 5, "e"), ("u", "p", 1, "a")], files)
    found = manifest_changes(before, after).collect()
    assert sorted((r.logical_table, r.status) for r in found) == [
        ("t", "added"), ("t", "changed"), ("t", "changed"), ("t", "same"), ("u", "same")
    ]


def test_report_header(spark, clean_dir, tmp_path):
    from parcelworks.plans.jobs import run_report

    out = run_report(spark, str(tmp_path / "wh"), str(tmp_path / "site"), data_dir=clean_dir)
    head = spark.read.json(out["report_header"]).first()
    assert head.purchase_coverage == "2019-03-01 to 2019-04-04" and head.license == "CC-BY-NC-SA-4.0"
    assert head.dataset and head.source_url.startswith("https://") and head.generated_at.endswith(" UTC")


def test_missing_files_listed_together(spark, tmp_path):
    from parcelworks.sources.csv import required_files

    (tmp_path / "olist_orders_dataset.csv").write_text("order_id\n")
    with pytest.raises(FileNotFoundError) as err:
        required_files(spark, str(tmp_path))
    assert str(err.value).count("olist_") == 6


def test_command_line_jobs(spark, clean_dir, tmp_path):
    from parcelworks.__main__ import main

    raw, wh = f"raw={clean_dir}", str(tmp_path / "wh")
    assert main(["build", raw, f"warehouse={wh}"], spark) == wh
    out = main(["quality", raw, f"warehouse={wh}", f"out={tmp_path / 'q'}"], spark)
    assert spark.read.json(out).where("passed").count() == 9
    site = main(["report", raw, f"warehouse={wh}", f"out={tmp_path / 's'}"], spark)
    assert spark.read.json(site + "/report_metric_list").count() == 6
    snap = main(["snapshot", raw, f"out={tmp_path / 'm'}"], spark)
    assert spark.read.json(snap).count() == 7
    with pytest.raises(SystemExit):
        main(["build", raw], spark)


def test_display_formats_equal_python_on_many_values(spark):
    """format_number-based display strings equal Python's format() on a
    batch of random and tie-prone doubles (one Spark job)."""
    import random

    rng = random.Random(11)
    values = (
        [rng.uniform(-1e6, 1e6) for _ in range(500)]
        + [rng.random() for _ in range(500)]
        + [k / 1000 for k in range(0, 1000, 7)]
        + [k / 8 for k in range(-40, 40)]
        + [0.0125, 0.0015, 2.675, 1.005, 0.125, 0.375, 1e-9]
    )
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = df.select(
        "v",
        D.fixed("v", 3).alias("f3"),
        D.fixed("v", 2).alias("f2"),
        D.percent("v").alias("pct"),
        D.money("v").alias("money"),
        D.thousands("v").alias("int"),
    ).collect()
    for r in got:
        v = r.v
        assert (r.f3, r.f2, r.pct, r.money, r.int) == (
            f"{v:.3f}", f"{v:.2f}", f"{v:.1%}", f"{v:,.2f}", f"{int(v):,}"
        ), v


def test_stored_tables_queryable_with_sql(spark, built):
    built.register_views()
    row = spark.sql(
        "SELECT count(*) AS n, sum(late_delivery) AS late FROM fct_orders WHERE late_delivery IS NOT NULL"
    ).first()
    assert (row.n, row.late) == (2, 1)
    assert spark.sql("SELECT count(*) AS n FROM stg_customers").first().n == 3
