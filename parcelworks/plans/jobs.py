"""The batch jobs, plus the warehouse's read/write layout.

Tables of one build (a version folder of ``plans.versions`` under the
warehouse folder, which must be shared on a cluster):

    stg_<table>/             7 staging tables (Parquet)
    order_seller_items/      (order_id, seller_id) rollup = the M4 bridge
    order_rollup/            items and reviews per order id (M1, M2)
    fct_orders/              one row per order
    order_seller_facts/      bridge joined once to the order facts
    fct_seller_performance/  one row per seller

Every table is written and read back, so the next one's lineage starts at
Parquet files: a lost executor re-runs one table, never the whole chain.  A
table is written as soon as its inputs are stored (``plans.build``); checks and
analyses that need only some tables start beside the rest.  The tables become
current together when the last is stored, before the quality gate, so a failed
gate leaves a finished build in place, a failed build the one before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from parcelworks.operators import analysis as A
from parcelworks.operators import marts as M
from parcelworks.operators import quality as Q
from parcelworks.operators import report as R
from parcelworks.operators.staging import stage_all
from parcelworks.plans.build import PARTITION_BYTES, Build
from parcelworks.plans.versions import commit, current_version, new_version
from parcelworks.session import configure
from parcelworks.sources.csv import read_raw_tables, register_raw_views
from parcelworks.sources.manifest import (
    build_snapshot_manifest,
    manifest_changes,
    read_manifest,
    snapshot_entries,
    write_snapshot_manifest,
)
from parcelworks.sources.schemas import LOGICAL_TABLES

STAGING = {name: f"stg_{name}" for name in LOGICAL_TABLES}
QUALITY_INPUTS = (STAGING["orders"], STAGING["order_items"], STAGING["reviews"], "fct_orders")
MARTS = ("order_seller_items", "fct_orders", "order_seller_facts", "fct_seller_performance")


def _path(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


@dataclass
class Warehouse:
    """Handles on the stored tables (SRC4); nothing is recomputed."""

    stg: dict[str, DataFrame]
    order_seller_items: DataFrame
    fct_orders: DataFrame
    order_seller_facts: DataFrame
    fct_seller_performance: DataFrame

    def register_views(self) -> None:
        for name, df in self.stg.items():
            df.createOrReplaceTempView(STAGING[name])
        for name in MARTS:
            getattr(self, name).createOrReplaceTempView(name)


def open_warehouse(spark: SparkSession, out_dir: str) -> Warehouse:
    """SRC4: the tables of the last finished build, read-only.

    They stay the same while later builds run or finish."""
    folder = current_version(spark, out_dir)
    return _handles(lambda name: spark.read.parquet(_path(folder, name)))


def _handles(read: Callable[[str], DataFrame]) -> Warehouse:
    return Warehouse(stg={name: read(table) for name, table in STAGING.items()}, **{name: read(name) for name in MARTS})


def run_concurrently(*steps: Callable[[], object]) -> list[object]:
    """Run independent driver-side steps (each submitting Spark jobs) at the
    same time; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        futures = [pool.submit(step) for step in steps]
        return [f.result() for f in futures]


def start_build(
    spark: SparkSession,
    out_dir: str,
    data_dir: str | None = None,
    raw: Mapping[str, DataFrame] | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> Build:
    """J1, running: raw -> staging -> marts.  ``finish_build`` makes the tables current.

    ``raw`` lets a caller supply the seven raw tables from another source
    (for example the star-schema adapter); otherwise CSVs under ``data_dir``
    are read."""
    configure(spark)
    if raw is None:
        if data_dir is None:
            raise ValueError("build_warehouse needs data_dir or raw tables")
        raw = read_raw_tables(spark, data_dir)
    register_raw_views(raw)
    build = Build(spark, new_version(out_dir), partition_bytes)
    for name, df in stage_all(raw).items():
        build.source(STAGING[name], df)
    build.table("order_seller_items", (STAGING["order_items"],), M.order_seller_items)
    build.table("order_rollup", ("order_seller_items", STAGING["reviews"]), M.order_rollup)
    # both sides stored: adaptive execution can split a hot id
    build.table("fct_orders", (STAGING["orders"], "order_rollup"), M.fct_orders)
    build.table("order_seller_facts", ("order_seller_items", "fct_orders"), M.order_seller_facts)
    build.table("fct_seller_performance", ("order_seller_facts",), M.fct_seller_performance)
    return build


def finish_build(build: Build, out_dir: str) -> Warehouse:
    """Wait for all tables and make them current together."""
    try:
        build.finish(*STAGING.values(), *MARTS)
    except BaseException:
        build.close()  # nothing goes on writing behind the caller's back
        raise
    commit(build.spark, out_dir, build.folder)
    return _handles(build.read)


def build_warehouse(
    spark: SparkSession,
    out_dir: str,
    data_dir: str | None = None,
    raw: Mapping[str, DataFrame] | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> Warehouse:
    """A finished build (see ``start_build``)."""
    build = start_build(spark, out_dir, data_dir, raw, partition_bytes)
    wh = finish_build(build, out_dir)
    build.close()
    return wh


def quality_of(wh: Warehouse) -> list[Row]:
    return Q.run_quality_checks(wh.stg["orders"], wh.stg["order_items"], wh.stg["reviews"], wh.fct_orders)


def write_quality_report(spark: SparkSession, results: list[Row], out_path: str) -> str:
    """SNK4: the nine result records as JSON lines in one file."""
    rows = [(r.name, r.passed, r.failures, r.detail) for r in results]
    spark.createDataFrame(rows, Q.RESULT_SCHEMA).coalesce(1).write.mode("overwrite").json(out_path)
    return out_path


def run_quality(
    spark: SparkSession,
    out_dir: str,
    report_path: str,
    data_dir: str | None = None,
    raw: Mapping[str, DataFrame] | None = None,
    echo: Callable[[str], None] = print,
) -> list[Row]:
    """Build, check beside the marts' writing, write the report, print a line
    per check, then gate (so the report exists even when the gate fails)."""
    build = start_build(spark, out_dir, data_dir, raw)
    checks = build.then("quality", QUALITY_INPUTS, Q.run_quality_checks)
    finish_build(build, out_dir)
    results = checks.result()
    build.close()
    write_quality_report(spark, results, report_path)
    for place, r in enumerate(results, 1):
        echo(f"check {place} of {len(results)}, {r.name}: " + ("no failing rows" if r.passed else f"{r.failures} failing"))
    Q.assert_quality(results)
    return results


def analysis_of(wh: Warehouse, seller_min_orders: int = A.SELLER_MIN_ORDERS) -> A.AnalysisFrames:
    return A.collect_analysis(
        wh.fct_orders, wh.stg["customers"], wh.order_seller_facts, seller_min_orders
    )


def write_report_data(
    analysis: A.AnalysisFrames, report: R.ReportFrames, output_dir: str
) -> dict[str, str]:
    """SNK6: one JSON dataset per analysis frame and report operator.

    Every frame is bounded (one row, months, states, top-k), so each is
    written as a single file."""
    frames = {f"analysis_{k}": v for k, v in analysis.frames().items()}
    frames.update({f"report_{k}": v for k, v in report.as_dict().items()})
    out = {}

    def sink(name: str, df: DataFrame) -> None:
        path = _path(output_dir, name)
        df.coalesce(1).write.mode("overwrite").json(path)
        out[name] = path

    run_concurrently(*[(lambda n=n, df=df: sink(n, df)) for n, df in frames.items()])
    return out


def run_report(
    spark: SparkSession,
    out_dir: str,
    output_dir: str,
    data_dir: str | None = None,
    raw: Mapping[str, DataFrame] | None = None,
    month_min_orders: int = A.MONTH_MIN_ORDERS,
    state_min_orders: int = A.STATE_MIN_ORDERS,
    seller_min_orders: int = A.SELLER_MIN_ORDERS,
) -> dict[str, str]:
    """Build, check, raise before any output on failure; then write the
    report datasets.  Writes no quality file.

    The checks, the order cube and the states start when the order facts are
    stored, the seller base when the seller facts are; the last three are
    cached (spilling to executor disk if large).  No report is written until
    the gate has passed."""
    build = start_build(spark, out_dir, data_dir, raw)
    checks = build.then("quality", QUALITY_INPUTS, Q.run_quality_checks)
    by_order = build.then("order_inputs", ("fct_orders", STAGING["customers"]), A.order_inputs, sized=False)
    by_seller = build.then("seller_inputs", ("order_seller_facts",), lambda facts: A.seller_inputs(facts, seller_min_orders), sized=False)
    try:
        finish_build(build, out_dir)
        build.close()
        Q.assert_quality(checks.result())
        analysis = A.frames_from(*by_order.result(), by_seller.result())
        report = R.build_report_frames(analysis, month_min_orders, state_min_orders, seller_min_orders)
        return write_report_data(analysis, report, output_dir)
    finally:
        for done in (by_order, by_seller):
            if done.done() and done.exception() is None:
                found = done.result()
                for df in found if isinstance(found, tuple) else (found,):
                    df.unpersist()


def run_snapshot(spark: SparkSession, data_dir: str, output: str, document: bool = False) -> str:
    """Manifest only, no build: one JSON line per input file (header
    fields, logical table, file name, bytes, SHA-256), written in parallel.

    ``document`` writes the one-document form instead (header fields and a
    ``files`` list), for layouts with a bounded number of files."""
    build = build_snapshot_manifest if document else snapshot_entries
    return write_snapshot_manifest(build(spark, data_dir), output)


def run_confirm(
    spark: SparkSession, data_dir: str, manifest: str, output: str, echo: Callable[[str], None] = print
) -> list[Row]:
    """Compare the input files with a stored manifest of either form.

    Writes one JSON line per file that is changed, missing or added, prints
    them, and returns them; none means that the inputs are the published ones."""
    found = manifest_changes(read_manifest(spark, manifest), snapshot_entries(spark, data_dir))
    differing = found.where("status <> 'same'").orderBy("logical_table", "filename").persist()
    differing.coalesce(1).write.mode("overwrite").json(output)
    rows = differing.collect()
    differing.unpersist()
    for r in rows:
        echo(f"{r.status}: {r.logical_table}/{r.filename}")
    return rows
