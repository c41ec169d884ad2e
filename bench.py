"""Benchmark: the warehouse's jobs end to end on the star-schema test tables.

Phases (each timed; the headline is the wall time of the whole run, so it
also holds what lies between the phases):

* build       raw adapter -> 7 staging tables -> 4 mart tables, all written
* quality_and_analysis_inputs
              the fused nine-check runner (one shuffle), concurrently with
              the analyses' shared inputs (order cube, states, seller base)
* a1..a6      each analysis frame derived from those inputs
* report      the report datasets (analysis + R1-R11) written as JSON
* snapshot_fingerprints  SHA-256 of the input files (J4), timed but not
              part of the headline value

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_OUT_DIR (scratch folder for the warehouse; default: the
session's checkpoint folder if set, else a new temp folder).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelworks.operators import report as R  # noqa: E402
from parcelworks.plans import jobs  # noqa: E402
from parcelworks.session import checkpoint_dir, local_session  # noqa: E402
from parcelworks.sources.manifest import file_fingerprints  # noqa: E402
from parcelworks.sources.starschema import STAR_TABLES, raw_tables_from_star  # noqa: E402

# Report thresholds used on the test tables (see FIXTURES.md section 3).
MONTH_MIN, STATE_MIN, SELLER_MIN = 50, 160, 150


def _scratch(spark) -> str:
    """BENCH_OUT_DIR, else a fresh folder under the session's checkpoint
    folder (the cluster's shared one, or the private one a local session
    creates), else a new temp folder."""
    root = os.environ.get("BENCH_OUT_DIR") or checkpoint_dir(spark)
    if root:
        return root.rstrip("/") + f"/bench-{uuid.uuid4().hex[:8]}"
    return tempfile.mkdtemp(prefix="parcelworks-bench-")


def _scale_factor(sf_dir: str):
    name = os.path.basename(sf_dir)
    try:
        return float(name[2:]) if name.startswith("sf") else name
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus * 2, app="parcelworks-bench")
    out = _scratch(spark)
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        result = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return result

    t_start = time.perf_counter()
    wh = timed(
        "build",
        lambda: jobs.build_warehouse(spark, out + "/warehouse", raw=raw_tables_from_star(spark, sf_dir)),
    )
    analysis = jobs.analysis_of(wh, SELLER_MIN)
    results, _ = timed(
        "quality_and_analysis_inputs",
        lambda: jobs.run_concurrently(lambda: jobs.quality_of(wh), analysis.materialize),
    )
    frames = analysis.frames()
    for key, name in zip(("a1", "a2", "a3", "a4", "a5", "a6"), frames):
        timed(f"{key}_{name}", frames[name].collect)
    report = R.build_report_frames(analysis, MONTH_MIN, STATE_MIN, SELLER_MIN)
    timed("report_write", lambda: jobs.write_report_data(analysis, report, out + "/report"))
    analysis.release()
    total = round(time.perf_counter() - t_start, 3)

    # J4 (input fingerprints) over the same input files; reported separately.
    files = {name: f"{sf_dir}/{name}.parquet" for name in STAR_TABLES}
    timed("snapshot_fingerprints", lambda: file_fingerprints(spark, files).collect())

    failed = [r.name for r in results if not r.passed]
    print(json.dumps({
        "metric": "end_to_end_build_quality_analysis_report",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": _scale_factor(sf_dir),
        "rows": {
            "fct_orders": wh.fct_orders.count(),
            "order_seller_facts": wh.order_seller_facts.count(),
        },
        "failed_checks": failed,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
