"""Run one batch job: ``spark-submit parcelworks/__main__.py JOB name=value ...``.

``JOBS`` lists each job with the settings it takes; the session comes from
spark-submit.  The job's output location is printed and returned.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from parcelworks.plans import jobs
from parcelworks.session import configure

JOBS = {
    "build": (("raw", "warehouse"), lambda s, raw, warehouse: jobs.build_warehouse(s, warehouse, data_dir=raw)),
    "quality": (("raw", "warehouse", "out"), lambda s, raw, warehouse, out: jobs.run_quality(s, warehouse, out, data_dir=raw)),
    "report": (("raw", "warehouse", "out"), lambda s, raw, warehouse, out: jobs.run_report(s, warehouse, out, data_dir=raw)),
    "snapshot": (("raw", "out"), lambda s, raw, out: jobs.run_snapshot(s, raw, out)),
    "confirm": (("raw", "manifest", "out"), lambda s, raw, manifest, out: jobs.run_confirm(s, raw, manifest, out)),
    "manifest": (("raw", "out"), lambda s, raw, out: jobs.run_snapshot(s, raw, out, document=True)),
}


def main(words: list[str], spark: SparkSession | None = None) -> str:
    job, *given = words or [""]
    settings = dict(word.split("=", 1) for word in given if "=" in word)
    names, run = JOBS.get(job, ((), None))
    if run is None or set(settings) != set(names) or len(given) != len(names):
        usage = [f"{name} " + " ".join(f"{n}=..." for n in needs) for name, (needs, _) in JOBS.items()]
        raise SystemExit("usage: " + " | ".join(usage))
    run(configure(spark or SparkSession.builder.appName(f"parcelworks-{job}").getOrCreate()), **settings)
    print(settings[names[-1]])
    return settings[names[-1]]


if __name__ == "__main__":
    main(sys.argv[1:])
