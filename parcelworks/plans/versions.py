"""Warehouse versions: all tables of a build become current at once, or none does.

Under a warehouse folder:

    versions/<id>/<table>/   the tables of one build; never written again
    commits/                 one JSON row per finished build (number, version)

A build writes a new version folder and, when all its tables are there, adds
one commit row; a reader takes the version of the highest commit.  So a reader
sees the tables of one finished build whatever runs beside it, and a build that
fails, or is cut off, changes nothing.  The commit row's file appears by the
rename with which Spark commits a write.  Old versions stay for their readers
until ``retire_versions``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelworks.sources.csv import names_in

COMMITS, VERSIONS = "commits", "versions"
_COMMIT_ROW = "number long, version string, finished timestamp"


def _under(out_dir: str, *names: str) -> str:
    return "/".join([out_dir.rstrip("/"), *names])


def new_version(out_dir: str) -> str:
    """The folder for one build's tables."""
    return _under(out_dir, VERSIONS, uuid.uuid4().hex)


def commits(spark: SparkSession, out_dir: str) -> DataFrame:
    """The finished builds: number (from 1), version, finished."""
    if COMMITS not in names_in(spark, out_dir):
        return spark.createDataFrame([], _COMMIT_ROW)
    return spark.read.schema(_COMMIT_ROW).json(_under(out_dir, COMMITS))


def _latest(spark: SparkSession, out_dir: str):
    return commits(spark, out_dir).orderBy(F.desc("number"), F.desc("version")).first()


def current_version(spark: SparkSession, out_dir: str) -> str:
    """The folder of the last finished build's tables."""
    latest = _latest(spark, out_dir)
    if latest is None:
        raise FileNotFoundError(f"{out_dir} holds no finished build")
    return _under(out_dir, VERSIONS, latest["version"])


def commit(spark: SparkSession, out_dir: str, folder: str) -> int:
    """Make a version folder current; returns the build's number.

    Builds that finish at the same moment may share a number; the greater
    version id is current then, for every reader."""
    latest = _latest(spark, out_dir)
    number = 1 + (latest["number"] if latest else 0)
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("number"), F.lit(folder.rpartition("/")[2]).alias("version"), F.current_timestamp().alias("finished")
    )
    row.coalesce(1).write.mode("append").json(_under(out_dir, COMMITS))
    return number


def retire_versions(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Delete the tables of finished builds before the last ``keep``; returns their ids.

    Folders without a commit may belong to a running build and stay."""
    if keep < 1:
        raise ValueError("the current version stays")
    rows = commits(spark, out_dir).orderBy(F.desc("number"), F.desc("version")).collect()
    there = names_in(spark, _under(out_dir, VERSIONS))
    retired = [r["version"] for r in rows[keep:] if r["version"] in there]
    context = spark.sparkContext
    for version in retired:
        place = context._jvm.org.apache.hadoop.fs.Path(_under(out_dir, VERSIONS, version))
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return retired
