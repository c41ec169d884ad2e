"""SRC1 / SRC2: locate and read the seven raw CSV inputs.

A logical table may be one file (the snapshot layout) or a folder of part
files with the same header (the layout at scale); Spark reads both.  The
existence check goes through the path's own Hadoop filesystem, so it works
for HDFS and object stores as well as local disks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelworks.sources.schemas import (
    DATASET_FILES,
    LOGICAL_TABLES,
    MULTILINE_TABLES,
    OPTIONAL_COLUMNS,
    raw_schema,
)


def _join(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


def names_in(spark: SparkSession, folder: str) -> set[str]:
    """Entry names of a folder, through its own Hadoop filesystem."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {entry.getPath().getName() for entry in store.listStatus(place)} if store.exists(place) else set()


def required_files(spark: SparkSession, data_dir: str) -> dict[str, str]:
    """Where each logical table lies: one listing of the folder against the expected names.

    Raises once, naming every table that is not there."""
    there = names_in(spark, data_dir)
    absent = set(DATASET_FILES.values()) - there
    if absent:
        listed = sorted(absent, key=list(DATASET_FILES.values()).index)
        raise FileNotFoundError(f"Missing required dataset files: {', '.join(_join(data_dir, name) for name in listed)}")
    return dict(zip(DATASET_FILES, (_join(data_dir, name) for name in DATASET_FILES.values()), strict=True))


def read_raw_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One raw table as all-string columns, bound to the header by name.

    No type inference: every column is text (``inferSchema`` off).  Columns
    are matched by header name, so their order in the file does not matter,
    but all part files of a folder must have one header (another one raises);
    extra columns are dropped, optional free-text columns may be absent, and
    a missing column that staging needs is an error.  PERMISSIVE keeps short
    rows (padded with NULL) and over-long rows (extra fields dropped).  Only
    tables with free text read in multi-line mode, which makes each file one
    split."""
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)  # a part file with another header is an error
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", table in MULTILINE_TABLES)
        .csv(path)
    )
    present = {c.strip().lstrip("\ufeff"): c for c in df.columns}
    expected = raw_schema(table).fieldNames()
    missing = [c for c in expected if c not in present and c not in OPTIONAL_COLUMNS.get(table, ())]
    if missing:
        raise ValueError(f"{path}: missing column(s) {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f"`{present[c]}`") if c in present else F.lit(None)).cast("string").alias(c)
            for c in expected
        ]
    )


def read_raw_tables(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    files = required_files(spark, data_dir)
    return {name: read_raw_table(spark, name, files[name]) for name in LOGICAL_TABLES}


def register_raw_views(raw: Mapping[str, DataFrame]) -> None:
    """SNK1: expose raw tables as ``raw_<name>`` temp views."""
    for name, df in raw.items():
        df.createOrReplaceTempView(f"raw_{name}")
