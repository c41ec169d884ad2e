"""Helpers shared by the training-data operators: tables, stored intermediates, ASCII folding.

Intermediate tables are written as Parquet under the shared folder that the
session names in ``spark.checkpoint.dir``; each call takes a new sub-folder, so
a lost executor re-reads files instead of recomputing a long lineage.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows and bytes per Arrow batch: whichever is reached first bounds a Python worker's memory.
ARROW_ROWS = "500"
ARROW_BYTES = str(32 << 20)


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Session settings that bound Python memory, and this package for the executors' Python.

    Shuffle and adaptive settings stay the user's.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only for a local session without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, hashes: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    ``hashes`` names columns whose values hardly repeat: no dictionary is tried for them.
    The shuffle files behind it are garbage then; a collection lets Spark's
    cleaner delete them now instead of at the driver's next full collection.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**{f"parquet.enable.dictionary#{column}": "false" for column in hashes}).parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def own_columns(df: DataFrame, *needed: str) -> DataFrame:
    """Only the operator's input columns, so extra columns of the caller can never clash."""
    return df.select(*[F.col(f"`{c}`") for c in needed])


def numbered(docs: DataFrame) -> tuple[list, dict[str, str]]:
    """(every column of ``docs`` under a numbered name, caller's name -> numbered name): no name of a caller can clash."""
    names = {name: f"_c{k}" for k, name in enumerate(docs.columns)}
    return [F.col(f"`{name}`").alias(own) for name, own in names.items()], names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the caller's columns, under their own names."""
    return df.select(*[F.col(own).alias(name) for name, own in names.items()])
