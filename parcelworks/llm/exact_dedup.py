"""Exact dedup by a tree merge of digest runs (DataFrame functions only).

Every scan partition is a *run* of digests.  Runs are merged in rounds of
``FAN_IN``: in round r, the r-th digit of a run's number is exchanged for the
r-th digit of the digest, so each merged run keeps 1/FAN_IN of the digest
space and no task ever holds all digests.  At each level the runs that meet
are merged by a grouped aggregate (combined map-side) that retains one
identifier per text.  A text is identified by SHA-256, verified at every level
by its byte length and an independent 64-bit hash, which are part of the key.

The winners then flow back down: first to one row per (run, text), then to the
rows.  A text that a third of all rows share has at most one row per run in
the first join, and a run's own rows in the second.

Defined results: null text counts as empty; texts are equal when identical
after lower-casing A-Z; a null doc_id ranks below every other; of rows with
equal doc_id and equal text exactly one is kept; an empty table gives no rows;
extra columns are ignored by ``mark`` and carried by ``drop_duplicates``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, numbered, own_columns, restored, stored

FAN_IN = 16
_BITS = 4  # log2(FAN_IN)
_KEY = ["digest", "n_bytes", "guard"]


def _text_key(text: Column) -> list[Column]:
    norm = ascii_lower(text)
    return [
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.octet_length(norm).alias("n_bytes"),
        F.xxhash64(norm).alias("guard"),
    ]


def _digit(number: Column, place: int) -> Column:
    return F.shiftrightunsigned(number, _BITS * place).bitwiseAND(F.lit(FAN_IN - 1).cast("long"))


def _exchange(run: Column, place: int) -> Column:
    """The run number with its digit at ``place`` replaced by the digest's digit."""
    change = _digit(F.col("guard"), place) - _digit(run, place)
    return run + change * F.lit(1 << (_BITS * place)).cast("long")


def mark(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(
        own_columns(docs, "doc_id", "text").select(
            "doc_id",
            F.monotonically_increasing_id().alias("rid"),
            F.spark_partition_id().cast("long").alias("run"),
            *_text_key(F.col("text")),
        ),
        "digests",
    )
    if keep == "largest":
        rank, pick = F.struct("doc_id", "rid"), F.max  # nulls are smallest in a struct
    else:
        rank, pick = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"), F.min

    leaves = stored(
        rows.groupBy("run", *_KEY).agg(pick(rank).alias("best"), F.count("*").alias("n")), "runs"
    )
    runs = (leaves.agg(F.max("run")).first()[0] or 0) + 1
    level = leaves
    for place in range(max(1, math.ceil(math.log(runs, FAN_IN)))):
        level = (
            level.withColumn("run", _exchange(F.col("run"), place))
            .groupBy("run", *_KEY)
            .agg(pick("best").alias("best"), F.sum("n").alias("n"))
        )
    winners = stored(level.select(*_KEY, "best", "n"), "winners")
    down = stored(leaves.select("run", *_KEY).join(winners, _KEY), "down")
    return rows.join(down, ["run", *_KEY]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """``docs`` with one row left of each group of equal texts; all columns stay.

    Rows are found again by (doc_id, digest); where a winner is itself repeated
    (same doc_id and text), one of the repeated rows is taken.
    """
    winners = (
        mark(docs, keep)
        .groupBy("doc_id", "text_sha256")
        .agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        .where("kept")
    )
    winners = stored(winners.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), "n"), "kept")
    columns, names = numbered(docs)
    hashed = docs.select(*columns, F.sha2(ascii_lower(F.col("text")), 256).alias("text_sha"))
    found = hashed.join(winners, F.col(names["doc_id"]).eqNullSafe(F.col("id")) & (F.col("text_sha") == F.col("sha")))
    once = found.where("n = 1")
    repeated = found.where("n > 1").dropDuplicates(["id", "sha"])
    return restored(once, names).union(restored(repeated, names))


SQL = f"""
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY folded) AS keep_id,
       count(*) OVER (PARTITION BY folded) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY folded) AS kept,
       sha256(folded) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS folded
      FROM documents)
"""
