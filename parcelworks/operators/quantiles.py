"""Exact, distributed quantiles of any double column (``quantile_cont``).

The built-in exact ``percentile`` merges every distinct value into one task's
buffer.  Here no task holds more than a bucket of distinct values or a table of
fixed size:

1. distinct values with multiplicities: ``groupBy(value).count()`` (shuffled,
   combined map-side, so a value shared by a third of all rows is one row per
   task);
2. a sketch of the distinct values gives ``splitters`` of about equal depth,
   whatever the range and however the values crowd together (equal-width
   buckets would put a crowd into one); values fall between them, per-bucket
   counts and their running total locate the bucket of every target rank;
3. with ``levels`` over 1 those buckets alone are split again, by sketches of
   their own; one level leaves about one in ``splitters`` of the distinct values
   to a ranking task, two one in its square (for over 10**10 of them);
4. the values at the ranks floor((n-1)p) and ceil((n-1)p) are picked out and
   interpolated, as SQL ``quantile_cont`` does.

Sketches only place the splitters; counts and ranks are exact.  Everything
stays a lazy DataFrame without a cross join; the result is one row with one
column per requested quantile (NULL when the input has no non-NULL value).  NaN
counts as greater than any other value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITTERS = 1024
_TARGET = ("name", "which", "frac")


def _marks(splitters: int) -> Column:
    """Aggregate: about equally deep splitters of v, ascending."""
    # one literal instead of thousands
    places = F.split(F.lit(",".join(str(k / splitters) for k in range(1, splitters))), ",").cast("array<double>")
    return F.percentile_approx("v", places, 4 * splitters)


def _below(marks: Column, splitters: int) -> Column:
    """How many marks are below v, by halving the step."""
    steps = [1 << k for k in range(splitters.bit_length() - 1, -1, -1)]

    def halved(low, step):
        at = low + step
        return F.when((at <= F.size(marks)) & (F.get(marks, at - 1) < F.col("v")), at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), halved)


def _placed(values: DataFrame, splitters: int) -> DataFrame:
    """``values`` (v, c) with the bucket g that v falls into."""
    marks = values.agg(_marks(splitters)).scalar()  # at most ``splitters`` numbers
    marked = values.select("v", "c", marks.alias("marks"))
    return marked.select("v", "c", _below(F.col("marks"), splitters).cast("long").alias("g"))


def _refined(values: DataFrame, targets: DataFrame, splitters: int) -> tuple[DataFrame, DataFrame]:
    """Values (v, c, g) and targets (g, r, ...) one level deeper: each bucket split by a sketch of its own."""
    # at most ``splitters`` numbers for a bucket, and a bucket for a target
    marks = F.broadcast(values.groupBy("g").agg(_marks(splitters).alias("marks")))
    split = values.join(marks, "g").select("g", "v", "c", _below(F.col("marks"), splitters).alias("b"))
    counts = split.groupBy("g", "b").agg(F.sum("c").alias("bc"))
    earlier = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("bc").over(earlier), F.lit(0)))
    found = counts.join(targets, "g").where((F.col("before") <= F.col("r")) & (F.col("r") < F.col("before") + F.col("bc")))
    deeper = (F.col("g") * splitters + F.col("b")).alias("deeper")
    wanted = F.broadcast(found.select("g", "b", deeper).distinct())
    inside = split.join(wanted, ["g", "b"]).select(F.col("deeper").alias("g"), "v", "c")
    return inside, found.select(deeper.alias("g"), (F.col("r") - F.col("before")).alias("r"), *_TARGET)


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Mapping[str, float], splitters: int = SPLITTERS, levels: int = 1
) -> DataFrame:
    """One row: ``{name: quantile_cont(column, p)}`` for each name -> p."""
    values = (
        df.select(F.col(column).cast("double").alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    values = _placed(values, splitters)

    # 0-based target ranks: floor and ceil of (n - 1) * p
    ranks = []
    for name, p in probabilities.items():
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        for which, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            ranks.append(
                F.struct(F.lit(name).alias("name"), F.lit(which).alias("which"), rank.cast("long").alias("rank"), (h - F.floor(h)).alias("frac"))
            )
    earlier = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = values.groupBy("g").agg(F.sum("c").alias("bc"))  # at most ``splitters`` rows
    per_bucket = per_bucket.select(
        "g", "bc", F.coalesce(F.sum("bc").over(earlier), F.lit(0)).alias("before"), F.sum("bc").over(Window.partitionBy()).alias("n")
    )
    found = per_bucket.select("g", "bc", "before", F.inline(F.array(*ranks)))
    found = found.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("bc")))
    targets = found.select("g", (F.col("rank") - F.col("before")).alias("r"), *_TARGET)
    for _ in range(levels - 1):
        values, targets = _refined(values, targets, splitters)

    # the ranked values are those of the targets' buckets
    smaller = Window.partitionBy("g", "name", "which").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.join(F.broadcast(targets), "g").withColumn("start", F.coalesce(F.sum("c").over(smaller), F.lit(0)))
    picked = ranked.where((F.col("start") <= F.col("r")) & (F.col("r") < F.col("start") + F.col("c")))

    out = []
    for name in probabilities:
        def pick(which: str, field: str = "v", name: str = name):
            return F.max(F.when((F.col("name") == name) & (F.col("which") == which), F.col(field)))

        low, high, frac = pick("lo"), pick("hi"), pick("lo", "frac")
        # equal ends need no step between them, which infinite ones could not take
        between = F.when((low == high) | (frac == 0), low).otherwise(low + (high - low) * frac)
        out.append(between.alias(name))
    return picked.agg(*out)
