"""Hard negatives by Fagin's threshold algorithm.

Every vector becomes integers (floor of ``SCALE`` times each component); a
row's score for an anchor is their integer inner product.  Higher scores come
first, ties by smaller id (null last).  An anchor's positives are its best
other rows of the same label; for each positive, the negatives are the best
rows of other labels whose score lies between two percentages of the
positive's.

Anchors meet the rows in cells: rows are dealt into groups, anchors into
shards, and a cell joins one group with one shard, so its memory is bounded and
no label or id decides its size.  Inside a cell every dimension has a list of
the group's rows sorted by their component.  For an anchor the lists are read
from their best end (the largest components where the anchor's is positive, the
smallest where it is negative), ever deeper, and every row met is scored in
full.  No unmet row can score above the threshold, which is the sum over the
lists of the anchor's component times the last one read.  Reading stops once
the threshold is strictly below the k-th score of every window, or below the
window itself; a row that only ties with the k-th could still win by its id.
The cells' best rows are merged by rank: first for the positives, whose scores
give the windows, then for the negatives.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; components beyond 2**27 after scaling count as
2**27; a shorter vector counts as padded with zeros; repeated ids are rows of
their own, and an anchor is only barred from itself; a null id is no anchor and
comes last among ties; an anchor without positives, or a window without rows,
gives no rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
FIRST_DEPTH = 32
_LIMIT = 1 << 27
_ANCHORS = 1 << 14  # of a shard
_LEAST_ROWS, _CELL_VALUES = 1 << 11, 1 << 23  # of a group

SQL = f"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS codes
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
           CAST(list_inner_product(a.codes, r.codes) AS BIGINT) AS score
    FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
), negatives AS (
    SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS place
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN {LOW} * positive_score AND {HIGH} * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= {NEGATIVES}
"""


class Lists:
    """The rows of a group, with one sorted list per dimension."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids  # ids: (rows, 2), no id and id
        columns = np.ascontiguousarray(codes.T)
        self.up = np.argsort(columns, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(columns, self.up, axis=1)
        self.down, self.falling = self.up[:, ::-1], self.values[:, ::-1]

    def top(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (least, greatest score), the first k allowed rows in it as (row, score)."""
        n = len(self.codes)
        plus, minus = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool)
        scores = np.zeros(n, self.codes.dtype)
        depth = 0
        open_windows = [w for w in windows if w[0] <= w[1]]
        while open_windows and depth < n:
            reach = min(n, max(FIRST_DEPTH, 2 * depth))
            if len(plus) + len(minus) == 0:
                reach = n  # every score is zero
                fresh = np.arange(n)
            else:
                before = met.copy()
                met[self.down[plus, depth:reach].ravel()] = True
                met[self.up[minus, depth:reach].ravel()] = True
                fresh = np.flatnonzero(met & ~before)
            met[fresh] = True
            scores[fresh] = self.codes[fresh] @ anchor
            threshold = self.falling[plus, reach - 1] @ anchor[plus] + self.values[minus, reach - 1] @ anchor[minus]
            depth = reach
            seen = scores[met & allowed]
            still = []
            for low, high in open_windows:
                inside = seen[(seen >= low) & (seen <= high)]
                full = len(inside) >= k and threshold < np.partition(inside, -k)[-k]
                if threshold >= low and not full:
                    still.append((low, high))
            open_windows = still
        found = []
        for low, high in windows:
            rows = np.flatnonzero(met & allowed & (scores >= low) & (scores <= high))
            if len(rows) > k:  # rows that tie with the k-th stay until their ids are compared
                rows = rows[scores[rows] >= np.partition(scores[rows], -k)[-k]]
            order = np.lexsort((self.ids[rows, 1], self.ids[rows, 0], -scores[rows]))[:k]
            found.append([(int(r), int(scores[r])) for r in rows[order]])
        return found


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    # products of doubles are exact below 2**53
    exact = np.abs(out).max(initial=0) ** 2 * max(width, 1) < 1 << 53
    return out.astype(np.float64) if exact else out


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _ids(table: pa.Table) -> np.ndarray:
    return np.column_stack([_column(table, "no_id"), _column(table, "id")])


def _answers(anchors: list, positions: list, found: list[tuple[int, int, int, int]]) -> pa.Table:
    rows, no_ids, ids, scores = zip(*found, strict=True) if found else ([], [], [], [])
    return pa.table(
        {
            "anchor": pa.array(anchors, pa.int64()),
            "position": pa.array(positions, pa.int32()),
            "row": pa.array(rows, pa.int64()),
            "no_id": pa.array(no_ids, pa.int32()),
            "id": pa.array(ids, pa.int64()),
            "score": pa.array(scores, pa.int64()),
        }
    )


_FOUND = "anchor long, position int, row long, no_id int, id long, score long"


def _cells(rows: DataFrame, anchors: DataFrame, size: int, n_anchors: int, width: int, find) -> DataFrame:
    """``find(rows, anchors)`` of every cell."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    group_rows = min(max(_CELL_VALUES // max(width, 1), 1), max(_LEAST_ROWS, -(-size // (2 * cores))))
    groups, shards = max(1, -(-size // group_rows)), max(1, -(-n_anchors // _ANCHORS))

    # a cell is much work for few bytes: a fixed number of tasks, not one chosen by bytes
    tasks = min(groups * shards, 20 * cores)

    def dealt(table: DataFrame, own: int, other: int, cell):
        own_number = F.pmod(F.xxhash64("row"), F.lit(own))
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("other")
        listed = table.select("*", own_number.alias("own"), every)
        return listed.select(*table.columns, cell(F.col("own"), F.col("other")).alias("cell")).repartition(tasks, "cell").groupBy("cell")

    left = dealt(rows, groups, shards, lambda group, shard: group * shards + shard)
    right = dealt(anchors, shards, groups, lambda shard, group: group * shards + shard)
    return left.cogroup(right).applyInArrow(find, _FOUND)


def prepared(vectors: DataFrame, label: Column, identifier: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """row, no_id, id, label, codes of the rows that take part."""
    x = F.col(f"`{vector}`")
    valid = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    code = F.transform(
        x, lambda v: F.least(F.greatest(F.floor(SCALE * v.cast("double")), F.lit(-_LIMIT)), F.lit(_LIMIT)).cast("int")
    )
    own = F.col(f"`{identifier}`").cast("long")
    rows = vectors.where(label.isNotNull() & x.isNotNull() & F.coalesce(valid, F.lit(False)))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        own.isNull().cast("int").alias("no_id"),
        F.coalesce(own, F.lit(0)).alias("id"),
        label.cast("long").alias("label"),
        code.alias("codes"),
    )


def mine(vectors: DataFrame, label: Column | str = "label", every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors: ids divisible by ``every``."""
    label = F.col(label) if isinstance(label, str) else label
    rows = stored(prepared(vectors, label), "vector-codes")
    is_anchor = (F.col("no_id") == 0) & (F.col("id") % every == 0)
    size, n_anchors, width = rows.agg(
        F.count("*"), F.coalesce(F.sum(is_anchor.cast("int")), F.lit(0)), F.coalesce(F.max(F.size("codes")), F.lit(0))
    ).first()
    anchors = stored(rows.where(is_anchor), "anchors")

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, ids, labels, numbers = _matrix(left["codes"], width), _ids(left), _column(left, "label"), _column(left, "row")
        own = _matrix(right["codes"], width).astype(codes.dtype)
        made, of = [], []
        wanted, own_rows = _column(right, "label"), _column(right, "row")
        for value in np.unique(wanted):
            part = np.flatnonzero(labels == value)
            lists = Lists(codes[part], ids[part])
            for a in np.flatnonzero(wanted == value) if len(part) else ():
                found = lists.top(own[a], numbers[part] != own_rows[a], [(-(1 << 62), 1 << 62)], POSITIVES)[0]
                made += [(int(numbers[part[r]]), *map(int, ids[part[r]]), s) for r, s in found]
                of += [int(own_rows[a])] * len(found)
        return _answers(of, [0] * len(of), made)

    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "no_id", "id", "row")
    ranked = _cells(rows, anchors, size, n_anchors, width, positives).withColumn("position", F.row_number().over(best))
    chosen = stored(ranked.where(F.col("position") <= POSITIVES), "positives")
    per_anchor = chosen.groupBy("anchor").agg(F.collect_list(F.struct("position", "score")).alias("windows"))
    armed = stored(anchors.join(per_anchor, anchors["row"] == per_anchor["anchor"]).drop("anchor"), "armed-anchors")

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, ids, labels, numbers = _matrix(left["codes"], width), _ids(left), _column(left, "label"), _column(left, "row")
        own = _matrix(right["codes"], width).astype(codes.dtype)
        lists = Lists(codes, ids)
        made, of, at = [], [], []
        wanted, own_rows = _column(right, "label"), _column(right, "row")
        for a, windows in enumerate(right["windows"].to_pylist()):
            bounds = [(-(-LOW * w["score"] // 100), HIGH * w["score"] // 100) for w in windows]
            for w, found in zip(windows, lists.top(own[a], labels != wanted[a], bounds, NEGATIVES), strict=True):
                made += [(int(numbers[r]), *map(int, ids[r]), s) for r, s in found]
                of += [int(own_rows[a])] * len(found)
                at += [w["position"]] * len(found)
        return _answers(of, at, made)

    best = Window.partitionBy("anchor", "position").orderBy(F.col("score").desc(), "no_id", "id", "row")
    ranked = _cells(rows, armed, size, n_anchors, width, negatives).withColumn("rank", F.row_number().over(best))

    def named(prefix: str) -> Column:
        return F.when(F.col("no_id") == 0, F.col("id")).alias(f"{prefix}_id")

    first = chosen.select("anchor", "position", named("positive"), F.col("score").alias("positive_score"))
    last = ranked.where(F.col("rank") <= NEGATIVES).select("anchor", "position", "rank", named("negative"), F.col("score").alias("negative_score"))
    own = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return last.join(first, ["anchor", "position"]).join(own, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
