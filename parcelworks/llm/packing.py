"""Best-fit packing: a configuration linear program over the length histogram.

1. Documents become pieces of at most ``capacity`` tokens; a longer document
   is cut into full pieces, its first piece takes the remainder.
2. Only the histogram of piece lengths (at most ``capacity`` rows, whatever the
   input) reaches the driver.  There the covering program over sequence
   *configurations* (which lengths share a sequence) is solved approximately
   by multiplicative weights: each round prices the best configuration with a
   knapsack dynamic program under the current weights, and lengths that the
   configuration covers lose weight.  A round raises the cover of one length by
   STEP and a covered length is priced no more, so the rounds that cover every
   length are at most 1 / STEP for each, whatever the input.
3. Rounding: configurations are taken as often as the whole part of their
   fractional amount, within the counts, then once more by largest remainder
   where all their pieces are left.  Only what remains is packed largest first,
   each sequence completed by a knapsack for the best fit.
4. Back in Spark each piece finds its place from its rank among the pieces of
   its length: rank inside its task's output plus the counts of earlier tasks,
   so a length that a third of all pieces share is not one group anywhere.

Defined results: null text counts as empty (the end id only); repeated rows,
equal and null doc_ids are packed like any other document; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, stored
from .tokenizing import byte_encoder

CAPACITY = 1024
END_ID = 2
STEP = 1 / 8  # cover that a round adds to the length it covers fastest
_COVERED = 1 - 1e-9  # the sum of the steps, but for its rounding

Config = dict[int, int]  # length -> how many in one sequence


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> list[int]:
    """Indices (with repeats) of the most valuable multiset of sizes (distinct, ascending) within the capacity."""
    least, most = int(sizes[0]), int(sizes[-1])
    worth, index = np.full(capacity + 1, -1.0), np.zeros(capacity + 1, int)
    worth[capacity - sizes], index[sizes] = values, np.arange(len(sizes))  # worth by size, largest first
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, int)  # a size
    for room in range(least, capacity + 1):
        top = min(room, most)
        total = best[room - top : room - least + 1] + worth[capacity - top : capacity - least + 1]
        j = int(total.argmax())
        best[room] = best[room - 1]
        if total[j] > best[room]:
            best[room], taken[room] = total[j], top - j
    found, room = [], capacity
    while room > 0:
        if not taken[room]:
            room -= 1
        else:
            found.append(int(index[taken[room]]))
            room -= int(taken[room])
    return found


def _within(found: list[int], left: np.ndarray) -> dict[int, int]:
    return {j: min(n, int(left[j])) for j, n in Counter(found).items() if left[j] > 0}


def _fill(sizes: np.ndarray, values: np.ndarray, free: np.ndarray, room: int) -> dict[int, int]:
    """A valuable configuration within the room and the free pieces; room that cut repeats leave is filled again."""
    config: dict[int, int] = {}
    free = free.copy()
    while True:
        open_ = np.flatnonzero((free > 0) & (sizes <= room))
        if not len(open_):
            return config
        found = [int(open_[i]) for i in knapsack(sizes[open_], values[open_], room)]
        for i, n in _within(found, free).items():
            config[i] = config.get(i, 0) + n
            free[i] -= n
            room -= n * int(sizes[i])


def _take(config: dict[int, int], times: int, left: np.ndarray, out: list, sizes: np.ndarray) -> None:
    for j, n in config.items():
        left[j] -= n * times
    out.append(({int(sizes[j]): n for j, n in config.items()}, times))


def _fractional(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int | None
) -> list[tuple[dict[int, int], float]]:
    """Configurations with fractional amounts that cover each length at least once (unless ``rounds`` ends them)."""
    covered = np.zeros(len(sizes))
    amounts: dict[tuple, float] = {}
    eta = np.log(len(sizes) + 1)
    done = 0
    while covered.min() < _COVERED and done != rounds:
        weights = np.exp(-eta * (covered - covered.min())) * sizes
        config = _fill(sizes, weights, np.where(covered < _COVERED, counts, 0), capacity)
        step = min(counts[j] / n for j, n in config.items()) * STEP
        key = tuple(sorted(config.items()))
        amounts[key] = amounts.get(key, 0.0) + step
        for j, n in config.items():
            covered[j] += n * step / counts[j]
        done += 1
    return [(dict(key), amount) for key, amount in amounts.items()]


def _rounded(proposals: list[tuple[dict[int, int], float]], sizes: np.ndarray, left: np.ndarray, out: list) -> None:
    """Whole numbers of the configurations, fullest first; then one more each, largest remainder first."""
    remainders = []
    for config, amount in sorted(proposals, key=lambda p: -sum(int(sizes[j]) * n for j, n in p[0].items())):
        times = min(int(amount), min(int(left[j]) // n for j, n in config.items()))
        if times > 0:
            _take(config, times, left, out, sizes)
        if amount > times:
            remainders.append((amount - times, config))
    for _, config in sorted(remainders, key=lambda r: -r[0]):
        if all(left[j] >= n for j, n in config.items()):
            _take(config, 1, left, out, sizes)


def _rest(sizes: np.ndarray, left: np.ndarray, capacity: int, out: list) -> None:
    """Pack what is left, largest length first, with the best-fitting company."""
    while left.any():
        j = int(np.flatnonzero(left)[-1])
        free = left.copy()
        free[j] -= 1
        config = _fill(sizes, sizes.astype(float), free, capacity - int(sizes[j]))
        config[j] = config.get(j, 0) + 1
        _take(config, max(1, min(int(left[i]) // n for i, n in config.items())), left, out, sizes)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None) -> list[tuple[Config, int]]:
    """Configurations with their number of sequences; together they hold every piece once."""
    out: list[tuple[Config, int]] = []
    if histogram.get(capacity):
        out.append(({capacity: 1}, histogram[capacity]))
    sizes = np.array(sorted(s for s, n in histogram.items() if 0 < s < capacity and n), dtype=int)
    if not len(sizes):
        return out
    counts = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    left = counts.copy()
    _rounded(_fractional(sizes, counts, capacity, rounds), sizes, left, out)
    _rest(sizes, left, capacity, out)
    return out


def _slots(configs: list[tuple[Config, int]]) -> dict[str, np.ndarray]:
    """A row per configuration and length: the ranks it serves and where they go."""
    rows, served, sequence = [], Counter(), 0
    for config, times in configs:
        at = 0
        for length, n in sorted(config.items(), reverse=True):
            rows.append((length, served[length], n, sequence, at))
            served[length] += n * times
            at += n * length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "n", "sequence", "offset"), table.T, strict=True))


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces: doc_id, piece, start, length, ids_crc32, and part and rank (the piece's place among
    the task's pieces of its length)."""

    def pieces(batches):
        encode = byte_encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = []
            for doc_id, blob in zip(batch["doc_id"].astype("Int64"), encode(batch["text"]), strict=True):
                blob += end
                n = len(blob) // 4
                first = n % capacity or min(n, capacity)
                starts = [0, *range(first, n, capacity)]
                for number, start in enumerate(starts):
                    stop = first if number == 0 else start + capacity
                    length = stop - start
                    out.append((doc_id, number, start, length, zlib.crc32(blob[4 * start : 4 * stop]), part, seen[length]))
                    seen[length] += 1
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])
            yield frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    return own_columns(docs, "doc_id", "text").mapInPandas(pieces, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = stored(cut(docs, tokenizer, capacity, end_id), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # at most one row per configuration and length; both are bounded by the capacity, not by the input
    slots = spark.sparkContext.broadcast(_slots(pack_histogram(histogram, capacity)))
    before = counts.select(
        "part", "length",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    before = stored(before, "piece-ranks")
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(batches):
        table = slots.value
        # (length, first) in one number; ranks stay far below 2**44
        keys = (table["length"] << 44) + table["first"]
        for batch in batches:
            key = (batch["length"].to_numpy() << 44) + batch["rank"].to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            k = batch["rank"].to_numpy() - table["first"][at]
            each = table["n"][at]
            batch["sequence_id"] = table["sequence"][at] + k // each
            batch["offset"] = table["offset"][at] + k % each * batch["length"].to_numpy()
            yield batch[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return ranked.select(*columns).mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
