"""Suffix-array dedup: repeated byte strings of at least ``MIN_BYTES``, across all documents.

One suffix array over a 100 TB corpus cannot be sorted, and almost all of it
repeats nowhere.  So the corpus is cut into places that can match first:

1. *Runs.*  Every start of a 400-byte string takes the least hash of the
   200-byte grams inside the string as its anchor (a sliding minimum, so equal
   strings have equal anchors wherever they stand).  Consecutive starts with one
   anchor are a run: about one per 110 bytes.  Only runs whose anchor occurs
   again can match.
2. *Classes.*  Runs of equal anchor and equal content are one class.  A class
   with two members repeats as a whole: copies of documents and the inside of
   long repeats, however many, end here in a grouped count.
3. *Suffix arrays.*  Classes that share an anchor but differ are compared byte by
   byte.  Runs of many anchors are concatenated in blocks of bounded size; a
   suffix array over the block (prefix doubling to 400 bytes) puts equal starts
   next to each other; the previous and next smaller positions in suffix order
   give each start its earlier match (longest previous factor of at least 400
   bytes) and its later one.
4. An anchor with over ``GROUP_LIMIT`` classes (a passage in a third of all
   documents) would not fit a block.  Its starts are matched exactly too: by
   the 128-bit hash of their 400 bytes in a grouped count, combined map-side.

``keep="none"`` removes every byte of a repeated string, ``keep="first"`` only
the copies that have an earlier match ((doc_id, position) order; null doc_ids
last).  Strings are judged on the input.

Defined results: null text counts as empty; texts under 400 bytes lose
nothing; equal texts (also repeated rows) repeat each other; an empty table
gives no rows; extra columns are ignored; very long and periodic texts give
long runs, which are cut into pieces of at most 4096 starts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns, stored

MIN_BYTES = 400
GRAM = 200
LONGEST_RUN = 4096
PIECE = 1 << 20  # starts hashed at once; longer texts are read in overlapping pieces
GROUP_LIMIT = 1000  # classes of one anchor that a suffix array takes; more go by grouped hashes
BLOCK_BYTES = 4 << 20  # bytes under one suffix array
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=64)
def _powers(which: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, 2**bits of them."""
    base, n = int(_BASES[which]), 1 << bits
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class Rolling:
    """Hashes of any substring of a byte array from one prefix sum."""

    def __init__(self, data: np.ndarray, which: int):
        self.up, self.down = _powers(which, max(12, int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, content hash, first start, number of starts, and whether the anchor's gram is in the run twice.

    Twice means that the run is periodic and may repeat itself; with one gram, the leftmost one of the first
    window is the rightmost one of the last.
    """
    one, two = Rolling(data, 0), Rolling(data, 1)
    n = len(data)
    grams = _mix((one.sums[GRAM:] - one.sums[:-GRAM]) * one.down[: n - GRAM + 1])
    least = sliding_min(grams, MIN_BYTES - GRAM + 1)
    cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    size = np.diff(np.append(cut, len(least)))
    if size.max() > LONGEST_RUN:
        pieces = [np.arange(s, s + k, LONGEST_RUN) for s, k in zip(cut, size, strict=True)]
        cut = np.concatenate(pieces)
        size = np.diff(np.append(cut, len(least)))
    content = _mix(two.of(cut, cut + size - 1 + MIN_BYTES) ^ _mix(size.astype(np.uint64)))
    windows = np.lib.stride_tricks.sliding_window_view(grams, MIN_BYTES - GRAM + 1)
    left = cut + windows[cut].argmin(axis=1)
    last = cut + size - 1
    right = last + MIN_BYTES - GRAM - windows[last, ::-1].argmin(axis=1)
    return least[cut], content, cut, size, left != right


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8"), np.uint8)


def _runs(rows: DataFrame) -> DataFrame:
    def find(batches):
        for batch in batches:
            owner, found = [], []
            for number, text in enumerate(batch["text"]):
                data = _bytes(text)
                for lo in range(0, len(data) - MIN_BYTES + 1, PIECE):
                    anchor, content, start, size, twice = runs_of(data[lo : lo + PIECE + MIN_BYTES - 1])
                    found.append((anchor, content, start + lo, size, twice))
                    owner.append(np.full(len(anchor), number))
            if found:
                anchor, content, start, size, twice = (np.concatenate(x) for x in zip(*found, strict=True))
                at = np.concatenate(owner)
                yield pd.DataFrame(
                    {"doc_id": batch["doc_id"].astype("Int64").take(at).array, "tid": batch["tid"].to_numpy()[at],
                     "anchor": anchor.view(np.int64), "content": content.view(np.int64), "start": start, "size": size,
                     "twice": twice}
                )

    return rows.mapInPandas(find, "doc_id long, tid long, anchor long, content long, start int, size int, twice boolean")


# -- suffix arrays -----------------------------------------------------------


def suffix_order(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of their 400-byte prefixes (ties by position), and their class in that order.

    Prefix doubling: eight bytes packed into a number, then ranks of 16, 32, ... 256 bytes, each from two
    of half the length; 400 bytes are two overlapping ranks of 256.  Data past the end reads as zero; starts
    have 400 bytes of their own.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(MIN_BYTES, np.uint8)]).astype(np.uint64)
    word = np.zeros(n + MIN_BYTES - 8, np.uint64)
    for j in range(8):
        word = (word << _U(8)) | padded[j : j + len(word)]
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    width = 8
    while 2 * width <= MIN_BYTES:
        ahead = np.concatenate([rank[width:], np.zeros(width, np.int64)])
        rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        width *= 2
    tail = rank[starts + MIN_BYTES - width]
    key = rank[starts] * (int(rank.max()) + 1) + tail
    order = np.lexsort((starts, key))
    classes = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]])) if len(order) else key
    return order, classes


def neighbours(order: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per start: the nearest smaller position among its 400-byte equals (-1: none), and the nearest greater.

    Equal starts are adjacent in suffix order and ties are ordered by position, so the previous smaller
    position of a start within its class is the element before it, and the next one the element after it.
    """
    earlier, later = np.full(len(order), -1), np.full(len(order), -1)
    joined = classes[1:] == classes[:-1]
    earlier[order[1:][joined]] = order[:-1][joined]
    later[order[:-1][joined]] = order[1:][joined]
    return earlier, later


def _intervals(flags: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def _neighbours_joined(at: np.ndarray) -> list[list[int]]:
    """Single starts as [from, to) intervals."""
    flags = np.zeros(int(max(at, default=-1)) + 1, bool)
    flags[np.asarray(at, np.int64)] = True
    return _intervals(flags)


def match_block(contexts: list[bytes], sizes: list[int], whole: list[bool]) -> list[tuple[list, list]]:
    """Per context the matched starts and those with an earlier match, as [from, to) intervals.

    ``whole``: the class has several members, so all its starts match.
    """
    at = np.cumsum([0, *map(len, contexts)])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.concatenate([np.arange(a, a + s) for a, s in zip(at, sizes, strict=False)])
    earlier, later = neighbours(*suffix_order(data, starts))
    out, lo = [], 0
    for size, every in zip(sizes, whole, strict=True):
        before, after = earlier[lo : lo + size] >= 0, later[lo : lo + size] >= 0
        out.append((_intervals(before | after | every), _intervals(before)))
        lo += size
    return out


_PLACE = ["place", "tid", "first"]  # order of first occurrence
_MATCH = "anchor long, content long, hits array<array<int>>, copies array<array<int>>"


def _by_suffix_array(contexts: DataFrame) -> DataFrame:
    """Contexts of one anchor come together (hash partitioning, sorted); blocks end between anchors."""

    def match(batches):
        held: list = []
        size = 0

        def flush():
            found = match_block([bytes(r.context) for r in held], [r.size for r in held], [r.members > 1 for r in held])
            return pd.DataFrame(
                {"anchor": [r.anchor for r in held], "content": [r.content for r in held],
                 "hits": [f[0] for f in found], "copies": [f[1] for f in found]}
            )

        for batch in batches:
            for row in batch.itertuples(index=False, name="Run"):
                if held and row.anchor != held[-1].anchor and size >= BLOCK_BYTES:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row.context)
        if held:
            yield flush()

    ready = contexts.repartition("anchor").sortWithinPartitions("anchor", *_PLACE)
    return ready.select("anchor", "content", "size", "members", "context").mapInPandas(match, _MATCH)


def _by_hash(contexts: DataFrame) -> DataFrame:
    """Anchors of very many classes: starts matched by the 128-bit hash of their 400 bytes."""

    def starts(batches):
        for batch in batches:
            for row in batch.itertuples(index=False, name="Run"):
                raw = bytes(row.context)
                made = [hashlib.blake2b(raw[k : k + MIN_BYTES], digest_size=16).digest() for k in range(row.size)]
                yield pd.DataFrame(
                    {"anchor": row.anchor, "content": row.content, "members": row.members, "place": row.place,
                     "tid": row.tid, "first": row.first, "at": range(row.size), "string": made}
                )

    names = ["anchor", "content", "members", *_PLACE]
    every = contexts.select(*names, "size", "context").mapInPandas(
        starts, "anchor long, content long, members long, place long, tid long, first int, at int, string binary"
    )
    every = stored(every, "hot-starts")
    where = F.struct(*_PLACE, "at")
    counts = every.groupBy("string").agg(F.sum("members").alias("n"), F.min(where).alias("least"))
    counts = stored(counts.where("n > 1"), "hot-strings")
    hit = every.join(counts, "string").select("anchor", "content", "at", (where > F.col("least")).alias("copy"))
    # at most LONGEST_RUN starts of a class
    found = hit.groupBy("anchor", "content").agg(
        F.collect_list("at").alias("hits"), F.collect_list(F.when(F.col("copy"), F.col("at"))).alias("copies")
    )

    def joined(batches):
        for batch in batches:
            for name in ("hits", "copies"):
                batch[name] = [_neighbours_joined(at) for at in batch[name]]
            yield batch

    return found.mapInPandas(joined, _MATCH)


def repeated_spans(docs: DataFrame, keep: str = "none") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, tid, text; spans to remove: doc_id, tid, spans array<array<int>> of [from, to))."""
    rows = own_columns(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"), F.coalesce("text", F.lit("")).alias("text")
    )
    runs = _runs(rows.where(F.octet_length("text") >= MIN_BYTES))
    anchors = runs.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"), F.max("twice").alias("twice")
    )
    mixed = F.col("twice") | (F.col("low") < F.col("high"))
    anchors = stored(anchors.where("n > 1 or twice").select("anchor", mixed.alias("mixed")), "anchors")
    repeated = stored(runs.drop("twice").join(anchors, "anchor"), "repeated-runs")

    here = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid", "start", "size")
    classes = repeated.groupBy("anchor", "content", "mixed").agg(F.count("*").alias("members"), F.min(here).alias("first"))
    classes = stored(classes.where("mixed or members > 1"), "run-classes")
    mixed = classes.where("mixed")
    mixed = mixed.select("anchor", "content", "members", "first.doc_id", "first.tid", "first.start", "first.size")
    hot = stored(mixed.groupBy("anchor").agg(F.count("*").alias("classes")).where(F.col("classes") > GROUP_LIMIT), "hot-anchors")
    contexts = stored(_contexts(rows, mixed.join(hot, "anchor", "left")), "contexts")
    matched = _by_suffix_array(contexts.where("not hot")).union(_by_hash(contexts.where("hot")))
    matched = stored(matched, "matches")

    # every run of a class takes the class's result; a class of several members matches as a whole
    placed = repeated.join(
        classes.select("anchor", "content", "members", F.col("first").alias("_first")), ["anchor", "content"]
    ).join(matched, ["anchor", "content"], "left")
    whole = F.array(F.array(F.lit(0), F.col("size")))
    none = F.array().cast("array<array<int>>")
    if keep == "first":
        hits = F.when(here != F.col("_first"), whole).otherwise(F.coalesce("copies", none))
    else:
        hits = F.when(F.col("members") > 1, whole).otherwise(F.coalesce("hits", none))
    spans = F.transform(hits, lambda h: F.array(h[0] + F.col("start"), h[1] + F.col("start") + MIN_BYTES - 1))
    found = placed.select("doc_id", "tid", spans.alias("own")).where(F.size("own") > 0).groupBy("doc_id", "tid")
    return rows, stored(found.agg(F.flatten(F.collect_list("own")).alias("spans")), "spans")


def _same_row():
    return F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tid") == F.col("_tid"))


def _keyed(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"doc_id": "_doc", "tid": "_tid"})


def _contexts(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The bytes of each class's first run: its starts and the 399 bytes after them."""
    wanted = classes.select(
        "doc_id", "tid", F.struct("anchor", "content", "members", "start", "size", F.col("classes").isNotNull().alias("hot")).alias("run")
    )
    wanted = stored(wanted.groupBy("doc_id", "tid").agg(F.collect_list("run").alias("runs")), "wanted-runs")

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, tid, text, runs in zip(
                batch["doc_id"].astype("Int64"), batch["tid"], batch["text"], batch["runs"], strict=True
            ):
                raw = text.encode("utf-8")
                place = (1 << 62) if doc_id is pd.NA else int(doc_id)
                for r in runs:
                    first, size = r["start"], r["size"]
                    context = raw[first : first + size - 1 + MIN_BYTES]
                    out.append((r["anchor"], r["content"], r["members"], size, r["hot"], place, tid, first, context))
            if out:
                yield pd.DataFrame(out, columns=names)

    names = ["anchor", "content", "members", "size", "hot", *_PLACE, "context"]
    found = rows.join(_keyed(wanted), _same_row())
    made = found.select("doc_id", "tid", "text", "runs").mapInPandas(
        cut,
        "anchor long, content long, members long, size int, hot boolean, place long, tid long, first int, context binary",
    )
    return made.dropDuplicates(["anchor", "content"])  # rows that repeat doc_id and text give equal contexts


def remove_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch["doc_id"].astype("Int64"), batch["text"], batch["spans"], strict=True):
                raw = text.encode("utf-8")
                parts, at, gone, n = [], 0, 0, 0
                for lo, hi in sorted((int(a), int(b)) for a, b in ([] if found is None else found)):
                    if lo > at or not n:
                        n += 1
                        parts.append(raw[at:lo])
                        at = lo
                    if hi > at:
                        gone += hi - at
                        at = hi
                parts.append(raw[at:])
                out.append((doc_id, len(raw), gone, n, b"".join(parts)))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
            yield frame.astype({"doc_id": "Int64"})

    touched = rows.join(_keyed(spans), _same_row(), "left")
    return touched.select("doc_id", "text", "spans").mapInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
