"""N-gram Jaccard join: a size-aware heavy-light set join, reduced to link components.

Sets are the distinct k-word shingles of a text.  Equal sets are collapsed to
one class first.  A pair with Jaccard >= t whose larger set has b shingles
shares at least c(b) = ceil(t * b) of them.

* *Light* (b <= boundary): every set enumerates its subsets of size c(b); two
  sets that link share one such subset, whose hash is the join key.
* *Heavy* (b > boundary): every set posts the rarest n - ceil(t * n) + 1 of its
  shingles to inverted lists; two sets that link share one of them.  Rarity
  comes from a counting sketch of fixed size over all documents (any fixed
  total order is exact; a rare-first order keeps the lists short).

The boundary minimises the number of postings plus expected list scans over
the size histogram (sizes up to ``MAX_LIGHT``; larger sets are heavy).  The
lists are then scanned by ``linking``: spanning forests first, then only members
still in different components, both under exact bounds on their overlap.  Every link is verified on the texts themselves.

Defined results: null and empty text, and text without words, have an empty
set, n_shingles 0, no link, and their own doc_id as component; rows with a null
doc_id link like others, and a component without any doc_id has component_id
null; repeated rows and ties share their class; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, own_columns, restored, stored
from .linking import distinct_lists, link_components, sketch
from .shingles import mix, shingle_sets, shingles_as_tuples

MAX_LIGHT = 30
SKETCH = 1 << 20  # counters of the rarity sketch; fixed whatever the input
_CHUNK = 1 << 12  # counters in a row of the sketch's tables


def need(size: int, percent: int) -> int:
    """Least overlap of a linked pair whose larger set has ``size`` members."""
    return -(-percent * size // 100)


_READ = "tid long, doc_id long, n long, s1 long, s2 long, profile binary, chunk int, counts binary"


def _read(docs: DataFrame, k: int) -> DataFrame:
    """One pass over the texts: a row per document (the 128-bit identity and the profile of its set) and, per
    task, the counters of the rarity sketch, packed."""

    def build(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            n, one, two, profiles, found = [], [], [], [], []
            for s in shingle_sets(batch["text"], k):
                n.append(len(s))
                profiles.append(sketch(s))
                one.append(int(s.sum().view(np.int64)))
                two.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)))
                found.append(s)
            if found:
                at = (np.concatenate(found) & np.uint64(SKETCH - 1)).astype(np.int64)
                total += np.bincount(at, minlength=SKETCH)
            yield pd.DataFrame({"tid": batch["tid"], "doc_id": batch["doc_id"].astype("Int64"), "n": n, "s1": one, "s2": two,
                                "profile": profiles, "chunk": -1, "counts": b""})
        parts = [(c, total[c * _CHUNK : (c + 1) * _CHUNK]) for c in range(SKETCH // _CHUNK)]
        kept = [(c, zlib.compress(np.minimum(p, 2**31 - 1).astype("<i4").tobytes(), 1)) for c, p in parts if p.any()]
        if kept:
            frame = pd.DataFrame(kept, columns=["chunk", "counts"])
            yield frame.assign(tid=0, doc_id=0, n=0, s1=0, s2=0, profile=b"")[[c.split()[0] for c in _READ.split(", ")]]

    return docs.mapInPandas(build, _READ)


def _light_sizes(n: int, boundary: int, percent: int) -> list[int]:
    """Subset sizes that a set of n members must enumerate."""
    sizes = {need(b, percent) for b in range(n, boundary + 1) if need(b, percent) <= n}
    return sorted(sizes)


def choose_boundary(histogram: dict[int, int], percent: int) -> int:
    """The light/heavy boundary of least cost; a set's cost is its number of postings."""
    best, best_cost = 0, None
    for x in range(MAX_LIGHT + 1):
        cost = 0
        for n, count in histogram.items():
            if n <= x:
                cost += count * sum(math.comb(n, c) for c in _light_sizes(n, x, percent))
            if n >= need(x + 1, percent):
                cost += 2 * count * (n - need(n, percent) + 1)  # a list is also scanned
        if best_cost is None or cost < best_cost:
            best, best_cost = x, cost
    return best


def _rarity(read: DataFrame) -> np.ndarray:
    """The sketch as one byte per counter, on a log scale: at most SKETCH bytes, whatever the input."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch["chunk"], batch["counts"], strict=True):
                own = np.frombuffer(zlib.decompress(counts), "<i4").astype(np.int64)
                total[chunk] = total[chunk] + own if chunk in total else own
        if total:
            scaled = [np.minimum(np.log2(t + 1) * 5, 255).astype(np.uint8).tobytes() for t in total.values()]
            yield pd.DataFrame({"chunk": list(total), "scaled": scaled})

    parts = read.where("chunk >= 0").select("chunk", "counts").repartition("chunk")
    table = np.zeros(SKETCH, np.uint8)
    for row in parts.mapInPandas(add, "chunk int, scaled binary").collect():
        table[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = np.frombuffer(row["scaled"], np.uint8)
    return table


def _postings(texts: DataFrame, rarity: np.ndarray, k: int, percent: int, boundary: int) -> DataFrame:
    """(key, id, size) of every class; ``texts`` has number and text."""
    shared = texts.sparkSession.sparkContext.broadcast(rarity)  # SKETCH bytes
    low = need(boundary + 1, percent)

    def post(batches):
        rank = shared.value
        for batch in batches:
            key, ids, sizes = [], [], []
            for number, s in zip(batch["number"], shingle_sets(batch["text"], k), strict=True):
                n, before = len(s), len(key)
                if n <= boundary:
                    for c in _light_sizes(n, boundary, percent):
                        rows = np.array(list(combinations(s.tolist(), c)), np.uint64)
                        key.append(mix(mix(rows).sum(axis=1, dtype=np.uint64) + np.uint64(c)))
                        ids.append(np.full(len(rows), number))
                if n >= low:
                    order = np.lexsort((s, rank[(s & np.uint64(SKETCH - 1)).astype(np.int64)]))
                    key.append(s[order[: n - need(n, percent) + 1]])
                    ids.append(np.full(len(key[-1]), number))
                sizes += [np.full(len(part), n, np.int32) for part in key[before:]]
            if ids:
                yield pd.DataFrame({"key": np.concatenate(key).view(np.int64), "id": np.concatenate(ids), "size": np.concatenate(sizes)})

    return texts.mapInPandas(post, "key long, id long, size int")


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(per row: doc_id, tid, n, component and root, both null without shingles; spanning links between classes)."""
    text = F.coalesce("text", F.lit(""))
    docs = own_columns(docs, "doc_id", "text").select(F.xxhash64(text).alias("tid"), "doc_id", text.alias("text"))
    read = stored(_read(docs, k), "sets")
    member = read.where("chunk < 0").select("doc_id", "tid", "n", "s1", "s2", "profile")
    identity = ["n", "s1", "s2"]
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("pick")
    classes = member.where("n > 0").groupBy(*identity).agg(
        F.min("doc_id").alias("least"), pick, F.first("profile").alias("profile")
    )
    classes = stored(classes.withColumn("number", F.monotonically_increasing_id()), "classes")
    histogram = classes.where(F.col("n") <= 2 * MAX_LIGHT).groupBy("n").count().collect()
    boundary = choose_boundary({r["n"]: r["count"] for r in histogram}, percent)
    sized = classes.select("number", "pick.*", F.col("n").alias("size"), "profile").drop("none")
    sized = sized.withColumnsRenamed({"doc_id": "_doc", "tid": "_tid"})
    # one text per class, found by doc_id and text hash (repeated rows give the same postings again)
    picked = classes.select("number", F.col("pick.doc_id").alias("_doc"), F.col("pick.tid").alias("_tid"))
    texts = docs.join(picked, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tid") == F.col("_tid"))).select("number", "text")
    postings = stored(_postings(texts, _rarity(read), k, percent, boundary), "postings")
    postings = stored(postings.join(distinct_lists(postings), "key").select("key", "id", "size", "members"), "lists")
    involved = postings.select(F.col("id").alias("number")).distinct()
    involved = involved.join(sized, "number")
    involved = stored(involved, "listed-classes")
    contents = docs.join(involved, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tid") == F.col("_tid")))
    contents = stored(contents.select(F.col("number").alias("id"), F.col("text").alias("content")), "contents")

    roots, links = link_components(
        postings, contents, involved.select(F.col("number").alias("id"), "size", F.col("profile").alias("sketch")),
        lambda texts: shingle_sets(texts, k), lambda t: shingles_as_tuples(t, k), percent,
    )
    named = classes.join(roots, F.col("number") == F.col("node"), "left")
    named = stored(named.select(*identity, "least", F.coalesce("root", "number").alias("root")), "class-components")
    least = stored(named.groupBy("root").agg(F.min("least").alias("component")), "component-ids")
    named = stored(named.join(least, "root").select(*identity, "component", "root"), "class-ids")
    return member.join(named, identity, "left").select("doc_id", "tid", "n", "component", "root"), links


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(per document: doc_id, n_shingles, component_id; spanning links between numbered classes).

    The spanning links join the components; most links inside a large group are not among them.
    """
    found, links = _linked(docs, k, percent)
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")), links


def one_per_component(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row left of each component; rows without shingles stay as they are.

    The row with the smallest doc_id stays (null last, then the smallest text
    hash); where it is itself repeated (same doc_id and text), one of the
    repeated rows.  Rows are told apart by doc_id and text hash.
    """
    found, _ = _linked(docs, k, percent)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")
    rows = stored(found.where("n > 0").groupBy("root", "doc_id", "tid").agg(F.count("*").alias("n")), "linked-rows")
    picked = rows.groupBy("root").agg(F.min(row).alias("pick"), F.sum("n").alias("size")).where("size > 1")
    judged = rows.join(stored(picked.select("root", "pick"), "kept-rows"), "root").withColumn("kept", row == F.col("pick"))
    judged = judged.where("not kept or n > 1").select(F.col("doc_id").alias("id"), F.col("tid").alias("hash"), "kept")
    judged = stored(judged, "near-copies")

    columns, names = numbered(docs)
    hashed = docs.select(*columns, F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    once = hashed.join(judged, same, "left_anti")
    repeated = hashed.join(judged.where("kept"), same).dropDuplicates(["id", "hash"])
    return restored(once, names).union(restored(repeated, names))
