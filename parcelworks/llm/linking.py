"""From shared keys to verified components, without emitting all pairs of a key's members.

Input: postings ``(key, id, size)`` such that two ids that must be linked share at
least one key, contents ``(id, content)`` and profiles ``(id, size, sketch)``.
Two contents link when the Jaccard similarity of their sets reaches ``percent``
/ 100.

The sketch of a set has a bit per hash bucket: whether the bucket holds an odd
number of members.  The bits in which two sketches differ are at most the
members in which the sets differ, so they bound the overlap from above; the
number of bits grows with the set, so long sets are told apart as well as short
ones.  Only pairs within the bound are verified on their contents.

0. *Equal lists.*  Keys with the same members (the shingles of a passage that
   the same documents share) give the same pairs; one key of each is kept.
1. *Short lists.*  Keys with at most ``SHORT`` members give all their pairs (a
   linear number), each pair once.
2. *Long lists.*  A longer list is cut into size classes, so that pairs whose
   sizes rule a link out do not meet; a member is posted in its own class and
   in the next.  The members of a class are compared with each other inside
   tasks, in blocks of at most ``BLOCK`` members.  The first scan returns
   ``FORESTS`` disjoint spanning forests of the most similar pairs, so its rows
   are linear while nearly every large group of near copies becomes one
   component.  A list whose members are in one component is finished.  The last
   scan compares what is still across components by sketches of ``WIDE`` times
   the bits, which come within a few percent of the true difference, and
   returns the pairs within the bound: linked ones and those that miss the
   limit by a few members.

So no link that could change a component is skipped, pairs inside a component,
the quadratic part of a hot group, are never made, and pairs that are not
similar do not leave the task that compares them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components, merged

SHORT = 16
BLOCK = 2048
FORESTS = 2
LEAST_BITS = 128
WIDE = 8  # bits a member in the last scan; the first has one
_CELLS = 1 << 20  # 64-bit sketch words compared at once


def sketch(hashes: np.ndarray, bits_each: int = 1) -> bytes:
    """One bit per bucket of a set of 64-bit hashes: whether it holds an odd number of them."""
    bits = max(LEAST_BITS, 1 << (bits_each * len(hashes) - 1).bit_length())
    odd = np.zeros(bits, bool)
    buckets = ((hashes >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)
    odd[:] = np.bincount(buckets, minlength=bits) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def _folded(sketch_: bytes, size: int) -> np.ndarray:
    """The sketch that ``size`` bytes would have held, as 64-bit words."""
    words = np.frombuffer(sketch_, np.uint64)
    return np.bitwise_xor.reduce(words.reshape(-1, size // 8), axis=0)


def reaches(both, a, b, percent: int):
    """Whether an overlap of two sets of sizes a and b has the similarity."""
    return 100 * both >= percent * (a + b - both)


def _forest(x, y, score, start):
    """Numbers of the pairs (x, y) of a spanning forest of best score over the components ``start`` (in rounds: every
    component takes its best pair to another one)."""
    order = np.argsort(-score, kind="stable")
    above = np.arange(start.max() + 1)
    chosen = []
    while len(order):
        label = above[start]
        cx, cy = label[x[order]], label[y[order]]
        live = cx != cy
        order, cx, cy = order[live], cx[live], cy[live]
        if not len(order):
            break
        best = np.full(len(above), len(order))
        np.minimum.at(best, cx, np.arange(len(order)))
        np.minimum.at(best, cy, np.arange(len(order)))
        for at in np.unique(best[best < len(order)]).tolist():
            one, two = int(above[cx[at]]), int(above[cy[at]])
            if one != two:
                above[above == two] = one
                chosen.append(int(order[at]))
    return chosen


def _close(sizes, sketches, labels, apart, percent: int):
    """(x, y, most) of the members in different components that may link, ``most`` bounding their overlap.

    Members stand in rising size, so y is the larger set; ``apart(x, y)`` says
    whether the two are to be compared here."""
    n = len(sizes)
    stop = np.searchsorted(sizes, sizes * 100 // percent, "right")  # larger sets cannot link
    widths = np.array([len(s) for s in sketches])
    largest = np.bincount(labels).argmax()
    found = []
    for width in np.unique(widths).tolist():
        first = int(np.argmax(widths == width))
        end = int(stop[widths == width].max())
        table = np.stack([_folded(s, width) for s in sketches[first:end]])
        rows, cols = np.arange(n) == -1, np.arange(n)
        rows[first:end] = widths[first:end] == width
        # every pair in two components has a member outside the largest one
        for own, other in ((labels != largest, np.ones(n, bool)), (labels == largest, labels != largest)):
            mine, theirs = np.flatnonzero(rows & own), cols[first:end][other[first:end]]
            step = max(1, _CELLS // max(1, len(theirs) * table.shape[1]))
            for lo in range(0, len(mine), step):
                part = mine[lo : lo + step]
                seen = theirs[(theirs > part[0]) & (theirs < stop[part].max())]
                if not len(seen):
                    continue
                bits = np.bitwise_count(table[part - first][:, None, :] ^ table[seen - first][None, :, :]).sum(axis=2, dtype=np.int64)
                a, b = sizes[part][:, None], sizes[seen][None, :]
                most = (a + b - np.maximum(bits, b - a)) // 2
                fits = reaches(most, a, b, percent) & (seen[None, :] > part[:, None]) & (labels[part][:, None] != labels[seen][None, :])
                x, y = np.nonzero(fits)
                keep = apart(part[x], seen[y])
                found.append((part[x][keep], seen[y][keep], most[x, y][keep]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _scan_list(ids, sizes, roots, native, block, sketches, percent: int, forest: bool):
    """Pairs of one cell in different components that the bound allows (``forest``: spanning forests of them); [(id, id)].

    ``native`` marks the members of the cell's own size class; the others have
    met each other in theirs.  ``block``: of a cell of two blocks, only pairs across them.
    """
    labels = np.unique(roots, return_inverse=True)[1]
    if labels.max() == 0:
        return []
    order = np.argsort(sizes, kind="stable")
    ids, sizes, labels, native, block = ids[order], sizes[order], labels[order], native[order], block[order]

    def apart(x, y):
        return (native[x] | native[y]) & ((block[x] != block[y]) | (block.min() == block.max()))

    x, y, most = _close(sizes, [sketches[k] for k in order], labels, apart, percent)
    if forest and len(x):
        score = most * 1000 // np.maximum(sizes[x] + sizes[y] - most, 1)
        taken: list[int] = []
        left = np.arange(len(x))
        for _ in range(FORESTS):
            taken += left[_forest(x[left], y[left], score[left], labels)].tolist() if len(left) else []
            left = np.setdiff1d(np.arange(len(x)), taken)
        x, y = x[taken], y[taken]
    return list(zip(ids[x].tolist(), ids[y].tolist(), strict=True))


def _scan(opened: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Candidate pairs (a, b), a < b; ``opened`` has key, id, root, size and sketch."""
    # a little wider than the limit allows, so that linked sizes differ by one class at most, rounding included
    ratio = float(np.log(100 / percent)) * (1 + 1e-9) + 1e-9
    band = F.floor(F.log(F.col("size").cast("double")) / F.lit(ratio)).cast("long")
    posted = opened.withColumn("native", band).withColumn("band", F.explode(F.array(F.col("native"), F.col("native") + 1)))
    posted = posted.withColumn("native", F.col("native") == F.col("band"))
    counts = posted.groupBy("key", "band").agg(F.count("*").alias("members"), F.max("native").alias("any"))
    counts = stored(counts.where("any and members > 1").select("key", "band", "members"), "cell-sizes")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    cells = posted.join(counts, ["key", "band"]).withColumn("blocks", blocks)
    cells = cells.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        "key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "native", "id", "root", "size", "sketch",
    )

    def pairs(batches):
        held, cell = [], None

        def flush():
            if len(held) < 2:
                return None
            _, _, _, _, own, native, ids, roots, sizes, sketches = zip(*held, strict=True)
            columns = (np.array(c) for c in (ids, sizes, roots, native, own))
            found = _scan_list(*columns, sketches, percent, forest)
            if not found:
                return None
            a, b = np.array(found).T
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for batch in batches:
            for row in zip(*(batch[c] for c in batch.columns), strict=True):
                if row[:4] != cell:
                    made = flush()
                    if made is not None:
                        yield made
                    held, cell = [], row[:4]
                held.append(row)
        made = flush()
        if made is not None:
            yield made

    ordered = cells.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j")
    return ordered.mapInPandas(pairs, "a long, b long").distinct()


def _verified(pairs: DataFrame, contents: DataFrame, exact: Callable[[str], set], percent: int) -> DataFrame:
    @F.pandas_udf("boolean")
    def same(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        last, a = None, set()
        for left, right in zip(x, y, strict=True):
            if left is not last:
                last, a = left, exact(left)
            b = exact(right)
            both = len(a & b)
            out.append(both > 0 and reaches(both, len(a), len(b), percent))
        return pd.Series(out, dtype=bool)

    one = contents.select(F.col("id").alias("a"), F.col("content").alias("content_a"))
    two = contents.select(F.col("id").alias("b"), F.col("content").alias("content_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    return both.where(same("content_a", "content_b")).select("a", "b")


def _open(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings of the keys whose members are not yet in one component, with the root."""
    known = postings.join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    known = known.withColumn("root", F.coalesce("root", "id"))
    keys = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    keys = stored(keys.where("low < high").select("key"), "open-keys")
    return stored(known.join(keys, "key"), "open-postings")


def distinct_lists(postings: DataFrame) -> DataFrame:
    """(key, members) of the keys with two members or more, one key of those with equal members.

    Lists count as equal when number, least, greatest and 120 hash bits agree."""
    digests = [F.sum(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40))).alias(f"digest_{seed}") for seed in range(3)]
    lists = postings.groupBy("key").agg(F.count("*").alias("members"), F.min("id").alias("low"), F.max("id").alias("high"), *digests)
    same = ["members", "low", "high", *(f"digest_{seed}" for seed in range(3))]
    return lists.where("low < high").groupBy(*same).agg(F.min("key").alias("key")).select("key", "members")


def _short_pairs(postings: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """All pairs of the short lists that the bound allows; ``postings`` have sizes."""
    one, two = (postings.select("key", F.col("id").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    near = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    pairs = one.join(two, "key").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()

    @F.pandas_udf("boolean")
    def within(size_a: pd.Series, one: pd.Series, size_b: pd.Series, two: pd.Series) -> pd.Series:
        out = []
        for a, p, b, q in zip(size_a, one, size_b, two, strict=True):
            width = min(len(p), len(q))
            bits = int(np.bitwise_count(_folded(p, width) ^ _folded(q, width)).sum())
            out.append(reaches((a + b - max(bits, abs(a - b))) // 2, a, b, percent))
        return pd.Series(out, dtype=bool)

    one = profiles.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("sketch_a"))
    two = profiles.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("sketch_b"))
    both = stored(pairs, "short-pairs").join(one, "a").join(two, "b")
    return both.where(within("size_a", "sketch_a", "size_b", "sketch_b")).select("a", "b")


def profiles_of(contents: DataFrame, hashes: Callable[[list[str]], Iterable[np.ndarray]], bits_each: int = 1) -> DataFrame:
    """(id, size, sketch); ``hashes`` gives the distinct 64-bit hashes of each content's set."""

    def profiled(batches):
        for batch in batches:
            found = list(hashes(batch["content"].tolist()))
            yield pd.DataFrame({"id": batch["id"], "size": [len(h) for h in found], "sketch": [sketch(h, bits_each) for h in found]})

    return contents.select("id", "content").mapInPandas(profiled, "id long, size int, sketch binary")


def link_components(
    postings: DataFrame,
    contents: DataFrame,
    profiles: DataFrame,
    hashes: Callable[[list[str]], Iterable[np.ndarray]],
    exact: Callable[[str], set],
    percent: int,
) -> tuple[DataFrame, DataFrame]:
    """(components (node, root), verified spanning links (a, b): enough to join the components, not every link).

    ``postings`` (key, id, size, members) are those of ``distinct_lists``;
    ``profiles`` has id, size and sketch of each content's set, ``hashes`` its
    64-bit hashes and ``exact`` the set itself.
    """
    short = _short_pairs(postings.where(F.col("members") <= SHORT), profiles, percent)
    lists = stored(postings.where(F.col("members") > SHORT).select("key", "id"), "long-lists")
    alone = lists.withColumn("root", F.col("id")).join(profiles, "id")
    near = stored(short.union(_scan(alone, percent, forest=True)).distinct(), "near-pairs")
    links = stored(_verified(near, contents, exact, percent), "links")
    roots = stored(components(links, "a", "b"), "roots")
    opened = _open(lists, roots)
    if not opened.isEmpty():
        involved = contents.join(opened.select("id").distinct(), "id")
        wide = stored(profiles_of(involved, hashes, WIDE), "wide-sketches")
        pairs = stored(_scan(opened.join(wide, "id"), percent, forest=False), "scan-pairs")
        more = stored(_verified(pairs, contents, exact, percent), "more-links")
        links = links.union(more)
        roots = stored(merged(roots, more, "a", "b"), "roots")
    return roots, links
