"""The bounds of the linking engine never hide a link, and near misses do not leave the scan."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelworks.llm import linking
from parcelworks.llm.shingles import shingle_set


def hashed(members):
    return np.array(sorted(hash((x, "salt")) & (2**64 - 1) for x in members), np.uint64)


def scan(sets, percent, roots=None, forest=False, native=None, block=None, bits=1):
    n = len(sets)
    return linking._scan_list(
        np.arange(n), np.array([len(s) for s in sets]), np.array(roots if roots is not None else range(n)),
        np.ones(n, bool) if native is None else np.array(native), np.zeros(n, int) if block is None else np.array(block),
        [linking.sketch(hashed(s), bits) for s in sets], percent, forest,
    )


def linked(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([50, 80, 90, 100]), st.sampled_from([1, 8]))
def test_no_link_is_lost(seed, percent, bits):
    rng = random.Random(seed)
    base = set(range(rng.randint(1, 700)))
    sets = []
    for _ in range(rng.randint(2, 25)):
        own = set(rng.sample(sorted(base), max(1, int(len(base) * rng.uniform(0.7, 1)))))
        sets.append(own | {rng.randint(10**6, 10**7) for _ in range(rng.randint(0, 40))})
    roots = [rng.randint(0, 5) for _ in sets]
    found = {tuple(sorted(p)) for p in scan(sets, percent, roots, bits=bits)}
    assert all(roots[a] != roots[b] for a, b in found)
    for a in range(len(sets)):
        for b in range(a):
            if roots[a] != roots[b] and linked(sets[a], sets[b], percent):
                assert (b, a) in found


def test_blocks_and_classes():
    sets = [set(range(50)) | {100 + k} for k in range(12)]
    block = [k % 2 for k in range(12)]
    native = [k % 3 > 0 for k in range(12)]
    found = {tuple(sorted(p)) for p in scan(sets, 80, native=native, block=block)}
    assert found == {(a, b) for b in range(12) for a in range(b) if block[a] != block[b] and (native[a] or native[b])}


@pytest.mark.parametrize("words, changed", [(300, 6), (3000, 60), (300, 9)])
def test_near_misses_stay_in_the_task(words, changed):
    """Texts of one origin with a similarity below the limit, and unrelated long texts, make no pairs."""
    rng = random.Random(words)
    origin = [f"w{rng.random()}" for _ in range(words)]
    sets = []
    for _ in range(60):
        own = list(origin)
        for place in rng.sample(range(words), changed):
            own[place] = f"x{rng.random()}"
        sets.append(shingle_set(" ".join(own), 5))
    n = len(sets)
    true = sum(linked(set(sets[a].tolist()), set(sets[b].tolist()), 80) for a in range(n) for b in range(a))
    arguments = (np.arange(n), np.array([len(s) for s in sets]), np.arange(n), np.ones(n, bool), np.zeros(n, int))
    found = linking._scan_list(*arguments, [linking.sketch(s, linking.WIDE) for s in sets], 80, False)
    assert true == 0 and len(found) <= n
    other = [np.array(rng.sample(range(2**62), 4000), np.uint64) for _ in range(40)]
    arguments = (np.arange(40), np.full(40, 4000), np.arange(40), np.ones(40, bool), np.zeros(40, int))
    assert linking._scan_list(*arguments, [linking.sketch(s) for s in other], 80, False) == []


def test_equal_lists_are_scanned_once(spark):
    rows = [(key, member, 5) for key, members in enumerate(([1, 2, 3], [1, 2, 3], [1, 2], [4], [1, 2, 3, 3], [2, 3, 1])) for member in members]
    found = linking.distinct_lists(spark.createDataFrame(rows, "key long, id long, size int")).collect()
    assert sorted((r.key, r.members) for r in found) == [(0, 3), (2, 2), (4, 4)]
