"""Hard negatives against brute force on integers, dirty rows included."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
from parcelworks.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row long, cell int, score long, id long"


def brute(rows):
    """Every result row, from the definition."""
    rows = [(i, v, lab) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows]
    out = []
    for a, (i, v, lab) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0, other) for b, (j, w, other) in enumerate(rows) if b != a]
        scored.sort()
        for p, no_id, j, _ in [s for s in scored if s[3] == lab][:5]:
            inside = [s for s in scored if s[3] != lab and 30 * -p <= 100 * -s[0] <= 90 * -p]
            for rank, (s, none, n, _) in enumerate(inside[:10], 1):
                out.append((i, None if no_id else j, rank, None if none else n, -p, -s))
    return sorted(out, key=str)


def make_rows(n=700, width=6, seed=3):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([rng.uniform(-1, 1), 0.25, -0.5]) for _ in range(width)], rng.choice([0, 1, 1, 1, 2])) for k in range(n)]
    rows += [(100, [0.25] * width, 1), (200, [0.0] * width, 2), (7, None, 1), (8, [0.1] * width, None), (None, [0.5] * width, 1)]
    rows += [(900, [float("nan")] * width, 1), (901, [float("inf")] + [0.0] * (width - 1), 1), (902, [None] * width, 0)]
    rows += [(1000, [0.5, -0.5], 2), (1001, [], 0), (1100, [-0.3] * width, 9), (300, [0.25] * width, 1), (300, [0.25] * width, 1)]
    return rows


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in hard_negatives.mine(frame).collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    rows = make_rows()
    want = brute(rows)
    assert len(want) > 300
    assert run(spark, rows) == want
    monkeypatch.setattr(hard_negatives, "_LEAST_ROWS", 40)  # many groups
    monkeypatch.setattr(hard_negatives, "_CELL_VALUES", 600)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 3)  # and shards
    assert run(spark, rows) == want


def test_large_values(spark):
    rng = random.Random(9)
    rows = [(k * 10, [rng.uniform(-1, 1) * 2.0 ** rng.randint(0, 18) for _ in range(4)], k % 3) for k in range(200)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(100, [1.0], 1)]) == []


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_threshold(data):
    n, width = data.draw(st.integers(1, 90)), data.draw(st.integers(1, 4))
    value = st.integers(-6, 6)
    codes = np.array(data.draw(st.lists(st.lists(value, min_size=width, max_size=width), min_size=n, max_size=n)), float)
    anchor = np.array(data.draw(st.lists(value, min_size=width, max_size=width)), float)
    allowed = np.array(data.draw(st.lists(st.booleans(), min_size=n, max_size=n)))
    low = data.draw(st.integers(-60, 60))
    windows = [(-(10**6), 10**6), (low, low + data.draw(st.integers(-3, 40)))]
    ids = np.column_stack([np.zeros(n, int), np.array(data.draw(st.permutations(range(n))))])
    scores = (codes @ anchor).astype(int)
    found = hard_negatives.Lists(codes, ids).top(anchor, allowed, windows, 4)
    for (lo, hi), got in zip(windows, found, strict=True):
        want = sorted((-scores[r], ids[r, 1], r) for r in range(n) if allowed[r] and lo <= scores[r] <= hi)[:4]
        assert got == [(r, -s) for s, _, r in want]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    import duckdb

    from parcelworks.llm import queries

    folder = f"/root/testdata/{sf}"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(duckdb.sql(hard_negatives.SQL).fetchall())
    found = sorted(tuple(r) for r in queries.QUERIES["op11_hard_negatives"](spark, folder).collect())
    assert found == want and found
