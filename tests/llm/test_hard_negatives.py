"""Hard negatives against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumitrace.llm import hard_negatives
from samples import generator


def vectors(spark, rows):
    """vec_id, label and embedding, with extra columns whose names the operator uses itself."""
    n = len(rows)
    table = pa.table(
        {
            "vec_id": pa.array([r[0] for r in rows], pa.int64()),
            "label": pa.array([r[1] for r in rows], pa.int32()),
            "embedding": pa.array([r[2] for r in rows], pa.list_(pa.float64())),
            "id": pa.array(["x"] * n),
            "spread": pa.array([1.5] * n),
            "anchor": pa.array([None] * n, pa.int64()),
            "score": pa.array([0] * n, pa.int64()),
        }
    )
    return spark.createDataFrame(table)


def floor256(x):
    return int(x) * 256 if abs(x) > 2**60 else math.floor(256 * x)


def expected(rows):
    used = {(i, l, tuple(v)) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, l, [floor256(x) for x in v]) for i, l, v in used]
    out = []
    for a, label, v in whole:
        if a % 100:
            continue
        met = [(max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), i, l) for i, l, w in whole if i != a]
        near = sorted((-s, i) for s, i, l in met if l == label)[:5]
        for p, (ps, pid) in enumerate(near, 1):
            ps = -ps
            window = sorted((-s, i) for s, i, l in met if l != label and 30 * ps <= 100 * s <= 90 * ps)[:10]
            out += [(a, pid, r, i, ps, -s, p) for r, (s, i) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    found = hard_negatives.mine(vectors(spark, rows).repartition(5), F.col("id") % 100 == 0, **kw)
    return sorted(map(tuple, found.collect()))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 9), st.integers(0, 2**32))
def test_strassen(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**28), 2**28, (m, k)), rng.integers(-(2**28), 2**28, (k, n))
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()
    assert (hard_negatives.products(a, np.ascontiguousarray(b.T)) == a @ b).all()


@pytest.mark.parametrize("sizes", [(1024, 8192), (3, 50)])
def test_against_brute_force(spark, sizes):
    rng = generator(12)
    rows = [(i, rng.randrange(4), [rng.gauss(0.2, 1) for _ in range(37)]) for i in range(0, 1500, 3)]
    # Ties, repeated rows, one id with two vectors, negative ids.
    rows += [(5000 + k, k % 3, [0.5] * 37) for k in range(40)] + rows[:30] + [(300, 1, [0.25] * 37), (-100, 2, [0.5] * 37)]
    assert mined(spark, rows, sizes=sizes) == expected(rows)


def test_rows_that_take_no_part_and_odd_lengths(spark):
    rng = generator(13)
    nan, inf = float("nan"), float("inf")
    rows = [(k, k % 2, [1.0 + rng.random(), rng.random()]) for k in range(60)]
    rows += [(100, None, [1.0, 1.0]), (200, 0, None), (300, 0, [1.0, None]), (400, 0, [nan, 1.0]), (500, 0, [inf, 1.0]), (None, 0, [1.0, 1.0])]
    rows += [(600, 0, []), (700, 1, [1.0]), (800, 0, [1.0, 0.5, 2.0]), (900, 1, [0.0, 0.0])]
    assert mined(spark, rows) == expected(rows)


def test_numbers_beyond_64_bits(spark):
    rng = generator(14)
    rows = [(k, k % 2, [rng.choice([1e300, -1e300, 1e17, 3.0, 1e9, 1e5]) * rng.random(), 1.0]) for k in range(0, 400, 5)]
    found = mined(spark, rows)
    assert found == expected(rows) and found


def test_few_rows(spark):
    assert mined(spark, [(0, 1, [1.0])]) == []
    assert hard_negatives.mine(vectors(spark, [(0, 1, [1.0])]).limit(0), F.col("id") % 100 == 0).collect() == []
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (3, 2, [-0.5])]
    assert mined(spark, rows) == expected(rows) == [(0, 1, 1, 2, 65536, 32768, 1)]
