"""Nearest neighbours against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumitrace.llm import neighbours


def table(spark, rows):
    return spark.createDataFrame(pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "node": pa.array(["x"] * len(rows)), "d": pa.array([1] * len(rows))}))


def brute(rows, query, k):
    own = dict(rows)[query]
    d = sorted((float(np.sqrt(((np.float64(v) - np.float64(own)) ** 2).sum())), i) for i, v in rows if i != query)
    return [(i, s) for s, i in d[:k]]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out = neighbours.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, 10).collect()
    hits = 0
    for q in range(0, 1500, 50):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        real = brute(rows, q, 10)
        hits += len({i for i, _ in real} & {m[1] for m in mine})
        exact = dict(brute(rows, q, 1500))
        assert all(abs(exact[m[1]] - m[2]) < 1e-12 for m in mine)
    assert hits >= 0.95 * 300


def test_few_rows_odd_rows_and_copies(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(4)]
    copies = [(100 + i, good[1][1]) for i in range(40)]
    odd = [(50, None), (51, []), (52, [0.0] * 4), (53, [1.0, None, 2.0, 3.0]), (54, [float("nan")] * 4), (55, [float("inf"), 0, 0, 0]), (56, [1.0, 2.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows = good + copies
    out = neighbours.nearest(table(spark, rows + odd + [good[2]]), F.col("vec_id") < 60, 10).collect()
    assert {r["query_id"] for r in out} == {0, 1, 2, 3}
    for q in range(4):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q)
        assert [(m[1], m[2]) for m in mine] == brute(rows, q, 10)
    few = neighbours.nearest(table(spark, good + odd), F.col("vec_id") == 0, 10).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in few) == [(k + 1, i) for k, (i, _) in enumerate(brute(good, 0, 10))]
    assert neighbours.nearest(table(spark, good).limit(0), F.col("vec_id") == 0, 10).count() == 0


@pytest.mark.parametrize("scale, noise, offset", [(1, 3e-5, 0), (1e6, 1, 0), (1e-7, 1, 0), (1, 1, 1000)])
def test_recall_whatever_the_scale(spark, scale, noise, offset):
    rng = np.random.default_rng(3)
    middle = rng.standard_normal(24) / 5
    x = (scale * (offset + middle + noise * rng.standard_normal((600, 24)) / 5)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    graph = neighbours.build_graph(neighbours.prepared(table(spark, rows)))
    name = {r["node"]: r["vec_id"] for r in neighbours.prepared(table(spark, rows)).select("node", "vec_id").collect()}
    found = {}
    for r in graph.collect():
        found.setdefault(name[r["node"]], set()).add(name[r["nbr"]])
    hits = sum(len({i for i, _ in brute(rows, q, 10)} & found.get(q, set())) for q in range(0, 600, 20))
    assert hits >= 0.95 * 300
