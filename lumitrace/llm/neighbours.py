"""Approximate nearest neighbours: an NN-descent graph, searched greedily.

Equal vectors are one node. The first graph comes from PROJECTIONS random
directions: nodes are sorted along one, and those in a block of BLOCK compared
with each other. A round of NN-descent then sends every node's neighbours, and
the nodes it is a neighbour of (up to JOINED together, new ones first), to the
node, compares them there, and lets each keep the DEGREE nearest it has met.
Rounds end when few edges change. All of this is joins and shuffles of rows of
bounded size. Vectors travel as single floats if that is what they are, else as
doubles, and are compared in double precision; ties go by a hash of the pair, so
that equally near nodes do not all link to the same few.

A query starts at its own node, if it has one, and at a few entry nodes, and
keeps the WIDTH nearest nodes it has met. Each step looks at the neighbours of
all those not yet looked at, for all queries in one join, until no query has
any left. Nodes found are ranked anew in double precision on original vectors.

Defined results: rows with NULL ids, and vectors that are NULL, empty, zero or
hold NULL or non-finite components, take no part, nor do vectors of another
length than most (ties: the shorter); a row repeated with its id counts once;
with fewer candidates than asked for all that are reachable are returned; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

DEGREE = 20
JOINED = 48
#: Rows that a task compares at once; those of one node stay together.
MEETING_ROWS = 8192
#: Best partners that a node learns of in one comparison.
PARTNERS = 8
PROJECTIONS, BLOCK = 6, 512
ROUNDS = 5
#: Rounds end when less than this part of all edges is new.
SETTLED = 0.01
#: Links of a node that the search follows.
LINKS = 128
WIDTH = 400
STEPS = 12
ENTRIES = 4


def prepared(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (doubles as bytes) and node of every row that takes part, each pair once."""

    def pack(batches):
        for batch in batches:
            ids, vecs = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                if i is None or not v or any(x is None for x in v):
                    continue
                a = np.array(v, dtype="<f8") + 0.0
                if np.isfinite(a).all() and a.any():
                    ids.append(i)
                    vecs.append(a.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())], names=["vec_id", "vec"])

    packed = frames.arrow_map(rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")), pack, "vec_id long, vec binary")
    packed = materialize(packed.distinct().withColumn("node", F.xxhash64("vec")), "vectors")
    usual = packed.groupBy(F.length("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    return packed.filter(F.length("vec") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def _precision(vectors: DataFrame) -> str:
    """The smallest of single and double floats that holds every vector as it is."""

    @F.arrow_udf("boolean")
    def loses(column: pa.Array) -> pa.Array:
        with np.errstate(over="ignore"):
            return pa.array([bool((v.astype("<f4").astype("<f8") != v).any()) for v in (np.frombuffer(x, "<f8") for x in column.to_pylist())], pa.bool_())

    frames.ship(vectors.sparkSession)
    return "<f4" if vectors.filter(loses("vec")).isEmpty() else "<f8"


def _as(kind: str):
    def convert(column: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in _matrix(column, "<f8").astype(kind)] if len(column) else [], pa.binary())

    return convert


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of each matrix of a stack, taken from its middle so that a common offset does not count."""
    x = x - x.mean(axis=-2, keepdims=True)
    own = np.einsum("...ij,...ij->...i", x, x)
    return np.maximum(own[..., :, None] + own[..., None, :] - 2 * x @ np.swapaxes(x, -1, -2), 0)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows from their own differences."""
    return ((x - y) ** 2).sum(axis=-1)


EDGES = "node long, nbr long, d double"


def _edge_batch(node, nbr, d) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(nbr, pa.int64()), pa.array(d, pa.float64())], names=["node", "nbr", "d"])


def _block_neighbours(degree: int, precise: str):
    def compare(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        x = x.astype(np.float64)
        d = _squares(x)
        np.fill_diagonal(d, np.inf)
        k = min(degree, len(ids) - 1)
        best = np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), int)
        rows = np.repeat(np.arange(len(ids)), k)
        return _edge_batch(ids[rows], ids[best.ravel()], _apart(x[rows], x[best.ravel()]))

    def blocks(batches):
        ids, vecs = np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = _matrix(batch.column("point"), precise)
            ids, vecs = np.append(ids, batch.column("node").to_numpy()), more if vecs is None else np.concatenate((vecs, more))
            while len(ids) >= 2 * BLOCK:
                yield compare(ids[:BLOCK], vecs[:BLOCK])
                ids, vecs = ids[BLOCK:], vecs[BLOCK:]
        if len(ids):
            yield compare(ids, vecs)

    return blocks


def _local_joins(precise: str):
    """Rows (at, node, radius, fresh, point) sorted by `at`: partners that the nodes meeting at one place learn of."""

    def compare(at, node, radius, fresh, x):
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sizes = np.diff(np.append(starts, len(at)))
        for lo in range(0, len(starts), 256):
            s, n = starts[lo : lo + 256], sizes[lo : lo + 256]
            m = int(n.max())
            if m < 2:
                continue
            place = np.minimum(s[:, None] + np.arange(m), len(at) - 1)
            real = np.arange(m) < n[:, None]
            d = _squares(x[place].astype(np.float64))
            new = fresh[place]
            allowed = real[:, :, None] & real[:, None, :] & (new[:, :, None] | new[:, None, :]) & (d < radius[place][:, :, None])
            allowed &= ~np.eye(m, dtype=bool)
            d = np.where(allowed, d, np.inf)
            k = min(PARTNERS, m - 1)
            best = np.argpartition(d, k - 1, axis=2)[:, :, :k]
            value = np.take_along_axis(d, best, axis=2)
            g, i, j = np.nonzero(np.isfinite(value))
            one, other = place[g, i], place[g, best[g, i, j]]
            yield _edge_batch(node[one], node[other], _apart(x[one].astype(np.float64), x[other].astype(np.float64)))

    def joins(batches):
        held, waiting, n = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "node", "radius", "fresh")] + [_matrix(batch.column("point"), precise)])
            n += batch.num_rows
            if n < MEETING_ROWS:
                continue
            held = [np.concatenate(parts) for parts in zip(*([held] if held else []), *waiting)]
            waiting, n = [], 0
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield from compare(*[a[:cut] for a in held])
                held = [a[cut:] for a in held]
        if waiting:
            held = [np.concatenate(parts) for parts in zip(*([held] if held else []), *waiting)]
        if held is not None and len(held[0]):
            yield from compare(*held)

    return joins


def _nearest(edges: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of every key; Spark drops the others before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return edges.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def build_graph(vectors: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """node, nbr, d of the NN-descent graph over the nodes of `prepared` rows."""
    spark = vectors.sparkSession
    frames.ship(spark)
    precise = _precision(vectors)
    point = F.arrow_udf(_as(precise), "binary")
    nodes = vectors.groupBy("node").agg(F.first("vec").alias("vec"))

    @F.arrow_udf("array<float>")
    def project(column: pa.Array) -> pa.Array:
        x = _matrix(column, "<f8") if len(column) else np.zeros((0, 1))
        lines = np.random.default_rng(5).standard_normal((x.shape[1], PROJECTIONS))
        return pa.array(list((x @ lines).astype(np.float32)), pa.list_(pa.float32()))

    nodes = materialize(nodes.select("node", point("vec").alias("point"), project("vec").alias("along")), "nodes")
    n = nodes.count()
    parts = max(1, n // (8 * BLOCK))
    found = None
    for t in range(PROJECTIONS):
        sorted_ = nodes.select("node", "point", F.col("along")[t].alias("p")).repartitionByRange(parts, "p", "node").sortWithinPartitions("p", "node")
        one = frames.arrow_map(sorted_.select("node", "point"), _block_neighbours(degree, precise), EDGES)
        found = one if found is None else found.unionByName(one)
    first = found.groupBy("node", "nbr").agg(F.min("d").alias("d"))
    edges = materialize(_nearest(first, ["node"], ["d", F.xxhash64("node", "nbr")], degree).withColumn("fresh", F.lit(True)), "graph")
    for _ in range(rounds):
        ends = edges.select(F.col("node").alias("at"), F.col("nbr").alias("node"), "d", "fresh")
        back = edges.select(F.col("nbr").alias("at"), "node", "d", "fresh")
        met = ends.unionByName(back).groupBy("at", "node").agg(F.min("d").alias("d"), F.max("fresh").alias("fresh"))
        met = _nearest(met, ["at"], [F.desc("fresh"), "d", F.xxhash64("at", "node")], JOINED).drop("d")
        worst = edges.groupBy("node").agg(F.when(F.count(F.lit(1)) >= degree, F.max("d")).otherwise(F.lit(float("inf"))).alias("radius"))
        info = nodes.select("node", "point").join(worst, "node", "left").select("node", "point", F.coalesce("radius", F.lit(float("inf"))).alias("radius"))
        here = met.join(info, "node").select("at", "node", "radius", "fresh", "point").repartition("at").sortWithinPartitions("at")
        learned = frames.arrow_map(here, _local_joins(precise), EDGES).groupBy("node", "nbr").agg(F.min("d").alias("d"))
        both = edges.select("node", "nbr", "d", F.lit(False).alias("fresh")).unionByName(learned.withColumn("fresh", F.lit(True)))
        both = both.groupBy("node", "nbr").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
        edges = materialize(_nearest(both, ["node"], ["d", F.xxhash64("node", "nbr")], degree), "graph")
        if edges.filter("fresh").count() < SETTLED * degree * n:
            break
    return edges.drop("fresh")


def _distances(precise: str):
    def between(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.float64())
        x, y = _matrix(a, precise).astype(np.float64), _matrix(b, precise).astype(np.float64)
        return pa.array(np.sqrt(((x - y) ** 2).sum(axis=1)))

    return between


def search(vectors: DataFrame, graph: DataFrame, queries: DataFrame, k: int, width: int = WIDTH, steps: int = STEPS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of other ids. `queries`: vec_id, vec, node as `prepared` gives them."""
    spark = vectors.sparkSession
    frames.ship(spark)
    precise = _precision(vectors)
    point = F.arrow_udf(_as(precise), "binary")
    near = F.arrow_udf(_distances(precise), "double")
    exact = F.arrow_udf(_distances("<f8"), "double")
    points = materialize(vectors.groupBy("node").agg(F.first("vec").alias("vec")).select(F.col("node").alias("nbr"), point("vec").alias("point")), "points")
    # All links of a node's own, then those of nodes that point at it, the nearest first.
    back = graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "d", F.lit(1).alias("turn"))
    both = graph.select("node", "nbr", "d", F.lit(0).alias("turn")).unionByName(back).groupBy("node", "nbr").agg(F.min("turn").alias("turn"), F.min("d").alias("d"))
    links = materialize(_nearest(both, ["node"], ["turn", "d", F.xxhash64("node", "nbr")], LINKS).select("node", "nbr"), "links")
    asked = materialize(queries.select(F.col("node").alias("q"), "vec").groupBy("q").agg(F.first("vec").alias("vec")).select("q", point("vec").alias("asked")), "asked")
    entries = [r["nbr"] for r in points.orderBy(F.xxhash64("nbr")).select("nbr").limit(ENTRIES).collect()]
    if not entries:
        return queries.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    starts = F.array_distinct(F.array(F.col("q"), *[F.lit(e) for e in entries]))
    todo = asked.select("q", F.explode(starts).alias("nbr"))
    pool, seen = None, None
    for _ in range(steps):
        met = todo.join(points, "nbr").join(asked, "q").select("q", F.col("nbr").alias("node"), near("point", "asked").alias("d"), F.lit(True).alias("fresh"))
        pool = met if pool is None else pool.withColumn("fresh", F.lit(False)).unionByName(met)
        pool = materialize(_nearest(pool, ["q"], ["d", F.xxhash64("q", "node")], width), "pool")
        now = todo.select("q", "nbr")
        seen = materialize(now if seen is None else seen.unionByName(now), "seen")
        following = pool.filter("fresh").select("q", "node").join(links, "node").select("q", "nbr").distinct()
        todo = materialize(following.join(seen, ["q", "nbr"], "left_anti"), "todo")
        if todo.isEmpty():
            break
    # Each node stands for its first k + 1 ids: among equal vectors only these can be in a result.
    members = _nearest(vectors, ["node"], ["vec_id"], k + 1)
    # Ties are by id in the result, so some more are ranked anew.
    close = _nearest(pool, ["q"], ["d", F.xxhash64("q", "node")], 3 * k)
    found = queries.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q"), F.col("vec").alias("own")).join(close.select("q", "node"), "q")
    found = found.join(members, "node").filter("query_id <> vec_id").select("query_id", "vec_id", exact("own", "vec").alias("score"))
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest found for each row that `is_query` (over vec_id) takes."""
    vectors = prepared(rows, id_col, vector)
    return search(vectors, build_graph(vectors), vectors.filter(is_query), k)
