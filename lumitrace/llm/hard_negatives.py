"""Hard negatives of anchor vectors, from exact integer inner products.

Components become the integers floor(SCALE * x). Anchors and candidates are dealt
into blocks by a hash of the row; a tile is one block of each. In a task a tile's
anchors come first and its candidates stream past them, so memory is bounded by
ANCHORS rows and one batch of candidates, whatever the size of a block. Each step
multiplies the two by Strassen's recursion on 64-bit integers, odd sides padded
with zeros, down to sides of at most LEAF; only integer additions and products
occur, so every score is exact.

A first pass over the tiles keeps a heap of the best rows of the anchor's own
label, a second one a heap per positive of the best rows of other labels inside
its window of scores. Heaps of tiles merge by taking the best of both, which a
ranking per anchor does, the ranks being cut in every partition before they are
shuffled.

Where a tile holds numbers whose products could leave 64 bits it is multiplied in
Python's own integers; scores beyond a long are then held at its ends.

Defined results: rows take no part whose id, label or vector is NULL or whose
vector holds a NULL or non-finite component; a row repeated with id, label and
vector counts once; rows of an anchor's own id are never its candidates; vectors
of different lengths are filled up with zeros, an empty one is all zeros; fewer
positives or negatives than asked for are returned as they are, a positive
without a row in its window gives none; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (30, 90)
#: Rows of a block. Anchors of a tile are held at once, candidates are not.
ANCHORS, CANDIDATES = 1024, 8192
LEAF = 32

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _even(m: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """`m` with zeros below and to the right."""
    out = np.zeros((rows, columns), m.dtype)
    out[: m.shape[0], : m.shape[1]] = m
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices by seven products of their quarters."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    m, k, n = ((side + 1) // 2 for side in (rows, inner, columns))
    if (2 * m, 2 * k) != a.shape:
        a = _even(a, 2 * m, 2 * k)
    if (2 * k, 2 * n) != b.shape:
        b = _even(b, 2 * k, 2 * n)
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.zeros((2 * m, 2 * n), a.dtype)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11 += p
    c22 += p
    p = strassen(a21 + a22, b11, leaf)
    c21 += p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12 += p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c12 += p
    c11 -= p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:rows, :columns]


def integers(vectors: pa.Array) -> np.ndarray:
    """floor(SCALE * x) of every component, a row each: 64-bit integers, or Python's own where those are too narrow."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = bool(len(values)) and float(np.abs(values).max()) >= 2.0**54
    whole = np.array([_floor(x) for x in values], object) if wide else np.floor(SCALE * values).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), whole.dtype)
    out[np.arange(out.shape[1]) < lengths[:, None]] = whole
    return out


def _floor(x: float) -> int:
    # Doubles this large are whole numbers, and multiplying them first could overflow.
    return int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(SCALE * x)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of `a` with those of `b`, exact; held at the ends of a long."""
    wide = max(a.shape[1], b.shape[1])
    a, b = (_even(m, m.shape[0], wide) if m.shape[1] < wide else m for m in (a, b))
    # Sums inside the recursion may leave 64 bits and come back; only the result must fit.
    if a.dtype == b.dtype == np.int64:
        reach = [float(np.abs(m.astype(np.float64)).max(initial=0)) for m in (a, b)]
        if wide * reach[0] * reach[1] < 2.0**62:
            return strassen(a, np.ascontiguousarray(b.T))
    exact = strassen(a.astype(object), b.astype(object).T) if wide else np.zeros((len(a), len(b)), object)
    return np.clip(exact, _LOW, _HIGH).astype(np.int64)


class Heaps:
    """The best `size` of what each of some rows has met: higher scores first, ties by smaller id."""

    def __init__(self, rows: int, size: int):
        self.rows, self.size = rows, size
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(rows, _LOW)

    def meet(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Take in a column of candidates `ids` each; `scores` and `allowed` are rows x candidates."""
        at, column = np.nonzero(allowed & (scores >= self.least[:, None]))
        if len(at):
            self.merge(at, scores[at, column], ids[column])

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        # ~score orders as -score does and cannot overflow.
        order = np.lexsort((ids, ~score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        stay = place < self.size
        self.row, self.score, self.id = row[stay], score[order][stay], ids[order][stay]
        full = place[stay] == self.size - 1
        self.least[self.row[full]] = self.score[full]


def taking_part(rows: DataFrame, id_col: str, label_col: str, vector: str) -> DataFrame:
    """id, label (long), vec (doubles) and spread, a hash of all three; each row once."""
    used = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    used = used.filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    used = used.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return used.distinct().withColumn("spread", F.xxhash64("id", "label", "vec"))


def _tiles(anchors: DataFrame, used: DataFrame, sizes: tuple[int, int]) -> DataFrame:
    """Rows of every tile (i, j) in one task, anchors (side 0) before candidates. `anchors` has what candidates have, and `asked`."""
    n_anchors, n_rows = (max(1, math.ceil(df.count() / size)) for df, size in zip((anchors, used), sizes))
    own = anchors.withColumn("i", F.pmod("spread", F.lit(n_anchors)).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).withColumn("side", F.lit(0))
    met = used.withColumn("j", F.pmod("spread", F.lit(n_rows)).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1)))).withColumn("side", F.lit(1))
    met = met.withColumn("asked", F.lit(None).cast(dict(anchors.dtypes)["asked"]))
    columns = ["i", "j", "side", "id", "label", "vec", "spread", "asked"]
    laid = own.select(*columns).unionByName(met.select(*columns))
    return laid.repartition("i", "j").sortWithinPartitions("i", "j", "side")


_COLUMNS = ["anchor", "place", "id", "score"]


class _Tile:
    """The anchors of one tile and the heaps that its candidates fill."""

    def __init__(self, asking: str):
        self.asking, self.parts, self.heaps = asking, [], None

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def _start(self) -> None:
        held = pa.Table.from_batches(self.parts).combine_chunks()
        self.id, self.label = held["id"].to_numpy(), held["label"].to_numpy()
        self.anchor, self.vecs = held["spread"].to_numpy(), integers(_whole(held["vec"]))
        if self.asking == "positives":
            self.owner, self.key = np.arange(len(self.id)), np.zeros(len(self.id), np.int64)
            self.heaps = Heaps(len(self.id), POSITIVES)
        else:
            flat = [(at, a["place"], -(-WINDOW[0] * a["score"] // 100), WINDOW[1] * a["score"] // 100) for at, some in enumerate(held["asked"].to_pylist()) for a in some]
            self.owner = np.array([f[0] for f in flat], np.int64)
            self.key = np.array([f[1] for f in flat], np.int64)
            self.low, self.high = (np.array([max(f[k], _LOW) for f in flat], np.int64) for k in (2, 3))
            self.heaps = Heaps(len(flat), NEGATIVES)

    def meet(self, batch: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if self.heaps is None:
            self._start()
        ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        scores = products(self.vecs, integers(batch.column("vec")))
        same = self.label[:, None] == labels
        if self.asking == "positives":
            self.heaps.meet(scores, same & (self.id[:, None] != ids), ids)
        else:
            apart = ~same & (self.id[:, None] != ids)
            scores = scores[self.owner]
            self.heaps.meet(scores, apart[self.owner] & (scores >= self.low[:, None]) & (scores <= self.high[:, None]), ids)

    def found(self) -> pa.RecordBatch:
        if self.heaps is None:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=_COLUMNS)
        at = self.heaps.row
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.anchor[self.owner[at]], self.key[at], self.heaps.id, self.heaps.score)], names=_COLUMNS)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    chunk = column.combine_chunks()
    return chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk


def _fill(asking: str):
    """Tiles in order, the heaps of each at its end."""

    def run(batches):
        tile, key = None, None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("i", "j", "side")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                i, j, side = marks[:, lo].tolist()
                if key != (i, j):
                    if tile:
                        yield tile.found()
                    tile, key = _Tile(asking), (i, j)
                (tile.meet if side else tile.add)(batch.slice(lo, hi - lo))
        if tile:
            yield tile.found()

    return run


def _best(tiles: DataFrame, asking: str, size: int) -> DataFrame:
    """The heaps of all tiles merged: anchor, place, id, score and rank."""
    met = frames.arrow_map(tiles, _fill(asking), ", ".join(f"{c} long" for c in _COLUMNS))
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector: str = "embedding", sizes: tuple[int, int] = (ANCHORS, CANDIDATES)) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    `is_anchor` is a condition on `id`, the id as a long. `sizes` are rows of an anchor and a candidate block.
    """
    frames.ship(rows.sparkSession)
    used = materialize(taking_part(rows, id_col, label_col, vector), "candidates")
    anchors = materialize(used.filter(is_anchor), "anchors")

    plain = anchors.withColumn("asked", F.lit(None).cast("array<struct<place:long,score:long>>"))
    positives = _best(_tiles(plain, used, sizes), "positives", POSITIVES)
    positives = materialize(positives.select("anchor", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # POSITIVES windows of an anchor at most.
    asked = positives.groupBy(F.col("anchor").alias("spread")).agg(F.array_sort(F.collect_list(F.struct("place", F.col("positive_score").alias("score")))).alias("asked"))
    asking = materialize(anchors.join(asked, "spread"), "windows")
    negatives = _best(_tiles(asking, used, sizes), "negatives", NEGATIVES)
    named = positives.join(anchors.select(F.col("spread").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return negatives.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("place").cast("int").alias("positive_rank")
    )
