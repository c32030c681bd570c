"""Pixels of images stored by tile, so that a lookup reads only the tiles it needs.

A tile is a square of pixels of one image and a partition of the stored table,
under one key, as Spark prunes by each partition column on its own. Lookups name
the boxes they need; the tiles those touch are met with the stored table by that
key, and the others are pruned at the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumitrace.workspace import materialize

SIZE = 256
#: Tiles that are broadcast to prune by: some 40 bytes each. More are joined by shuffle, as most of the table is asked for then.
BROADCAST_TILES = 250_000
#: Tiles, and so files, that one task writes; AQE looks at bytes, and would have one task write them all.
TILES_PER_TASK = 128


class PixelTiles:
    def __init__(self, spark: SparkSession, root: str, size: int = SIZE):
        """`size` is the side of a tile in pixels, the same whenever the folder is opened."""
        self.spark, self.root, self.size = spark, root.rstrip("/"), size

    def _tile(self, i: Column, j: Column) -> Column:
        return F.concat_ws("_", F.col("image_id").cast("string"), i.cast("string"), j.cast("string")).alias("tile")

    def write(self, pixels: DataFrame, mode: str = "append") -> None:
        """Store pixels (image_id, i, j, value); a tile goes to one file."""
        place = self._tile(F.floor(F.col("i") / self.size), F.floor(F.col("j") / self.size))
        tiled = pixels.select("image_id", "i", "j", "value", place)
        tasks = math.ceil(tiled.select("tile").distinct().count() / TILES_PER_TASK)
        tiled.repartition(max(tasks, 1), "tile").write.mode(mode).partitionBy("tile").parquet(self.root)

    def near(self, boxes: DataFrame) -> DataFrame:
        """Pixels (image_id, i, j, value) of all tiles that boxes (image_id, i, j, half) touch."""
        span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - F.col("half")) / self.size), F.floor((F.col(c) + F.col("half")) / self.size)))
        some = boxes.filter("i IS NOT NULL AND j IS NOT NULL").select("image_id", "j", "half", span("i").alias("ti")).select("image_id", "ti", span("j").alias("tj"))
        wanted = materialize(some.distinct().select("ti", "tj", self._tile(F.col("ti"), F.col("tj"))), "tiles")
        # Spark prunes by a join whose other side is filtered; images have no pixels below 0.
        side = wanted.filter("ti >= 0 AND tj >= 0")
        if side.count() <= BROADCAST_TILES:
            side = F.broadcast(side)
        rows = self.spark.read.schema("image_id long, i long, j long, value double, tile string").parquet(self.root)
        return rows.join(side.select("tile"), "tile").select("image_id", "i", "j", "value")
