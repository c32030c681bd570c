"""Files of images - measurements, forced measurements, whatever is kept per image - under a manifest.

Rows of a kind are written by image into a folder of the version that adds them
and never change. The manifest is a table of changes: which files a version
adds, and which it takes away. A version exists once its changes are written,
so a write that dies adds nothing, and every earlier version stays readable.
Reading joins the partitions of a kind with the manifest, which prunes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHANGES = "kind string, image_id long, written long, present boolean"


def globbed(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Paths that a list of file patterns stands for, in its order; those of one pattern sorted.

    A pattern without a match is an error: a run must not lose an input silently.
    """
    out = []
    for pattern in patterns:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        here = sorted(str(f.getPath().toUri().getPath()) for f in found or [])
        if not here:
            raise FileNotFoundError(f"no file matches {pattern!r}")
        out += here
    return out


def input_lists(spark: SparkSession, inputs: dict[str, list[str] | dict[str, list[str]]]) -> DataFrame:
    """Rows (epoch, kind, paths) of a run's inputs: per kind a list of patterns, or a map from epoch to such a list.

    Without epochs every list is of the epoch ''. What is on the driver is the run's configuration.
    """
    rows = []
    for kind, given in inputs.items():
        for epoch, patterns in (given.items() if isinstance(given, dict) else [("", given)]):
            rows.append((epoch, kind, globbed(spark, patterns)))
    return spark.createDataFrame(rows, "epoch string, kind string, paths array<string>")


class FileManifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        """Versions whose changes are complete."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/version=*/_SUCCESS")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(int(str(f.getPath()).split("/version=")[1].split("/")[0]) for f in found or [])

    def _next(self) -> int:
        return max(self.versions(), default=0) + 1

    def _commit(self, version: int, changes: DataFrame) -> int:
        changes.select("kind", "image_id", "written", "present").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")
        return version

    def append(self, kind: str, rows: DataFrame) -> int:
        """Add the files of some images (`image_id`) as a new version; earlier files of these images stay."""
        version = self._next()
        path = f"{self.root}/files/kind={kind}/written={version}"
        # What a write that died has left under this number is written over.
        rows.repartitionByRange("image_id", "id").write.mode("overwrite").partitionBy("image_id").parquet(path)
        images = rows.select(F.col("image_id").cast("long").alias("image_id")).distinct()
        return self._commit(version, images.withColumns({"kind": F.lit(kind), "written": F.lit(version).cast("long"), "present": F.lit(True)}))

    def remove(self, kind: str, images: DataFrame) -> int:
        """Take the files of some images (`image_id`) out, as a new version."""
        here = self.files(kind).join(images.select("image_id").distinct(), "image_id", "left_semi")
        return self._commit(self._next(), here.select("kind", "image_id", "written", F.lit(False).alias("present")))

    def files(self, kind: str | None = None, version: int | None = None) -> DataFrame:
        """kind, image_id, written and path of the files of a version; the last one by default."""
        known = [v for v in self.versions() if version is None or v <= version]
        if version is not None and version not in known:
            raise KeyError(f"no version {version}")
        if not known:
            return self.spark.createDataFrame([], "kind string, image_id long, written long, path string")
        paths = [f"{self.root}/manifest/version={v}" for v in known]
        changes = self.spark.read.schema(f"{_CHANGES}, version long").option("basePath", f"{self.root}/manifest").parquet(*paths)
        if kind is not None:
            changes = changes.filter(F.col("kind") == kind)
        last = changes.groupBy("kind", "image_id", "written").agg(F.max_by("present", "version").alias("present")).filter("present")
        path = F.format_string(f"{self.root}/files/kind=%s/written=%d/image_id=%d", "kind", "written", "image_id")
        return last.select("kind", "image_id", "written", path.alias("path"))

    def read(self, kind: str, version: int | None = None) -> DataFrame:
        """Rows of a kind in a version, with the version that wrote them (`written`)."""
        present = self.files(kind, version).select("image_id", "written")
        rows = self.spark.read.parquet(f"{self.root}/files/kind={kind}")
        rows = rows.withColumns({"image_id": F.col("image_id").cast("long"), "written": F.col("written").cast("long")})
        return rows.join(F.broadcast(present) if present.count() <= 100_000 else present, ["image_id", "written"], "left_semi")

    def previous(self, kind: str) -> DataFrame:
        """Rows of a kind in the version before the last."""
        known = self.versions()
        if len(known) < 2:
            raise KeyError("no earlier version")
        return self.read(kind, known[-2])
