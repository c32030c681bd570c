"""Stored tables: measurements by image, and versioned tables of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumitrace.sources.sky_table import SkyTable

# Columns that hold a table's position, if it has one.
POSITIONS = (("wavg_ra", "wavg_dec"), ("ra", "dec"))


def read_measurements(spark: SparkSession, root: str, columns: list[str] | None = None, images: list[int] | None = None) -> DataFrame:
    """Measurements under `root`, partitioned by image; columns and images are pruned at the scan."""
    rows = spark.read.parquet(root)
    if images is not None:
        rows = rows.filter(F.col("image_id").isin(images))
    return rows.select(*columns) if columns else rows


def write_by_image(rows: DataFrame, root: str, mode: str = "append") -> None:
    """Write rows partitioned by image.

    Ranges of (image, id) spread one large image over several tasks and give
    a small image one file.
    """
    rows.repartitionByRange("image_id", "id").write.mode(mode).partitionBy("image_id").parquet(root)


class RunStore:
    """Tables of runs as immutable versions: `<root>/run=<run>/version=<n>/<table>`.

    Which version is current is a line in a pointer table. Going back is a
    new line, so nothing is overwritten and a failed write changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _dir(self, run: str, version: int) -> str:
        return f"{self.root}/run={run}/version={version}"

    def _pointers(self, run: str) -> str:
        return f"{self.root}/run={run}/pointers"

    def _exists(self, path: str) -> bool:
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)

    def _history(self, run: str) -> list[tuple[int, int]]:
        if not self._exists(self._pointers(run)):
            return []
        # One row per version ever made current.
        rows = self.spark.read.schema("step long, version long").parquet(self._pointers(run)).orderBy("step").collect()
        return [(r["step"], r["version"]) for r in rows]

    def _point(self, run: str, version: int) -> None:
        step = len(self._history(run)) + 1
        line = self.spark.range(1).select(F.lit(step).cast("long").alias("step"), F.lit(version).cast("long").alias("version"))
        line.write.mode("append").parquet(self._pointers(run))

    def current_version(self, run: str) -> int | None:
        history = self._history(run)
        return history[-1][1] if history else None

    def save(self, run: str, tables: dict[str, DataFrame]) -> int:
        """Write all tables, those with positions by sky, as the next version and make it current."""
        history = self._history(run)
        version = max((v for _, v in history), default=0) + 1
        for name, df in tables.items():
            pos = next((p for p in POSITIONS if set(p) <= set(df.columns)), None)
            path = f"{self._dir(run, version)}/{name}"
            if pos:
                SkyTable(self.spark, path).write(df, pos, mode="overwrite")
            else:
                df.write.mode("overwrite").parquet(path)
        self._point(run, version)
        return version

    def append_forced(self, run: str, forced: DataFrame, version: int | None = None) -> None:
        """Forced measurements of a run, by image."""
        version = version or self.current_version(run)
        write_by_image(forced, f"{self._dir(run, version)}/forced_measurements")

    def read(self, run: str, table: str, version: int | None = None) -> DataFrame:
        version = version or self.current_version(run)
        if version is None:
            raise KeyError(f"run {run} has no stored tables")
        stored = SkyTable(self.spark, f"{self._dir(run, version)}/{table}")
        return stored.rows() if stored.exists() else self.spark.read.parquet(stored.root)

    def cone(self, run: str, table: str, ra: float, dec: float, radius_deg: float, version: int | None = None) -> DataFrame:
        """Rows of a stored table with positions in a cone, from the files that hold that part of the sky."""
        version = version or self.current_version(run)
        stored = SkyTable(self.spark, f"{self._dir(run, version)}/{table}")
        if version is None or not stored.exists():
            raise KeyError(f"run {run} has no table {table} by sky")
        pos = next(p for p in POSITIONS if set(p) <= set(stored.rows().columns))
        return stored.cone(ra, dec, radius_deg, pos)

    def previous(self, run: str, table: str) -> DataFrame:
        """A table of the version before the current one."""
        version = self.current_version(run)
        if not version or version < 2:
            raise KeyError(f"run {run} has no earlier version")
        return self.read(run, table, version - 1)

    def restore(self, run: str) -> int:
        """Make the version before the current one current again."""
        version = self.current_version(run)
        if not version or version < 2:
            raise KeyError(f"run {run} has no earlier version")
        self._point(run, version - 1)
        return version - 1
