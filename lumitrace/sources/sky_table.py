"""Tables stored in the order of the sky key, with the stretch of keys of every file.

A cone reads only files whose stretch meets its key ranges, and in these only
row groups that do. The list of files is a small table beside the rows; what a
cone needs of it reaches the driver, no more than the files it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumitrace.functions.sky import EDGE_DEG, separation
from lumitrace.operators.sky_curve import KEY, cone_ranges, in_ranges, sky_key

Position = tuple[str, str]


def sky_sorted(df: DataFrame, pos: Position, files: int | None = None) -> DataFrame:
    """Rows with their `sky_key`, ranges of it together and in order; the number of ranges is AQE's unless given."""
    keyed = df.withColumn(KEY, sky_key(*pos))
    ranged = keyed.repartitionByRange(files, KEY) if files else keyed.repartitionByRange(KEY)
    return ranged.sortWithinPartitions(KEY)


class SkyTable:
    """`<root>/rows` and `<root>/files`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, df: DataFrame, pos: Position = ("ra", "dec"), files: int | None = None, mode: str = "errorifexists") -> None:
        """Write `df`, which must not have a column `sky_key`. Rows without a position are kept; no cone finds them.

        The list of files is written last: without it there is no table.
        """
        if KEY in df.columns:
            raise ValueError(f"{KEY} is the name of the table's own key")
        sky_sorted(df, pos, files).write.mode(mode).parquet(f"{self.root}/rows")
        stored = self.spark.read.parquet(f"{self.root}/rows")
        ends = stored.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.min(KEY).alias("low"), F.max(KEY).alias("high"), F.count(F.lit(1)).alias("n"))
        ends.write.mode(mode).parquet(f"{self.root}/files")

    def exists(self) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/files/_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows").drop(KEY)

    def files(self) -> DataFrame:
        """name, low, high, n: a row per file."""
        return self.spark.read.parquet(f"{self.root}/files")

    def cone(self, ra_deg: float, dec_deg: float, radius_deg: float, pos: Position = ("ra", "dec")) -> DataFrame:
        """Rows of a cone (edge included) with their distance in arcsec, nearest first."""
        ranges = cone_ranges(ra_deg, dec_deg, radius_deg)
        paths = [f"{self.root}/rows/{r['name']}" for r in self.files().filter(in_ranges(ranges, "low", "high")).select("name").collect()]
        stored = self.spark.read.parquet(f"{self.root}/rows")
        found = self.spark.read.schema(stored.schema).parquet(*paths) if paths else stored.limit(0)
        sep = separation(*pos, F.lit(float(ra_deg)), F.lit(float(dec_deg)))
        near = found.filter(in_ranges(ranges)).withColumn("distance", sep * 3600.0).filter(sep <= radius_deg + EDGE_DEG)
        return near.drop(KEY).orderBy("distance")
