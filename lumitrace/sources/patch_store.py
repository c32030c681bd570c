"""Tables filed by sky patch that change in batches under a log of commits.

A batch writes folders of its own and then its line in the log, which is what
makes them visible: a batch that dies half way has changed nothing, and is
written over when it is run again. There are three kinds of table:

- *replaced*: a batch writes the patches it touched anew, whole. The log says
  which batch wrote the valid copy of each patch.
- *added*: rows of a batch are added to their patches and stay as they are.
- *plain*: rows of a batch, without patches.

A line of the log is a small table: the valid copies of replaced patches and
some numbers. Reading takes the last line, whatever the number of batches.
Only the patches asked for are listed and read. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumitrace.workspace import no_rows

_LINE = "kind string, name string, patch long, value long"


@dataclass(frozen=True)
class Commit:
    """What a reader sees."""

    batch: int
    copies: dict[str, dict[int, int]] = field(default_factory=dict)  # table -> patch -> batch that wrote it
    numbers: dict[str, int] = field(default_factory=dict)


class PatchStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- files

    def _found(self, pattern: str) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return [str(f.getPath()) for f in files or []]

    def _read(self, paths: list[str], schema: T.StructType | None) -> DataFrame:
        if paths:
            reader = self.spark.read.schema(schema) if schema else self.spark.read
            return reader.parquet(*paths)
        if schema is None:
            raise KeyError(f"nothing stored under {self.root}")
        return no_rows(self.spark, schema)

    # --- the log

    def last(self) -> Commit | None:
        """The last commit, None before the first."""
        batches = [int(p.split("/batch=")[1].split("/")[0]) for p in self._found("log/batch=*/_SUCCESS")]
        return self.commit_of(max(batches)) if batches else None

    def commit_of(self, batch: int) -> Commit:
        commit = Commit(batch)
        for r in self.spark.read.schema(_LINE).parquet(f"{self.root}/log/batch={batch}").collect():
            if r["kind"] == "copy":
                commit.copies.setdefault(r["name"], {})[r["patch"]] = r["value"]
            else:
                commit.numbers[r["name"]] = r["value"]
        return commit

    def commit(self, commit: Commit) -> None:
        """Make a batch visible; everything it wrote has to be there."""
        rows = [("copy", name, patch, batch) for name, copies in commit.copies.items() for patch, batch in copies.items()]
        rows += [("number", name, None, value) for name, value in commit.numbers.items()]
        line = self.spark.createDataFrame(rows, _LINE).coalesce(1)
        line.write.mode("overwrite").parquet(f"{self.root}/log/batch={commit.batch}")

    # --- tables

    def replace(self, name: str, rows: DataFrame, batch: int) -> list[int]:
        """Write whole patches (column `patch`) of a replaced table; returns the patches that have rows."""
        path = f"{self.root}/{name}/batch={batch}"
        rows.repartition("patch").write.mode("overwrite").partitionBy("patch").parquet(path)
        return sorted(int(p.rsplit("patch=", 1)[1]) for p in self._found(f"{name}/batch={batch}/patch=*"))

    def copies(self, name: str, schema: T.StructType, commit: Commit | None, patches: list[int] | None = None) -> DataFrame:
        """Rows of a replaced table, of all patches or of some; `schema` without `patch`."""
        valid = commit.copies.get(name, {}) if commit else {}
        wanted = valid if patches is None else [p for p in patches if p in valid]
        return self._read([f"{self.root}/{name}/batch={valid[p]}/patch={p}" for p in wanted], schema)

    def add(self, name: str, rows: DataFrame, batch: int) -> None:
        """Add the rows of a batch to their patches (column `patch`)."""
        placed = rows.withColumn("batch", F.lit(batch).cast("long")).repartition("patch")
        # Only the patches of this batch are written over, should it be run again.
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("patch", "batch").parquet(f"{self.root}/{name}")

    def added(self, name: str, schema: T.StructType, commit: Commit | None, patches: list[int] | None = None) -> DataFrame:
        """Rows added up to a commit, of all patches or of some; `schema` without `patch` and `batch`."""
        here = self._found(f"{name}/patch=*") if patches is None else [p for n in patches for p in self._found(f"{name}/patch={n}")]
        if commit is None or not here:
            return self._read([], schema)
        batched = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(batched).option("basePath", f"{self.root}/{name}").parquet(*here)
        return rows.filter(F.col("batch") <= commit.batch).select(*schema.fieldNames())

    def put(self, name: str, rows: DataFrame, batch: int) -> None:
        """Rows of a batch of a plain table."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def plain(self, name: str, schema: T.StructType, commit: Commit | None) -> DataFrame:
        """Rows of a plain table up to a commit."""
        paths = [p for p in self._found(f"{name}/batch=*") if commit and int(p.rsplit("batch=", 1)[1]) <= commit.batch]
        return self._read(paths, schema)
