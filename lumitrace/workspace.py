"""Where intermediate tables live, and how lineage is cut.

Loops write each step as a Parquet table in the shared folder the cluster
names in `spark.checkpoint.dir`. A table there survives the loss of any
executor, is computed once, and gives the next step real file sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for local masters."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lumitrace-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` once and return a scan of the written table. `options` are the Parquet writer's, with `_` for `.`."""
    path = new_path(df.sparkSession, label)
    df.write.options(**{k.replace("_", "."): v for k, v in options.items()}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table, of which no Python worker has to be told."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
