"""What the text operators share: row keys, Arrow batches in bounded chunks, rates of bounded samples, bit filters."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()

#: Rows in an Arrow batch. Batches are held on both sides of a worker's pipe, and a row may be a long text.
BATCH_ROWS = 500

#: Bytes of text that are worked on at once inside a task; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Give executors the package's source, once per application; Spark's file server hands it out. Batches are kept small from here on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="lumitrace-source-"), "lumitrace-source.zip")
    Path(path).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """`mapInArrow` with the package at hand on executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and `text_key`. Rows with one doc_id but other texts stay apart; NULL text has a key of its own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text", F.col("text").isNull()))


def bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo `buckets`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def on_key(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join on columns that may be NULL; the right side's copies of them are dropped."""
    renamed = right.select(*[F.col(n).alias(f"_r_{n}" if n in names else n) for n in right.columns])
    cond = [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in names]
    out = left.join(renamed, cond, how)
    return out.drop(*[f"_r_{n}" for n in names]) if how not in ("left_semi", "left_anti") else out


def chunks(batch: pa.RecordBatch, column: str = "text"):
    """Slices of a batch, each with up to CHUNK_BYTES of text in `column`."""
    sizes = np.array([0 if v is None else v for v in _lengths(batch.column(column))], dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > CHUNK_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def _lengths(column: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def hash_rate(rows: int, wanted: int) -> int:
    """Of a million hash values, how many to take so that about `wanted` of `rows` rows remain."""
    return 1_000_000 if rows <= wanted else max(1, 1_000_000 * wanted // rows)


def hashed_below(key: Column, rate: Column | int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000)) < rate


class BitFilter:
    """A bit table over 64-bit keys, at most `MAX_BITS` long however many keys there are. It has no false negatives."""

    MAX_BITS = 1 << 26

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def build(cls, keys: DataFrame, column: str) -> BitFilter:
        """From a long column; what reaches the driver is the table itself, 8 MB at most."""
        n = keys.count()
        bits = 1 << 16
        while bits < min(32 * n, cls.MAX_BITS):
            bits <<= 1
        place = F.pmod(F.col(column), F.lit(bits))
        word = F.shiftright(place, 6).cast("int").alias("word")
        mask = F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64) as int))").alias("mask")
        rows = keys.select(word, mask).groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        words = np.zeros(bits // 64, dtype=np.uint64)
        words[rows["word"].to_numpy()] = rows["mask"].to_numpy().astype(np.int64).view(np.uint64)
        return cls(words, bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which of these uint64 keys may be in it."""
        place = keys & np.uint64(self.bits - 1)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, text, text_key of the rows whose text_key is in `wanted`, before any shuffle; a few others may be among them."""
    ship(docs.sparkSession)
    few = docs.sparkSession.sparkContext.broadcast(BitFilter.build(wanted, "text_key"))

    @F.arrow_udf("boolean")
    def maybe(key: pa.Array) -> pa.Array:
        return pa.array(few.value.has(key.to_numpy(zero_copy_only=False).view(np.uint64)))

    return keyed(docs).filter(maybe("text_key"))


def whole_rows(docs: DataFrame) -> DataFrame:
    """The row's other columns as `row` beside doc_id, text and text_key, so no column of its can clash with one that an operator adds, and a text travels once."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(others.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text", F.col("text").isNull()))


def unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of a table again from its `whole_rows`, some of them replaced."""
    changed = {"text": F.col("text"), **changed}
    return rows.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in columns])


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` less the rows whose doc_id and text_key are in `dropped`."""
    rows = on_key(whole_rows(docs), dropped.select("doc_id", "text_key").distinct().hint("shuffle_hash"), ["doc_id", "text_key"], "left_anti")
    return unpacked(rows, docs.columns)
