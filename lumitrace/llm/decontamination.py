"""Benchmark passages in documents, by a prefix-filtered join over item-sized windows.

A window is WINDOW consecutive words of an item (a shorter item is one window);
its tokens are its shingles of up to SIZE words. Shingles are ordered by how
often documents hold them. As a window must be contained whole, its prefix is
its rarest shingle, and a window with a shingle that no document holds is out.
Prefixes are joined with the documents' shingles; the place of the shingle
gives the only start the window can have there, which has to lie inside the
text (positional and length bounds), and the words themselves are compared.

Documents are read once. A bit table over the benchmark's shingles, of at most
8 MB, keeps only stretches of text all of whose shingles may be the benchmark's
and that are long enough for a window; all later steps work on these, exactly.

Defined results: NULL text has no words, n_hit 0 and is clean; items without
words, and those with NULL item_id, are ignored; repeated items or rows change
nothing; an empty benchmark leaves all documents clean; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumitrace.llm import frames, words
from lumitrace.workspace import materialize

WINDOW = 13
SIZE = 5
#: A document is contaminated if at least one in so many of its words is hit.
ONE_IN = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRETCHES = "doc_id long, text_key long, n_words long, stretches array<struct<at: long, words: array<string>>>"


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words, k (shingle size): every window of every item once per item."""
    folded = F.translate(F.col("text").cast("string"), frames.UPPER, frames.LOWER)
    items = benchmark.select("item_id", F.regexp_extract_all(folded, F.lit(f"({WORD})"), 1).alias("all")).filter("item_id IS NOT NULL AND size(all) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    cut = items.select("item_id", "all", F.explode(starts).alias("s"))
    return cut.select("item_id", F.slice("all", F.col("s") + 1, window).alias("words")).withColumn("k", F.least(F.size("words"), F.lit(SIZE))).distinct()


def _benchmark_filters(benchmark: DataFrame, window: int) -> dict[int, tuple[int, frames.BitFilter]]:
    """By shingle size: how many in a row the shortest window has, and the bit table of all."""

    def hashes(batches):
        for batch in batches:
            for some in frames.chunks(batch):
                w = words.Words(some.column("text"), words.LETTERS)
                for i in range(some.num_rows):
                    own = w.of(i)
                    k = min(SIZE, len(own))
                    if k:
                        found = words.shingles(own, k).view(np.int64)
                        n = len(found)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, min(len(own), window) - k + 1, np.int32)), pa.array(found)], names=["k", "run", "hash"]
                        )

    items = benchmark.filter("item_id IS NOT NULL").select(F.col("text").cast("string").alias("text"))
    found = materialize(frames.arrow_map(items, hashes, "k int, run int, hash long").groupBy("k", "hash").agg(F.min("run").alias("run")), "benchmark")
    runs = {r["k"]: r["run"] for r in found.groupBy("k").agg(F.min("run").alias("run")).collect()}
    return {k: (run, frames.BitFilter.build(found.filter(F.col("k") == k), "hash")) for k, run in runs.items()}


def _intervals(flags: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.column_stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))


def stretches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, text_key, n_words and the stretches that windows can lie in, with their words."""
    shared = docs.sparkSession.sparkContext.broadcast(_benchmark_filters(benchmark, window))

    def cut(batches):
        kind = pa.list_(pa.struct([("at", pa.int64()), ("words", pa.list_(pa.string()))]))
        for batch in batches:
            for some in frames.chunks(batch):
                w = words.Words(some.column("text"), words.LETTERS)
                counts, found = [], []
                for i in range(some.num_rows):
                    own, lo = w.of(i), int(w.first[i])
                    inside = np.zeros(len(own), dtype=bool)
                    for k, (run, bits) in shared.value.items():
                        for s, e in _intervals(bits.has(words.shingles(own, k))):
                            if e - s >= run:
                                inside[s : e - 1 + k] = True
                    counts.append(len(own))
                    found.append([{"at": int(s), "words": w.strings(lo + int(s), lo + int(e))} for s, e in _intervals(inside)])
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text_key"), pa.array(counts, pa.int64()), pa.array(found, kind)], names=["doc_id", "text_key", "n_words", "stretches"])

    return frames.arrow_map(frames.keyed(docs), cut, STRETCHES)


def _shingle(place: Column, size: Column, of: str = "words") -> Column:
    return F.array_join(F.slice(of, place + 1, size), " ")


def hits(found: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, at, length, words: each place where a window occurs. `found`: see `stretches`."""
    rows = found.select("doc_id", "text_key", F.explode("stretches").alias("s")).select("doc_id", "text_key", "s.at", "s.words")
    sizes = sorted(r["k"] for r in windows.select("k").distinct().collect())
    if not sizes:
        return rows.select("doc_id", "text_key", "at", F.lit(0).alias("length"), "words").limit(0)
    every = None
    for k in sizes:
        places = F.sequence(F.lit(0), F.size("words") - k)
        one = rows.filter(F.size("words") >= k).select("*", F.explode(places).alias("i"), F.lit(k).alias("k"))
        every = one if every is None else every.unionByName(one)
    # What lies within a window's length of the shingle goes with it, so a long stretch is not copied whole.
    near = F.greatest(F.col("i") - (window - 1), F.lit(0))
    every = every.select("doc_id", "text_key", (F.col("at") + near).alias("from"), (F.col("i") - near).alias("i"), "k", _shingle(F.col("i"), F.col("k")).alias("shingle"), F.slice("words", near + 1, 2 * window).alias("context"))
    rarity = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    distinct = windows.select("words", "k").distinct()
    tokens = distinct.select("words", "k", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("k"))).alias("o"))
    tokens = tokens.withColumn("shingle", _shingle(F.col("o"), F.col("k"))).join(rarity, "shingle", "left")
    prefix = tokens.groupBy("words").agg(F.min(F.struct("n", "shingle", "o")).alias("p"), F.count("n").alias("present"), F.count(F.lit(1)).alias("all"))
    prefix = prefix.filter("present = all").select(F.col("words").alias("wanted"), "p.shingle", "p.o", F.size("words").alias("length"))
    start = F.col("i") - F.col("o")
    pairs = every.join(prefix, "shingle").filter((start >= 0) & (start + F.col("length") <= F.size("context")))
    exact = pairs.filter(F.slice("context", start + 1, F.col("length")) == F.col("wanted"))
    return exact.select("doc_id", "text_key", (F.col("from") + start).alias("at"), "length", F.col("wanted").alias("words")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """Per row: doc_id, text_key, n_words, n_hit, items (ids as sorted strings), contaminated."""
    found = materialize(stretches(docs, benchmark, window), "stretches")
    windows = materialize(item_windows(benchmark, window), "windows")
    places = materialize(hits(found, windows, window), "hits")
    row = ["doc_id", "text_key"]
    spans = places.groupBy(*row, "at").agg(F.max("length").alias("length")).withColumn("end", F.col("at") + F.col("length"))
    before = F.max("end").over(Window.partitionBy(*row).orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("end") - F.greatest("at", F.coalesce(before, F.lit(0))), F.lit(0))
    n_hit = spans.withColumn("fresh", fresh).groupBy(*row).agg(F.sum("fresh").cast("long").alias("n_hit"))
    in_items = places.select(*row, "words").distinct().join(windows.select("words", F.col("item_id").cast("string").alias("item")), "words")
    items = in_items.groupBy(*row).agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = frames.on_key(found.select(*row, "n_words"), n_hit, row)
    out = frames.on_key(out, items, row)
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    out = out.withColumn("n_hit", hit).withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """`docs` without the contaminated rows."""
    found = contamination(docs, benchmark, window, one_in).filter("contaminated")
    return frames.without(docs, materialize(found.select("doc_id", "text_key"), "contaminated"))
