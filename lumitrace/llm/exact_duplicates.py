"""Documents of equal text, with DataFrame functions only.

Texts are equal when they are identical after A-Z are lower-cased. They are
merged in three stages, each of which groups by the whole text beside its
digest, so a digest only decides where rows meet, never whether they are equal:

1. every partition merges its own copies (the partial step of an aggregate);
2. what is left meets by digest and salt, the salt being the partition a row
   comes from, so a group of copies is spread over SALTS keys and each of them
   receives one row of a partition at most;
3. the winners of the salts meet by digest.

On the way back a group holds its keeper and size only. Groups of more than one
in HOT_SHARE of all rows, of which there are at most HOT_SHARE, are broadcast;
the others are joined by digest. Rows without a copy match nothing and keep
themselves. Digests that stand for several texts are joined by text as well.

Defined results: NULL text counts as empty, and empty texts are copies of each
other; the largest doc_id stays, NULL only if a group has no other; repeated
rows are copies of each other, and where the id that stays is repeated all its
rows say `kept`, of which `without_copies` returns one; an empty table gives no
rows; extra columns are ignored, or handed on by `without_copies`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

SALTS = 64
#: Groups of at least one in so many rows are broadcast: so many groups, of some 60 bytes each, at most.
HOT_SHARE = 10_000


def whole_digest(sha: Column) -> Column:
    """All 256 bits decide where rows meet."""
    return sha


def _read(docs: DataFrame, meet: Callable[[Column], Column]) -> DataFrame:
    """doc_id, the text as it is compared, its SHA-256 and the digest that it meets others by."""
    folded = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), frames.UPPER, frames.LOWER)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), folded.alias("folded"))
    read = read.withColumn("sha", F.unhex(F.sha2("folded", 256)))
    return read.withColumn("digest", meet(F.col("sha")))


def equal_texts(docs: DataFrame, meet: Callable[[Column], Column] = whole_digest) -> DataFrame:
    """Per distinct text: digest, keep_id, group_size, and the text itself where others share its digest."""
    salted = _read(docs, meet).select("doc_id", "folded", "digest", (F.spark_partition_id() % SALTS).alias("salt"))
    winners = salted.groupBy("digest", "salt", "folded").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # One exchange by digest serves both the merge and the count of texts.
    merged = winners.repartition("digest").groupBy("digest", "folded").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    per_digest = merged.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    per_digest = materialize(per_digest, "digests")
    single = per_digest.filter("texts = 1").select("digest", "keep_id", "group_size", F.lit(None).cast("string").alias("folded"))
    shared = per_digest.filter("texts > 1").select("digest")
    if shared.isEmpty():
        return single
    # Digests of several texts, which a strong one does not have, are listed text by text.
    listed = merged.join(shared, "digest", "left_semi").select("digest", "keep_id", "group_size", "folded")
    return single.unionByName(materialize(listed, "shared-digests"))


def copies(docs: DataFrame, meet: Callable[[Column], Column] = whole_digest) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept and text_sha256 (lower-case hex)."""
    groups = equal_texts(docs, meet)
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    plain = groups.filter("folded IS NULL AND group_size > 1").select("digest", "keep_id", "group_size")
    hot = plain.filter(F.col("group_size") * HOT_SHARE >= total)
    rest = plain.filter(F.col("group_size") * HOT_SHARE < total)

    rows = _read(docs, meet)
    marked = materialize(rows.select("doc_id", "sha", "digest").join(F.broadcast(hot), "digest", "left"), "rows")
    crowded = marked.filter("group_size IS NOT NULL").select("doc_id", "sha", "keep_id", "group_size")
    others = marked.filter("group_size IS NULL").select("doc_id", "sha", "digest")
    shared = groups.filter("folded IS NOT NULL")
    if not shared.isEmpty():
        others = others.join(shared.select("digest"), "digest", "left_anti")
        by_text = rows.join(shared, ["digest", "folded"]).select("doc_id", "sha", "keep_id", "group_size")
        crowded = crowded.unionByName(by_text)
    alone = F.col("group_size").isNull()
    others = others.join(rest, "digest", "left").select(
        "doc_id", "sha", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return others.unionByName(crowded).select("doc_id", "keep_id", "group_size", kept, F.lower(F.hex("sha")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of every text: that of the largest doc_id."""
    found = materialize(copies(docs), "copies")
    stay = found.filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    folded = F.translate(F.coalesce("text", F.lit("")), frames.UPPER, frames.LOWER)
    rows = frames.whole_rows(docs).withColumn("text_sha256", F.sha2(folded, 256))
    key = ["doc_id", "text_sha256"]
    once = frames.on_key(rows, stay.filter("n = 1"), key, "left_semi")
    again = frames.on_key(rows, stay.filter("n > 1"), key, "left_semi").dropDuplicates(key)
    return frames.unpacked(once.unionByName(again), docs.columns)
