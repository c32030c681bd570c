"""Runs as sets of tables: add, update, remove, restore."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.operators.ranking import dense_index


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name, missing ones NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that are in exactly one of two tables."""
    both = a.distinct().withColumn("_in_a", F.lit(1)).unionByName(b.distinct().withColumn("_in_a", F.lit(0)))
    return both.groupBy(*a.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").drop("_n")


def only_new(after: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of `after` that `before` has not."""
    return after.join(before, after.columns, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Old rows replaced by new ones of the same key, other new rows added."""
    kept = old.join(new.select(key), key, "left_anti")
    return kept.unionByName(new.select(*old.columns))


def assign_ids(rows: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """Persistent ids for new rows, following the highest existing one."""
    top = existing.agg(F.max("id")).first()[0] or 0
    return dense_index(rows, order, "id", top + 1)


def link_missing(candidates: DataFrame, links: DataFrame) -> DataFrame:
    """Candidate links that do not exist yet."""
    return candidates.distinct().join(links, candidates.columns, "left_anti")


def running_count(runs: DataFrame) -> DataFrame:
    """Number of runs in progress."""
    return runs.filter("status = 'RUN'").agg(F.count(F.lit(1)).alias("n_running"))


def remove_run(tables: dict[str, DataFrame], run_id: int) -> dict[str, DataFrame]:
    """All tables without one run.

    Expects runs(id), sources(id, run_id), associations(source_id, meas_id),
    relations(from_source_id, to_source_id), run_images(run_id, image_id),
    run_regions(run_id, skyreg_id), images(id), sky_regions(id) and
    measurements(id, image_id, forced). Images and regions that only this run
    used go, with their measurements; shared ones stay. Forced measurements
    of the run's own sources go as well.
    """
    gone = tables["sources"].filter(F.col("run_id") == run_id).select(F.col("id").alias("source_id"))
    out = dict(tables)
    out["runs"] = tables["runs"].filter(F.col("id") != run_id)
    out["sources"] = tables["sources"].filter(F.col("run_id") != run_id)
    out["associations"] = tables["associations"].join(gone, "source_id", "left_anti")
    relations = tables["relations"]
    for end in ("from_source_id", "to_source_id"):
        relations = relations.join(gone.select(F.col("source_id").alias(end)), end, "left_anti")
    out["relations"] = relations.select(*tables["relations"].columns)
    for links, table, key in (("run_images", "images", "image_id"), ("run_regions", "sky_regions", "skyreg_id")):
        out[links] = tables[links].filter(F.col("run_id") != run_id)
        of_run = tables[links].filter(F.col("run_id") == run_id).select(key).distinct()
        orphans = of_run.join(out[links].select(key), key, "left_anti").select(F.col(key).alias("id"))
        out[table] = tables[table].join(orphans, "id", "left_anti")
        if table == "images":
            orphan_images = orphans.select(F.col("id").alias("image_id"))
    forced = tables["associations"].join(gone, "source_id", "left_semi").select(F.col("meas_id").alias("id"))
    forced = tables["measurements"].filter("forced").select("id").join(forced, "id", "left_semi")
    measurements = tables["measurements"].join(orphan_images, "image_id", "left_anti").join(forced, "id", "left_anti")
    out["measurements"] = measurements.select(*tables["measurements"].columns)
    return out


def restore_problems(before: dict[str, DataFrame], now: dict[str, DataFrame]) -> DataFrame:
    """Why a snapshot cannot be restored: images or forced ids of it that are gone. Empty when it can."""
    images = before["images"].select("id").subtract(now["images"].select("id"))
    forced = before["measurements"].filter("forced").select("id").subtract(now["measurements"].filter("forced").select("id"))
    return images.select(F.lit("image_missing").alias("problem"), "id").unionByName(forced.select(F.lit("forced_missing").alias("problem"), "id"))


def restore(before: dict[str, DataFrame], now: dict[str, DataFrame], run_id: int) -> dict[str, DataFrame]:
    """Tables after taking one run back to its snapshot; rows of other runs stay untouched.

    `sources` has run_id; associations, relations and forced measurements
    belong to the run of their source.
    """
    of_run = F.col("run_id") == run_id
    added = now["sources"].filter(of_run).select("id").join(before["sources"].select("id"), "id", "left_anti").select(F.col("id").alias("source_id"))
    mine = now["sources"].filter(of_run).select(F.col("id").alias("source_id"))
    out = dict(now)
    others = now["sources"].filter(~of_run)
    out["sources"] = others.unionByName(before["sources"].filter(of_run).select(*others.columns))
    # Links of the run's sources are those of the snapshot again.
    kept = now["associations"].join(mine, "source_id", "left_anti")
    out["associations"] = kept.unionByName(before["associations"].join(mine, "source_id", "left_semi").select(*kept.columns))
    edge = lambda df: df.withColumnRenamed("source_id", "from_source_id")
    kept = now["relations"].join(edge(mine), "from_source_id", "left_anti")
    out["relations"] = kept.unionByName(before["relations"].join(edge(mine), "from_source_id", "left_semi").select(*kept.columns))
    linked = now["associations"].join(mine, "source_id", "left_semi").select(F.col("meas_id").alias("id")).distinct()
    extra = now["measurements"].filter("forced").select("id").join(linked, "id", "left_semi").join(before["measurements"].select("id"), "id", "left_anti")
    out["measurements"] = now["measurements"].join(extra, "id", "left_anti")
    out["removed_sources"] = added
    return out
