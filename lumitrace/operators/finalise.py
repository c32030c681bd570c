"""Final tables of a run: sources, relations, associations, pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.coords import position_name
from lumitrace.operators.coverage import flag_new
from lumitrace.operators.pairs import pair_aggregates, significant_pairs
from lumitrace.operators.skyjoin import nearest_other
from lumitrace.operators.stats import relation_counts, source_statistics
from lumitrace.settings import RunSettings

#: Columns of light curves that coverage and the final rows of sources are made of.
CURVE_COLUMNS = ["source", "id", "image_id", "epoch", "datetime", "forced", "has_siblings", "ra", "dec", "weight_ew", "weight_ns", "compactness", "snr"]
CURVE_COLUMNS += [f"flux_{k}{c}" for k in ("int", "peak") for c in ("", "_err", "_isl_ratio")]
PAIR_COLUMNS = [f"{m}_abs_significant_max_{k}" for k in ("int", "peak") for m in ("vs", "m")]


def light_curves(associations: DataFrame, measurements: DataFrame, images: DataFrame) -> DataFrame:
    """Measurements with the source they belong to, and the epoch and time of their image."""
    info = images.select("image_id", "epoch", "datetime")
    linked = associations.select("source", F.col("meas_id").alias("id"), "d2d", "dr")
    drop = [c for c in ("epoch", "datetime", "d2d", "dr", "source") if c in measurements.columns]
    return linked.join(measurements.drop(*drop), "id").join(info, "image_id")


def with_neighbours(sources: DataFrame) -> DataFrame:
    """Adds the distance to the nearest other source."""
    spots = nearest_other(sources.select(F.col("source").alias("id"), F.col("wavg_ra").alias("ra"), F.col("wavg_dec").alias("dec")))
    return sources.join(spots.select(F.col("id").alias("source"), F.col("sep").alias("n_neighbour_dist")), "source", "left")


def final_sources(curves: DataFrame, relations: DataFrame, new: DataFrame, settings: RunSettings, neighbours: bool = True, classes: DataFrame | None = None) -> DataFrame:
    """One row per source with all statistics; those of its own rows only without `neighbours`. `relations` are all pairs, or links beside `classes`."""
    sources = source_statistics(curves)
    sources = flag_new(sources, new)
    sources = sources.join(relation_counts(relations, classes), "source", "left").withColumn("n_rel", F.coalesce("n_rel", F.lit(0)))
    if neighbours:
        sources = with_neighbours(sources)
    if settings.pair_metrics:
        sources = sources.join(pair_aggregates(curves, settings.min_abs_vs), "source", "left")
        sources = sources.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in PAIR_COLUMNS})
    return sources.withColumn("name", position_name("wavg_ra", "wavg_dec"))


def final_relations(relations: DataFrame, ids: DataFrame) -> DataFrame:
    """Relations in final ids (`ids` maps source to id), without self relations."""
    a = ids.select(F.col("source").alias("from_source_id"), F.col("id").alias("_from"))
    b = ids.select(F.col("source").alias("to_source_id"), F.col("id").alias("_to"))
    mapped = relations.join(a, "from_source_id").join(b, "to_source_id").filter("_from <> _to")
    return mapped.select(F.col("_from").alias("from_source_id"), F.col("_to").alias("to_source_id")).distinct()


def final_associations(associations: DataFrame, ids: DataFrame) -> DataFrame:
    """Associations in final ids."""
    mapped = associations.join(ids.select("source", "id"), "source")
    return mapped.select(F.col("id").alias("source_id"), "meas_id", "d2d", "dr")


def final_pairs(curves: DataFrame, images: DataFrame, ids: DataFrame, min_abs_vs: float) -> DataFrame:
    """Significant pairs in final ids, with image names."""
    names = images.select("image_id", "name")
    pairs = significant_pairs(curves, min_abs_vs).join(ids.select("source", "id"), "source")
    for side in "ab":
        named = names.select(F.col("image_id").alias(f"image_id_{side}"), F.col("name").alias(f"image_name_{side}"))
        pairs = pairs.join(named, f"image_id_{side}", "left")
    return pairs.withColumnRenamed("id", "source_id").drop("source", "image_id_a", "image_id_b")


def rename_sources(sources: DataFrame) -> DataFrame:
    """Names of existing sources rebuilt from their positions."""
    return sources.withColumn("name", position_name("wavg_ra", "wavg_dec"))
