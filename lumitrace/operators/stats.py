"""Per-source statistics as mergeable aggregates.

No list of rows is collected per source: image lists and relation lists stay
in long form, so a source may own any share of the measurements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.sky import _col

FLUX_TYPES = ("int", "peak")


def lifted_ra(ra) -> Column:
    """RA with values up to 0.1 deg moved above 360, as weighted sums need near RA 0."""
    return F.when(_col(ra) <= 0.1, _col(ra) + 360.0).otherwise(_col(ra))


def eta(kind: str) -> Column:
    """Weighted reduced chi-square of the fluxes around their weighted mean; 0 for one row."""
    flux, err = F.col(f"flux_{kind}"), F.col(f"flux_{kind}_err")
    weight = F.try_divide(F.lit(1.0), err * err)
    n = F.count(F.lit(1))
    spread = F.avg(weight * flux * flux) - F.try_divide(F.pow(F.avg(weight * flux), 2), F.avg(weight))
    return F.when(n == 1, F.lit(0.0)).otherwise(F.try_divide(n.cast("double"), (n - 1).cast("double")) * spread)


def modulation(kind: str) -> Column:
    """Sample standard deviation over mean; 0 when undefined."""
    flux = F.col(f"flux_{kind}")
    return F.coalesce(F.try_divide(F.stddev_samp(flux), F.avg(flux)), F.lit(0.0))


def weighted_position() -> dict[str, Column]:
    """Weighted mean position over rows that are not forced, RA reduced to [0, 360)."""
    real = ~F.col("forced")
    w_ew, w_ns = F.when(real, F.col("weight_ew")), F.when(real, F.col("weight_ns"))
    ra = F.try_divide(F.sum(w_ew * lifted_ra("ra")), F.sum(w_ew))
    return {
        "wavg_ra": F.when(ra >= 360.0, ra - 360.0).otherwise(ra),
        "wavg_dec": F.try_divide(F.sum(w_ns * F.col("dec")), F.sum(w_ns)),
    }


def source_statistics(measurements: DataFrame) -> DataFrame:
    """One row of statistics per source.

    Positions, compactness and snr use rows that are not forced; the position
    uncertainties use the weights of all rows.
    """
    real = ~F.col("forced")
    aggregates = {
        "n_meas": F.count("id"),
        "n_meas_forced": F.sum(F.col("forced").cast("long")),
        "n_meas_sel": F.sum(real.cast("long")),
        "n_sibl": F.sum(F.col("has_siblings").cast("long")),
        **weighted_position(),
        "avg_compactness": F.avg(F.when(real, F.col("compactness"))),
        "min_snr": F.min(F.when(real, F.col("snr"))),
        "max_snr": F.max(F.when(real, F.col("snr"))),
        "wavg_uncertainty_ew": F.try_divide(F.lit(1.0), F.sqrt(F.sum("weight_ew"))),
        "wavg_uncertainty_ns": F.try_divide(F.lit(1.0), F.sqrt(F.sum("weight_ns"))),
    }
    for kind in FLUX_TYPES:
        flux = f"flux_{kind}"
        aggregates |= {
            f"avg_{flux}": F.avg(flux),
            f"max_{flux}": F.max(flux),
            f"min_{flux}": F.min(flux),
            f"min_{flux}_isl_ratio": F.min(f"{flux}_isl_ratio"),
            f"v_{kind}": modulation(kind),
            f"eta_{kind}": eta(kind),
        }
    return measurements.groupBy("source").agg(*[value.alias(name) for name, value in aggregates.items()])


def average_position(measurements: DataFrame) -> DataFrame:
    """Average position per source."""
    return measurements.groupBy("source").agg(*[v.alias(k) for k, v in weighted_position().items()])


def seen_images(measurements: DataFrame) -> DataFrame:
    """Images and epochs in which each source was seen, one row each."""
    return measurements.groupBy("source", "image_id").agg(F.min("epoch").alias("epoch"), F.min("datetime").alias("datetime"))


def related_ids(relations: DataFrame) -> DataFrame:
    """Distinct relations of each source, self excluded."""
    return relations.select("from_source_id", "to_source_id").filter("from_source_id <> to_source_id").dropDuplicates()


def relation_counts(relations: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Number of sources that each source is related to, by pairs and, if given, by classes (class_id, source, size).

    A source of one class is related to the rest of it, whose number is known,
    and to what its pairs add outside. Members are listed only for sources of
    several classes, as these may overlap.
    """
    pairs = related_ids(relations).select(F.col("from_source_id").alias("source"), F.col("to_source_id").alias("other"))
    if classes is not None:
        members = classes.select("class_id", F.col("source").alias("other"))
        held = classes.groupBy("source").agg(F.count(F.lit(1)).alias("_classes"), F.min("class_id").alias("class_id"), F.min("size").alias("size"))
        one = held.filter("_classes = 1").select("source", "class_id", "size")
        outside = pairs.join(one.select("source", "class_id"), "source", "left").join(members, ["class_id", "other"], "left_anti")
        several = classes.join(held.filter("_classes > 1").select("source"), "source", "left_semi").select("source", "class_id")
        listed = several.join(members, "class_id").filter("source <> other").select("source", "other")
        pairs = outside.select("source", "other").unionByName(listed).distinct()
        counts = pairs.groupBy("source").agg(F.count(F.lit(1)).alias("n_rel")).unionByName(one.select("source", (F.col("size") - 1).alias("n_rel")))
        return counts.groupBy("source").agg(F.sum("n_rel").alias("n_rel"))
    return pairs.groupBy("source").agg(F.count(F.lit(1)).alias("n_rel"))


def run_counters(images: DataFrame, sources: DataFrame, measurements: DataFrame) -> DataFrame:
    """Numbers shown for a run, as one row."""
    n_images = images.agg(F.count(F.lit(1)).alias("n_images"))
    n_sources = sources.agg(
        F.count(F.lit(1)).alias("n_sources"), F.coalesce(F.sum(F.col("new").cast("long")), F.lit(0)).alias("n_new_sources")
    )
    # A measurement may belong to several sources: count each id once.
    once = measurements.select("id", "forced").dropDuplicates(["id"])
    n_meas = once.agg(
        F.coalesce(F.sum((~F.col("forced")).cast("long")), F.lit(0)).alias("n_selavy_measurements"),
        F.coalesce(F.sum(F.col("forced").cast("long")), F.lit(0)).alias("n_forced_measurements"),
    )
    # Three one-row frames laid over each other.
    rows = n_images.unionByName(n_sources, allowMissingColumns=True).unionByName(n_meas, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
