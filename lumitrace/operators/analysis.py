"""Distribution of variability metrics over a whole run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.operators.ranking import group_median
from lumitrace.workspace import materialize

# Median absolute deviation of a normal distribution of standard deviation 1, inverted.
MAD_TO_STD = 1.482602218505602
# Rounds and width of the clipping.
CLIP_ROUNDS, CLIP_SIGMA = 5, 3.0
# An analysis needs this many sources.
MIN_SOURCES = 50
BINS = 50


def variable_candidates(sources: DataFrame) -> DataFrame:
    """Sources an analysis can use: several measurements and all metrics positive."""
    return sources.filter("n_meas > 1 AND eta_int > 0 AND eta_peak > 0 AND v_int > 0 AND v_peak > 0")


def log_metrics(sources: DataFrame, kind: str) -> DataFrame:
    """Long form (metric, value) of log10 eta and V."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.log10(f"{m}_{kind}").alias("value")) for m in ("eta", "v")])
    return sources.select(F.inline(rows))


def clip_once(values: DataFrame) -> DataFrame:
    """Values within 3 robust deviations of the median of their metric."""
    middle = group_median(values, ["metric"], "value", "_mid")
    # One row per metric.
    apart = values.join(F.broadcast(middle), "metric").withColumn("_dev", F.abs(F.col("value") - F.col("_mid")))
    spread = group_median(apart, ["metric"], "_dev", "_mad")
    reach = F.col("_mad") * (MAD_TO_STD * CLIP_SIGMA)
    return apart.join(F.broadcast(spread), "metric").filter(F.col("_dev") <= reach).select("metric", "value")


def robust_fit(values: DataFrame, rounds: int = CLIP_ROUNDS) -> DataFrame:
    """Mean and population standard deviation per metric after clipping until nothing changes."""
    values = materialize(values, "metrics")
    n = values.count()
    for _ in range(rounds):
        values = materialize(clip_once(values), "clipped")
        left = values.count()
        if left == n:
            break
        n = left
    return values.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sigma"))


def eta_v_analysis(
    sources: DataFrame, eta_sigma: float, v_sigma: float, kind: str = "peak", rounds: int = CLIP_ROUNDS, min_sources: int = MIN_SOURCES
) -> DataFrame:
    """Usable sources with the cutoffs of the run and whether they exceed both."""
    usable = materialize(variable_candidates(sources), "usable")
    if usable.limit(min_sources).count() < min_sources:
        raise ValueError(f"an analysis needs at least {min_sources} sources")
    fit = robust_fit(log_metrics(usable, kind), rounds)
    # Two rows, one per metric, reach the driver.
    fitted = {r["metric"]: (r["mean"], r["sigma"]) for r in fit.collect()}
    eta_cutoff = 10 ** (fitted["eta"][0] + eta_sigma * fitted["eta"][1])
    v_cutoff = 10 ** (fitted["v"][0] + v_sigma * fitted["v"][1])
    above = (F.col(f"eta_{kind}") >= eta_cutoff) & (F.col(f"v_{kind}") >= v_cutoff)
    return usable.withColumns({"eta_cutoff": F.lit(eta_cutoff), "v_cutoff": F.lit(v_cutoff), "candidate": above})


def histogram(values: DataFrame, bins: int = BINS) -> DataFrame:
    """Density histogram per metric over equal bins; the last bin is closed."""
    ends = values.groupBy("metric").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    rows = values.join(F.broadcast(ends), "metric").withColumn("_width", width)
    place: Column = F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_width")), F.lit(bins - 1))
    counts = rows.groupBy("metric", place.cast("long").alias("bin"), "_lo", "_width", "_n").agg(F.count(F.lit(1)).alias("_in"))
    return counts.select(
        "metric",
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("left"),
        (F.col("_in") / (F.col("_n") * F.col("_width"))).alias("density"),
    )
