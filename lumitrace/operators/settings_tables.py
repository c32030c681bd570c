"""Run settings and manifests held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INPUT_KINDS = ("image", "catalogue", "noise", "background")


def merge_settings(defaults: DataFrame, given: DataFrame) -> DataFrame:
    """Defaults with the given values on top; nested settings use dotted keys."""
    given = given.select("key", F.col("value").alias("_given"))
    merged = defaults.join(given, "key", "left")
    return merged.select("key", F.coalesce("_given", "value").alias("value"), F.col("_given").isNotNull().alias("given"))


def settings_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Settings whose value differs between two runs, missing ones included."""
    a = before.select("key", F.col("value").alias("before"))
    b = after.select("key", F.col("value").alias("after"))
    return a.join(b, "key", "full").filter(~F.col("before").eqNullSafe(F.col("after")))


def rerun_mode(before: DataFrame, after: DataFrame, input_prefix: str = "inputs.") -> str:
    """`same`, `add_images` when only inputs differ, else `full_rerun`."""
    diff = settings_diff(before, after)
    is_input = F.col("key").startswith(input_prefix)
    row = diff.agg(F.count_if(is_input).alias("inputs"), F.count_if(~is_input).alias("others")).first()
    if row["others"]:
        return "full_rerun"
    return "add_images" if row["inputs"] else "same"


def pair_inputs(manifest: DataFrame) -> DataFrame:
    """One row per image: files of all kinds that share epoch and position.

    `manifest` holds epoch, kind, pos, path. The pivot has the fixed list of
    kinds, so it is one aggregation.
    """
    return manifest.groupBy("epoch", "pos").pivot("kind", list(INPUT_KINDS)).agg(F.min("path"))


def manifest_from_lists(lists: DataFrame) -> DataFrame:
    """Long manifest from one row per epoch and kind with a list of paths."""
    return lists.select("epoch", "kind", F.posexplode("paths").alias("pos", "path"))


def label_epochs(images: DataFrame, manifest_epochs: DataFrame | None = None) -> DataFrame:
    """Epoch number per image.

    With a manifest (name, epoch_key) images share the rank of their key.
    Without one every image is its own epoch in time order.
    """
    from lumitrace.operators.ranking import dense_index

    if manifest_epochs is None:
        return dense_index(images, ["datetime", "id"], "epoch", 1)
    keyed = images.join(manifest_epochs, "name")
    ranks = dense_index(keyed.select("epoch_key").distinct(), ["epoch_key"], "epoch", 1)
    return keyed.join(ranks, "epoch_key").drop("epoch_key")


def manifest_problems(manifest: DataFrame, monitor: bool = False, max_images: int | None = None) -> DataFrame:
    """Everything wrong with a manifest, one row per problem (empty when valid)."""
    required = ["image", "catalogue", "noise"] + (["background"] if monitor else [])
    counts = manifest.groupBy("epoch").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in INPUT_KINDS]
    )
    checks = []
    for kind in INPUT_KINDS[1:]:
        mismatch = F.col(kind) != F.col("image")
        if kind not in required:
            mismatch = mismatch & (F.col(kind) > 0)
        checks.append(counts.filter(mismatch).select(F.lit("count_mismatch").alias("problem"), F.concat_ws(":", F.col("epoch").cast("string"), F.lit(kind)).alias("detail")))
    repeated = manifest.groupBy("kind", "path").count().filter("count > 1")
    checks.append(repeated.select(F.lit("duplicate_path").alias("problem"), F.concat_ws(":", "kind", "path").alias("detail")))
    totals = manifest.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in INPUT_KINDS])
    checks.append(totals.filter("image < 2").select(F.lit("too_few_images").alias("problem"), F.col("image").cast("string").alias("detail")))
    for kind in required:
        checks.append(totals.filter(F.col(kind) == 0).select(F.lit("missing_kind").alias("problem"), F.lit(kind).alias("detail")))
    if max_images is not None:
        checks.append(totals.filter(F.col("image") > max_images).select(F.lit("too_many_images").alias("problem"), F.col("image").cast("string").alias("detail")))
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out
