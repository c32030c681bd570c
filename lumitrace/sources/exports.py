"""Exports: joined measurement and pair tables, region files, sky regions as GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumitrace.functions.display import narrow_floats, narrow_ints
from lumitrace.operators.ranking import dense_index


def measurement_export(measurements: DataFrame, associations: DataFrame) -> DataFrame:
    """Measurements that belong to a source, with its id; plain timestamps and narrow floats."""
    linked = associations.select(F.col("meas_id").alias("id"), F.col("source_id").alias("source"))
    rows = measurements.drop("source").join(linked, "id")
    plain = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in rows.schema.fields
    ]
    return narrow_floats(rows.select(*plain))


def pair_export(pairs: DataFrame) -> DataFrame:
    """Pairs with narrow integers and floats."""
    return narrow_ints(narrow_floats(pairs))


def plain_number(name: str) -> Column:
    """A double as text without an exponent for small values."""
    value = F.col(name)
    decimal = F.regexp_replace(value.cast("decimal(30,17)").cast("string"), "0+$", "")
    return F.when((value != 0) & (F.abs(value) < 1e-3), decimal).otherwise(value.cast("string"))


def region_lines(rows: DataFrame, model: str = "measurement", link_prefix: str = "/") -> DataFrame:
    """One region-file line per measurement: an ellipse and its properties as JSON.

    `rows` has ra, dec, bmaj, bmin, pa, forced, color and `label_id`, the id shown.
    """
    text = lambda c: F.col(c).cast("string")
    ellipse = F.concat(
        F.lit("ellipse("), plain_number("ra"), F.lit("d, "), plain_number("dec"), F.lit("d, "), text("bmaj"), F.lit('", '), text("bmin"), F.lit('", '),
        (F.col("pa") + 90 + 180).cast("string"), F.lit("d)"),
    )
    data = F.struct(
        F.concat(F.lit(f"{model} ID: "), text("label_id")).alias("text"),
        F.concat(F.lit(f"{link_prefix}{model}s/"), text("label_id"), F.lit("/")).alias("link"),
    )
    dash = F.when(F.col("forced"), F.array(F.lit(3), F.lit(2)))
    properties = F.to_json(F.struct(F.col("color"), data.alias("data"), dash.alias("strokeDashArray")))
    return rows.select("id", F.concat(ellipse, F.lit(" "), properties).alias("value"))


def region_features(regions: DataFrame) -> DataFrame:
    """One GeoJSON feature per sky region; RA above 180 is moved to negative values."""
    ra = F.when(F.col("centre_ra") > 180, F.col("centre_ra") - 360.0).otherwise(F.col("centre_ra"))
    dec, dra, ddec = F.col("centre_dec"), F.col("width_ra") / 2, F.col("width_dec") / 2
    corner = lambda sx, sy: F.array(ra + sx * dra, dec + sy * ddec)
    outline = F.array(F.array(corner(1, 1), corner(1, -1), corner(-1, -1), corner(-1, 1), corner(1, 1)))
    number: Column = F.format_string("%02d", "id")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.concat(F.lit("SkyRegion"), F.col("id").cast("string")).alias("id"),
        F.struct(number.alias("n"), F.array(ra, dec).alias("loc")).alias("properties"),
        F.struct(F.lit("MultiLineString").alias("type"), outline.alias("coordinates")).alias("geometry"),
    )
    return regions.select("id", F.to_json(feature).alias("value"))


def write_feature_collection(regions: DataFrame, path: str) -> None:
    """Write a feature collection as text: an opening line, a feature per line, a closing line.

    Lines are range-partitioned, so part files in name order make the document.
    """
    features = region_features(regions)
    numbered = dense_index(features, ["id"], "n")
    last = regions.sparkSession.range(1).select(F.lit(None).cast("long").alias("n"), F.lit("]}").alias("value"))
    first = regions.sparkSession.range(1).select(F.lit(-1).cast("long").alias("n"), F.lit('{"type":"FeatureCollection","features":[').alias("value"))
    body = numbered.select("n", F.concat(F.when(F.col("n") > 0, F.lit(",")).otherwise(F.lit("")), "value").alias("value"))
    lines = first.unionByName(body).unionByName(last).orderBy(F.asc_nulls_last("n"))
    lines.select("value").write.mode("overwrite").text(path)
