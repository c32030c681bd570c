"""Sky tables derived from the generic test tables (they carry no sky of their own).

Every event becomes a measurement of the source its user stands for, every
day an epoch, and keys become positions spread over the sky. A few
milli-arcsec that depend on the event keep positions distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Order of the event types that number the images of a day.
EVENT_TYPES = ["signup", "view", "click", "purchase", "error"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_ra(key: Column) -> Column:
    return (key * F.lit(137.508)) % F.lit(360.0)


def key_dec(key: Column) -> Column:
    return F.lit(-80.0) + (key * F.lit(61.803)) % F.lit(160.0)


def measurements(spark: SparkSession, sf_dir: str, epoch_days: int = 1) -> DataFrame:
    """Measurements of the run; `epoch_days` days form an epoch, each with one image per event type."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    peak = F.col("value") + 1.0
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    epoch = F.floor(day / epoch_days) + 1
    kind = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col("event_type"))
    err = F.lit(0.5) + F.lit(0.05) * F.col("value") + k / 100.0
    offset = k - 50
    base = events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("source"),
        F.col("ts").alias("datetime"),
        epoch.cast("long").alias("epoch"),
        (epoch * 10 + kind).cast("long").alias("image_id"),
        ((key_ra(F.col("user_id")) + offset * F.lit(2e-5) + F.col("event_id") % 997 * F.lit(1e-8) + 360.0) % F.lit(360.0)).alias("ra"),
        (key_dec(F.col("user_id")) + offset * F.lit(1e-5) + F.col("event_id") % 991 * F.lit(1e-8)).alias("dec"),
        peak.alias("flux_peak"),
        err.alias("flux_peak_err"),
        (peak * (1 + k / 200.0)).alias("flux_int"),
        err.alias("flux_int_err"),
        (F.col("event_type") == "error").alias("forced"),
        (F.col("event_type") == "view").alias("has_siblings"),
        F.concat(F.lit("island_"), day.cast("string"), F.lit("_"), F.col("user_id").cast("string")).alias("island_id"),
        (0.2 + k / 500.0).alias("local_rms"),
        k.cast("long").alias("k"),
    )
    # Position errors in degrees: 0.5 to 1.5 arcsec.
    unc = (F.lit(0.5) + F.col("k") / 100.0) / 3600.0
    return base.withColumns(
        {
            "uncertainty_ew": unc,
            "uncertainty_ns": unc,
            "weight_ew": 1.0 / (F.col("flux_peak_err") * F.col("flux_peak_err")),
            "weight_ns": 1.0 / (F.col("flux_peak_err") * F.col("flux_peak_err")),
            "snr": F.col("flux_peak") / F.col("local_rms"),
            "compactness": F.col("flux_int") / F.col("flux_peak"),
            "flux_int_isl_ratio": 1.0 / (1.0 + F.col("k") / 100.0),
            "flux_peak_isl_ratio": 1.0 / (1.0 + F.col("k") / 50.0),
        }
    )


# The same derivation for the comparison engine, as the body of a CTE.
_TYPE_NUMBER = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(EVENT_TYPES, 1)) + " END"


def measurements_sql(epoch_days: int = 1) -> str:
    return f"""
  SELECT b.*,
    (CAST(0.5 AS DOUBLE) + k / CAST(100 AS DOUBLE)) / CAST(3600 AS DOUBLE) AS uncertainty_ew,
    (CAST(0.5 AS DOUBLE) + k / CAST(100 AS DOUBLE)) / CAST(3600 AS DOUBLE) AS uncertainty_ns,
    1.0::DOUBLE / (flux_peak_err * flux_peak_err) AS weight_ew,
    1.0::DOUBLE / (flux_peak_err * flux_peak_err) AS weight_ns,
    flux_peak / local_rms AS snr,
    flux_int / flux_peak AS compactness,
    1.0::DOUBLE / (1.0::DOUBLE + k / 100.0::DOUBLE) AS flux_int_isl_ratio,
    1.0::DOUBLE / (1.0::DOUBLE + k / 50.0::DOUBLE) AS flux_peak_isl_ratio
  FROM (
    SELECT event_id AS id, user_id AS source, ts AS datetime, epoch, epoch * 10 + kind AS image_id,
      ((user_id * 137.508::DOUBLE) % 360.0::DOUBLE + (k - 50) * 2e-5::DOUBLE + event_id % 997 * 1e-8::DOUBLE + 360.0::DOUBLE) % 360.0::DOUBLE AS ra,
      -80.0::DOUBLE + (user_id * 61.803::DOUBLE) % 160.0::DOUBLE + (k - 50) * 1e-5::DOUBLE + event_id % 991 * 1e-8::DOUBLE AS dec,
      value + 1.0::DOUBLE AS flux_peak,
      0.5::DOUBLE + 0.05::DOUBLE * value + k / 100.0::DOUBLE AS flux_peak_err,
      (value + 1.0::DOUBLE) * (1 + k / 200.0::DOUBLE) AS flux_int,
      0.5::DOUBLE + 0.05::DOUBLE * value + k / 100.0::DOUBLE AS flux_int_err,
      event_type = 'error' AS forced, event_type = 'view' AS has_siblings,
      'island_' || CAST(day AS VARCHAR) || '_' || CAST(user_id AS VARCHAR) AS island_id,
      0.2::DOUBLE + k / 500.0::DOUBLE AS local_rms, k
    FROM (
      SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS day,
        CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / {epoch_days}::DOUBLE) AS BIGINT) + 1 AS epoch,
        CAST({_TYPE_NUMBER} AS BIGINT) AS kind
      FROM events
    )
  ) b
"""


def sky_rows(spark: SparkSession, sf_dir: str, name: str, key: str, prefix: str = "") -> DataFrame:
    """Any keyed table as positions: `<prefix>id`, `<prefix>ra`, `<prefix>dec`, plus its columns."""
    df = table(spark, sf_dir, name)
    k = F.col(key).cast("long")
    return df.withColumns({f"{prefix}id": k, f"{prefix}ra": key_ra(k), f"{prefix}dec": key_dec(k)})


def sky_rows_sql(name: str, key: str, prefix: str = "") -> str:
    return (
        f"SELECT *, CAST({key} AS BIGINT) AS {prefix}id, ({key} * 137.508::DOUBLE) % 360.0::DOUBLE AS {prefix}ra, "
        f"-80.0::DOUBLE + ({key} * 61.803::DOUBLE) % 160.0::DOUBLE AS {prefix}dec FROM {name}"
    )


def run_images(spark: SparkSession, sf_dir: str, epoch_days: int = 1) -> DataFrame:
    """One row per image of the run."""
    m = measurements(spark, sf_dir, epoch_days)
    images = m.groupBy("image_id").agg(
        F.min("epoch").alias("epoch"),
        F.min("datetime").alias("datetime"),
        F.min("local_rms").alias("rms_min"),
        F.max("local_rms").alias("rms_max"),
    )
    return images.withColumns(
        {
            "id": F.col("image_id"),
            "name": F.format_string("field.i.IMG%05d.cont.taylor.0", F.col("image_id")),
            "ra": key_ra(F.col("image_id")),
            "dec": key_dec(F.col("image_id")),
            "beam_bmaj": 0.002 + (F.col("image_id") % 7) * 0.0005,
            "beam_bmin": 0.002 + (F.col("image_id") % 5) * 0.0002,
            "beam_bpa": (F.col("image_id") % 180).cast("double"),
        }
    )


def run_images_sql(epoch_days: int = 1) -> str:
    return f"""
  SELECT *, image_id AS id, printf('field.i.IMG%05d.cont.taylor.0', image_id) AS name,
    (image_id * 137.508::DOUBLE) % 360.0::DOUBLE AS ra, -80.0::DOUBLE + (image_id * 61.803::DOUBLE) % 160.0::DOUBLE AS dec,
    0.002::DOUBLE + (image_id % 7) * 0.0005::DOUBLE AS beam_bmaj, 0.002::DOUBLE + (image_id % 5) * 0.0002::DOUBLE AS beam_bmin,
    CAST(image_id % 180 AS DOUBLE) AS beam_bpa
  FROM (SELECT image_id, min(epoch) AS epoch, min(datetime) AS datetime, min(local_rms) AS rms_min, max(local_rms) AS rms_max
        FROM ({measurements_sql(epoch_days)}) GROUP BY image_id)
"""
