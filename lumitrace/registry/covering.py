"""Coverage, new sources, pixel lookups and forced measurements."""

from pyspark.sql import functions as F

from lumitrace.operators import coverage, forced, pixels, stats
from lumitrace.registry.base import lifted_sql, query, rnd, rnds, rounded, sep_sql
from lumitrace.settings import RunSettings
from lumitrace.sources.pixel_tiles import PixelTiles
from lumitrace.workspace import new_path
from lumitrace.sources.driver_tables import key_dec, key_ra, measurements, measurements_sql, table

DAYS = 1


def detections(spark, sf_dir):
    """One-day epochs; each region (nation) has one image per epoch and sees the users of its number."""
    m = measurements(spark, sf_dir, DAYS)
    return m.withColumn("image_id", F.col("epoch") * 100 + F.col("source") % 25)


def images(spark, sf_dir):
    d = detections(spark, sf_dir)
    return d.groupBy("image_id").agg(F.min("epoch").alias("epoch"), F.min("datetime").alias("datetime"), F.min("local_rms").alias("rms_min")).withColumns(
        {
            "skyreg_id": F.col("image_id") % 100,
            "beam_bmaj": 0.002 + (F.col("image_id") % 7) * 0.0005,
            "beam_bmin": 0.002 + (F.col("image_id") % 5) * 0.0002,
            "beam_bpa": (F.col("image_id") % 180).cast("double"),
        }
    )


def regions(spark, sf_dir):
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf_dir, "nation").select(k.alias("id"), key_ra(k).alias("centre_ra"), key_dec(k).alias("centre_dec"), (28.0 + k % 5).alias("xtr_radius"))


_COVER_TABLES = f"""d AS (SELECT * EXCLUDE (image_id), epoch * 100 + source % 25 AS image_id FROM ({measurements_sql(DAYS)})),
 im AS (SELECT image_id, min(epoch) AS epoch, min(datetime) AS datetime, min(local_rms) AS rms_min, image_id % 100 AS skyreg_id,
   0.002::DOUBLE + (image_id % 7) * 0.0005::DOUBLE AS beam_bmaj, 0.002::DOUBLE + (image_id % 5) * 0.0002::DOUBLE AS beam_bmin,
   CAST(image_id % 180 AS DOUBLE) AS beam_bpa FROM d GROUP BY image_id),
 rg AS (SELECT CAST(n_nationkey AS BIGINT) AS id, (n_nationkey * 137.508::DOUBLE) % 360.0::DOUBLE AS centre_ra,
   -80.0::DOUBLE + (n_nationkey * 61.803::DOUBLE) % 160.0::DOUBLE AS centre_dec, 28.0::DOUBLE + n_nationkey % 5 AS xtr_radius FROM nation)"""

# From detections d, images im and regions rg to the missing images with the flux of the first detection.
COVER_STEPS = f"""pos0 AS (SELECT source, sum(weight_ew * {lifted_sql("ra")}) FILTER (NOT forced) / sum(weight_ew) FILTER (NOT forced) AS wra,
   sum(weight_ns * dec) FILTER (NOT forced) / sum(weight_ns) FILTER (NOT forced) AS wavg_dec FROM d GROUP BY source),
 pos AS (SELECT source, CASE WHEN wra >= 360 THEN wra - 360 ELSE wra END AS wavg_ra, wavg_dec FROM pos0),
 cov AS (SELECT source, rg.id AS skyreg_id, {sep_sql("wavg_ra", "wavg_dec", "centre_ra", "centre_dec")} AS sep, xtr_radius FROM pos, rg),
 ideal AS (SELECT source, epoch, image_id, datetime FROM (SELECT cov.source, im.epoch, im.image_id, im.datetime,
   row_number() OVER (PARTITION BY cov.source, im.epoch ORDER BY sep, cov.skyreg_id, im.datetime, im.image_id) AS rn
   FROM cov JOIN im ON cov.skyreg_id = im.skyreg_id WHERE sep < xtr_radius) WHERE rn = 1),
 seen AS (SELECT DISTINCT d.source, d.image_id, d.epoch, im.datetime FROM d JOIN im ON d.image_id = im.image_id),
 det AS (SELECT source, image_id AS detection, datetime AS detection_time FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY datetime, image_id) AS rn FROM seen) WHERE rn = 1),
 prim AS (SELECT source, image_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY datetime, image_id) AS rn FROM ideal) WHERE rn = 1),
 mis AS (SELECT ideal.source, ideal.image_id, ideal.epoch, ideal.datetime AS image_time, detection, detection_time,
   EXISTS (SELECT 1 FROM prim JOIN seen ON prim.source = seen.source AND prim.image_id = seen.image_id WHERE prim.source = ideal.source) AS in_primary, wavg_ra, wavg_dec
   FROM ideal JOIN det ON ideal.source = det.source JOIN pos ON ideal.source = pos.source
   WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.source = ideal.source AND (seen.image_id = ideal.image_id OR seen.epoch = ideal.epoch))),
 fl AS (SELECT source, image_id AS detection, max(flux_peak) AS flux_peak FROM d GROUP BY source, image_id),
 mf AS (SELECT mis.*, fl.flux_peak, im.rms_min FROM mis JOIN im ON mis.image_id = im.image_id LEFT JOIN fl ON mis.source = fl.source AND mis.detection = fl.detection)"""
COVER_CTE = f"{_COVER_TABLES}, {COVER_STEPS}"


def missing(spark, sf_dir):
    return coverage.missing_images(detections(spark, sf_dir), images(spark, sf_dir), regions(spark, sf_dir))


@query("ideal_images", f"WITH {COVER_CTE} SELECT source, epoch, image_id, datetime FROM ideal")
def ideal_images(spark, sf_dir):
    return coverage.ideal_images(stats.average_position(detections(spark, sf_dir)), images(spark, sf_dir), regions(spark, sf_dir))


@query(
    "missing_images",
    f"WITH {COVER_CTE} SELECT source, image_id, epoch, image_time, detection, detection_time, in_primary, {rnds('wavg_ra', 'wavg_dec')} FROM mis",
)
def missing_images(spark, sf_dir):
    return rounded(missing(spark, sf_dir))


@query(
    "new_source_candidates",
    f"""WITH {COVER_CTE} SELECT source, image_id, {rnd("flux_peak / rms_min", 5)} AS diff_sigma FROM mf
    WHERE NOT in_primary AND image_time < detection_time AND flux_peak / rms_min >= 5.0::DOUBLE""",
)
def new_source_candidates(spark, sf_dir):
    found = coverage.new_source_candidates(missing(spark, sf_dir), detections(spark, sf_dir), images(spark, sf_dir), 5.0)
    return rounded(found.select("source", "image_id", "diff_sigma"), 5)


@query(
    "new_source_flags",
    f"""WITH {COVER_CTE}, c AS (SELECT source, max(flux_peak) AS f, max(0.3::DOUBLE + image_id % 7) FILTER (image_id % 9 <> 0) AS r FROM mf
      WHERE NOT in_primary AND image_time < detection_time AND flux_peak / rms_min >= 5.0::DOUBLE GROUP BY source)
    SELECT pos.source, r IS NOT NULL AS new, {rnd("coalesce(f / r, 0)", 6)} AS new_high_sigma FROM pos LEFT JOIN c ON pos.source = c.source""",
)
def new_source_flags(spark, sf_dir):
    found = coverage.new_source_candidates(missing(spark, sf_dir), detections(spark, sf_dir), images(spark, sf_dir), 5.0)
    # Noise by image number; every ninth image has none at the position.
    rms = F.when(F.col("image_id") % 9 != 0, 0.3 + F.col("image_id") % 7)
    sampled = found.select("source", "image_id", rms.alias("true_rms"))
    new = coverage.new_high_sigma(found, sampled)
    return rounded(coverage.flag_new(stats.average_position(detections(spark, sf_dir)).select("source"), new))


@query(
    "forced_candidates",
    f"WITH {COVER_CTE} SELECT source, image_id, {rnds('wavg_ra', 'wavg_dec', 'flux_peak')}, {rnd('flux_peak / rms_min', 5)} AS max_snr FROM mf WHERE flux_peak / rms_min > 3.0::DOUBLE",
)
def forced_candidates(spark, sf_dir):
    found = forced.forced_candidates(missing(spark, sf_dir), detections(spark, sf_dir), images(spark, sf_dir), 3.0)
    return rounded(found.withColumn("max_snr", F.floor(F.col("max_snr") * 1e5 + 0.5) / 1e5))


@query(
    "forced_candidates_adding",
    f"""WITH {COVER_CTE} SELECT source, image_id FROM mis WHERE image_id NOT IN (SELECT image_id FROM im WHERE epoch <= 15)
    OR (image_id IN (SELECT image_id FROM im WHERE epoch <= 15) AND source NOT IN (SELECT s_suppkey FROM supplier))""",
)
def forced_candidates_adding(spark, sf_dir):
    done_images = images(spark, sf_dir).filter("epoch <= 15").select("image_id")
    done_sources = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"))
    return forced.candidates_when_adding(missing(spark, sf_dir), done_images, done_sources).select("source", "image_id")


# Fits for every event: some fluxes missing or 0, some errors 0, some fits diverged.
FITS_SQL = f"""SELECT source, image_id, id, CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 0.0::DOUBLE ELSE flux_peak / 1000 END AS flux,
  CASE WHEN k % 17 = 0 THEN 0.0::DOUBLE ELSE flux_peak_err / 1000 END AS flux_err, CASE WHEN k % 19 = 0 THEN 'inf'::DOUBLE ELSE k::DOUBLE END AS chi2
  FROM ({measurements_sql()})"""
GOOD_FIT = "flux IS NOT NULL AND flux <> 0 AND flux_err <> 0 AND chi2 <> 'inf'::DOUBLE"


def fits(spark, sf_dir):
    k = F.col("k")
    return measurements(spark, sf_dir).select(
        "id", F.col("id").alias("source"), "image_id",
        F.when(k % 11 == 0, None).when(k % 13 == 0, 0.0).otherwise(F.col("flux_peak") / 1000).alias("flux"),
        F.when(k % 17 == 0, 0.0).otherwise(F.col("flux_peak_err") / 1000).alias("flux_err"),
        F.when(k % 19 == 0, float("inf")).otherwise(k.cast("double")).alias("chi2"),
    )


@query(
    "usable_fits",
    f"""SELECT id AS source, image_id, {rnd("flux * 1000")} AS flux_int, {rnd("flux_err * 1000")} AS flux_int_err, chi2 AS chi_squared_fit
    FROM ({FITS_SQL}) WHERE {GOOD_FIT}""",
)
def usable_fits(spark, sf_dir):
    return rounded(forced.clean_fits(fits(spark, sf_dir)))


def _empty_images(spark, sf_dir):
    """The run's images and 25 more that hold no measurement."""
    im = measurements(spark, sf_dir).groupBy("image_id").agg(F.min("datetime").alias("datetime"))
    im = im.withColumns({"beam_bmaj": 0.002 + (F.col("image_id") % 7) * 0.0005, "beam_bmin": F.lit(0.002), "beam_bpa": (F.col("image_id") % 180).cast("double")})
    return im


@query(
    "island_maxima",
    f"""WITH m AS ({measurements_sql()}), x AS (SELECT DISTINCT image_id FROM m UNION SELECT 100000 + n_nationkey FROM nation)
    SELECT x.image_id, coalesce(min(regexp_extract(island_id, '^(.*)_[^_]*$', 1) || '_'), 'island_') AS prefix,
    coalesce(max(CAST(split_part(island_id, '_', 3) AS BIGINT)) + 1, 1) AS max_id FROM x LEFT JOIN m ON x.image_id = m.image_id GROUP BY x.image_id""",
)
def island_maxima(spark, sf_dir):
    m = measurements(spark, sf_dir)
    extra = table(spark, sf_dir, "nation").select((F.col("n_nationkey").cast("long") + 100000).alias("image_id"))
    return forced.island_maxima(m, m.select("image_id").union(extra).distinct())


_FORCED = ["flux_int", "flux_int_err", "flux_peak", "snr", "bmaj", "bmin", "pa", "compactness", "flux_int_isl_ratio", "ra", "dec"]


@query(
    "forced_measurements",
    f"""WITH m AS ({measurements_sql()}), f AS (SELECT id AS source, image_id, flux * 1000 AS flux_int, flux_err * 1000 AS flux_int_err FROM ({FITS_SQL}) WHERE {GOOD_FIT}),
     mx AS (SELECT image_id, min(regexp_extract(island_id, '^(.*)_[^_]*$', 1) || '_') AS prefix, max(CAST(split_part(island_id, '_', 3) AS BIGINT)) + 1 AS max_id FROM m GROUP BY image_id),
     c AS (SELECT f.*, prefix || CAST(max_id - 1 + row_number() OVER (PARTITION BY f.image_id ORDER BY source) AS VARCHAR) AS island_id FROM f JOIN mx USING (image_id))
    SELECT c.source, c.image_id, c.island_id, replace(c.island_id, 'island', 'component') || 'a' AS component_id,
     replace(c.island_id, 'island', 'component') || 'a_f_run003' AS name, true AS forced, false AS has_siblings,
     {rnd("c.flux_int")} AS flux_int, {rnd("c.flux_int_err")} AS flux_int_err, {rnd("c.flux_int")} AS flux_peak, {rnd("c.flux_int / c.flux_int_err")} AS snr,
     {rnd("(0.002::DOUBLE + (c.image_id % 7) * 0.0005::DOUBLE) * 3600")} AS bmaj, {rnd("7.2::DOUBLE")} AS bmin, {rnd("c.image_id % 180")} AS pa,
     1.0::DOUBLE AS compactness, 1.0::DOUBLE AS flux_int_isl_ratio, {rnd("m.ra")} AS ra, {rnd("m.dec")} AS dec FROM c JOIN m ON c.source = m.id""",
)
def forced_measurements(spark, sf_dir):
    m = measurements(spark, sf_dir)
    im = _empty_images(spark, sf_dir)
    spots = m.select(F.col("id").alias("source"), F.col("ra").alias("wavg_ra"), F.col("dec").alias("wavg_dec"))
    rows = forced.complete_forced(forced.clean_fits(fits(spark, sf_dir)), spots, im, forced.island_maxima(m, im), RunSettings(), 3)
    return rounded(rows.select("source", "image_id", "island_id", "component_id", "name", "forced", "has_siblings", *_FORCED))


@query(
    "appended_forced",
    f"""WITH m AS ({measurements_sql()}) SELECT id, source, flux_peak, forced, image_id FROM m
    UNION ALL SELECT 1000000 + id, source, flux_peak / 1000 * 1000, true, image_id FROM m WHERE forced""",
)
def appended_forced(spark, sf_dir):
    m = measurements(spark, sf_dir)
    extra = m.filter("forced").select((F.col("id") + 1000000).alias("id"), "source", (F.col("flux_peak") / 1000 * 1000).alias("flux_peak"), F.lit(True).alias("forced"), "image_id", F.lit(1).alias("unused"))
    return forced.append_forced(m.select("id", "source", "flux_peak", "forced", "image_id"), extra)


@query(
    "without_run_forced",
    f"WITH m AS ({measurements_sql()}) SELECT id FROM m WHERE NOT (forced AND source IN (SELECT s_suppkey FROM supplier))",
)
def without_run_forced(spark, sf_dir):
    m = measurements(spark, sf_dir)
    links = m.select("source", F.col("id").alias("meas_id"))
    run_sources = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"))
    return forced.remove_forced(m, links, run_sources).select("id")


# Four images of 25 columns, made of the parts; blank where the size is 1.
PIXELS_SQL = """px AS (SELECT p_partkey % 4 AS image_id, (p_partkey // 4) // 25 AS i, (p_partkey // 4) % 25 AS j,
   CASE WHEN p_size = 1 THEN 'nan'::DOUBLE ELSE p_retailprice / 1e6::DOUBLE END AS value FROM part),
 wc AS (SELECT image_id, 10.0::DOUBLE * image_id AS ra0, 0.0::DOUBLE AS dec0, max(i) + 1 AS naxis2 FROM px GROUP BY image_id)"""


def pixel_table(spark, sf_dir):
    place = F.floor(F.col("p_partkey") / 4)
    value = F.when(F.col("p_size") == 1, float("nan")).otherwise(F.col("p_retailprice") / 1e6)
    return table(spark, sf_dir, "part").select((F.col("p_partkey") % 4).alias("image_id"), F.floor(place / 25).alias("i"), (place % 25).alias("j"), value.alias("value"))


def pixel_tiles(spark, sf_dir):
    """The same pixels, stored by tiles of 8 pixels a side."""
    tiles = PixelTiles(spark, new_path(spark, "pixels"), 8)
    tiles.write(pixel_table(spark, sf_dir))
    return tiles


def projections(spark, sf_dir):
    number = lambda v: F.lit(float(v))
    return pixel_table(spark, sf_dir).groupBy("image_id").agg((F.max("i") + 1).alias("naxis2")).select(
        "image_id", F.when(F.col("image_id") % 2 == 0, "SIN").otherwise("TAN").alias("projection"), (10.0 * F.col("image_id")).alias("crval1"), number(0).alias("crval2"),
        number(13).alias("crpix1"), number(11).alias("crpix2"), number(-0.01).alias("cdelt1"), number(0.01).alias("cdelt2"), F.lit(25).alias("naxis1"), "naxis2", number(0.02).alias("bmaj"),
    )


def spots(spark, sf_dir):
    """Every event at a pixel of one of the images, or just outside."""
    m = measurements(spark, sf_dir)
    image = F.col("id") % 4
    return m.select(
        F.col("id").alias("source"), "id", image.alias("image_id"), F.pmod(10.0 * image + (F.col("k") % 30 - 15) * 0.01, F.lit(360.0)).alias("ra"), ((F.col("id") % 23 - 12) * 0.01).alias("dec")
    )


SPOTS_SQL = f"""sp AS (SELECT id, id % 4 AS image_id, (10.0::DOUBLE * (id % 4) + (k % 30 - 15) * 0.01::DOUBLE + 360) % 360 AS ra, (id % 23 - 12) * 0.01::DOUBLE AS dec FROM ({measurements_sql()})),
 x0 AS (SELECT sp.*, wc.naxis2, degrees(cos(radians(dec)) * sin(radians(ra - ra0))) AS xi, degrees(sin(radians(dec))) AS et,
   CASE WHEN sp.image_id % 2 = 0 THEN 1.0::DOUBLE ELSE 1 / (cos(radians(dec)) * cos(radians(ra - ra0))) END AS st FROM sp JOIN wc ON sp.image_id = wc.image_id),
 lo AS (SELECT *, CAST(floor(et * st / 0.01::DOUBLE + 10.5::DOUBLE) AS BIGINT) AS i, CAST(floor(xi * st / -0.01::DOUBLE + 12.5::DOUBLE) AS BIGINT) AS j FROM x0)"""


@query(
    "sampled_noise",
    f"""WITH {PIXELS_SQL}, {SPOTS_SQL}, bad AS (SELECT DISTINCT lo.id FROM lo JOIN px ON lo.image_id = px.image_id AND px.i BETWEEN lo.i - 1 AND lo.i AND px.j BETWEEN lo.j - 1 AND lo.j WHERE isnan(px.value))
    SELECT lo.id AS source, lo.image_id, {rnd("CASE WHEN lo.i >= 4 AND lo.i < naxis2 - 4 AND lo.j >= 4 AND lo.j < 21 AND lo.id NOT IN (SELECT id FROM bad) THEN px.value * 1000 END", 6)} AS true_rms
    FROM lo LEFT JOIN px ON lo.image_id = px.image_id AND lo.i = px.i AND lo.j = px.j""",
)
def sampled_noise(spark, sf_dir):
    out = pixels.sample_noise(spots(spark, sf_dir), projections(spark, sf_dir), pixel_tiles(spark, sf_dir), edge_buffer=1.2)
    return rounded(out)


@query(
    "stamps",
    f"""WITH {PIXELS_SQL}, {SPOTS_SQL} SELECT lo.id, lo.image_id, px.i, px.j, {rnd("CASE WHEN isnan(px.value) THEN 0 ELSE px.value END", 7)} AS value
    FROM lo JOIN px ON lo.image_id = px.image_id AND abs(px.i - lo.i) <= 1 AND abs(px.j - lo.j) <= 1""",
)
def stamps(spark, sf_dir):
    out = pixels.stamp(spots(spark, sf_dir), projections(spark, sf_dir), pixel_tiles(spark, sf_dir), 2.0)
    return rounded(out.withColumn("value", F.nanvl("value", F.lit(0.0))), 7)
