"""Whole runs with sampled noise, new sources and forced rows: in one go, and growing with the images that arrive."""

import re
from dataclasses import replace

from pyspark.sql import functions as F

from lumitrace.functions.display import round_to
from lumitrace.operators import association
from lumitrace.plans import pipeline
from lumitrace.registry.associating import SETTINGS, chain_sql, two_epochs_sql
from lumitrace.registry.base import query, rnd, rnds, rounded, sep_sql
from lumitrace.registry.covering import COVER_STEPS, regions
from lumitrace.registry.statistics import statistics_body
from lumitrace.registry.storing import _CENTRE, _RUN_FORKS
from lumitrace.settings import RunSettings
from lumitrace.sources.driver_tables import key_dec, key_ra, measurements, run_images, table
from lumitrace.sources.tables import RunStore
from lumitrace.streaming.increments import Coverage, Increments
from lumitrace.workspace import materialize, new_path

DAYS = 10
# Noise images: SIN, SIDE pixels of SCALE degrees a side.
SIDE, SCALE = 31, 4.0
MONITORED = RunSettings(radius=1.2, epoch_duplicate_radius=0.6, method="basic", monitor=True, pair_metrics=False)


def _run_tables(spark, sf_dir):
    """Measurements, images of five sky regions, and what coverage needs."""
    m = measurements(spark, sf_dir, DAYS).drop("source", "epoch", "datetime").withColumn("forced", F.lit(False))
    region = F.col("image_id") % 10
    # Images and pixels are few, and derived from whole tables.
    images = materialize(run_images(spark, sf_dir, DAYS).withColumns({"skyreg_id": region, "ra": key_ra(region), "dec": key_dec(region)}), "run-images")
    number = lambda v: F.lit(float(v))
    wcs = images.select(
        "image_id", F.lit("SIN").alias("projection"), F.col("ra").alias("crval1"), F.col("dec").alias("crval2"), number(16).alias("crpix1"), number(16).alias("crpix2"),
        number(-SCALE).alias("cdelt1"), number(SCALE).alias("cdelt2"), F.lit(SIDE).alias("naxis1"), F.lit(SIDE).alias("naxis2"), number(0.02).alias("bmaj"),
    )
    k, part = F.col("l_orderkey"), F.col("l_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        (10 * (1 + k % 3) + 1 + part % 5).alias("image_id"), ((k * 7 + F.col("l_linenumber")) % SIDE).alias("i"), ((part * 3 + F.floor(k / SIDE)) % SIDE).alias("j"), (F.col("l_quantity").cast("double") / 1e5).alias("value")
    )
    pixels = materialize(lines.groupBy("image_id", "i", "j").agg(F.min("value").alias("value")), "pixels")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("long").alias("source"), (10 * (1 + F.col("o_orderkey") % 3) + 1 + F.floor(F.col("o_orderkey") / 3) % 5).alias("image_id"), (F.col("o_totalprice").cast("double") / 1e7).alias("price")
    )
    fits = orders.groupBy("source", "image_id").agg(F.min("price").alias("price")).select(
        "source", "image_id", F.when((F.col("source") + F.col("image_id")) % 11 == 0, 0.0).otherwise(F.col("price")).alias("flux"), (0.0001 + (F.col("source") % 7) * 0.0001).alias("flux_err"), F.lit(1.0).alias("chi2")
    )
    discs = regions(spark, sf_dir).withColumn("xtr_radius", F.lit(75.0))
    return m, images, Coverage(discs, wcs, pixels, fits)


_DETECTIONS = re.sub(r"\bim\b", "ri", re.sub(r"\bd\b", "lc", COVER_STEPS))
_L = "radians(wavg_ra - ri.ra)"
_FORCED_ERR = "(sqrt(1.0::DOUBLE + 0.0001::DOUBLE) / 3600)"
_RUN_SQL = f"""WITH {chain_sql(DAYS, centre=_CENTRE)},
 ri AS (SELECT *, image_id % 10 AS skyreg_id FROM im),
 rg AS (SELECT CAST(n_nationkey AS BIGINT) AS id, (n_nationkey * 137.508::DOUBLE) % 360.0::DOUBLE AS centre_ra, -80.0::DOUBLE + (n_nationkey * 61.803::DOUBLE) % 160.0::DOUBLE AS centre_dec, 75.0::DOUBLE AS xtr_radius FROM nation),
 lc AS MATERIALIZED (SELECT h.source, false AS forced, im.datetime, k.* EXCLUDE (source, forced, datetime) FROM h JOIN k ON h.meas_id = k.id JOIN im ON k.image_id = im.image_id),
 {_DETECTIONS},
 cand AS (SELECT mf.* FROM mf WHERE NOT in_primary AND image_time < detection_time AND flux_peak / rms_min >= 5.0::DOUBLE),
 spot AS (SELECT cand.source, cand.image_id, cand.flux_peak, sin(radians(ri.dec)) * sin(radians(wavg_dec)) + cos(radians(ri.dec)) * cos(radians(wavg_dec)) * cos({_L}) AS facing,
   CAST(floor(degrees(cos(radians(ri.dec)) * sin(radians(wavg_dec)) - sin(radians(ri.dec)) * cos(radians(wavg_dec)) * cos({_L})) / {SCALE}::DOUBLE + 16 - 1 + 0.5::DOUBLE) AS BIGINT) AS i,
   CAST(floor(degrees(cos(radians(wavg_dec)) * sin({_L})) / -{SCALE}::DOUBLE + 16 - 1 + 0.5::DOUBLE) AS BIGINT) AS j FROM cand JOIN ri ON cand.image_id = ri.image_id),
 px AS (SELECT 10 * (1 + l_orderkey % 3) + 1 + l_partkey % 5 AS image_id, (l_orderkey * 7 + l_linenumber) % {SIDE} AS i, (l_partkey * 3 + l_orderkey // {SIDE}) % {SIDE} AS j, min(l_quantity::DOUBLE / 1e5::DOUBLE) AS value FROM lineitem GROUP BY 1, 2, 3),
 fresh AS (SELECT spot.source, max(px.value * 1000) AS rms FROM spot JOIN px USING (image_id, i, j) WHERE facing > 0 AND i BETWEEN 0 AND {SIDE - 1} AND j BETWEEN 0 AND {SIDE - 1} AND px.value <> 0 GROUP BY spot.source),
 sigma AS (SELECT fresh.source, max(cand.flux_peak) / max(rms) AS new_high_sigma FROM fresh JOIN cand ON fresh.source = cand.source GROUP BY fresh.source),
 ft AS (SELECT source, image_id, CASE WHEN (source + image_id) % 11 = 0 THEN 0.0::DOUBLE ELSE price END AS flux, 0.0001::DOUBLE + (source % 7) * 0.0001::DOUBLE AS flux_err FROM (
   SELECT o_custkey::BIGINT AS source, 10 * (1 + o_orderkey % 3) + 1 + (o_orderkey // 3) % 5 AS image_id, min(o_totalprice::DOUBLE / 1e7::DOUBLE) AS price FROM orders GROUP BY 1, 2)),
 ff AS (SELECT mf.source, flux * 1000 AS f, flux_err * 1000 AS e FROM mf JOIN ft USING (source, image_id) WHERE flux_peak / rms_min > 3.0::DOUBLE AND flux <> 0),
 al AS (SELECT source, id, forced, has_siblings, weight_ew, weight_ns, ra, dec, compactness, snr, flux_int, flux_int_err, flux_peak, flux_peak_err, flux_int_isl_ratio, flux_peak_isl_ratio FROM lc
   UNION ALL SELECT source, -1, true, false, 1 / pow({_FORCED_ERR}, 2), 1 / pow({_FORCED_ERR}, 2), 0, 0, 1, f / e, f, e, f, e, 1, 1 FROM ff),
 s AS MATERIALIZED ({statistics_body(lambda e: e).replace("FROM m GROUP", "FROM al GROUP")}),
 rel AS (SELECT x AS source, count(DISTINCT y) AS n_rel FROM ({_RUN_FORKS}) WHERE x <> y GROUP BY x),
 nn AS (SELECT a.source, min({sep_sql("a.wavg_ra", "a.wavg_dec", "b.wavg_ra", "b.wavg_dec")}) AS n_neighbour_dist FROM s a JOIN s b ON a.source <> b.source GROUP BY a.source)
 SELECT CAST(s.source AS BIGINT) AS source, n_meas, n_meas_forced, coalesce(n_rel, 0) AS n_rel, new_high_sigma IS NOT NULL AS new, {rnd("coalesce(new_high_sigma, 0)", 5)} AS new_high_sigma,
  {rnds("wavg_ra", "wavg_dec", "max_flux_int", "v_peak", "n_neighbour_dist", digits=5)}, {rnd("avg_flux_peak", 10)} AS avg_flux_peak, {rnd("eta_peak", 4)} AS eta_peak
 FROM s LEFT JOIN rel USING (source) LEFT JOIN nn USING (source) LEFT JOIN sigma USING (source)"""


def _final(sources):
    # In one pass: joins of parts of a table work it out once for each part.
    digits = dict.fromkeys(["new_high_sigma", "wavg_ra", "wavg_dec", "max_flux_int", "v_peak", "n_neighbour_dist"], 5) | {"avg_flux_peak": 10, "eta_peak": 4}
    return sources.select("source", "n_meas", "n_meas_forced", "n_rel", "new", *[round_to(F.col(name), n).alias(name) for name, n in digits.items()])


@query("monitored_run", _RUN_SQL)
def monitored_run(spark, sf_dir):
    """A run in one go, with noise sampled from images, new sources and forced measurements."""
    m, images, extra = _run_tables(spark, sf_dir)
    tables = pipeline.run(m, images, extra.regions, MONITORED, wcs=extra.wcs, noise_pixels=extra.noise_pixels, fits=extra.fits)
    return _final(tables["sources"])


def grown(spark, sf_dir, epochs_by_batch):
    """The run with its epochs arriving in batches."""
    m, images, extra = _run_tables(spark, sf_dir)
    # Every batch looks for its fits among all.
    extra = replace(extra, fits=materialize(extra.fits, "fits"))
    steps = Increments(spark, new_path(spark, "grown"), MONITORED, width=30.0)
    for batch, wanted in enumerate(epochs_by_batch):
        rows = m.join(images.filter(wanted).select("image_id"), "image_id", "left_semi")
        steps.process(rows, batch, images, extra)
    return steps


@query("images_added_run", _RUN_SQL)
def images_added_run(spark, sf_dir):
    """The same run, its epochs added one after the other: forced rows only where they are new, sources replaced patch by patch."""
    return _final(grown(spark, sf_dir, ["epoch <= 1", "epoch = 2", "epoch > 2"]).tables()["sources"])


_TWO = f"{two_epochs_sql('basic')} SELECT CAST(source AS BIGINT) AS source, meas_id, {rnd('d2d', 5)} AS d2d FROM a"


def _stored_run(spark, sf_dir):
    """Tables of a run over the first of two epochs, and all measurements and images."""
    m = measurements(spark, sf_dir, 15).drop("source").withColumn("forced", F.lit(False))
    images = materialize(run_images(spark, sf_dir, 15), "run-images")
    first = images.filter("epoch = 1")
    done = association.associate(m.join(first.select("image_id"), "image_id", "left_semi"), first, SETTINGS)
    store = RunStore(spark, new_path(spark, "stored-run"))
    store.save("run", {"associations": done.associations, "relations": done.relations, "measurements": m})
    return {t: store.read("run", t) for t in ("associations", "relations", "measurements")}, m, images


@query("rebuilt_run", _TWO)
def rebuilt_run(spark, sf_dir):
    """The state of a stored run of one epoch is rebuilt from its tables, then the second epoch is added."""
    stored, m, images = _stored_run(spark, sf_dir)
    state = association.rebuild(stored["associations"], stored["measurements"], stored["relations"], images)
    return rounded(association.associate(m, images.filter("epoch = 2"), SETTINGS, state).associations.select("source", "meas_id", "d2d"), 5)


@query("rerun_without_new_images", f"{two_epochs_sql('basic')} SELECT CAST(src AS BIGINT) AS source, {rnd('bra')} AS src_ra, {rnd('bdec')} AS src_dec, {rnd('bew')} AS src_ew, 1::BIGINT AS n FROM seeds")
def rerun_without_new_images(spark, sf_dir):
    """Images are to be added to a stored run, but none is new: its rebuilt state is what comes back."""
    stored, m, images = _stored_run(spark, sf_dir)
    state = association.rebuild(stored["associations"], stored["measurements"], stored["relations"], images)
    again = association.associate(m, images.filter("epoch < 1"), SETTINGS, state)
    n = again.associations.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return rounded(association.positions(again.state).select("source", "src_ra", "src_dec", "src_ew").join(n, "source"))
