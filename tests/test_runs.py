"""Whole runs: new sources, gaps filled, images added, runs removed, arriving files."""

import datetime as dt

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from lumitrace.operators import lifecycle
from lumitrace.plans import pipeline
from lumitrace.settings import RunSettings
from lumitrace.sources.tables import RunStore
from lumitrace.streaming.increments import Increments

MEAS = (
    "id long, image_id long, ra double, dec double, uncertainty_ew double, uncertainty_ns double, weight_ew double, weight_ns double, forced boolean, "
    "flux_int double, flux_int_err double, flux_peak double, flux_peak_err double, flux_int_isl_ratio double, flux_peak_isl_ratio double, "
    "compactness double, snr double, has_siblings boolean, island_id string, name string"
)
# Two fields: A is seen in four epochs, C (far away) in epochs 1 and 4.
FIELDS = {"A": (150.0, -30.0, [1, 2, 3, 4]), "C": (20.0, 10.0, [1, 4])}


def images_of(spark, epochs):
    rows = []
    for number, (ra, dec, seen) in enumerate(FIELDS.values(), 1):
        for e in seen:
            if e in epochs:
                when = dt.datetime(2020, 1, e, number)
                rows.append((10 * e + number, f"f.i.IMG{e}{number}.cont", e, when, ra, dec, number, 0.1, 0.004, 0.003, 10.0))
    schema = "image_id long, name string, epoch long, datetime timestamp, ra double, dec double, skyreg_id long, rms_min double, beam_bmaj double, beam_bmin double, beam_bpa double"
    return frame(spark, rows, schema)


def regions(spark):
    rows = [(n, ra, dec, 5.0) for n, (ra, dec, _) in enumerate(FIELDS.values(), 1)]
    return frame(spark, rows, "id long, centre_ra double, centre_dec double, xtr_radius double")


def measurements(spark):
    unc, rows, n = 1 / 3600, [], 0
    spots = {"A": [(150.0, -30.0, 10.0), (150.1, -30.0, 20.0), (149.9, -30.1, 5.0)], "C": [(20.0, 10.0, 8.0), (20.1, 10.1, 9.0)]}
    for number, (field, (_, _, seen)) in enumerate(FIELDS.items(), 1):
        for e in seen:
            for i, (ra, dec, flux) in enumerate(spots[field]):
                # The third source of A appears in epoch 3; the second drops out in epoch 2.
                if field == "A" and ((i == 2 and e < 3) or (i == 1 and e == 2)):
                    continue
                n += 1
                f = flux * (1 + 0.5 * e)
                rows.append((100 * e + n, 10 * e + number, ra + e * 1e-5, dec, unc, unc, unc**-2, unc**-2, False, f, 0.3, f, 0.3, 1.0, 1.0, 1.0, f / 0.3, False, f"island_{i}", f"IMG_{n}"))
    return frame(spark, rows, MEAS)


def pixel_tables(spark):
    wcs = images_of(spark, [1, 2, 3, 4]).select(
        "image_id", F.lit("SIN").alias("projection"), F.col("ra").alias("crval1"), F.col("dec").alias("crval2"), F.lit(20.5).alias("crpix1"), F.lit(20.5).alias("crpix2"),
        F.lit(-0.02).alias("cdelt1"), F.lit(0.02).alias("cdelt2"), F.lit(40).alias("naxis1"), F.lit(40).alias("naxis2"), F.lit(0.04).alias("bmaj"),
    )
    grid = spark.range(1600).select(F.floor(F.col("id") / 40).alias("i"), (F.col("id") % 40).alias("j"))
    value = F.lit(0.0005)
    ids = F.array(*[F.lit(x).cast("long") for x in (11, 21, 31, 41, 12, 42)])
    return wcs, grid.select(F.explode(ids).alias("image_id"), "i", "j", value.alias("value"))


def fits(spark):
    rows = [(s, im, 0.004, 0.0002, 1.0) for s in range(1, 12) for im in (11, 21, 31, 41, 12, 42)]
    return frame(spark, rows, "source long, image_id long, flux double, flux_err double, chi2 double")


SETTINGS = RunSettings(monitor=True)


def shape(tables):
    """Ids differ between ways of running; sizes, positions and flags must not."""
    return rows_of(
        tables["sources"].select(F.round("wavg_ra", 6).alias("ra"), F.round("wavg_dec", 6).alias("dec"), "n_meas", "n_meas_forced", "new", F.round("new_high_sigma", 6).alias("sigma"), F.round("eta_peak", 6).alias("eta")),
        "ra", "dec", "n_meas", "n_meas_forced", "new", "sigma", "eta",
    )


def test_run_and_added_images(spark, tmp_path):
    m, reg = measurements(spark), regions(spark)
    wcs, pix = pixel_tables(spark)
    extra = dict(wcs=wcs, noise_pixels=pix, fits=fits(spark))
    whole = pipeline.run(m, images_of(spark, [1, 2, 3, 4]), reg, SETTINGS, **extra)
    got = shape(whole)
    assert len(got) == 5
    # The late source of A is new: 5 * 2.5 mJy over 0.5 mJy; its two early images are filled.
    late = [r for r in got if r[4]]
    assert len(late) == 1 and late[0][2:4] == (4, 2) and late[0][5] == pytest.approx(25.0)
    gap = [r for r in got if r[3] == 1]
    assert len(gap) == 1 and gap[0][2] == 4
    forced = whole["measurements"].filter("forced")
    assert forced.count() == 3
    assert rows_of(forced, "name")[0][0].endswith("_f_run001")
    # Fields A and C never see each other.
    assert whole["missing"].filter("image_id in (12, 42) and wavg_ra > 100").count() == 0

    store = RunStore(spark, str(tmp_path / "store"))
    first_images, all_images = images_of(spark, [1, 2]), images_of(spark, [1, 2, 3, 4])
    early = m.join(first_images.select("image_id"), "image_id", "left_semi")
    pipeline.run_and_store(store, "r", early, first_images, reg, SETTINGS, **extra)
    pipeline.add_images(store, "r", m, all_images, reg, SETTINGS, **extra)
    added = {t: store.read("r", t) for t in ("sources", "measurements")}
    assert shape(added) == got
    assert store.restore("r") == 1
    assert store.read("r", "sources").count() == 4


def test_removing_a_run_keeps_what_others_use(spark):
    t = {
        "runs": frame(spark, [(1,), (2,)], "id long"),
        "sources": frame(spark, [(1, 1), (2, 2)], "id long, run_id long"),
        "associations": frame(spark, [(1, 1), (1, 2), (2, 2), (1, 9)], "source_id long, meas_id long"),
        "relations": frame(spark, [(1, 2), (2, 1)], "from_source_id long, to_source_id long"),
        "run_images": frame(spark, [(1, 10), (1, 11), (2, 11)], "run_id long, image_id long"),
        "run_regions": frame(spark, [(1, 5), (1, 6), (2, 6)], "run_id long, skyreg_id long"),
        "images": frame(spark, [(10,), (11,)], "id long"),
        "sky_regions": frame(spark, [(5,), (6,)], "id long"),
        "measurements": frame(spark, [(1, 10, False), (2, 11, False), (9, 11, True)], "id long, image_id long, forced boolean"),
    }
    left = lifecycle.remove_run(t, 1)
    assert rows_of(left["images"], "id") == [(11,)]
    assert rows_of(left["sky_regions"], "id") == [(6,)]
    assert rows_of(left["measurements"], "id") == [(2,)]
    assert rows_of(left["associations"], "source_id", "meas_id") == [(2, 2)]
    assert left["relations"].count() == 0 and rows_of(left["runs"], "id") == [(2,)]


def test_arriving_files(spark, tmp_path):
    m = measurements(spark).select("id", "image_id", "ra", "dec", "uncertainty_ew", "uncertainty_ns", "weight_ew", "weight_ns")
    images = images_of(spark, [1, 2, 3, 4])
    steps = Increments(spark, str(tmp_path / "state"), RunSettings())
    folder = str(tmp_path / "in")
    for epochs in ([1, 2], [3, 4]):
        arrived = m.join(images.filter(F.col("epoch").isin(epochs)).select("image_id"), "image_id", "left_semi")
        arrived.select(*m.columns).coalesce(1).write.mode("append").parquet(folder)
        steps.start(folder, m.schema, images, str(tmp_path / "cp")).awaitTermination()
    out = steps.load()
    sizes = sorted(r["count"] for r in out.associations.groupBy("source").count().collect())
    assert sizes == [2, 2, 2, 3, 4]
    assert out.next_id == 6


def test_manifests_and_settings(spark):
    from lumitrace.operators import settings_tables as S

    def manifest(rows):
        return frame(spark, rows, "epoch string, kind string, pos long, path string")

    good = [(e, k, p, f"{k}{e}{p}") for e in ("1", "2") for k in ("image", "catalogue", "noise") for p in (0, 1)]
    assert S.manifest_problems(manifest(good)).isEmpty()
    problems = lambda rows, **kw: {r["problem"] for r in S.manifest_problems(manifest(rows), **kw).collect()}
    assert problems(good, monitor=True) == {"count_mismatch", "missing_kind"}
    assert problems(good[:-1]) == {"count_mismatch"}
    assert problems([(e, k, p, path.replace("21", "20")) for e, k, p, path in good]) == {"duplicate_path"}
    assert problems([r for r in good if r[0] == "1" and r[2] == 0]) == {"too_few_images"}
    assert problems(good, max_images=3) == {"too_many_images"}
    kv = lambda rows: frame(spark, rows, "key string, value string")
    before = kv([("inputs.image", "a"), ("method", "basic")])
    assert S.rerun_mode(before, before) == "same"
    assert S.rerun_mode(before, kv([("inputs.image", "a,b"), ("method", "basic")])) == "add_images"
    assert S.rerun_mode(before, kv([("inputs.image", "a,b"), ("method", "advanced")])) == "full_rerun"


def test_only_what_is_made_use_of_travels(spark, monkeypatch):
    """Light curves have no columns that nothing is made of; regions without images are not met with sources."""
    from lumitrace.operators import coverage

    seen, region_join, missing_images = {}, coverage.region_join, coverage.missing_images
    monkeypatch.setattr(coverage, "region_join", lambda rows, discs, **kw: seen.update(regions=discs.count()) or region_join(rows, discs, **kw))
    monkeypatch.setattr(coverage, "missing_images", lambda curves, *rest: seen.update(curves=curves.columns) or missing_images(curves, *rest))
    bare = frame(spark, [(9, 150.0, -30.0, 5.0)], "id long, centre_ra double, centre_dec double, xtr_radius double")
    tables = pipeline.run(measurements(spark), images_of(spark, [1, 2, 3, 4]), regions(spark).unionByName(bare), RunSettings(method="basic"))
    assert tables["sources"].count() == 5
    assert seen["regions"] == 2
    assert "island_id" not in seen["curves"] and "name" not in seen["curves"]
