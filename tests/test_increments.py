"""Growing runs on sky patches: what a batch reads and writes, batches that die, sources that move."""

import math
import os
import random

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F
from test_runs import SETTINGS, fits, images_of, measurements, pixel_tables, regions, shape

from lumitrace.operators import association
from lumitrace.operators.patches import patch, patch_count, patch_list, patches_within
from lumitrace.plans import pipeline
from lumitrace.settings import RunSettings
from lumitrace.sources.patch_store import PatchStore
from lumitrace.streaming.increments import Coverage, Increments

COLUMNS = "id long, image_id long, ra double, dec double, uncertainty_ew double, uncertainty_ns double, weight_ew double, weight_ns double"


def separation(a, b):
    (ra1, d1), (ra2, d2) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((d1 - d2) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((ra1 - ra2) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(h))))


@pytest.mark.parametrize("width", [5.0, 30.0])
def test_patches_cover_what_is_near(spark, width):
    """Every point within the radius of a spot lies in one of its patches, at poles and RA 0 too."""
    rng = random.Random(1)
    spots = [(0.0, 0.0, 0.5), (359.999, -30.0, 0.01), (10.0, 89.9, 1.0), (200.0, -90.0, 0.001), (77.0, 45.0, 40.0), (1.0, 90.0, 0.0), (0.0, 5.0, 0.0), (180.0, -85.0, 5.0)]
    spots += [(rng.uniform(0, 360), rng.uniform(-90, 90), rng.choice([1e-4, 1.0, 20.0])) for _ in range(10)]
    points = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(3000)]
    points += [((ra + rng.uniform(-r, r)) % 360, max(-90.0, min(90.0, dec + rng.uniform(-r, r)))) for ra, dec, r in spots for _ in range(60)]
    filed = frame(spark, points, "ra double, dec double").withColumn("p", patch("ra", "dec", width)).collect()
    assert len({r["p"] for r in filed}) <= patch_count(width)
    for ra, dec, r in spots:
        near = set(patch_list(patches_within(frame(spark, [(ra, dec)], "ra double, dec double"), "ra", "dec", r, width)))
        assert {q["p"] for q in filed if separation((ra, dec), (q["ra"], q["dec"])) <= r} <= near
        assert len(near) <= patch_count(width)


def coverage(spark):
    wcs, pix = pixel_tables(spark)
    return Coverage(regions(spark), wcs, pix, fits(spark))


def batches(spark):
    m, images = measurements(spark), images_of(spark, [1, 2, 3, 4])
    for batch, epochs in enumerate([[1, 2], [3, 4]]):
        yield batch, m.join(images.filter(F.col("epoch").isin(epochs)).select("image_id"), "image_id", "left_semi").select(*m.columns)


def test_equals_the_run_in_one_go(spark, tmp_path):
    extra = coverage(spark)
    images = images_of(spark, [1, 2, 3, 4])
    whole = pipeline.run(measurements(spark), images, extra.regions, SETTINGS, wcs=extra.wcs, noise_pixels=extra.noise_pixels, fits=extra.fits)
    steps = Increments(spark, str(tmp_path / "run"), SETTINGS)
    for batch, rows in batches(spark):
        steps.process(rows, batch, images, extra)
        steps.process(rows, batch, images, extra)
    tables = steps.tables()
    assert shape(tables) == shape(whole)
    curves = tables["curves"]
    forced = curves.filter("forced")
    assert forced.count() == 3 and forced.filter("id >= 0").isEmpty() and forced.select("id").distinct().count() == 3
    # Island numbers of an image never repeat.
    assert curves.groupBy("image_id", "source").count().filter("count > 1").isEmpty()
    assert rows_of(tables["sources"].join(whole["sources"].select("source", F.col("n_neighbour_dist").alias("d")), "source").select(F.round(F.col("n_neighbour_dist") - F.col("d"), 9).alias("x")).distinct(), "x") == [(0.0,)]


def test_a_batch_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    images = images_of(spark, [1, 2, 3, 4])
    parts = dict(batches(spark))
    content = lambda run: (rows_of(run.load().associations, "source", "meas_id"), rows_of(run.load().state, "source", "sum_ra"))
    steps = Increments(spark, str(tmp_path / "run"), SETTINGS)
    steps.process(parts[0], 0, images)
    before = content(steps)
    # Everything of the batch is written but its line in the log; then it dies half way through its tables.
    for broken in ("commit", "put"):
        with monkeypatch.context() as m:
            m.setattr(PatchStore, broken, lambda *a: (_ for _ in ()).throw(OSError("executor lost")))
            with pytest.raises(OSError):
                steps.process(parts[1], 1, images)
        assert content(Increments(spark, str(tmp_path / "run"), SETTINGS)) == before
    steps.process(parts[1], 1, images)
    plain = Increments(spark, str(tmp_path / "plain"), SETTINGS)
    for batch, rows in parts.items():
        plain.process(rows, batch, images)
    assert content(steps) == content(plain)


def spots_at(spark, images_at, jitter=1e-5):
    """One image per (ra, dec), 20 sources around it; images are numbered from 1."""
    rows, unc = [], 1 / 3600
    for image, (ra, dec) in enumerate(images_at, 1):
        for k in range(20):
            rows.append((1000 * image + k, image, (ra + 0.05 * (k % 5) + jitter * image) % 360, dec + 0.05 * (k // 5), unc, unc, unc**-2, unc**-2))
    images = [(n, n, ra, dec, 0.004) for n, (ra, dec) in enumerate(images_at, 1)]
    return frame(spark, rows, COLUMNS), frame(spark, images, "image_id long, epoch long, ra double, dec double, beam_bmaj double")


def files(root, part):
    return sum(len([f for f in names if f.endswith(".parquet")]) for path, _, names in os.walk(root) if part in path + "/")


def test_files_of_a_batch_do_not_grow_with_history(spark, tmp_path):
    # Each within one patch: the band of -33 has 62 of them.
    places = [(360 / 62 * 4 * k + 2, -33.0) for k in range(4)] + [(2.0, -33.0)]
    rows, images = spots_at(spark, places)
    root = str(tmp_path / "run")
    steps = Increments(spark, root, RunSettings())
    written = []
    for n in range(1, len(places) + 1):
        steps.process(rows.filter(F.col("image_id") == n), n, images)
        written.append((files(root, f"/state/batch={n}/"), files(root, f"/batch={n}/")))
    assert len(set(written[:-1])) == 1 and written[-1] <= written[0]
    last = steps.store.last()
    # The first patch was written again, those between are still the copies of their own batches.
    assert sorted(set(last.copies["state"].values())) == list(range(2, len(places) + 1))
    seen = steps._state(last, patch_list(patches_within(rows.filter("image_id = 3"), "ra", "dec", 0.01)))
    assert all("/batch=3/" in f for f in seen.inputFiles()) and seen.count() == 20
    assert steps.load().associations.count() == 100 and steps.load().state.count() == 80


def test_sources_that_move_to_other_patches(spark, tmp_path):
    """A source drifts over RA 0 and over the edge of its patch; forks take over history from its home."""
    unc = 1 / 3600
    rows = [(n, n, (360 - 0.0007 + 0.0006 * n) % 360, -0.0007 + 0.0006 * n, unc, unc, unc**-2, unc**-2) for n in range(1, 6)]
    rows += [(100 + n, n, (360 - 0.0007 + 0.0006 * n + 0.0002) % 360, -0.0007 + 0.0006 * n, unc, unc, unc**-2, unc**-2) for n in range(3, 6)]
    m = frame(spark, rows, COLUMNS)
    images = frame(spark, [(n, n, 0.0, 0.0, 0.004) for n in range(1, 6)], "image_id long, epoch long, ra double, dec double, beam_bmaj double")
    settings = RunSettings(radius=12.0, epoch_duplicate_radius=0.0, method="advanced")
    whole = association.associate(m, images, settings)
    steps = Increments(spark, str(tmp_path / "run"), settings)
    for n in range(1, 6):
        steps.process(m.filter(F.col("image_id") == n), n, images)
    got = steps.load()
    assert rows_of(got.associations, "source", "meas_id") == rows_of(whole.associations, "source", "meas_id")
    assert rows_of(got.relations, "from_source_id", "to_source_id") == rows_of(whole.relations, "from_source_id", "to_source_id")
    assert got.next_id == whole.next_id
    # Homes stay where sources were new, whatever patch they are in by now.
    held = rows_of(steps._state(steps.store.last()), "source", "home")
    assert len(held) == whole.state.count()
    assert not {home for _, home in held} <= set(steps.store.last().copies["state"])
