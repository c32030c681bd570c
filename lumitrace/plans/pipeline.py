"""A run from catalogues to final tables, and the same run with images added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.operators import association, clean, components, coverage, finalise, forced, lifecycle
from lumitrace.operators.ranking import dense_index
from lumitrace.settings import RunSettings
from lumitrace.sources.tables import RunStore, write_by_image
from lumitrace.workspace import materialize

RUN_TABLES = ["images", "sources", "associations", "relations", "measurements"]


def ingest(rows: DataFrame, images: DataFrame, settings: RunSettings, root: str, known: DataFrame | None = None) -> DataFrame:
    """Clean catalogue rows and add them to the stored measurements, by image.

    `known` holds id, image_id and forced of all measurements there are, those
    forced by runs included: images with rows of their own are skipped, and
    new ids follow the highest known one, in (image, component) order.
    Returns the rows added.
    """
    top = 0
    if known is not None:
        stored = known.filter("NOT forced").select("image_id").distinct()
        rows = rows.join(stored, "image_id", "left_anti")
        top = known.agg(F.max("id")).first()[0] or 0
    cleaned = clean.clean_components(rows, images, settings)
    added = materialize(dense_index(cleaned, ["image_id", "component_id"], "id", top + 1), "ingested")
    write_by_image(added, root)
    return added


def with_groups(images: DataFrame, regions: DataFrame) -> DataFrame:
    """Images with the group of overlapping regions they belong to."""
    groups = components.group_regions(regions.select("id", "centre_ra", "centre_dec", "xtr_radius"))
    return components.attach_groups(images, groups)


def _forced_rows(
    missing: DataFrame,
    curves: DataFrame,
    measurements: DataFrame,
    images: DataFrame,
    fits: DataFrame,
    settings: RunSettings,
    run_id: int,
) -> DataFrame:
    """Measurements made of the fits at places where a source should be seen."""
    wanted = forced.forced_candidates(missing, curves, images, settings.monitor_min_sigma)
    usable = forced.clean_fits(fits).join(wanted.select("source", "image_id"), ["source", "image_id"], "left_semi")
    islands = forced.island_maxima(measurements, images)
    # Those of the sources that `missing` was found for.
    positions = wanted.select("source", "wavg_ra", "wavg_dec").distinct()
    rows = forced.complete_forced(usable, positions, images, islands, settings, run_id)
    return materialize(lifecycle.assign_ids(rows, measurements.select("id"), ["image_id", "source"]), "forced")


def run(
    measurements: DataFrame,
    images: DataFrame,
    regions: DataFrame,
    settings: RunSettings,
    *,
    run_id: int = 1,
    wcs: DataFrame | None = None,
    noise_pixels: DataFrame | None = None,
    fits: DataFrame | None = None,
    prior: dict[str, DataFrame] | None = None,
    pair_list: bool = False,
    relation_list: bool = True,
) -> dict[str, DataFrame]:
    """All tables of a run.

    `images` has image_id, name, epoch, datetime, ra, dec, skyreg_id, rms_min
    and the beam. With `wcs` and `noise_pixels` new sources are flagged; with
    `settings.monitor` and `fits` (source, image_id, flux, flux_err, chi2)
    gaps are filled. `prior` holds the tables of an earlier run of the same
    settings: only images that are not in it are associated, and the ids of
    its forced measurements must not be among the new ones. `pair_list` adds
    `measurement_pairs`, which grows with the square of a source's rows; the
    pair metrics of a source need no list. Without `relation_list`,
    `relations` holds links of forks only and `relation_classes` the classes of
    sources that share a measurement, a row per member instead of all pairs.
    """
    images = materialize(images, "images")
    measurements = clean.with_flux_fraction(measurements, settings.flux_fractional_error)
    if prior is None:
        todo, start, known = images, None, None
    else:
        known = prior["images"].select("image_id")
        todo = images.join(known, "image_id", "left_anti")
        start = association.rebuild(prior["associations"], prior["measurements"], prior["relations"], images, prior.get("relation_classes"))
        old_forced = prior["measurements"].filter("forced")
        measurements = forced.append_forced(measurements, old_forced)
    result = association.associate(measurements.filter("NOT forced"), todo, settings, start)

    # Of all measurements, only what the tables below are made of travels.
    used = [c for c in measurements.columns if c in finalise.CURVE_COLUMNS]
    curves = materialize(finalise.light_curves(result.associations, measurements.select(*used), images), "curves")
    missing = materialize(coverage.missing_images(curves, images, regions), "missing")
    if wcs is not None and noise_pixels is not None:
        new = coverage.new_sources(missing, curves, images, wcs, noise_pixels, settings.new_source_min_sigma, settings.monitor_edge_buffer)
    else:
        new = curves.select("source").filter("false").withColumn("new_high_sigma", F.lit(0.0))
    new = materialize(new, "new")

    associations = result.associations
    if settings.monitor and fits is not None:
        gaps = missing
        if prior is not None:
            gaps = forced.candidates_when_adding(missing, known, prior["sources"].select("source"))
        extra = _forced_rows(gaps, curves, measurements, images, fits, settings, run_id)
        times = images.select("image_id", "epoch", "datetime")
        curves = forced.append_forced(curves, materialize(extra.join(times, "image_id"), "forced-curves"))
        measurements = forced.append_forced(measurements, extra)
        links = extra.select("source", F.col("id").alias("meas_id"), F.lit(0.0).alias("d2d"), F.lit(0.0).alias("dr"))
        associations = associations.unionByName(links)

    tables = {
        "images": images,
        "measurements": measurements,
        "associations": associations,
        "relations": result.relations if relation_list else result.links,
        "missing": missing,
        "sources": finalise.final_sources(curves, result.links, new, settings, classes=result.classes),
    }
    if not relation_list and result.classes is not None:
        tables["relation_classes"] = result.classes
    if pair_list:
        ids = curves.select("source").distinct().withColumn("id", F.col("source"))
        tables["measurement_pairs"] = finalise.final_pairs(curves, images, ids, settings.min_abs_vs)
    return tables


def run_and_store(store: RunStore, name: str, *args, **kwargs) -> int:
    """Run, write all tables as a new version, and return its number."""
    return store.save(name, run(*args, **kwargs))


def add_images(store: RunStore, name: str, measurements: DataFrame, images: DataFrame, regions: DataFrame, settings: RunSettings, **kwargs) -> int:
    """Add the images that the stored run has not seen, as a new version."""
    kept = RUN_TABLES if kwargs.get("relation_list", True) or settings.method == "basic" else [*RUN_TABLES, "relation_classes"]
    prior = {table: store.read(name, table) for table in kept}
    return store.save(name, run(measurements, images, regions, settings, prior=prior, **kwargs))
