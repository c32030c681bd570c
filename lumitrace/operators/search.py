"""Questions about finished runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.functions.coords import degrees_to_dms, degrees_to_hms
from lumitrace.functions.sky import UNITS_PER_DEG, to_galactic
from lumitrace.operators.pairs import significant_pairs
from lumitrace.operators.skyjoin import cone_search

# Source columns with a smallest and a largest value to search by.
RANGE_COLUMNS = [
    "avg_flux_int", "avg_flux_peak", "min_flux_peak", "max_flux_peak", "min_flux_int", "max_flux_int", "min_flux_peak_isl_ratio",
    "min_flux_int_isl_ratio", "v_int", "v_peak", "eta_int", "eta_peak", "vs_abs_significant_max_int", "vs_abs_significant_max_peak",
    "m_abs_significant_max_int", "m_abs_significant_max_peak", "n_meas", "n_meas_sel", "n_meas_forced", "n_rel", "new_high_sigma",
    "avg_compactness", "min_snr", "max_snr", "n_neighbour_dist",
]

# Half of these many points are shown as stamps at most, and the colours of region files.
STAMPS = 30
HIGHLIGHT, PLAIN = "#FF0000", "#0000FF"


def search_sources(
    sources: DataFrame,
    runs: DataFrame,
    tags: DataFrame | None = None,
    associations: DataFrame | None = None,
    *,
    run: str | None = None,
    ranges: dict[str, tuple[float | None, float | None]] | None = None,
    neighbour_unit: str = "deg",
    names: list[str] | None = None,
    ids: list[int] | None = None,
    measurement: int | None = None,
    new_only: bool = False,
    no_siblings: bool = False,
    tag_include: str | None = None,
    tag_exclude: str | None = None,
    cone: tuple[float, float, float] | None = None,
    cone_unit: str = "deg",
) -> DataFrame:
    """Sources of completed runs that meet all given criteria.

    Ranges are inclusive. A cone (ra, dec, radius) adds `distance` in arcsec
    and orders by it.
    """
    done = runs.filter("status = 'END'")
    if run is not None:
        done = done.filter(F.col("name") == run)
    found = sources.join(done.select(F.col("id").alias("run_id")), "run_id", "left_semi")
    for column, (low, high) in (ranges or {}).items():
        if column not in RANGE_COLUMNS:
            raise ValueError(f"cannot search by {column}")
        scale = UNITS_PER_DEG[neighbour_unit] if column == "n_neighbour_dist" else 1.0
        if low is not None:
            found = found.filter(F.col(column) >= low / scale)
        if high is not None:
            found = found.filter(F.col(column) <= high / scale)
    if names is not None:
        found = found.filter(F.col("name").isin(names))
    if ids is not None:
        found = found.filter(F.col("id").isin(ids))
    if measurement is not None:
        linked = associations.filter(F.col("meas_id") == measurement).select(F.col("source_id").alias("id"))
        found = found.join(linked, "id", "left_semi")
    if new_only:
        found = found.filter("new")
    if no_siblings:
        found = found.filter("n_sibl = 0")
    if tag_include is not None:
        found = found.join(tags.filter(F.col("tag") == tag_include).select(F.col("source_id").alias("id")), "id", "left_semi")
    if tag_exclude is not None:
        found = found.join(tags.filter(F.col("tag") == tag_exclude).select(F.col("source_id").alias("id")), "id", "left_anti")
    if cone is not None:
        ra, dec, radius = cone
        found = cone_search(found, ra, dec, radius / UNITS_PER_DEG[cone_unit], ("wavg_ra", "wavg_dec"))
    return found


def related_sources(sources: DataFrame, relations: DataFrame, source_id: int, classes: DataFrame | None = None) -> DataFrame:
    """Sources a source is related to: by pairs and, if given, as members of its classes (class_id, source)."""
    targets = relations.filter(F.col("from_source_id") == source_id).select(F.col("to_source_id").alias("id"))
    if classes is not None:
        own = classes.filter(F.col("source") == source_id).select("class_id")
        targets = targets.unionByName(classes.join(own, "class_id", "left_semi").filter(F.col("source") != source_id).select(F.col("source").alias("id")))
    return sources.join(targets, "id", "left_semi")


def measurements_of_source(measurements: DataFrame, associations: DataFrame, source_id: int) -> DataFrame:
    linked = associations.filter(F.col("source_id") == source_id).select(F.col("meas_id").alias("id"))
    return measurements.join(linked, "id", "left_semi")


def siblings(measurements: DataFrame, chosen: DataFrame) -> DataFrame:
    """Measurements in the same island of the same image as any of the chosen ones (id), other than itself.

    Islands are summed up first, so no pairs are formed however large one is.
    """
    marked = measurements.join(chosen.select("id"), "id", "left_semi")
    islands = marked.groupBy("image_id", "island_id").agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("_one"))
    near = measurements.join(islands, ["image_id", "island_id"]).filter("_n > 1 OR _one <> id")
    return near.select(*measurements.columns)


def siblings_of(measurements: DataFrame, measurement_id: int) -> DataFrame:
    """Other measurements in the island of one measurement."""
    me = measurements.filter(F.col("id") == measurement_id).select("image_id", "island_id")
    return measurements.filter(F.col("id") != measurement_id).join(me, ["image_id", "island_id"], "left_semi")


def sources_of_measurement(sources: DataFrame, associations: DataFrame, measurement_id: int) -> DataFrame:
    linked = associations.filter(F.col("meas_id") == measurement_id).select(F.col("source_id").alias("id"))
    return sources.join(linked, "id", "left_semi")


def images_of_run(images: DataFrame, run_images: DataFrame, run_id: int) -> DataFrame:
    return images.join(run_images.filter(F.col("run_id") == run_id).select(F.col("image_id").alias("id")), "id", "left_semi").orderBy("datetime")


def measurements_of_run(measurements: DataFrame, associations: DataFrame, sources: DataFrame, run_id: int) -> DataFrame:
    of_run = sources.filter(F.col("run_id") == run_id).select(F.col("id").alias("source_id"))
    linked = associations.join(of_run, "source_id", "left_semi").select(F.col("meas_id").alias("id"))
    return measurements.join(linked, "id", "left_semi")


def runs_of_image(runs: DataFrame, run_images: DataFrame, image_id: int) -> DataFrame:
    return runs.join(run_images.filter(F.col("image_id") == image_id).select(F.col("run_id").alias("id")), "id", "left_semi").orderBy("name")


def detections_of_image(measurements: DataFrame, image_id: int) -> DataFrame:
    """Measurements of an image that are not forced, in RA order."""
    return measurements.filter((F.col("image_id") == image_id) & ~F.col("forced")).orderBy("ra")


def source_details(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """Sources with run name and position in sexagesimal and galactic form."""
    names = runs.select(F.col("id").alias("run_id"), F.col("name").alias("run_name"))
    lon, lat = to_galactic("wavg_ra", "wavg_dec")
    return sources.join(names, "run_id").withColumns(
        {"hms": degrees_to_hms("wavg_ra"), "dms": degrees_to_dms("wavg_dec"), "l": lon, "b": lat}
    )


def light_curve(curves: DataFrame, source_id: int, images: DataFrame, bands: DataFrame, kind: str = "peak") -> DataFrame:
    """Flux points of one source in time order, with error bounds, method and frequency."""
    info = images.select(F.col("id").alias("image_id"), F.col("name").alias("image_name"), "band_id")
    frequency = bands.select(F.col("id").alias("band_id"), "frequency")
    flux, err = F.col(f"flux_{kind}"), F.col(f"flux_{kind}_err")
    rows = curves.filter(F.col("source") == source_id).join(info, "image_id").join(frequency, "band_id", "left")
    return rows.select(
        "id",
        "datetime",
        "image_name",
        "frequency",
        flux.alias("flux"),
        (flux - err).alias("lower"),
        (flux + err).alias("upper"),
        F.when(F.col("forced"), "Forced").otherwise("Selavy").alias("method"),
    ).orderBy("datetime", "id")


def flux_points(curves: DataFrame, kind: str = "peak") -> DataFrame:
    """Flux points of all sources, for light curves."""
    flux, err = F.col(f"flux_{kind}"), F.col(f"flux_{kind}_err")
    method = F.when(F.col("forced"), "Forced").otherwise("Selavy")
    return curves.select("source", "id", "datetime", flux.alias("flux"), (flux - err).alias("lower"), (flux + err).alias("upper"), method.alias("method"))


def first_detections(curves: DataFrame) -> DataFrame:
    """First measurement of each source that is not forced."""
    first = curves.filter("NOT forced").groupBy("source").agg(F.min(F.struct("datetime", "id", "image_id")).alias("_f"))
    return first.select("source", F.col("_f.id").alias("first_id"), F.col("_f.image_id").alias("first_image"), F.col("_f.datetime").alias("first_time"))


def stamp_measurements(curves: DataFrame, source_id: int, n: int = STAMPS) -> DataFrame:
    """The first measurements of a source, for stamps."""
    return curves.filter(F.col("source") == source_id).orderBy("datetime", "id").limit(n)


def pairs_of_source(curves: DataFrame, source_id: int, min_abs_vs: float) -> DataFrame:
    """Significant pairs of one source, on demand."""
    return significant_pairs(curves.filter(F.col("source") == source_id), min_abs_vs)


def measurement_details(measurements: DataFrame, associations: DataFrame) -> DataFrame:
    """Measurements with the number of sources they belong to and of their siblings."""
    n_sources = associations.groupBy(F.col("meas_id").alias("id")).agg(F.count(F.lit(1)).alias("n_sources"))
    islands = measurements.groupBy("image_id", "island_id").agg((F.count(F.lit(1)) - 1).alias("n_siblings"))
    joined = measurements.join(n_sources, "id", "left").join(islands, ["image_id", "island_id"])
    return joined.withColumn("n_sources", F.coalesce("n_sources", F.lit(0)))


def sources_of_each_measurement(measurements: DataFrame, associations: DataFrame) -> DataFrame:
    """id, source_id: the sources behind `n_sources`, a row each."""
    linked = associations.select(F.col("meas_id").alias("id"), "source_id").distinct()
    return linked.join(measurements.select("id"), "id", "left_semi")


def image_details(images: DataFrame, measurements: DataFrame, run_images: DataFrame) -> DataFrame:
    """Images with the numbers of their measurements and runs."""
    n_meas = measurements.groupBy("image_id").agg(F.count_if(~F.col("forced")).alias("n_meas"))
    n_runs = run_images.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_runs"))
    keyed = images.withColumn("image_id", F.col("id"))
    joined = keyed.join(n_meas, "image_id", "left").join(n_runs, "image_id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_meas", "n_runs")}).drop("image_id")


def record_with_neighbours(rows: DataFrame, record_id: int) -> DataFrame:
    """Ids of the records before and after one record; itself at an end."""
    ids = F.col("id")
    ends = rows.agg(F.max(F.when(ids < record_id, ids)).alias("p"), F.min(F.when(ids > record_id, ids)).alias("n"))
    here = F.lit(record_id).cast("long")
    return ends.select(here.alias("id"), F.coalesce("p", here).alias("previous_id"), F.coalesce("n", here).alias("next_id"))


def measurements_in_cone(
    measurements: DataFrame,
    image_id: int,
    ra: float,
    dec: float,
    radius_deg: float,
    *,
    associations: DataFrame | None = None,
    sources: DataFrame | None = None,
    run_id: int | None = None,
    no_forced: bool = False,
    selected: int | None = None,
    select_by: str = "measurement",
) -> DataFrame:
    """Measurements of an image in a cone, with a colour that marks the selected ones.

    `select_by` is `measurement` or `source`; with no selection all rows have the plain colour.
    """
    if select_by not in ("measurement", "source"):
        raise ValueError("select_by must be measurement or source")
    found = measurements.filter(F.col("image_id") == image_id)
    if no_forced:
        found = found.filter("NOT forced")
    if run_id is not None:
        found = measurements_of_run(found, associations, sources, run_id)
    found = cone_search(found, ra, dec, radius_deg)
    if selected is None:
        return found.withColumn("color", F.lit(PLAIN))
    if select_by == "measurement":
        return found.withColumn("color", F.when(F.col("id") == selected, HIGHLIGHT).otherwise(PLAIN))
    of_source = associations.filter(F.col("source_id") == selected).select(F.col("meas_id").alias("id")).distinct().withColumn("_sel", F.lit(True))
    marked = found.join(of_source, "id", "left")
    return marked.withColumn("color", F.when(F.col("_sel"), HIGHLIGHT).otherwise(PLAIN)).drop("_sel").orderBy("distance")


def image_list(images: DataFrame, bands: DataFrame) -> DataFrame:
    """Images with their frequency, by time."""
    return images.join(bands.select(F.col("id").alias("band_id"), "frequency"), "band_id", "left").orderBy("datetime")


def measurement_list(measurements: DataFrame, images: DataFrame, bands: DataFrame) -> DataFrame:
    """Measurements with image name and frequency, in RA order."""
    info = images.select(F.col("id").alias("image_id"), F.col("name").alias("image_name"), "band_id")
    frequency = bands.select(F.col("id").alias("band_id"), "frequency")
    return measurements.join(info, "image_id").join(frequency, "band_id", "left").orderBy("ra")


def run_list(runs: DataFrame, sources: DataFrame, run_images: DataFrame) -> DataFrame:
    """Runs by name, with the numbers of their images and sources."""
    n_sources = sources.groupBy(F.col("run_id").alias("id")).agg(F.count(F.lit(1)).alias("n_sources"))
    n_images = run_images.groupBy(F.col("run_id").alias("id")).agg(F.count_distinct("image_id").alias("n_images"))
    joined = runs.join(n_sources, "id", "left").join(n_images, "id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_sources", "n_images")}).orderBy("name")


def favourites_of(sources: DataFrame, favourites: DataFrame, user: str) -> DataFrame:
    """Sources a user has marked."""
    mine = favourites.filter(F.col("user") == user).select(F.col("source_id").alias("id"))
    return sources.join(mine, "id", "left_semi")


def text_search(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column contains the text, ignoring case."""
    return df.filter(F.contains(F.lower(column), F.lit(text.lower())))


def top_related(sources: DataFrame, n: int) -> DataFrame:
    """Sources with the most relations, then by RA."""
    return sources.orderBy(F.desc("n_rel"), "wavg_ra", "id").limit(n)
