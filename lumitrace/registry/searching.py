"""Questions about finished runs."""

from pyspark.sql import functions as F

from lumitrace.operators import ranking, search, stats
from lumitrace.registry.base import query, rnd, rnds, rounded, sep_sql
from lumitrace.registry.lifecycle import _STATUS
from lumitrace.registry.scalars import _B, _L, _dms_sql, _hms_sql
from lumitrace.registry.statistics import PAIRS_CTE, edges, EDGES_SQL, statistics_body
from lumitrace.sources.driver_tables import measurements, measurements_sql, run_images, run_images_sql, table
from lumitrace.workspace import materialize

# Sources of 25 runs (nations) with the statistics of the events, runs in several states, tags from orders.
CTE = f"""WITH m AS ({measurements_sql()}), s0 AS ({statistics_body(lambda e: e)}),
 src AS (SELECT s0.*, source AS id, source % 25 AS run_id, 'S' || source AS name, source % 6 = 0 AS new FROM s0),
 runs AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, {_STATUS} AS status FROM nation),
 tags AS (SELECT o_custkey AS source_id, o_orderpriority AS tag FROM orders), fav AS (SELECT o_custkey AS source_id, o_orderstatus AS "user" FROM orders),
 done AS (SELECT src.* FROM src JOIN runs ON src.run_id = runs.id WHERE status = 'END')"""


def sources(spark, sf_dir):
    s = stats.source_statistics(measurements(spark, sf_dir))
    n = F.col("source")
    return s.withColumns({"id": n, "run_id": n % 25, "name": F.concat(F.lit("S"), n.cast("string")), "new": n % 6 == 0})


def runs(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.expr(_STATUS).alias("status"))


def tags(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderpriority").alias("tag"))


def links(spark, sf_dir):
    return measurements(spark, sf_dir).select(F.col("source").alias("source_id"), F.col("id").alias("meas_id"))


@query("sources_of_completed_runs", f"{CTE} SELECT id, run_id, n_meas FROM done")
def sources_of_completed_runs(spark, sf_dir):
    return search.search_sources(sources(spark, sf_dir), runs(spark, sf_dir)).select("id", "run_id", "n_meas")


@query(
    "sources_by_range",
    f"{CTE} SELECT id, {rnds('v_peak', 'eta_int', 'max_snr')} FROM done WHERE v_peak >= 0.3::DOUBLE AND v_peak <= 3.0::DOUBLE AND eta_int >= 1.0::DOUBLE AND max_snr <= 500.0::DOUBLE AND n_meas >= 40",
)
def sources_by_range(spark, sf_dir):
    ranges = {"v_peak": (0.3, 3.0), "eta_int": (1.0, None), "max_snr": (None, 500.0), "n_meas": (40, None)}
    found = search.search_sources(sources(spark, sf_dir), runs(spark, sf_dir), ranges=ranges)
    return rounded(found.select("id", "v_peak", "eta_int", "max_snr"))


# Columns that a source gets from other tables of a run, here filled from its statistics.
_FILLED = {
    "vs_abs_significant_max_int": "v_int * 7", "vs_abs_significant_max_peak": "v_peak * 7", "m_abs_significant_max_int": "v_int * 3",
    "m_abs_significant_max_peak": "v_peak * 3", "n_rel": "n_sibl", "new_high_sigma": "max_snr / 9", "n_neighbour_dist": "abs(wavg_dec) / 60",
}
_EVERY_RANGE_SQL = " UNION ALL ".join(f"SELECT '{c}' AS criterion, id FROM f WHERE {c} >= {'0.25' if c == 'n_neighbour_dist' else '0.3'}::DOUBLE AND {c} <= {'0.75' if c == 'n_neighbour_dist' else '60'}::DOUBLE" for c in search.RANGE_COLUMNS)


@query("sources_by_every_range", f"{CTE}, f AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in _FILLED.items())} FROM done) {_EVERY_RANGE_SQL}")
def sources_by_every_range(spark, sf_dir):
    """Each of the 25 criteria in turn; neighbour distances are asked for in arcmin."""
    filled = sources(spark, sf_dir).withColumns({c: F.expr(e) for c, e in _FILLED.items()})
    # Each criterion reads the stored rows, none works the statistics out again.
    s, r = materialize(filled.select("id", "run_id", *search.RANGE_COLUMNS), "sources"), runs(spark, sf_dir)
    found = None
    for c in search.RANGE_COLUMNS:
        low, high = (15.0, 45.0) if c == "n_neighbour_dist" else (0.3, 60.0)
        one = search.search_sources(s, r, ranges={c: (low, high)}, neighbour_unit="arcmin").select(F.lit(c).alias("criterion"), "id")
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "sources_by_flags_and_tags",
    f"""{CTE} SELECT id FROM done WHERE new AND id IN (SELECT source_id FROM tags WHERE tag = '1-URGENT') AND id NOT IN (SELECT source_id FROM tags WHERE tag = '5-LOW' AND source_id IS NOT NULL)
    UNION ALL SELECT id + 100000 FROM done WHERE n_sibl = 0
    UNION ALL SELECT id + 200000 FROM done WHERE name IN ('S3', 'S15', 'S25')
    UNION ALL SELECT id + 300000 FROM done WHERE id IN (0, 5, 28, 40)
    UNION ALL SELECT done.id + 400000 FROM done JOIN runs ON done.run_id = runs.id WHERE runs.name = 'NATION_5'""",
)
def sources_by_flags_and_tags(spark, sf_dir):
    s, r, t = sources(spark, sf_dir), runs(spark, sf_dir), tags(spark, sf_dir)
    found = [
        search.search_sources(s, r, t, new_only=True, tag_include="1-URGENT", tag_exclude="5-LOW"),
        search.search_sources(s, r, no_siblings=True),
        search.search_sources(s, r, names=["S3", "S15", "S25"]),
        search.search_sources(s, r, ids=[0, 5, 28, 40]),
        search.search_sources(s, r, run="NATION_5"),
    ]
    out = None
    for i, f in enumerate(found):
        part = f.select((F.col("id") + 100000 * i).alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


_CONE = sep_sql("wavg_ra", "wavg_dec", "100.0::DOUBLE", "-30.0::DOUBLE")


@query("sources_in_cone", f"{CTE} SELECT id, {rnd(_CONE + ' * 3600', 3)} AS distance FROM done WHERE {_CONE} <= 2400.0::DOUBLE / 60")
def sources_in_cone(spark, sf_dir):
    found = search.search_sources(sources(spark, sf_dir), runs(spark, sf_dir), cone=(100.0, -30.0, 2400.0), cone_unit="arcmin")
    return rounded(found.select("id", "distance"), 3)


@query("sources_by_measurement", f"{CTE} SELECT id FROM done WHERE id IN (SELECT source FROM m WHERE id = (SELECT min(id) FROM m WHERE source % 25 IN (SELECT id FROM runs WHERE status = 'END')))")
def sources_by_measurement(spark, sf_dir):
    done = runs(spark, sf_dir).filter("status = 'END'").select(F.col("id").alias("run_id"))
    of_run = links(spark, sf_dir).withColumn("run_id", F.col("source_id") % 25).join(done, "run_id", "left_semi")
    first = of_run.agg(F.min("meas_id")).first()[0]
    return search.search_sources(sources(spark, sf_dir), runs(spark, sf_dir), associations=links(spark, sf_dir), measurement=first).select("id")


@query("related_sources", f"{CTE}, e AS ({EDGES_SQL}) SELECT id, n_meas FROM src WHERE id IN (SELECT to_source_id FROM e WHERE from_source_id = 4)")
def related_sources(spark, sf_dir):
    return search.related_sources(sources(spark, sf_dir), edges(measurements(spark, sf_dir)), 4).select("id", "n_meas")


@query("measurements_of_source", f"{CTE} SELECT id, epoch FROM m WHERE source = 12")
def measurements_of_source(spark, sf_dir):
    return search.measurements_of_source(measurements(spark, sf_dir), links(spark, sf_dir), 12).select("id", "epoch")


@query(
    "sibling_measurements",
    f"{CTE} SELECT DISTINCT b.id, b.image_id FROM m a JOIN m b ON a.image_id = b.image_id AND a.island_id = b.island_id AND a.id <> b.id WHERE a.k >= 50",
)
def sibling_measurements(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return search.siblings(m, m.filter("k >= 50")).select("id", "image_id")


@query("siblings_of_measurement", f"{CTE} SELECT b.id FROM m a JOIN m b ON a.image_id = b.image_id AND a.island_id = b.island_id AND a.id <> b.id WHERE a.id = (SELECT min(id) FROM (SELECT min(id) AS id FROM m GROUP BY image_id, island_id HAVING count(*) > 1))")
def siblings_of_measurement(spark, sf_dir):
    m = measurements(spark, sf_dir)
    pairs = m.groupBy("image_id", "island_id").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return search.siblings_of(m, pairs.agg(F.min("id")).first()[0]).select("id")


@query("sources_of_measurement", f"{CTE} SELECT id, name FROM src WHERE id IN (SELECT source FROM m WHERE id = 77)")
def sources_of_measurement(spark, sf_dir):
    return search.sources_of_measurement(sources(spark, sf_dir), links(spark, sf_dir), 77).select("id", "name")


_RUN_IMAGES = "ri AS (SELECT DISTINCT source % 25 AS run_id, image_id FROM m)"


def run_images_links(spark, sf_dir):
    return measurements(spark, sf_dir).select((F.col("source") % 25).alias("run_id"), "image_id").distinct()


@query("images_of_run", f"{CTE}, {_RUN_IMAGES}, im AS ({run_images_sql()}) SELECT id, name, datetime FROM im WHERE id IN (SELECT image_id FROM ri WHERE run_id = 3)")
def images_of_run(spark, sf_dir):
    return search.images_of_run(run_images(spark, sf_dir), run_images_links(spark, sf_dir), 3).select("id", "name", "datetime")


@query("measurements_of_run", f"{CTE} SELECT id, image_id FROM m WHERE source % 25 = 3")
def measurements_of_run(spark, sf_dir):
    return search.measurements_of_run(measurements(spark, sf_dir), links(spark, sf_dir), sources(spark, sf_dir), 3).select("id", "image_id")


@query("runs_of_image", f"{CTE}, {_RUN_IMAGES} SELECT id, name FROM runs WHERE id IN (SELECT run_id FROM ri WHERE image_id = 11)")
def runs_of_image(spark, sf_dir):
    return search.runs_of_image(runs(spark, sf_dir), run_images_links(spark, sf_dir), 11).select("id", "name")


@query("detections_of_image", f"{CTE} SELECT id, {rnd('ra')} AS ra FROM m WHERE image_id = 12 AND NOT forced")
def detections_of_image(spark, sf_dir):
    return rounded(search.detections_of_image(measurements(spark, sf_dir), 12).select("id", "ra"))


_DETAIL = {"ra": "wavg_ra", "dec": "wavg_dec"}


@query(
    "source_details",
    f"{CTE}, x AS (SELECT src.id, runs.name AS run_name, wavg_ra AS ra, wavg_dec AS dec FROM src JOIN runs ON src.run_id = runs.id) SELECT id, run_name, {_hms_sql('ra', 1, False)} AS hms, {_dms_sql('dec', 0, False)} AS dms, {rnd(_L)} AS l, {rnd(_B)} AS b FROM x",
)
def source_details(spark, sf_dir):
    from lumitrace.functions.coords import degrees_to_dms, degrees_to_hms

    out = search.source_details(sources(spark, sf_dir), runs(spark, sf_dir))
    # Fewer digits than shown on a page: averages may differ in the last bits.
    out = out.withColumns({"hms": degrees_to_hms("wavg_ra", 1), "dms": degrees_to_dms("wavg_dec", 0)})
    return rounded(out.select("id", "run_name", "hms", "dms", "l", "b"))


_POINT = "id, datetime, {f} AS flux, {lo} AS lower, {hi} AS upper, CASE WHEN forced THEN 'Forced' ELSE 'Selavy' END AS method".format(
    f=rnd("flux_peak"), lo=rnd("flux_peak - flux_peak_err"), hi=rnd("flux_peak + flux_peak_err")
)


@query("light_curves", f"{CTE} SELECT source, {_POINT} FROM m")
def light_curves(spark, sf_dir):
    return rounded(search.flux_points(measurements(spark, sf_dir)))


@query(
    "light_curve_of_source",
    f"{CTE}, im AS ({run_images_sql()}) SELECT m.id, m.datetime, im.name AS image_name, CAST(888 + image_id % 3 AS BIGINT) AS frequency, {_POINT.split(', ', 2)[2]} FROM m JOIN im USING (image_id) WHERE source = 9".replace("forced THEN", "m.forced THEN"),
)
def light_curve_of_source(spark, sf_dir):
    im = run_images(spark, sf_dir).withColumn("band_id", F.col("image_id") % 3)
    bands = im.select(F.col("band_id").alias("id"), (888 + F.col("band_id")).alias("frequency")).distinct()
    return rounded(search.light_curve(measurements(spark, sf_dir), 9, im.select("id", "name", "band_id"), bands))


@query(
    "first_detections",
    f"{CTE} SELECT source, id AS first_id, image_id AS first_image, datetime AS first_time FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY datetime, id) AS rn FROM m WHERE NOT forced) WHERE rn = 1",
)
def first_detections(spark, sf_dir):
    return search.first_detections(measurements(spark, sf_dir))


@query("stamp_measurements", f"{CTE} SELECT id, datetime FROM m WHERE source = 21 ORDER BY datetime, id LIMIT 30")
def stamp_measurements(spark, sf_dir):
    return search.stamp_measurements(measurements(spark, sf_dir), 21).select("id", "datetime")


@query("pairs_of_source", f"{PAIRS_CTE} SELECT meas_id_a, meas_id_b, {rnds('vs_peak', 'm_peak')} FROM p WHERE source = 30 AND (abs(vs_peak) >= 2.0::DOUBLE OR abs(vs_int) >= 2.0::DOUBLE)")
def pairs_of_source(spark, sf_dir):
    return rounded(search.pairs_of_source(measurements(spark, sf_dir), 30, 2.0).select("meas_id_a", "meas_id_b", "vs_peak", "m_peak"))


@query(
    "measurement_details",
    f"{CTE} SELECT id, 1::BIGINT AS n_sources, count(*) OVER (PARTITION BY image_id, island_id) - 1 AS n_siblings FROM m",
)
def measurement_details(spark, sf_dir):
    return search.measurement_details(measurements(spark, sf_dir), links(spark, sf_dir)).select("id", "n_sources", "n_siblings")


@query("sources_of_each_measurement", f"{CTE} SELECT id, source AS source_id FROM m")
def sources_of_each_measurement(spark, sf_dir):
    return search.sources_of_each_measurement(measurements(spark, sf_dir), links(spark, sf_dir))


@query(
    "image_details",
    f"{CTE}, im AS ({run_images_sql()}) SELECT im.id, name, (SELECT count(*) FROM m WHERE m.image_id = im.id AND NOT forced) AS n_meas, (SELECT count(DISTINCT source % 25) FROM m WHERE m.image_id = im.id) AS n_runs FROM im",
)
def image_details(spark, sf_dir):
    out = search.image_details(run_images(spark, sf_dir), measurements(spark, sf_dir), run_images_links(spark, sf_dir))
    return out.select("id", "name", "n_meas", "n_runs")


@query("record_neighbours", f"{CTE} SELECT 77::BIGINT AS id, (SELECT max(id) FROM m WHERE id < 77) AS previous_id, (SELECT min(id) FROM m WHERE id > 77) AS next_id")
def record_neighbours(spark, sf_dir):
    return search.record_with_neighbours(measurements(spark, sf_dir), 77)


_SPOT = sep_sql("ra", "dec", "137.508::DOUBLE", "-18.197::DOUBLE")


@query(
    "image_cone_measurements",
    f"{CTE} SELECT id, {rnd(_SPOT + ' * 3600', 3)} AS distance, CASE WHEN source = 1 THEN '#FF0000' ELSE '#0000FF' END AS color FROM m WHERE image_id % 10 = 3 AND image_id = 13 AND NOT forced AND source % 25 IN (1, 2) AND {_SPOT} <= 120.0::DOUBLE",
)
def image_cone_measurements(spark, sf_dir):
    m = measurements(spark, sf_dir)
    found = [
        search.measurements_in_cone(
            m, 13, 137.508, -18.197, 120.0, associations=links(spark, sf_dir), sources=sources(spark, sf_dir), run_id=r, no_forced=True, selected=1, select_by="source"
        )
        for r in (1, 2)
    ]
    return rounded(found[0].unionByName(found[1]).select("id", "distance", "color"), 3)


@query("image_list", f"{CTE}, im AS ({run_images_sql()}) SELECT id, name, datetime, CAST(888 + image_id % 3 AS BIGINT) AS frequency FROM im")
def image_list(spark, sf_dir):
    im = run_images(spark, sf_dir).withColumn("band_id", F.col("image_id") % 3)
    bands = im.select(F.col("band_id").alias("id"), (888 + F.col("band_id")).alias("frequency")).distinct()
    return search.image_list(im, bands).select("id", "name", "datetime", "frequency")


@query("favourite_sources", f"{CTE} SELECT id, name FROM src WHERE id IN (SELECT source_id FROM fav WHERE \"user\" = 'P')")
def favourite_sources(spark, sf_dir):
    fav = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderstatus").alias("user"))
    return search.favourites_of(sources(spark, sf_dir), fav, "P").select("id", "name")


@query("names_with_text", "SELECT c_custkey, c_name FROM customer WHERE lower(c_name) LIKE '%#0000001%'")
def names_with_text(spark, sf_dir):
    return search.text_search(table(spark, sf_dir, "customer"), "c_name", "#0000001").select("c_custkey", "c_name")


@query("second_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100 OFFSET 100")
def second_page(spark, sf_dir):
    return ranking.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 2)


@query(
    "top_related_sources",
    f"{CTE}, e AS ({EDGES_SQL}), r AS (SELECT from_source_id AS source, count(DISTINCT to_source_id) AS n_rel FROM e WHERE from_source_id <> to_source_id GROUP BY 1) SELECT src.id, n_rel FROM src JOIN r USING (source) ORDER BY n_rel DESC, wavg_ra, src.id LIMIT 10",
)
def top_related_sources(spark, sf_dir):
    counted = sources(spark, sf_dir).join(stats.relation_counts(edges(measurements(spark, sf_dir))), "source")
    return search.top_related(counted, 10).select("id", "n_rel")


@query("ordered_measurements", f"{CTE} SELECT id, {rnd('ra')} AS ra FROM m ORDER BY ra, id")
def ordered_measurements(spark, sf_dir):
    return rounded(measurements(spark, sf_dir).orderBy("ra", "id").select("id", "ra"))


@query(
    "duplicate_flags",
    f"{CTE} SELECT id, count(*) OVER (PARTITION BY source, epoch) > 1 AS repeated, {rnd('min(flux_peak) OVER (PARTITION BY source, epoch)')} AS least FROM m",
)
def duplicate_flags(spark, sf_dir):
    rows = ranking.with_group_values(measurements(spark, sf_dir), ["source", "epoch"], n=F.count(F.lit(1)), least=F.min("flux_peak"))
    return rounded(rows.select("id", (F.col("n") > 1).alias("repeated"), "least"))


@query(
    "first_and_last_rows",
    f"""{CTE} SELECT f.source, f.id AS first_id, l.id AS last_id FROM (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY datetime, id) AS rn FROM m) f
    JOIN (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY datetime DESC, id DESC) AS rn FROM m) l ON f.source = l.source AND f.rn = 1 AND l.rn = 1""",
)
def first_and_last_rows(spark, sf_dir):
    m = measurements(spark, sf_dir).select("source", "datetime", "id")
    first = ranking.first_by(m, ["source"], ["datetime", "id"]).select("source", F.col("id").alias("first_id"))
    last = ranking.first_by(m, ["source"], ["datetime", "id"], last=True).select("source", F.col("id").alias("last_id"))
    return first.join(last, "source")


@query("measurement_list", f"{CTE}, im AS ({run_images_sql()}) SELECT m.id, im.name AS image_name, CAST(888 + image_id % 3 AS BIGINT) AS frequency, {rnd('m.ra')} AS ra FROM m JOIN im USING (image_id)")
def measurement_list(spark, sf_dir):
    im = run_images(spark, sf_dir).withColumn("band_id", F.col("image_id") % 3)
    bands = im.select(F.col("band_id").alias("id"), (888 + F.col("band_id")).alias("frequency")).distinct()
    return rounded(search.measurement_list(measurements(spark, sf_dir), im, bands).select("id", "image_name", "frequency", "ra"))


@query("run_list", f"{CTE}, {_RUN_IMAGES} SELECT id, name, status, (SELECT count(*) FROM src WHERE run_id = runs.id) AS n_sources, (SELECT count(*) FROM ri WHERE run_id = runs.id) AS n_images FROM runs")
def run_list(spark, sf_dir):
    return search.run_list(runs(spark, sf_dir), sources(spark, sf_dir), run_images_links(spark, sf_dir))
