"""Final tables, set operations, exports and run removal."""

from pyspark.sql import functions as F

from lumitrace.operators import finalise, lifecycle
from lumitrace.operators.pairs import significant_pairs
from lumitrace.registry.base import query, rnd, rnds, rounded, sep_sql
from lumitrace.registry.scalars import POSITION_NAME_SQL
from lumitrace.registry.statistics import _AGG_NAMES, _best_pair_sql, EDGES_SQL, PAIRS_CTE, edges, statistics_body
from lumitrace.settings import RunSettings
from lumitrace.sources import exports
from lumitrace.sources.driver_tables import measurements, measurements_sql, run_images, run_images_sql, sky_rows, sky_rows_sql, table

M = f"WITH m AS ({measurements_sql()})"

_RAW = lambda e: e


@query(
    "final_sources",
    f"""{PAIRS_CTE}, s AS ({statistics_body(_RAW)}), e AS ({EDGES_SQL}), rel AS (SELECT from_source_id AS source, count(DISTINCT to_source_id) AS n_rel FROM e WHERE from_source_id <> to_source_id GROUP BY 1),
     nn AS (SELECT a.source, min({sep_sql("a.wavg_ra", "a.wavg_dec", "b.wavg_ra", "b.wavg_dec")}) AS n_neighbour_dist FROM s a JOIN s b ON a.source <> b.source GROUP BY a.source),
     ag AS (SELECT * FROM ({_best_pair_sql("peak")}) FULL JOIN ({_best_pair_sql("int")}) USING (source)), x AS (SELECT s.*, s.wavg_ra AS ra, s.wavg_dec AS dec FROM s)
    SELECT x.source, n_meas, n_sibl, {rnds("wavg_ra", "wavg_dec", "avg_flux_peak", "v_int", "eta_peak")}, s_suppkey IS NOT NULL AS new, {rnd("coalesce(s_acctbal, 0)")} AS new_high_sigma,
     coalesce(n_rel, 0) AS n_rel, {rnd("n_neighbour_dist")} AS n_neighbour_dist, {", ".join(f"{rnd(f'coalesce({n}, 0)')} AS {n}" for n in _AGG_NAMES)}, {POSITION_NAME_SQL} AS name
    FROM x LEFT JOIN rel USING (source) LEFT JOIN nn USING (source) LEFT JOIN ag USING (source) LEFT JOIN supplier ON x.source = s_suppkey""",
)
def final_sources(spark, sf_dir):
    m = measurements(spark, sf_dir)
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"), F.col("s_acctbal").alias("new_high_sigma"))
    out = finalise.final_sources(m, edges(m), new, RunSettings())
    return rounded(
        out.select("source", "n_meas", "n_sibl", "wavg_ra", "wavg_dec", "avg_flux_peak", "v_int", "eta_peak", "new", "new_high_sigma", "n_rel", "n_neighbour_dist", *_AGG_NAMES, "name")
    )


IDS_SQL = "ids AS (SELECT c_custkey AS source, c_custkey + 1000 AS id FROM customer)"


def ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source"), (F.col("c_custkey") + 1000).alias("id"))


@query(
    "final_relations",
    f"""{M}, e AS ({EDGES_SQL}), {IDS_SQL} SELECT DISTINCT a.id AS from_source_id, b.id AS to_source_id
    FROM e JOIN ids a ON e.from_source_id = a.source JOIN ids b ON e.to_source_id = b.source WHERE a.id <> b.id""",
)
def final_relations(spark, sf_dir):
    return finalise.final_relations(edges(measurements(spark, sf_dir)), ids(spark, sf_dir))


@query(
    "final_associations",
    f"{M}, {IDS_SQL} SELECT ids.id AS source_id, m.id AS meas_id, {rnd('k / 50.0::DOUBLE')} AS d2d, 0.0::DOUBLE AS dr FROM m JOIN ids USING (source)",
)
def final_associations(spark, sf_dir):
    m = measurements(spark, sf_dir)
    links = m.select("source", F.col("id").alias("meas_id"), (F.col("k") / 50.0).alias("d2d"), F.lit(0.0).alias("dr"))
    return rounded(finalise.final_associations(links, ids(spark, sf_dir)))


@query(
    "final_pairs",
    f"""{PAIRS_CTE}, {IDS_SQL}, im AS ({run_images_sql()}) SELECT ids.id AS source_id, meas_id_a, meas_id_b, a.name AS image_name_a, b.name AS image_name_b, {rnds("vs_peak", "m_int")}
    FROM p JOIN ids USING (source) JOIN im a ON p.image_id_a = a.image_id JOIN im b ON p.image_id_b = b.image_id
    WHERE abs(vs_peak) >= 8.0::DOUBLE OR abs(vs_int) >= 8.0::DOUBLE""",
)
def final_pairs(spark, sf_dir):
    out = finalise.final_pairs(measurements(spark, sf_dir), run_images(spark, sf_dir), ids(spark, sf_dir), 8.0)
    return rounded(out.select("source_id", "meas_id_a", "meas_id_b", "image_name_a", "image_name_b", "vs_peak", "m_int"))


@query("renamed_sources", f"WITH c AS ({sky_rows_sql('supplier', 's_suppkey')}) SELECT id, {POSITION_NAME_SQL} AS name FROM c")
def renamed_sources(spark, sf_dir):
    s = sky_rows(spark, sf_dir, "supplier", "s_suppkey").select("id", F.col("s_name").alias("name"), F.col("ra").alias("wavg_ra"), F.col("dec").alias("wavg_dec"))
    return finalise.rename_sources(s).select("id", "name")


_A = "SELECT c_custkey AS id, c_nationkey AS n FROM customer"
_B = "SELECT s_suppkey AS id, s_nationkey AS n FROM supplier"


def _ab(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("n"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("n"))
    return a, b


@query("upserted_sources", f"SELECT id, CAST(n AS BIGINT) AS n FROM ({_A}) WHERE id NOT IN (SELECT s_suppkey FROM supplier) UNION ALL {_B.replace('s_nationkey AS n', 'CAST(s_nationkey AS BIGINT)')}")
def upserted_sources(spark, sf_dir):
    return lifecycle.upsert(*_ab(spark, sf_dir))


@query(
    "symmetric_difference",
    f"SELECT id, CAST(n AS BIGINT) AS n FROM ((({_A}) EXCEPT ({_B})) UNION ALL (({_B}) EXCEPT ({_A})))",
)
def symmetric_difference(spark, sf_dir):
    return lifecycle.symmetric_difference(*_ab(spark, sf_dir))


@query("only_new_rows", f"SELECT id, CAST(n AS BIGINT) AS n FROM (({_A}) EXCEPT ({_B}))")
def only_new_rows(spark, sf_dir):
    return lifecycle.only_new(*_ab(spark, sf_dir))


@query(
    "aligned_union",
    f"SELECT id, CAST(n AS BIGINT) AS n, NULL::VARCHAR AS label FROM ({_A}) UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier",
)
def aligned_union(spark, sf_dir):
    a, _ = _ab(spark, sf_dir)
    return lifecycle.union_aligned(a, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label")))


@query("distinct_rows", f"{M} SELECT DISTINCT image_id, epoch, forced FROM m")
def distinct_rows(spark, sf_dir):
    return measurements(spark, sf_dir).select("image_id", "epoch", "forced").dropDuplicates()


@query("without_ids", f"{M} SELECT id FROM m EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def without_ids(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return measurements(spark, sf_dir).select("id").subtract(done)


@query("among_ids", f"{M} SELECT id, source FROM m WHERE id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def among_ids(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return measurements(spark, sf_dir).select("id", "source").join(done, "id", "left_semi")


@query(
    "assigned_ids",
    "SELECT o_orderkey, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders",
)
def assigned_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    old = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return lifecycle.assign_ids(o, old, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "id")


@query("missing_links", f"{M} SELECT DISTINCT source AS run_id, image_id FROM m EXCEPT SELECT source, image_id FROM m WHERE forced")
def missing_links(spark, sf_dir):
    m = measurements(spark, sf_dir).select(F.col("source").alias("run_id"), "image_id", "forced")
    return lifecycle.link_missing(m.drop("forced"), m.filter("forced").drop("forced"))


_STATUS = "CASE n_regionkey WHEN 0 THEN 'END' WHEN 1 THEN 'RUN' WHEN 2 THEN 'ERR' WHEN 3 THEN 'END' ELSE 'INI' END"


@query("running_count", f"SELECT count(*) AS n_running FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {_STATUS} = 'RUN'")
def running_count(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(_STATUS).alias("status"))
    runs = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return lifecycle.running_count(runs)


def run_tables(spark, sf_dir):
    """A store of 25 runs: a source belongs to the run of its number, an image to the runs that saw it."""
    m = measurements(spark, sf_dir)
    m = m.withColumns({"image_id": F.col("source") % 70, "run_id": F.col("source") % 25})
    return {
        "runs": table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")),
        "sources": m.select(F.col("source").alias("id"), "run_id").distinct(),
        "associations": m.select(F.col("source").alias("source_id"), F.col("id").alias("meas_id")),
        "relations": edges(m).distinct(),
        "run_images": m.select("run_id", "image_id").distinct(),
        "run_regions": m.select("run_id", (F.col("image_id") % 30).alias("skyreg_id")).distinct(),
        "images": m.select(F.col("image_id").alias("id")).distinct(),
        "sky_regions": m.select((F.col("image_id") % 30).alias("id")).distinct(),
        "measurements": m.select("id", "image_id", "forced"),
    }


RUN = 7
_RM = f"""WITH m0 AS ({measurements_sql()}), m AS (SELECT * EXCLUDE (image_id), source % 70 AS image_id, source % 25 AS run_id FROM m0),
 ri AS (SELECT DISTINCT run_id, image_id FROM m), rr AS (SELECT DISTINCT run_id, image_id % 30 AS skyreg_id FROM m), e AS (SELECT DISTINCT * FROM ({EDGES_SQL}))"""


@query(
    "removed_run",
    f"""{_RM}
    SELECT 'runs' AS name, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS total FROM nation WHERE n_nationkey <> {RUN}
    UNION ALL SELECT 'sources', count(*), CAST(sum(id) AS BIGINT) FROM (SELECT DISTINCT source AS id, run_id FROM m) WHERE run_id <> {RUN}
    UNION ALL SELECT 'associations', count(*), CAST(sum(id) AS BIGINT) FROM m WHERE run_id <> {RUN}
    UNION ALL SELECT 'relations', count(*), CAST(sum(from_source_id * 1000 + to_source_id) AS BIGINT) FROM e WHERE from_source_id % 25 <> {RUN}
      AND to_source_id NOT IN (SELECT source FROM m WHERE run_id = {RUN})
    UNION ALL SELECT 'run_images', count(*), CAST(sum(image_id) AS BIGINT) FROM ri WHERE run_id <> {RUN}
    UNION ALL SELECT 'images', count(DISTINCT image_id), CAST(sum(DISTINCT image_id) AS BIGINT) FROM ri WHERE run_id <> {RUN}
    UNION ALL SELECT 'sky_regions', count(DISTINCT skyreg_id), CAST(sum(DISTINCT skyreg_id) AS BIGINT) FROM rr WHERE run_id <> {RUN}
    UNION ALL SELECT 'measurements', count(*), CAST(sum(id) AS BIGINT) FROM m WHERE image_id IN (SELECT image_id FROM ri WHERE run_id <> {RUN}) AND NOT (forced AND run_id = {RUN})""",
)
def removed_run(spark, sf_dir):
    """Row count and key sum of every table after one run is removed."""
    left = lifecycle.remove_run(run_tables(spark, sf_dir), RUN)
    keys = {"runs": "id", "sources": "id", "associations": "meas_id", "run_images": "image_id", "images": "id", "sky_regions": "id", "measurements": "id"}
    parts = [left[t].agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(k).alias("total")) for t, k in keys.items()]
    parts.append(left["relations"].agg(F.lit("relations").alias("name"), F.count(F.lit(1)).alias("n"), F.sum(F.col("from_source_id") * 1000 + F.col("to_source_id")).alias("total")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "restored_run",
    f"""WITH m0 AS ({measurements_sql()}), m AS (SELECT *, source % 25 AS run_id FROM m0)
    SELECT source AS source_id, id AS meas_id FROM m WHERE run_id <> {RUN} OR epoch <= 20""",
)
def restored_run(spark, sf_dir):
    """Associations after run 7 is taken back to the state it had on day 20."""
    m = measurements(spark, sf_dir).withColumn("run_id", F.col("source") % 25)

    def state(rows):
        return {
            "sources": rows.select(F.col("source").alias("id"), "run_id").distinct(),
            "associations": rows.select(F.col("source").alias("source_id"), F.col("id").alias("meas_id")),
            "relations": edges(rows).distinct(),
            "measurements": rows.select("id", "image_id", "forced"),
        }

    return lifecycle.restore(state(m.filter("epoch <= 20")), state(m), RUN)["associations"]


@query(
    "restore_problems",
    f"""{M} SELECT 'image_missing' AS problem, image_id AS id FROM m WHERE epoch <= 3 GROUP BY image_id
    UNION ALL SELECT 'forced_missing', id FROM m WHERE forced AND epoch <= 3""",
)
def restore_problems(spark, sf_dir):
    m = measurements(spark, sf_dir)
    now = m.filter("epoch > 3")
    state = lambda rows: {"images": rows.select(F.col("image_id").alias("id")).distinct(), "measurements": rows.select("id", "forced")}
    return lifecycle.restore_problems(state(m), state(now))


@query(
    "measurement_export",
    f"{M} SELECT m.id, datetime, c_custkey AS source, CAST(flux_peak AS FLOAT) AS flux_peak, CAST(ra AS FLOAT) AS ra FROM m JOIN customer ON m.source = c_custkey",
)
def measurement_export(spark, sf_dir):
    m = measurements(spark, sf_dir)
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source"))
    links = m.join(known, "source", "left_semi").select(F.col("source").alias("source_id"), F.col("id").alias("meas_id"))
    return exports.measurement_export(m.select("id", "datetime", "flux_peak", "ra"), links)


@query(
    "pair_export",
    f"""{PAIRS_CTE} SELECT CAST(meas_id_a AS BIGINT) AS meas_id_a, CAST(meas_id_b AS BIGINT) AS meas_id_b, CAST(round(CAST(vs_peak AS FLOAT), 3) AS DOUBLE) AS vs_peak
    FROM p WHERE abs(vs_peak) >= 9.0::DOUBLE OR abs(vs_int) >= 9.0::DOUBLE""".replace("CAST(round(CAST(vs_peak AS FLOAT), 3) AS DOUBLE)", rnd("CAST(CAST(vs_peak AS FLOAT) AS DOUBLE)", 3)),
)
def pair_export(spark, sf_dir):
    out = exports.pair_export(significant_pairs(measurements(spark, sf_dir), 9.0))
    return rounded(out.select(F.col("meas_id_a").cast("long"), F.col("meas_id_b").cast("long"), "vs_peak"), 3)


@query(
    "region_lines",
    f"""{M}, r AS (SELECT id, {rnd("ra", 4)} AS ra, {rnd("dec", 4)} AS dec, 10.0::DOUBLE + k AS bmaj, 5.5::DOUBLE AS bmin, k * 1.5::DOUBLE AS pa, forced, source FROM m)
    SELECT id, 'ellipse(' || ra || 'd, ' || dec || 'd, ' || bmaj || '", ' || bmin || '", ' || (pa + 270) || 'd) {{"color":"' || CASE WHEN source = 7 THEN '#FF0000' ELSE '#0000FF' END
     || '","data":{{"text":"source ID: ' || source || '","link":"/sources/' || source || '/"}}' || CASE WHEN forced THEN ',"strokeDashArray":[3,2]' ELSE '' END || '}}' AS value FROM r""",
)
def region_lines(spark, sf_dir):
    m = measurements(spark, sf_dir)
    r = lambda c: (F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c)
    color = F.when(F.col("source") == 7, "#FF0000").otherwise("#0000FF")
    rows = m.select("id", r("ra"), r("dec"), (10.0 + F.col("k")).alias("bmaj"), F.lit(5.5).alias("bmin"), (F.col("k") * 1.5).alias("pa"), "forced", color.alias("color"), F.col("source").alias("label_id"))
    return exports.region_lines(rows, "source")


@query(
    "region_features",
    """WITH g AS (SELECT CAST(c_custkey AS BIGINT) AS id, CASE WHEN c_custkey % 360 > 180 THEN c_custkey % 360 - 360.0::DOUBLE ELSE (c_custkey % 360)::DOUBLE END AS ra, (c_custkey % 80)::DOUBLE AS de FROM customer)
    SELECT id, '{"type":"Feature","id":"SkyRegion' || id || '","properties":{"n":"' || printf('%02d', id) || '","loc":[' || ra || ',' || de || ']},"geometry":{"type":"MultiLineString","coordinates":[[['
      || (ra + 3) || ',' || (de + 2) || '],[' || (ra + 3) || ',' || (de - 2) || '],[' || (ra - 3) || ',' || (de - 2) || '],[' || (ra - 3) || ',' || (de + 2) || '],[' || (ra + 3) || ',' || (de + 2) || ']]]}}' AS value FROM g""",
)
def region_features(spark, sf_dir):
    k = F.col("c_custkey").cast("long")
    regions = table(spark, sf_dir, "customer").select(
        k.alias("id"), (k % 360).cast("double").alias("centre_ra"), (k % 80).cast("double").alias("centre_dec"), F.lit(6.0).alias("width_ra"), F.lit(4.0).alias("width_dec")
    )
    return exports.region_features(regions)
