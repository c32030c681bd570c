"""Files under a manifest, inputs by list and epoch, tables of removed and restored runs row by row."""

from pyspark.sql import functions as F

from lumitrace.operators import coverage, lifecycle, settings_tables
from lumitrace.registry.associating import REGIONS_SQL, regions
from lumitrace.registry.base import query
from lumitrace.registry.lifecycle import _RM, RUN, run_tables
from lumitrace.registry.statistics import EDGES_SQL, edges
from lumitrace.sources.driver_tables import measurements, measurements_sql, run_images, run_images_sql, table
from lumitrace.sources.file_manifest import FileManifest
from lumitrace.workspace import new_path

M = f"WITH m AS ({measurements_sql()})"


def _forced_files(spark, sf_dir):
    """Forced rows of days 1 to 15, then those of later days, then one image's files taken out."""
    m = measurements(spark, sf_dir).filter("forced").select("id", "image_id", "source", "epoch")
    store = FileManifest(spark, new_path(spark, "forced-files"))
    store.append("forced", m.filter("epoch <= 15"))
    store.append("forced", m.filter("epoch > 10 AND epoch <= 25").withColumn("id", F.when(F.col("epoch") <= 15, F.col("id") + 1000000).otherwise(F.col("id"))))
    return store, m


@query(
    "forced_files_appended",
    f"""{M} SELECT id, image_id, source, 1::BIGINT AS written FROM m WHERE forced AND epoch <= 15
    UNION ALL SELECT CASE WHEN epoch <= 15 THEN id + 1000000 ELSE id END, image_id, source, 2 FROM m WHERE forced AND epoch > 10 AND epoch <= 25""",
)
def forced_files_appended(spark, sf_dir):
    """An image that is given forced rows twice keeps both files."""
    store, _ = _forced_files(spark, sf_dir)
    return store.read("forced").select("id", "image_id", "source", "written")


@query("previous_version_files", f"{M} SELECT id, image_id, source FROM m WHERE forced AND epoch <= 15")
def previous_version_files(spark, sf_dir):
    """The version before the last, by its manifest."""
    store, _ = _forced_files(spark, sf_dir)
    return store.previous("forced").select("id", "image_id", "source")


@query(
    "removed_files",
    f"""{M}, f AS (SELECT image_id, 1::BIGINT AS written FROM m WHERE forced AND epoch <= 15 UNION SELECT image_id, 2 FROM m WHERE forced AND epoch > 10 AND epoch <= 25)
    SELECT image_id, written FROM f WHERE image_id NOT IN (SELECT image_id FROM m WHERE epoch % 3 = 0)""",
)
def removed_files(spark, sf_dir):
    """Files left after those of every third day are taken out."""
    store, m = _forced_files(spark, sf_dir)
    store.remove("forced", m.filter("epoch % 3 = 0"))
    return store.files("forced").select("image_id", "written")


_LISTS = """l AS (SELECT strftime(o_orderdate, '%Y-%m') AS epoch, CASE o_orderkey % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'catalogue' ELSE 'noise' END AS kind, o_orderkey FROM orders),
 p AS (SELECT epoch, kind, row_number() OVER (PARTITION BY epoch, kind ORDER BY o_orderkey) - 1 AS pos, kind || '-' || o_orderkey AS path FROM l)"""


@query(
    "listed_inputs",
    f"""WITH {_LISTS} SELECT epoch, pos::BIGINT AS pos, {", ".join(f"min(path) FILTER (kind = '{k}') AS {k}" for k in settings_tables.INPUT_KINDS)} FROM p GROUP BY epoch, pos""",
)
def listed_inputs(spark, sf_dir):
    """Files given as a list per epoch and kind, paired by their place in the list."""
    o = table(spark, sf_dir, "orders")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("image", "catalogue", "noise")]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    path = F.struct("o_orderkey", F.concat(kind, F.lit("-"), F.col("o_orderkey").cast("string")).alias("path"))
    lists = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("epoch"), kind.alias("kind")).agg(F.array_sort(F.collect_list(path))["path"].alias("paths"))
    return settings_tables.pair_inputs(settings_tables.manifest_from_lists(lists)).withColumn("pos", F.col("pos").cast("long"))


@query("image_epochs_by_key", f"WITH im AS ({run_images_sql()}) SELECT name, dense_rank() OVER (ORDER BY 'day ' || lpad((epoch // 3)::VARCHAR, 4, '0')) AS epoch FROM im")
def image_epochs_by_key(spark, sf_dir):
    """Images that are given with an epoch each share the rank of its key."""
    im = run_images(spark, sf_dir)
    key = F.format_string("day %04d", F.floor(F.col("epoch") / 3))
    return settings_tables.label_epochs(im.drop("epoch"), im.select("name", key.alias("epoch_key"))).select("name", "epoch")


@query(
    "region_images",
    f"WITH {REGIONS_SQL}, im AS ({run_images_sql()}) SELECT g.id AS skyreg_id, im.image_id, im.name, im.epoch, im.datetime FROM g LEFT JOIN im ON im.image_id % 40 = g.id",
)
def region_images(spark, sf_dir):
    images = run_images(spark, sf_dir).withColumn("skyreg_id", F.col("image_id") % 40)
    return coverage.region_images(regions(spark, sf_dir), images)


_KEYS = {
    "runs": ("id", "id"),
    "sources": ("id", "run_id"),
    "associations": ("source_id", "meas_id"),
    "relations": ("from_source_id", "to_source_id"),
    "run_images": ("run_id", "image_id"),
    "run_regions": ("run_id", "skyreg_id"),
    "images": ("id", "id"),
    "sky_regions": ("id", "id"),
    "measurements": ("id", "image_id"),
}


def _rows(tables, names):
    """All rows of some tables by their two keys."""
    parts = [tables[n].select(F.lit(n).alias("name"), F.col(_KEYS[n][0]).cast("long").alias("a"), F.col(_KEYS[n][1]).cast("long").alias("b")) for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "rows_after_removal",
    f"""{_RM} SELECT 'runs' AS name, n_nationkey::BIGINT AS a, n_nationkey::BIGINT AS b FROM nation WHERE n_nationkey <> {RUN}
    UNION ALL SELECT DISTINCT 'sources', source, run_id FROM m WHERE run_id <> {RUN}
    UNION ALL SELECT 'associations', source, id FROM m WHERE run_id <> {RUN}
    UNION ALL SELECT 'relations', from_source_id, to_source_id FROM e WHERE from_source_id % 25 <> {RUN} AND to_source_id NOT IN (SELECT source FROM m WHERE run_id = {RUN})
    UNION ALL SELECT 'run_images', run_id, image_id FROM ri WHERE run_id <> {RUN}
    UNION ALL SELECT 'run_regions', run_id, skyreg_id FROM rr WHERE run_id <> {RUN}
    UNION ALL SELECT DISTINCT 'images', image_id, image_id FROM ri WHERE run_id <> {RUN}
    UNION ALL SELECT DISTINCT 'sky_regions', skyreg_id, skyreg_id FROM rr WHERE run_id <> {RUN}
    UNION ALL SELECT 'measurements', id, image_id FROM m WHERE image_id IN (SELECT image_id FROM ri WHERE run_id <> {RUN}) AND NOT (forced AND run_id = {RUN})""",
)
def rows_after_removal(spark, sf_dir):
    """Every row that is left of every table after one run is removed."""
    return _rows(lifecycle.remove_run(run_tables(spark, sf_dir), RUN), list(_KEYS))


_STAYS = f"(source % 25 <> {RUN} OR epoch <= 20)"


@query(
    "restored_tables",
    f"""{M}, e AS (SELECT DISTINCT from_source_id, to_source_id FROM ({EDGES_SQL}) WHERE from_source_id % 25 <> {RUN}
      UNION SELECT DISTINCT source, (source * 7 + k) % 120 FROM m WHERE has_siblings AND epoch <= 20 AND source % 25 = {RUN})
    SELECT DISTINCT 'sources' AS name, source AS a, source % 25 AS b FROM m WHERE {_STAYS}
    UNION ALL SELECT 'associations', source, id FROM m WHERE {_STAYS}
    UNION ALL SELECT 'relations', from_source_id, to_source_id FROM e
    UNION ALL SELECT 'measurements', id, image_id FROM m WHERE NOT forced OR {_STAYS}""",
)
def restored_tables(spark, sf_dir):
    """All tables after run 7 is taken back to the state it had on day 20."""
    m = measurements(spark, sf_dir).withColumn("run_id", F.col("source") % 25)

    def state(rows):
        return {
            "sources": rows.select(F.col("source").alias("id"), "run_id").distinct(),
            "associations": rows.select(F.col("source").alias("source_id"), F.col("id").alias("meas_id")),
            "relations": edges(rows).distinct(),
            "measurements": rows.select("id", "image_id", "forced"),
        }

    restored = lifecycle.restore(state(m.filter("epoch <= 20")), state(m), RUN)
    return _rows(restored, ["sources", "associations", "relations", "measurements"])
