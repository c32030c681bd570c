"""Association steps and runs."""

from pyspark.sql import functions as F

from lumitrace.operators import association, components, duplicates, stats
from lumitrace.registry.base import lifted_sql, query, rnd, rounded, sep_sql
from lumitrace.settings import RunSettings
from lumitrace.sources.driver_tables import key_dec, key_ra, measurements, measurements_sql, run_images, run_images_sql, table

RADIUS, DUPLICATE, DR_LIMIT, BEAMWIDTH = 1.2, 0.6, 1.4, 0.2
SETTINGS = RunSettings(radius=RADIUS, epoch_duplicate_radius=DUPLICATE, deruiter_radius=DR_LIMIT, beamwidth_limit=BEAMWIDTH)


def kept_sql(days: int, limit_arcsec: float) -> str:
    """CTEs m, im, d, k: measurements without the duplicates of their epoch."""
    lim = f"({limit_arcsec}::DOUBLE / 3600)"
    return f"""m AS ({measurements_sql(days)}), im AS ({run_images_sql(days)}),
 d AS (SELECT m.*, im.beam_bmaj, {sep_sql("m.ra", "m.dec", "im.ra", "im.dec")} AS dist FROM m JOIN im ON m.image_id = im.image_id),
 k AS (SELECT * FROM d WHERE id NOT IN (SELECT j.id FROM d i JOIN d j ON i.epoch = j.epoch AND i.image_id <> j.image_id
   AND abs(i.dec - j.dec) <= {lim} AND (i.dist < j.dist OR (i.dist = j.dist AND i.id < j.id))
   AND {sep_sql("i.ra", "i.dec", "j.ra", "j.dec")} <= {lim}))"""


@query("epoch_duplicates", f"WITH {kept_sql(1, 2.5)} SELECT id, image_id, epoch FROM k")
def epoch_duplicates(spark, sf_dir):
    m = measurements(spark, sf_dir)
    rows = duplicates.with_centre_distance(m, run_images(spark, sf_dir))
    return duplicates.drop_epoch_duplicates(rows, 2.5 / 3600).select("id", "image_id", "epoch")


_SHIFT = "((a.bra - b.ra + 180::DOUBLE) - 360 * floor((a.bra - b.ra + 180::DOUBLE) / 360) - 180)"
_DR = f"""sqrt(pow(radians({_SHIFT}) * cos(radians((a.bdec + b.dec) / 2)), 2) / (pow(radians(a.bew), 2) + pow(radians(b.uncertainty_ew), 2))
   + pow(radians(a.bdec - b.dec), 2) / (pow(radians(a.bns), 2) + pow(radians(b.uncertainty_ns), 2)))"""


def two_epochs_sql(method: str) -> str:
    """CTEs up to `f` (rows of epoch 2 with final source and parent) for a run of two epochs."""
    dist = "dr" if method == "deruiter" else "d2d"
    lim = f"(SELECT {BEAMWIDTH / 2}::DOUBLE * max(beam_bmaj) FROM im WHERE epoch = 2)" if method == "deruiter" else f"({RADIUS}::DOUBLE / 3600)"
    dr = _DR if method == "deruiter" else "0.0::DOUBLE"
    base = f"""{kept_sql(15, DUPLICATE)},
 seeds AS (SELECT *, row_number() OVER (ORDER BY ra, id) AS src,
   CASE WHEN (weight_ew * {lifted_sql("ra")}) / weight_ew >= 360 THEN (weight_ew * {lifted_sql("ra")}) / weight_ew - 360 ELSE (weight_ew * {lifted_sql("ra")}) / weight_ew END AS bra,
   (weight_ns * dec) / weight_ns AS bdec, 1 / sqrt(weight_ew) AS bew, 1 / sqrt(weight_ns) AS bns FROM k WHERE epoch = 1),
 e2 AS (SELECT * FROM k WHERE epoch = 2), lim AS (SELECT {lim} AS l),
 p0 AS (SELECT b.id, a.src, {sep_sql("a.bra", "a.bdec", "b.ra", "b.dec")} AS sep, {dr} AS dr
   FROM seeds a JOIN e2 b ON abs(a.bdec - b.dec) <= (SELECT l FROM lim)),
 p1 AS (SELECT id, src, sep * 3600 AS d2d, dr FROM p0 WHERE sep <= (SELECT l FROM lim){f" AND dr <= {DR_LIMIT}::DOUBLE" if method == "deruiter" else ""})"""
    if method == "basic":
        matched = "p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2d, src) AS rn FROM p1) WHERE rn = 1)"
    else:
        matched = f"""pc AS (SELECT *, count(*) OVER (PARTITION BY id) > 1 AND count(*) OVER (PARTITION BY src) > 1 AS tangled FROM p1),
 p2 AS (SELECT * FROM (SELECT *, min({dist}) FILTER (tangled) OVER (PARTITION BY id) AS least FROM pc) WHERE NOT tangled OR {dist} = least)"""
    return f"""WITH {base}, {matched},
 r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY {dist}, id) AS nth FROM p2),
 top AS (SELECT max(src) AS t FROM seeds),
 forks AS (SELECT id, src, d2d, dr, (SELECT t FROM top) + row_number() OVER (ORDER BY src, {dist}, id) AS child FROM r WHERE nth > 1),
 fresh AS (SELECT id, (SELECT t FROM top) + (SELECT count(*) FROM forks) + row_number() OVER (ORDER BY ra, id) AS child FROM e2 WHERE id NOT IN (SELECT id FROM r)),
 f AS (SELECT id, src AS source, CAST(NULL AS BIGINT) AS parent, d2d, dr FROM r WHERE nth = 1
   UNION ALL SELECT id, child, src, d2d, dr FROM forks
   UNION ALL SELECT id, child, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM fresh),
 a AS (SELECT source, id AS meas_id, d2d, dr FROM f UNION ALL SELECT src, id, 0.0::DOUBLE, 0.0::DOUBLE FROM seeds
   UNION ALL SELECT child, seeds.id, 0.0::DOUBLE, 0.0::DOUBLE FROM forks JOIN seeds ON forks.src = seeds.src)"""


def relations_sql(method: str) -> str:
    edges = "SELECT parent AS x, source AS y FROM f WHERE parent IS NOT NULL UNION SELECT source, parent FROM f WHERE parent IS NOT NULL"
    if method != "basic":
        edges += " UNION SELECT g.source, h.source FROM f g JOIN f h ON g.id = h.id AND g.source <> h.source"
    return edges


def run(spark, sf_dir, method, days):
    m = measurements(spark, sf_dir, days).drop("source")
    return association.associate(m, run_images(spark, sf_dir, days), SETTINGS.with_(method=method))


def _two_epochs(method: str):
    @query(
        f"association_{method}",
        f"{two_epochs_sql(method)} SELECT CAST(source AS BIGINT) AS source, meas_id, {rnd('d2d', 5)} AS d2d, {rnd('dr', 5)} AS dr FROM a",
    )
    def associations(spark, sf_dir):
        return rounded(run(spark, sf_dir, method, 15).associations, 5)

    @query(f"relations_{method}", f"{two_epochs_sql(method)} SELECT CAST(x AS BIGINT) AS from_source_id, CAST(y AS BIGINT) AS to_source_id FROM ({relations_sql(method)})")
    def relations(spark, sf_dir):
        return run(spark, sf_dir, method, 15).relations


for _method in ("basic", "advanced", "deruiter"):
    _two_epochs(_method)


@query("relation_counts_by_class", f"{two_epochs_sql('deruiter')} SELECT CAST(x AS BIGINT) AS source, count(DISTINCT y) AS n_rel FROM ({relations_sql('deruiter')}) WHERE x <> y GROUP BY x")
def relation_counts_by_class(spark, sf_dir):
    """Related sources of each source, from links and classes."""
    done = run(spark, sf_dir, "deruiter", 15)
    return stats.relation_counts(done.links, done.classes)


@query(
    "sources_sharing_measurements",
    f"""{two_epochs_sql('deruiter')}, g AS (SELECT id, list(DISTINCT source ORDER BY source) AS members FROM f GROUP BY id HAVING count(DISTINCT source) > 1)
    SELECT class_id, CAST(source AS BIGINT) AS source, size FROM (SELECT min(id) AS class_id, unnest(members) AS source, len(members) AS size FROM g GROUP BY members)""",
)
def sources_sharing_measurements(spark, sf_dir):
    """Classes of sources that share a measurement, a row per member."""
    return run(spark, sf_dir, "deruiter", 15).classes


@query(
    "weighted_positions",
    f"""{two_epochs_sql("basic")}, w AS (SELECT a.source, sum(weight_ew * {lifted_sql("ra")}) / sum(weight_ew) AS ra,
      sum(weight_ns * dec) / sum(weight_ns) AS dec, 1 / sqrt(sum(weight_ew)) AS ew FROM a JOIN k ON a.meas_id = k.id GROUP BY a.source)
    SELECT CAST(source AS BIGINT) AS source, {rnd("CASE WHEN ra >= 360 THEN ra - 360 ELSE ra END")} AS src_ra, {rnd("dec")} AS src_dec, {rnd("ew")} AS src_ew FROM w""",
)
def weighted_positions(spark, sf_dir):
    state = run(spark, sf_dir, "basic", 15).state
    return rounded(association.positions(state).select("source", "src_ra", "src_dec", "src_ew"))


#: Epochs that `chain_sql` unrolls; those that the tables lack are empty steps.
UNROLLED = 8


def chain_sql(days: int, group: str = "0", before: str = "", centre: tuple[str, str] = ("im.ra", "im.dec")) -> str:
    """CTEs up to `h`: the history (source, grp, meas_id, d2d) of a basic run over all epochs, with region group `group` and `centre` of image im."""
    lim, dup = f"({RADIUS}::DOUBLE / 3600)", f"({DUPLICATE}::DOUBLE / 3600)"
    lifted = f"sum(weight_ew * {lifted_sql('ra')}) / sum(weight_ew)"
    ctes = [
        f"{before}m AS ({measurements_sql(days)})",
        f"im AS (SELECT im.* EXCLUDE (ra, dec), {centre[0]} AS ra, {centre[1]} AS dec, {group} AS grp FROM ({run_images_sql(days)}) im)",
        f"d AS (SELECT m.*, im.grp, {sep_sql('m.ra', 'm.dec', 'im.ra', 'im.dec')} AS dist FROM m JOIN im ON m.image_id = im.image_id)",
        f"""k0 AS (SELECT * FROM d WHERE id NOT IN (SELECT j.id FROM d i JOIN d j ON i.epoch = j.epoch AND i.grp = j.grp AND i.image_id <> j.image_id
          AND abs(i.dec - j.dec) <= {dup} AND (i.dist < j.dist OR (i.dist = j.dist AND i.id < j.id)) AND {sep_sql('i.ra', 'i.dec', 'j.ra', 'j.dec')} <= {dup}))""",
        "k AS MATERIALIZED (SELECT k0.*, CASE WHEN n > 1 THEN ra ELSE 0.0::DOUBLE END AS ord FROM k0 JOIN (SELECT grp, epoch, count(*) AS n FROM im GROUP BY grp, epoch) USING (grp, epoch))",
        "h0 AS (SELECT 0::BIGINT AS source, 0::BIGINT AS grp, 0::BIGINT AS meas_id, 0.0::DOUBLE AS d2d WHERE false)",
        "t0 AS (SELECT 0::BIGINT AS t)",
    ]
    for e in range(1, UNROLLED + 1):
        h, t = f"h{e - 1}", f"(SELECT t FROM t{e - 1})"
        ctes += [
            f"s{e} AS MATERIALIZED (SELECT source, grp, CASE WHEN r >= 360 THEN r - 360 ELSE r END AS bra, bdec FROM (SELECT {h}.source, k.grp, {lifted} AS r, sum(weight_ns * dec) / sum(weight_ns) AS bdec FROM {h} JOIN k ON meas_id = id GROUP BY {h}.source, k.grp))",
            f"e{e} AS MATERIALIZED (SELECT * FROM k WHERE epoch = {e})",
            f"p{e} AS (SELECT b.id, a.source AS src, {sep_sql('a.bra', 'a.bdec', 'b.ra', 'b.dec')} * 3600 AS d2d FROM s{e} a JOIN e{e} b ON a.grp = b.grp AND abs(a.bdec - b.dec) <= {lim})",
            f"n{e} AS (SELECT id, src, d2d, row_number() OVER (PARTITION BY id ORDER BY d2d, src) AS place FROM p{e} WHERE d2d <= {lim} * 3600)",
            f"r{e} AS MATERIALIZED (SELECT id, src, d2d, row_number() OVER (PARTITION BY src ORDER BY d2d, id) AS nth FROM n{e} WHERE place = 1)",
            f"f{e} AS MATERIALIZED (SELECT id, src, d2d, {t} + row_number() OVER (ORDER BY src, d2d, ord, id) AS child FROM r{e} JOIN e{e} USING (id) WHERE nth > 1)",
            f"w{e} AS MATERIALIZED (SELECT id, {t} + (SELECT count(*) FROM f{e}) + row_number() OVER (ORDER BY ord, id) AS child FROM e{e} WHERE id NOT IN (SELECT id FROM r{e}))",
            f"o{e} AS (SELECT id, src AS source, d2d FROM r{e} WHERE nth = 1 UNION ALL SELECT id, child, d2d FROM f{e} UNION ALL SELECT id, child, 0.0::DOUBLE FROM w{e})",
            f"""h{e} AS MATERIALIZED (SELECT * FROM {h} UNION ALL SELECT o.source, e.grp, o.id, o.d2d FROM o{e} o JOIN e{e} e ON o.id = e.id
              UNION ALL SELECT f.child, h.grp, h.meas_id, h.d2d FROM f{e} f JOIN {h} h ON f.src = h.source)""",
            f"t{e} AS (SELECT {t} + (SELECT count(*) FROM f{e}) + (SELECT count(*) FROM w{e}) AS t)",
        ]
    return ", ".join(ctes) + f", h AS (SELECT * FROM h{UNROLLED})"


_CHAINED = f"SELECT CAST(source AS BIGINT) AS source, meas_id, {rnd('d2d', 5)} AS d2d, 0.0::DOUBLE AS dr FROM h"


@query("association_six_epochs", f"WITH {chain_sql(5)} {_CHAINED}")
def association_six_epochs(spark, sf_dir):
    return rounded(run(spark, sf_dir, "basic", 5).associations, 5)


def regions(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("long")
    return n.select(k.alias("id"), key_ra(k).alias("centre_ra"), key_dec(k).alias("centre_dec"), (18.0 + k % 5).alias("xtr_radius"))


REGIONS_SQL = """g AS (SELECT CAST(n_nationkey AS BIGINT) AS id, (n_nationkey * 137.508::DOUBLE) % 360.0::DOUBLE AS centre_ra,
   -80.0::DOUBLE + (n_nationkey * 61.803::DOUBLE) % 160.0::DOUBLE AS centre_dec, 18.0::DOUBLE + n_nationkey % 5 AS xtr_radius FROM nation)"""

GROUPS_SQL = f"""{REGIONS_SQL},
 e AS (SELECT a.id AS x, b.id AS y FROM g a JOIN g b ON {sep_sql("a.centre_ra", "a.centre_dec", "b.centre_ra", "b.centre_dec")} <= 1.1::DOUBLE * greatest(a.xtr_radius, b.xtr_radius)),
 reach AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
 gr AS (SELECT x AS id, dense_rank() OVER (ORDER BY label) AS skyreg_group FROM (SELECT x, min(y) AS label FROM reach GROUP BY x))"""


@query("region_groups", f"WITH RECURSIVE {GROUPS_SQL} SELECT id, skyreg_group FROM gr")
def region_groups(spark, sf_dir):
    return components.group_regions(regions(spark, sf_dir))


@query(
    "images_with_groups",
    f"""WITH RECURSIVE {GROUPS_SQL}, im AS ({run_images_sql()}) SELECT im.image_id, im.name, im.image_id % 25 AS skyreg_id, skyreg_group, im.datetime
    FROM im LEFT JOIN gr ON im.image_id % 25 = gr.id""",
)
def images_with_groups(spark, sf_dir):
    images = run_images(spark, sf_dir).withColumn("skyreg_id", F.col("image_id") % 25)
    grouped = components.attach_groups(images, components.group_regions(regions(spark, sf_dir)))
    return grouped.select("image_id", "name", "skyreg_id", "skyreg_group", "datetime")


_GROUPED = chain_sql(15, "coalesce((SELECT skyreg_group FROM gr WHERE gr.id = im.image_id % 25), 0)", GROUPS_SQL + ", ")


@query("grouped_association", f"WITH RECURSIVE {_GROUPED} {_CHAINED}")
def grouped_association(spark, sf_dir):
    """All region groups in one loop: the group is part of every join key."""
    m = measurements(spark, sf_dir, 15).drop("source")
    images = run_images(spark, sf_dir, 15).withColumn("skyreg_id", F.col("image_id") % 25)
    images = components.attach_groups(images, components.group_regions(regions(spark, sf_dir)))
    return rounded(association.associate(m, images, SETTINGS).associations, 5)


@query(
    "chained_group_ids",
    f"""WITH m AS ({measurements_sql()}), t AS (SELECT epoch, max(source) + 1 AS top FROM m GROUP BY epoch),
    o AS (SELECT epoch, coalesce(sum(top) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM t)
    SELECT id, epoch AS skyreg_group, CAST(source + 1 + off AS BIGINT) AS source FROM m JOIN o USING (epoch)""",
)
def chained_group_ids(spark, sf_dir):
    m = measurements(spark, sf_dir).select("id", F.col("epoch").alias("skyreg_group"), (F.col("source") + 1).alias("source"))
    return association.chain_group_ids(m)


@query(
    "renumbered_sources",
    f"""WITH m AS ({measurements_sql()}), n AS (SELECT source, 5000 + row_number() OVER (ORDER BY source) - 1 AS fresh
      FROM (SELECT DISTINCT source FROM m WHERE source NOT IN (SELECT s_suppkey FROM supplier)))
    SELECT id, coalesce(fresh, m.source) AS source FROM m LEFT JOIN n ON m.source = n.source""",
)
def renumbered_sources(spark, sf_dir):
    m = measurements(spark, sf_dir).select("id", "source")
    done = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"))
    edges = m.select(F.col("source").alias("from_source_id"), F.col("source").alias("to_source_id"))
    rows, _ = association.renumber_added(m, edges, done, 5000)
    return rows


@query(
    "renumbered_relations",
    f"""WITH m AS ({measurements_sql()}), n AS (SELECT source, 5000 + row_number() OVER (ORDER BY source) - 1 AS fresh
      FROM (SELECT DISTINCT source FROM m WHERE source NOT IN (SELECT s_suppkey FROM supplier)))
    SELECT m.id, coalesce(a.fresh, m.source) AS from_source_id, coalesce(b.fresh, (m.source * 7 + m.k) % 120) AS to_source_id
    FROM m LEFT JOIN n a ON m.source = a.source LEFT JOIN n b ON (m.source * 7 + m.k) % 120 = b.source WHERE m.has_siblings""",
)
def renumbered_relations(spark, sf_dir):
    """The relations of renumbered sources, both ends mapped."""
    m = measurements(spark, sf_dir)
    done = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"))
    edges = m.filter("has_siblings").select("id", F.col("source").alias("from_source_id"), ((F.col("source") * 7 + F.col("k")) % 120).alias("to_source_id"))
    return association.renumber_added(m.select("id", "source"), edges, done, 5000)[1]
