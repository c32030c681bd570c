"""Files written and read back, whole runs, arriving images."""

from pyspark.sql import functions as F

from lumitrace.plans import pipeline
from lumitrace.registry.associating import SETTINGS, UNROLLED, chain_sql, two_epochs_sql
from lumitrace.registry.base import query, rnd, rnds, rounded, sep_sql
from lumitrace.registry.cleaning import COMPONENTS_SQL, components
from lumitrace.registry.covering import regions
from lumitrace.registry.scalars import POSITION_NAME_SQL
from lumitrace.registry.statistics import M, PAIRS_CTE, _best_pair_sql, statistics_body
from lumitrace.settings import RunSettings
from lumitrace.sources import catalogues
from lumitrace.sources.driver_tables import key_dec, key_ra, measurements, measurements_sql, run_images
from lumitrace.sources.tables import RunStore, read_measurements, write_by_image
from lumitrace.streaming.increments import Increments
from lumitrace.workspace import materialize, new_path

_READ = ["local_rms", "ra", "dec", "flux_peak", "flux_int", "flux_peak_err", "bmaj", "pa"]
_READ_SQL = f"SELECT 'IMG' || image_id AS image, island_id, component_id, {rnds(*_READ)}, false AS has_siblings FROM ({COMPONENTS_SQL})"


def _catalogue_lines(spark, sf_dir, mark: str, separator: str):
    """Events as catalogue files, one folder per image: a header line and a line per component."""
    rows = components(spark, sf_dir)
    filled = {target: name for name, (target, _) in catalogues.COMPONENT_COLUMNS.items()}
    values = []
    for target in filled:
        present = target in rows.columns
        values.append(F.col(target).cast("string") if present else F.lit("0"))
    line = F.concat_ws(separator, *values)
    header = F.lit(mark + separator.join(filled.values()))
    body = rows.select("image_id", line.alias("value"))
    headers = rows.select("image_id").distinct().select("image_id", header.alias("value"))
    # All lines of an image go to one file, so each file has its header.
    return headers.unionByName(body).repartition("image_id")


def _read_back(spark, path, reader):
    out = reader(spark, f"{path}/*")
    image = F.regexp_extract("catalogue_path", "image_id=([0-9]+)", 1)
    return rounded(out.select(F.concat(F.lit("IMG"), image).alias("image"), "island_id", "component_id", *_READ, "has_siblings"))


@query("text_catalogues", _READ_SQL)
def text_catalogues(spark, sf_dir):
    path = new_path(spark, "text")
    _catalogue_lines(spark, sf_dir, "# ", "  ").write.partitionBy("image_id").text(path)
    return _read_back(spark, path, catalogues.read_text)


@query("csv_catalogues", _READ_SQL)
def csv_catalogues(spark, sf_dir):
    path = new_path(spark, "csv")
    _catalogue_lines(spark, sf_dir, "", ",").write.partitionBy("image_id").text(path)
    return _read_back(spark, path, catalogues.read_csv)


@query("wide_csv_catalogues", _READ_SQL)
def wide_csv_catalogues(spark, sf_dir):
    """As `csv_catalogues`, behind 90 further columns."""
    path = new_path(spark, "wide-csv")
    lines = _catalogue_lines(spark, sf_dir, "", ",")
    more = F.when(F.col("value").startswith("island_id"), F.lit(",".join(f"x{i}" for i in range(90)))).otherwise(F.lit("0," * 89 + "0"))
    lines.withColumn("value", F.concat_ws(",", more, "value")).write.partitionBy("image_id").text(path)
    return _read_back(spark, path, catalogues.read_csv)


@query("votable_catalogues", _READ_SQL)
def votable_catalogues(spark, sf_dir):
    """Events as XML tables, a file per image."""
    path = new_path(spark, "votable")
    rows = components(spark, sf_dir)
    names = {target: name for name, (target, _) in catalogues.COMPONENT_COLUMNS.items()}
    cells = [F.concat(F.lit("<TD>"), F.col(t).cast("string") if t in rows.columns else F.lit("0"), F.lit("</TD>")) for t in names]
    fields = "".join(f'<FIELD name="{n}"/>' for n in names.values())
    line = F.struct(F.lit(1).alias("place"), F.concat(F.lit("<TR>"), *cells, F.lit("</TR>")).alias("value"))
    ends = F.array(F.struct(F.lit(0).alias("place"), F.lit(f"<VOTABLE><RESOURCE><TABLE>{fields}<DATA><TABLEDATA>").alias("value")), F.struct(F.lit(2).alias("place"), F.lit("</TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>").alias("value")))
    lines = rows.select("image_id", line.alias("l")).unionByName(rows.select("image_id").distinct().select("image_id", F.explode(ends).alias("l")))
    placed = lines.select("image_id", "l.place", "l.value").repartition("image_id").sortWithinPartitions("image_id", "place")
    placed.drop("place").write.partitionBy("image_id").text(path)
    return _read_back(spark, path, lambda s, p: catalogues.read_votable(s, p.rstrip("*") + "*/*"))


@query("stored_measurements", f"SELECT id, image_id, {rnd('flux_peak')} AS flux_peak FROM ({measurements_sql()})")
def stored_measurements(spark, sf_dir):
    path = new_path(spark, "measurements")
    write_by_image(measurements(spark, sf_dir), path)
    stored = read_measurements(spark, path, ["id", "image_id", "flux_peak"])
    return rounded(stored.withColumn("image_id", F.col("image_id").cast("long")))


@query(
    "restored_version",
    f"SELECT id, source FROM ({measurements_sql()}) WHERE forced",
)
def restored_version(spark, sf_dir):
    """Two versions of a table are stored, then the first is made current again."""
    store = RunStore(spark, new_path(spark, "store"))
    m = measurements(spark, sf_dir).select("id", "source", "forced")
    store.save("run", {"rows": m.filter("forced")})
    store.save("run", {"rows": m})
    store.restore("run")
    return store.read("run", "rows").select("id", "source")


@query(
    "arriving_images",
    f"{two_epochs_sql('basic')} SELECT CAST(source AS BIGINT) AS source, meas_id, {rnd('d2d', 5)} AS d2d FROM a",
)
def arriving_images(spark, sf_dir):
    """Epochs arrive one after the other as files of a stream."""
    m = measurements(spark, sf_dir, 15).drop("source")
    images = materialize(run_images(spark, sf_dir, 15), "run-images")
    rows = m.select("id", "image_id", "ra", "dec", "uncertainty_ew", "uncertainty_ns", "weight_ew", "weight_ns", "epoch")
    folder, checkpoint = new_path(spark, "arriving"), new_path(spark, "stream")
    steps = Increments(spark, new_path(spark, "increments"), SETTINGS, width=30.0)
    for (epoch,) in rows.select("epoch").distinct().orderBy("epoch").collect():
        rows.filter(F.col("epoch") == epoch).drop("epoch").write.mode("append").parquet(folder)
        steps.start(folder, rows.drop("epoch").schema, images, checkpoint).awaitTermination()
    return rounded(steps.load().associations.select("source", "meas_id", "d2d"), 5)


_RUN_FORKS = " UNION ALL ".join(f"SELECT src AS x, child AS y FROM f{e} UNION ALL SELECT child, src FROM f{e}" for e in range(1, UNROLLED + 1))
_RUN_PAIRS = PAIRS_CTE[len(M) + 2 :].replace("FROM m a JOIN m b", "FROM lc a JOIN lc b")
_CENTRE = ("(im.image_id % 10 * 137.508::DOUBLE) % 360.0::DOUBLE", "-80.0::DOUBLE + (im.image_id % 10 * 61.803::DOUBLE) % 160.0::DOUBLE")
_RUN_SQL = f"""WITH {chain_sql(10, centre=_CENTRE)},
 lc AS MATERIALIZED (SELECT h.source, false AS forced, im.datetime, k.* EXCLUDE (source, forced, datetime) FROM h JOIN k ON h.meas_id = k.id JOIN im ON k.image_id = im.image_id),
 s AS MATERIALIZED ({statistics_body(lambda e: e).replace("FROM m GROUP", "FROM lc GROUP")}), {_RUN_PAIRS},
 rel AS (SELECT x AS source, count(DISTINCT y) AS n_rel FROM ({_RUN_FORKS}) WHERE x <> y GROUP BY x),
 nn AS (SELECT a.source, min({sep_sql("a.wavg_ra", "a.wavg_dec", "b.wavg_ra", "b.wavg_dec")}) AS n_neighbour_dist FROM s a JOIN s b ON a.source <> b.source GROUP BY a.source),
 x AS (SELECT s.*, wavg_ra AS ra, wavg_dec AS dec FROM s)
 SELECT CAST(x.source AS BIGINT) AS source, {POSITION_NAME_SQL} AS name, n_meas, coalesce(n_rel, 0) AS n_rel, {rnds("wavg_ra", "wavg_dec", "eta_peak", "v_peak", "n_neighbour_dist")},
  {rnd("coalesce(m_abs_significant_max_peak, 0)")} AS m_abs_significant_max_peak
 FROM x LEFT JOIN rel USING (source) LEFT JOIN nn USING (source) LEFT JOIN ({_best_pair_sql("peak")}) USING (source)"""


@query("whole_run", _RUN_SQL)
def whole_run(spark, sf_dir):
    """A run from measurements to final sources, over three epochs."""
    m = measurements(spark, sf_dir, 10).drop("source", "epoch", "datetime").withColumn("forced", F.lit(False))
    images = run_images(spark, sf_dir, 10)
    region = F.col("image_id") % 10
    images = images.withColumns({"skyreg_id": region, "ra": key_ra(region), "dec": key_dec(region)})
    discs = regions(spark, sf_dir).withColumn("xtr_radius", F.lit(75.0))
    tables = pipeline.run(m, images, discs, RunSettings(radius=1.2, epoch_duplicate_radius=0.6, method="basic"))
    return rounded(tables["sources"].select("source", "name", "n_meas", "n_rel", "wavg_ra", "wavg_dec", "eta_peak", "v_peak", "n_neighbour_dist", "m_abs_significant_max_peak"))
