"""Catalogue cleaning, image attributes, manifests."""

from pyspark.sql import functions as F

from lumitrace.operators import clean, images, settings_tables
from lumitrace.registry.base import query, rnd, rnds, rounded
from lumitrace.registry.scalars import _CONDON, _corner_sql, _rho_sql
from lumitrace.settings import RunSettings
from lumitrace.sources import catalogues
from lumitrace.sources.driver_tables import key_dec, key_ra, measurements, measurements_sql, run_images, run_images_sql, table


def components(spark, sf_dir):
    """Events as catalogue rows, with zero sizes, zero noise and tiny errors among them."""
    m = measurements(spark, sf_dir)
    k = F.col("k")
    return m.select(
        "id", "image_id", "island_id", F.concat(F.lit("component_"), F.col("id").cast("string")).alias("component_id"), "ra", "dec",
        ((k % 5) * 400.0).alias("ra_err"), (400.0 + (k % 3) * 400.0).alias("dec_err"), "flux_peak", "flux_int",
        ((k % 4) * 0.0006).alias("flux_peak_err"), ((k % 7) * 0.0004).alias("flux_int_err"), ((k % 20) * 1.5).alias("bmaj"),
        (10.0 + k % 7).alias("bmin"), (k * 1.8).alias("pa"), F.when(k % 10 == 0, 0.0).otherwise(F.col("local_rms")).alias("local_rms"),
    )


COMPONENTS_SQL = f"""SELECT id, image_id, island_id, 'component_' || id AS component_id, ra, dec, (k % 5) * 400.0::DOUBLE AS ra_err, 400.0::DOUBLE + (k % 3) * 400.0::DOUBLE AS dec_err,
  flux_peak, flux_int, (k % 4) * 0.0006::DOUBLE AS flux_peak_err, (k % 7) * 0.0004::DOUBLE AS flux_int_err, (k % 20) * 1.5::DOUBLE AS bmaj,
  10.0::DOUBLE + k % 7 AS bmin, k * 1.8::DOUBLE AS pa, CASE WHEN k % 10 = 0 THEN 0.0::DOUBLE ELSE local_rms END AS local_rms FROM ({measurements_sql()})"""

CLEAN_CTE = f"""r AS ({COMPONENTS_SQL}), im AS ({run_images_sql()}),
 c0 AS (SELECT r.* EXCLUDE (flux_peak_err, flux_int_err, ra_err, dec_err, local_rms), im.name AS image_name, im.beam_bmaj AS bb, im.beam_bmin AS sb,
   greatest(flux_peak_err, 0.001::DOUBLE) AS flux_peak_err, greatest(flux_int_err, 0.001::DOUBLE) AS flux_int_err,
   greatest(ra_err, 0.01::DOUBLE) / 3600 AS ra_err, greatest(dec_err, 0.01::DOUBLE) / 3600 AS dec_err,
   CASE WHEN local_rms = 0 THEN 0.2::DOUBLE ELSE local_rms END AS local_rms
   FROM r JOIN im ON r.image_id = im.image_id
   WHERE bmaj <> 0 AND bmin <> 0 AND flux_peak <> 0 AND flux_int <> 0 AND bmaj > im.beam_bmaj * 500 AND bmin > im.beam_bmin * 500),
 c1 AS (SELECT *, flux_peak / local_rms AS snr, flux_int / flux_peak AS compactness FROM c0)"""


def _positions_sql(source: str) -> str:
    corners = ", ".join(_corner_sql(s, t).replace("e_ra", "ra_err").replace("e_dec", "dec_err") for s in (1, -1) for t in (1, -1))
    return f"""e AS (SELECT *, degrees(greatest({corners})) AS error_radius FROM {source}),
 u AS (SELECT *, sqrt(error_radius * error_radius + pow(1::DOUBLE / 3600, 2)) AS unc FROM e),
 z AS (SELECT *, flux_int / sum(flux_int) OVER (PARTITION BY image_id, island_id) AS flux_int_isl_ratio,
   flux_peak / sum(flux_peak) OVER (PARTITION BY image_id, island_id) AS flux_peak_isl_ratio FROM u)"""


_NAME_SQL = "split_part(split_part(image_name, '.i.', 2), '.', 1) || '_' || component_id"
_SHOWN = ["flux_peak_err", "flux_int_err", "snr", "compactness", "flux_int_isl_ratio", "flux_peak_isl_ratio", "local_rms"]


def _cleaned(spark, sf_dir, condon: bool):
    out = clean.clean_components(components(spark, sf_dir), run_images(spark, sf_dir), RunSettings(condon_errors=condon))
    errors = [(F.col(c) * 3600).alias(c) for c in ("ra_err", "dec_err")]
    return out.select("id", "name", *errors, *_SHOWN, "error_radius", "uncertainty_ew", "weight_ew")


def _cleaned_sql() -> str:
    return f"SELECT id, {_NAME_SQL} AS name, {rnd('ra_err * 3600', 5)} AS ra_err, {rnd('dec_err * 3600', 5)} AS dec_err, {rnds(*_SHOWN, digits=5)}"


@query(
    "cleaned_measurements",
    f"""WITH {CLEAN_CTE}, {_positions_sql('c1')} {_cleaned_sql()}, {rnd("error_radius * 3600", 2)} AS error_radius,
    {rnd("unc * 3600", 2)} AS uncertainty_ew, {rnd("1e6::DOUBLE / pow(unc * 3600, 2)", 3)} AS weight FROM z""",
)
def cleaned_measurements(spark, sf_dir):
    out = _cleaned(spark, sf_dir, False)
    # The arc cosine carries about 1e-7 arcsec of noise here, so positions keep two digits.
    coarse = {c: F.floor(F.col(c) * 3600 * 100.0 + 0.5) / 100.0 for c in ("error_radius", "uncertainty_ew")}
    weight = F.floor(F.col("weight_ew") / 3600.0 / 3600.0 * 1e6 * 1000.0 + 0.5) / 1000.0
    return rounded(out.withColumns(coarse | {"weight": weight}).drop("weight_ew"), 5)


_C3 = f"""g AS (SELECT *, bmaj / 3600 AS mj, bmin / 3600 AS mn, radians(pa) AS th FROM c1),
 h AS (SELECT *, {_rho_sql(2.5, 0.5)} AS r1, {_rho_sql(0.5, 2.5)} AS r2, {_rho_sql(1.5, 1.5)} AS r3 FROM g),
 q AS (SELECT *, mj / (sqrt(4 * ln(2::DOUBLE)) * r1) AS p1, mn / (sqrt(4 * ln(2::DOUBLE)) * r2) AS p2, sqrt(2::DOUBLE) * mj / r1 AS e_maj,
   sqrt(2::DOUBLE) * mn / r2 AS e_min, sqrt(2 * flux_peak * flux_peak / (r3 * r3)) AS e_peak FROM h),
 c3 AS (SELECT * EXCLUDE (flux_peak_err, flux_int_err, ra_err, dec_err), {", ".join(f"{e} AS {n}" for n, e in _CONDON.items())} FROM q)"""


@query("cleaned_with_condon", f"WITH {CLEAN_CTE}, {_C3}, {_positions_sql('c3')} {_cleaned_sql()} FROM z")
def cleaned_with_condon(spark, sf_dir):
    return rounded(_cleaned(spark, sf_dir, True).drop("error_radius", "uncertainty_ew", "weight_ew"), 5)


@query(
    "duplicate_components",
    f"""WITH r AS ({COMPONENTS_SQL}) SELECT image_id, 'component_' || (id % 300) AS component_id, count(*) AS n FROM r
    GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_components(spark, sf_dir):
    c = components(spark, sf_dir).withColumn("component_id", F.concat(F.lit("component_"), (F.col("id") % 300).cast("string")))
    return clean.duplicate_components(c)


@query("dropped_rows", f"""WITH r AS ({COMPONENTS_SQL}), im AS ({run_images_sql()}) SELECT r.id FROM r JOIN im ON r.image_id = im.image_id
    WHERE NOT (bmaj <> 0 AND bmin <> 0 AND flux_peak <> 0 AND flux_int <> 0 AND bmaj > beam_bmaj * 500 AND bmin > beam_bmin * 500)""")
def dropped_rows(spark, sf_dir):
    rows = components(spark, sf_dir)
    beams = run_images(spark, sf_dir).select("image_id", "beam_bmaj", "beam_bmin")
    kept = clean.drop_tiny(clean.drop_unrealistic(rows).join(beams, "image_id"))
    return rows.select("id").join(kept.select("id"), "id", "left_anti")


@query(
    "island_ratios",
    f"""WITH r AS ({COMPONENTS_SQL}) SELECT id, {rnd("flux_int / sum(flux_int) OVER w", 7)} AS flux_int_isl_ratio,
    {rnd("flux_peak / sum(flux_peak) OVER w", 7)} AS flux_peak_isl_ratio FROM r WINDOW w AS (PARTITION BY image_id, island_id)""",
)
def island_ratios(spark, sf_dir):
    out = clean.with_island_ratios(components(spark, sf_dir))
    return rounded(out.select("id", "flux_int_isl_ratio", "flux_peak_isl_ratio"), 7)


@query(
    "flux_fraction_errors",
    f"""WITH m AS ({measurements_sql()}) SELECT id, {rnd("sqrt(pow(flux_int_err, 2) + pow(0.05::DOUBLE * flux_int, 2))")} AS flux_int_err,
    {rnd("sqrt(pow(flux_peak_err, 2) + pow(0.05::DOUBLE * flux_peak, 2))")} AS flux_peak_err FROM m""",
)
def flux_fraction_errors(spark, sf_dir):
    return rounded(clean.with_flux_fraction(measurements(spark, sf_dir), 0.05).select("id", "flux_int_err", "flux_peak_err"))


_SURVEY_COLS = ["ra", "ra_err", "dec", "dec_err", "flux_peak", "flux_peak_err", "flux_int", "flux_int_err", "bmaj", "bmin", "pa"]


def _survey_sql(name: str) -> str:
    t = catalogues.SURVEYS[name]
    same_flux = t["peak_flux"] == t["total_flux"]
    fi, fie = ("flux_peak", "flux_peak_err") if same_flux else ("flux_int", "flux_int_err")
    p, f, a = (f"{t[x]!r}::DOUBLE" for x in ("pos_err_ang_scale", "flux_scale", "ang_scale"))
    exprs = ["ra", f"ra_err * {p}", "dec", f"dec_err * {p}", f"flux_peak * {f}", f"flux_peak_err * {f}", f"{fi} * {f}", f"{fie} * {f}", f"bmaj * {a}", f"bmin * {a}", "pa"]
    cols = ", ".join(f"{rnd(e, 5)} AS {c}" for e, c in zip(exprs, _SURVEY_COLS))
    return f"SELECT '{name}' AS survey, {cols}, {t['freq']!r}::DOUBLE AS frequency FROM r"


@query("translated_surveys", f"WITH r AS ({COMPONENTS_SQL}) " + " UNION ALL ".join(_survey_sql(n) for n in catalogues.SURVEYS))
def translated_surveys(spark, sf_dir):
    rows = components(spark, sf_dir)
    keys = {"ra": "ra", "err_ra": "ra_err", "dec": "dec", "err_dec": "dec_err", "total_flux": "flux_int", "err_total_flux": "flux_int_err",
            "peak_flux": "flux_peak", "err_peak_flux": "flux_peak_err", "bmaj": "bmaj", "bmin": "bmin", "pa": "pa"}
    out = None
    for name, t in catalogues.SURVEYS.items():
        # Where a survey has one flux column, the peak flux fills it.
        named = {t[key]: F.col(column) for key, column in keys.items()}
        part = catalogues.translate(rows.select(*[v.alias(k) for k, v in named.items()]), name)
        part = rounded(part, 5).withColumn("survey", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


_CARDS = {
    "TELESCOP": "CASE WHEN c_custkey % 5 = 0 THEN 'OTHER' ELSE 'ASKAP' END",
    "DATE-OBS": "'2020-01-0' || CAST(1 + c_custkey % 9 AS VARCHAR) || 'T03:04:05.25'",
    "TIMESYS": "'UTC'",
    "BMAJ": "'0.00' || CAST(3 + c_custkey % 4 AS VARCHAR)",
    "BMIN": "'0.002'",
    "BPA": "CAST(c_custkey % 90 AS VARCHAR)",
    "NAXIS1": "CAST(1000 + c_custkey % 100 AS VARCHAR)",
    "NAXIS2": "CAST(900 + c_custkey % 50 AS VARCHAR)",
    "CTYPE1": "'RA---SIN'",
    "CRVAL1": "CAST(c_custkey % 350 AS VARCHAR)",
    "CRVAL2": "CAST(c_custkey % 80 AS VARCHAR)",
    "CRPIX1": "CAST(1000 + c_custkey % 100 AS VARCHAR) || '.0'",
    "CRPIX2": "CAST(900 + c_custkey % 50 AS VARCHAR) || '.0'",
    "CDELT1": "'-0.0007'",
    "CDELT2": "'0.0007'",
    "CTYPE3": "CASE WHEN c_custkey % 3 = 0 THEN 'FREQ' ELSE 'STOKES' END",
    "CRVAL3": "'887500000'",
    "CDELT3": "'288000000'",
    "CTYPE4": "CASE WHEN c_custkey % 3 = 1 THEN 'VOPT' ELSE 'STOKES' END",
    "CRVAL4": "'943500000'",
    "RESTFREQ": "'1367500000'",
    "RESTBW": "'144000000'",
}
_POLARISED = "c_custkey % 2 = 0"


def header_cards(spark, sf_dir, *more):
    c = table(spark, sf_dir, "customer")
    cards = [F.struct(F.lit(k).alias("keyword"), F.expr(e.replace("VARCHAR", "STRING")).alias("value")) for k, e in _CARDS.items()]
    cards.append(F.struct(F.lit("STOKES").alias("keyword"), F.when(F.expr(_POLARISED), F.lit("V")).alias("value")))
    rows = c.select(F.col("c_name").alias("image"), *more, F.explode(F.array(*cards)).alias("card"))
    return rows.select("image", *more, "card.*").filter("value IS NOT NULL")


# The reference pixel is 500/450 pixels off the centre: the SIN deprojection in full.
_X = "radians((nx / 2 - nx) * -0.0007::DOUBLE)"
_Y = "radians((ny / 2 - ny) * 0.0007::DOUBLE)"
_RHO = f"sqrt({_X} * {_X} + {_Y} * {_Y})"
_D0 = "radians(d0)"
_DEC = f"degrees(asin(cos(asin({_RHO})) * sin({_D0}) + {_Y} / {_RHO} * sin(asin({_RHO})) * cos({_D0})))"
_RA = f"degrees(atan2({_X} * sin(asin({_RHO})), {_RHO} * cos({_D0}) * cos(asin({_RHO})) - {_Y} * sin({_D0}) * sin(asin({_RHO}))))"
_RA = f"(({_RA} + a0) - 360 * floor(({_RA} + a0) / 360))"


def _own(expr: str) -> str:
    return f"CASE WHEN own THEN {expr} END"


@query(
    "image_attributes",
    f"""WITH c AS (SELECT c_name AS image, c_custkey % 5 <> 0 AS own, c_custkey, (1000 + c_custkey % 100)::DOUBLE AS nx, (900 + c_custkey % 50)::DOUBLE AS ny,
      (c_custkey % 350)::DOUBLE AS a0, (c_custkey % 80)::DOUBLE AS d0 FROM customer)
    SELECT image, CASE WHEN {_POLARISED} THEN 'V' ELSE 'I' END AS polarisation, 0.0::DOUBLE AS duration,
      {rnd(_own("2458849.5::DOUBLE + c_custkey % 9 + (3 * 3600 + 4 * 60 + 5.25::DOUBLE) / 86400"), 6)} AS jd,
      {rnd("CASE WHEN own THEN 0.003::DOUBLE + (c_custkey % 4) * 0.001::DOUBLE ELSE 0 END")} AS beam_bmaj, {rnd(_own(_RA), 7)} AS ra, {rnd(_own(_DEC), 7)} AS dec,
      {rnd(_own("sqrt(nx * nx + ny * ny) / 2 * 0.0007::DOUBLE"))} AS fov_bmin, {rnd(_own("ny * 0.0007::DOUBLE"))} AS physical_bmaj,
      {rnd(_own("sqrt(nx * nx + ny * ny) / 2"))} AS radius_pixels,
      CASE c_custkey % 3 WHEN 0 THEN 887500000::DOUBLE WHEN 1 THEN 943500000 ELSE 1367500000 END AS freq_eff,
      CASE c_custkey % 3 WHEN 0 THEN 288000000::DOUBLE WHEN 1 THEN 0 ELSE 144000000 END AS freq_bw FROM c""",
)
def image_attributes(spark, sf_dir):
    out = images.image_attributes(header_cards(spark, sf_dir))
    r = lambda c, d=6: (F.floor(F.col(c) * 10.0**d + 0.5).cast("double") / 10.0**d).alias(c)
    return out.select(
        "image", "polarisation", "duration", r("jd"), r("beam_bmaj"), r("ra", 7), r("dec", 7), r("fov_bmin"), r("physical_bmaj"),
        r("radius_pixels"), "freq_eff", "freq_bw",
    )


@query(
    "header_problems",
    "SELECT c_name AS image, 'BPA' AS missing FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0",
)
def header_problems(spark, sf_dir):
    cards = header_cards(spark, sf_dir, "c_custkey").filter("NOT (keyword = 'BPA' AND c_custkey % 7 = 0)")
    return images.header_problems(cards)


@query(
    "frequency_bands",
    """WITH RECURSIVE f AS (SELECT row_number() OVER (ORDER BY s) AS i, f FROM
        (SELECT CAST(floor(p_retailprice) AS BIGINT) AS f, min(p_partkey) AS s FROM part GROUP BY 1)),
      fold AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS DOUBLE[]) AS bands
        UNION ALL SELECT f.i, CASE WHEN len(list_filter(bands, lambda b: abs(f.f - b) / b < 0.02::DOUBLE)) > 0 THEN bands ELSE list_append(bands, f.f::DOUBLE) END
        FROM fold JOIN f ON f.i = fold.i + 1),
      done AS (SELECT bands FROM fold ORDER BY i DESC LIMIT 1)
    SELECT f AS frequency, list_filter(bands, lambda b: abs(f - b) / b < 0.02::DOUBLE)[1] AS band_frequency FROM f, done""",
)
def frequency_bands(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.floor("p_retailprice").alias("frequency"), F.col("p_partkey").alias("first_seen"))
    return images.assign_bands(p)[0]


@query(
    "sky_regions",
    f"""WITH w AS (SELECT DISTINCT (c_nationkey * 137.508::DOUBLE) % 360.0::DOUBLE AS centre_ra, -80.0::DOUBLE + (c_nationkey * 61.803::DOUBLE) % 160.0::DOUBLE AS centre_dec,
       5.0::DOUBLE + length(c_mktsegment) AS xtr_radius FROM customer),
     old AS (SELECT CAST(n_nationkey AS BIGINT) AS id, (n_nationkey * 137.508::DOUBLE) % 360.0::DOUBLE AS centre_ra,
       -80.0::DOUBLE + (n_nationkey * 61.803::DOUBLE) % 160.0::DOUBLE AS centre_dec, 13.0::DOUBLE AS xtr_radius FROM nation),
     fresh AS (SELECT w.* FROM w ANTI JOIN old USING (centre_ra, centre_dec, xtr_radius)),
     a AS (SELECT id, centre_ra, centre_dec, xtr_radius FROM old UNION ALL
       SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY centre_ra, centre_dec, xtr_radius), centre_ra, centre_dec, xtr_radius FROM fresh)
    SELECT CAST(id AS BIGINT) AS id, {rnds("centre_ra", "centre_dec", "xtr_radius")}, {rnd("cos(radians(centre_dec)) * cos(radians(centre_ra))")} AS x,
      {rnd("sin(radians(centre_dec))")} AS z FROM a""",
)
def sky_regions(spark, sf_dir):
    k = F.col("n_nationkey").cast("long")
    x, y, z = images.unit_vector("centre_ra", "centre_dec")
    old = table(spark, sf_dir, "nation").select(
        k.alias("id"), key_ra(k).alias("centre_ra"), key_dec(k).alias("centre_dec"), F.lit(1.0).alias("width_ra"), F.lit(1.0).alias("width_dec"), F.lit(13.0).alias("xtr_radius")
    )
    old = old.withColumns({"x": x, "y": y, "z": z})
    n = F.col("c_nationkey").cast("long")
    new = table(spark, sf_dir, "customer").select(
        key_ra(n).alias("ra"), key_dec(n).alias("dec"), (5.0 + F.length("c_mktsegment")).alias("fov_bmin"), F.lit(1.0).alias("physical_bmin"), F.lit(1.0).alias("physical_bmaj")
    )
    return rounded(images.get_or_create_regions(new, old).select("id", "centre_ra", "centre_dec", "xtr_radius", "x", "z"))


@query(
    "unseen_images",
    "SELECT c_name AS name, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def unseen_images(spark, sf_dir):
    new = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), "c_custkey")
    old = table(spark, sf_dir, "supplier").select(F.format_string("Customer#%09d", "s_suppkey").alias("name"))
    return images.unseen_images(new, old)


@query(
    "filled_backgrounds",
    """SELECT printf('Customer#%09d', s_suppkey) AS name, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE c_mktsegment END AS background_path
    FROM supplier LEFT JOIN customer ON s_suppkey = c_custkey""",
)
def filled_backgrounds(spark, sf_dir):
    old = table(spark, sf_dir, "supplier").select(
        F.format_string("Customer#%09d", "s_suppkey").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("background_path")
    )
    new = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("background_path"))
    return images.fill_backgrounds(old, new)


@query(
    "noise_statistics",
    f"""SELECT l_suppkey AS image_id, {rnd("median(l_extendedprice * l_discount) * 1000", 3)} AS rms_median,
    {rnd("min(l_extendedprice * l_discount) * 1000", 3)} AS rms_min, {rnd("max(l_extendedprice * l_discount) * 1000", 3)} AS rms_max
    FROM lineitem WHERE l_extendedprice * l_discount > 0 GROUP BY l_suppkey""",
)
def noise_statistics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # Zero discounts stand for blank pixels.
    pixels = li.select(F.col("l_suppkey").alias("image_id"), (F.col("l_extendedprice") * F.col("l_discount")).alias("value"))
    return rounded(images.noise_statistics(pixels), 3)


_KIND_SQL = "CASE o_orderkey % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'catalogue' WHEN 2 THEN 'noise' ELSE 'background' END"
MANIFEST_SQL = f"""SELECT strftime(o_orderdate, '%Y-%m') AS epoch, {_KIND_SQL} AS kind, o_custkey // 4 AS pos,
   {_KIND_SQL} || CAST(o_orderkey // 4 - o_orderkey // 4 % 2 AS VARCHAR) AS path FROM orders"""


def manifest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("image", "catalogue", "noise", "background")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    number = F.floor(F.col("o_orderkey") / 4)
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("epoch"), kind.alias("kind"), F.floor(F.col("o_custkey") / 4).alias("pos"),
        F.concat(kind, (number - number % 2).cast("string")).alias("path"),
    )


@query(
    "paired_inputs",
    f"""WITH f AS ({MANIFEST_SQL}) SELECT epoch, pos, {", ".join(f"min(path) FILTER (kind = '{k}') AS {k}" for k in settings_tables.INPUT_KINDS)}
    FROM f GROUP BY epoch, pos""",
)
def paired_inputs(spark, sf_dir):
    return settings_tables.pair_inputs(manifest(spark, sf_dir))


_COUNTS = ", ".join(f"count(*) FILTER (kind = '{k}') AS {k}" for k in settings_tables.INPUT_KINDS)


@query(
    "manifest_problems",
    f"""WITH f AS ({MANIFEST_SQL}), c AS (SELECT epoch, {_COUNTS} FROM f GROUP BY epoch), t AS (SELECT {_COUNTS} FROM f)
    SELECT 'count_mismatch' AS problem, epoch || ':catalogue' AS detail FROM c WHERE catalogue <> image
    UNION ALL SELECT 'count_mismatch', epoch || ':noise' FROM c WHERE noise <> image
    UNION ALL SELECT 'count_mismatch', epoch || ':background' FROM c WHERE background <> image
    UNION ALL SELECT 'duplicate_path', kind || ':' || path FROM f GROUP BY kind, path HAVING count(*) > 1
    UNION ALL SELECT 'too_many_images', CAST(image AS VARCHAR) FROM t WHERE image > 200""",
)
def manifest_problems(spark, sf_dir):
    return settings_tables.manifest_problems(manifest(spark, sf_dir), monitor=True, max_images=200)


@query(
    "image_epochs",
    f"WITH im AS ({run_images_sql()}) SELECT name, row_number() OVER (ORDER BY datetime, id) AS epoch FROM im",
)
def image_epochs(spark, sf_dir):
    im = run_images(spark, sf_dir).drop("epoch")
    return settings_tables.label_epochs(im).select("name", "epoch")


@query(
    "settings_differences",
    """SELECT key, before, after FROM (SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS before FROM customer)
    FULL JOIN (SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 4 = 0 THEN 'BUILDING' ELSE p_type END AS after FROM part) USING (key)
    WHERE before IS DISTINCT FROM after""",
)
def settings_differences(spark, sf_dir):
    before = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value"))
    value = F.when(F.col("p_partkey") % 4 == 0, F.lit("BUILDING")).otherwise(F.col("p_type"))
    after = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), value.alias("value"))
    return settings_tables.settings_diff(before, after)
