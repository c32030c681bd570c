"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from lumitrace.functions import coords, display, fluxes, naming, sky
from lumitrace.operators import settings_tables
from lumitrace.registry.base import query, rnd, rounded, sep_sql
from lumitrace.sources.driver_tables import key_dec, key_ra, measurements, measurements_sql, sky_rows, sky_rows_sql, table

C = f"WITH c AS ({sky_rows_sql('customer', 'c_custkey')})"
M = f"WITH m AS ({measurements_sql()})"


@query(
    "unit_vectors",
    f"""{C} SELECT id, {rnd("cos(radians(dec)) * cos(radians(ra))", 9)} AS x, {rnd("cos(radians(dec)) * sin(radians(ra))", 9)} AS y,
    {rnd("sin(radians(dec))", 9)} AS z FROM c""",
)
def unit_vectors(spark, sf_dir):
    c = sky_rows(spark, sf_dir, "customer", "c_custkey")
    x, y, z = sky.unit_vector("ra", "dec")
    return rounded(c.select("id", x.alias("x"), y.alias("y"), z.alias("z")), 9)


@query(
    "sky_separations",
    f"""{C}, n AS ({sky_rows_sql("nation", "n_nationkey", "n")})
    SELECT id, {rnd(sep_sql("ra", "dec", "nra", "ndec"), 8)} AS sep_deg,
    {rnd('''acos(least(1.0::DOUBLE, greatest(-1.0::DOUBLE, sin(radians(dec)) * sin(radians(ndec))
        + cos(radians(dec)) * cos(radians(ndec)) * cos(radians(ra - nra)))))''', 8)} AS sep_rad
    FROM c JOIN n ON c_nationkey = n_nationkey""",
)
def sky_separations(spark, sf_dir):
    c = sky_rows(spark, sf_dir, "customer", "c_custkey")
    n = sky_rows(spark, sf_dir, "nation", "n_nationkey", "n")
    both = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return rounded(
        both.select(
            "id",
            sky.separation("ra", "dec", "nra", "ndec").alias("sep_deg"),
            sky.separation_arccos("ra", "dec", "nra", "ndec").alias("sep_rad"),
        ),
        8,
    )


@query(
    "angle_units",
    f"""{M} SELECT id, {rnd("ra * 3600", 4)} AS ra_arcsec, {rnd("ra * 60", 5)} AS ra_arcmin, {rnd("k / 3600::DOUBLE", 9)} AS k_deg,
    {rnd("k / 60::DOUBLE", 9)} AS k_arcmin_deg FROM m""",
)
def angle_units(spark, sf_dir):
    m = measurements(spark, sf_dir)
    r = display.round_to
    return m.select(
        "id",
        r(sky.from_degrees("ra", "arcsec"), 4).alias("ra_arcsec"),
        r(sky.from_degrees("ra", "arcmin"), 5).alias("ra_arcmin"),
        r(sky.to_degrees("k", "arcsec"), 9).alias("k_deg"),
        r(sky.to_degrees("k", "arcmin"), 9).alias("k_arcmin_deg"),
    )


_SHIFT = "((ra - bra + 180::DOUBLE) - 360 * floor((ra - bra + 180::DOUBLE) / 360) - 180)"


@query(
    "de_ruiter_radius",
    f"""{M}, b AS (SELECT *, (source * 137.508::DOUBLE) % 360.0::DOUBLE AS bra, -80.0::DOUBLE + (source * 61.803::DOUBLE) % 160.0::DOUBLE AS bdec FROM m)
    SELECT id, {rnd(f'''sqrt(pow(radians({_SHIFT}) * cos(radians((dec + bdec) / 2)), 2)
        / (pow(radians(uncertainty_ew), 2) + pow(radians(0.0002::DOUBLE), 2))
        + pow(radians(dec - bdec), 2) / (pow(radians(uncertainty_ns), 2) + pow(radians(0.0002::DOUBLE), 2)))''', 5)} AS dr FROM b""",
)
def de_ruiter_radius(spark, sf_dir):
    m = measurements(spark, sf_dir)
    b = m.withColumns({"bra": key_ra(F.col("source")), "bdec": key_dec(F.col("source"))})
    dr = sky.de_ruiter("ra", "dec", "uncertainty_ew", "uncertainty_ns", "bra", "bdec", 0.0002, 0.0002)
    return rounded(b.select("id", dr.alias("dr")), 5)


def _corner_sql(s: int, t: int) -> str:
    ra2, dec2 = f"(ra + {s} * e_ra)", f"(dec + {t} * e_dec)"
    return (
        f"acos(least(1.0::DOUBLE, sin(radians(dec)) * sin(radians({dec2})) + cos(radians(dec)) * cos(radians({dec2})) "
        f"* cos(radians(ra - {ra2}))))"
    )


@query(
    "error_radius",
    f"""{M}, e AS (SELECT *, 0.1::DOUBLE + k / 100.0::DOUBLE AS e_ra, 0.1::DOUBLE + k / 200.0::DOUBLE AS e_dec FROM m)
    SELECT id, {rnd(f'degrees(greatest({", ".join(_corner_sql(s, t) for s in (1, -1) for t in (1, -1))}))', 6)} AS error_radius FROM e""",
)
def error_radius(spark, sf_dir):
    m = measurements(spark, sf_dir)
    e = m.withColumns({"e_ra": 0.1 + F.col("k") / 100.0, "e_dec": 0.1 + F.col("k") / 200.0})
    return rounded(e.select("id", sky.error_radius("ra", "e_ra", "dec", "e_dec").alias("error_radius")), 6)


# Gaussian fit errors: sizes and a beam derived from k; every 20th value of k gives a zero size.
_SIZES = """SELECT *, (k % 20) * 1.5::DOUBLE AS bmaj, 10.0::DOUBLE + k % 7 AS bmin, k * 1.8::DOUBLE AS pa, 0.0035::DOUBLE AS bb, 0.003::DOUBLE AS sb FROM m"""


def _rho_sql(x: float, y: float) -> str:
    return f"sqrt(mj * mn / (4 * bb * sb) * pow(1 + pow(bb / mj, 2), {x}::DOUBLE) * pow(1 + pow(sb / mn, 2), {y}::DOUBLE) * snr * snr)"


CONDON_CTE = f"""s AS ({_SIZES}), g AS (SELECT *, nullif(bmaj, 0) / 3600 AS mj, bmin / 3600 AS mn, radians(pa) AS th FROM s),
 h AS (SELECT *, {_rho_sql(2.5, 0.5)} AS r1, {_rho_sql(0.5, 2.5)} AS r2, {_rho_sql(1.5, 1.5)} AS r3 FROM g),
 q AS (SELECT *, mj / (sqrt(4 * ln(2::DOUBLE)) * r1) AS p1, mn / (sqrt(4 * ln(2::DOUBLE)) * r2) AS p2, sqrt(2::DOUBLE) * mj / r1 AS e_maj,
       sqrt(2::DOUBLE) * mn / r2 AS e_min, sqrt(2 * flux_peak * flux_peak / (r3 * r3)) AS e_peak FROM h)"""

_CONDON = {
    "flux_peak_err": "e_peak",
    "flux_int_err": "abs(flux_int) * sqrt(e_peak * e_peak / (flux_peak * flux_peak) + bb * sb / (mj * mn) * (pow(e_maj / mj, 2) + pow(e_min / mn, 2)))",
    "err_bmaj": "e_maj",
    "err_bmin": "e_min",
    "err_pa": "CASE WHEN mj > mn THEN least(2 * mj * mn / nullif(mj * mj - mn * mn, 0) / r2, pi()) ELSE pi() END",
    "ra_err": "sqrt(pow(p1 * sin(th), 2) + pow(p2 * cos(th), 2))",
    "dec_err": "sqrt(pow(p1 * cos(th), 2) + pow(p2 * sin(th), 2))",
}


@query(
    "condon_errors",
    f"""{M}, {CONDON_CTE} SELECT id, {", ".join(f"{rnd(f'CASE WHEN mj IS NULL THEN 0 ELSE {e} END')} AS {n}" for n, e in _CONDON.items())} FROM q""",
)
def condon_errors(spark, sf_dir):
    m = measurements(spark, sf_dir)
    k = F.col("k")
    s = m.withColumns({"bmaj": (k % 20) * 1.5, "bmin": 10.0 + k % 7, "pa": k * 1.8, "beam_bmaj": F.lit(0.0035), "beam_bmin": F.lit(0.003)})
    return rounded(fluxes.with_condon_errors(s).select("id", *_CONDON))


def _sexa_sql(value: str, precision: int, truncate: bool, marks: tuple[str, str, str]) -> str:
    unit = 10 ** (8 - precision)
    fine = f"CAST(floor(({value}) * 360000000000::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
    kept = f"({fine} // {unit})" if truncate else f"(({fine} + {unit // 2}) // {unit})"
    whole = f"({kept} // {10**precision})"
    frac = f" || '.' || lpad(CAST({kept} % {10**precision} AS VARCHAR), {precision}, '0')" if precision else ""
    a, b, c = marks
    return (
        f"printf('%02d', {whole} // 3600) || '{a}' || printf('%02d', ({whole} // 60) % 60) || '{b}' || "
        f"printf('%02d', {whole} % 60){frac} || '{c}'"
    )


def _dms_sql(deg: str, precision: int, truncate: bool, marks=(":", ":", "")) -> str:
    return f"(CASE WHEN {deg} < 0 THEN '-' ELSE '+' END || {_sexa_sql(f'abs({deg})', precision, truncate, marks)})"


def _hms_sql(deg: str, precision: int, truncate: bool, marks=(":", ":", "")) -> str:
    return _sexa_sql(f"({deg}) / 15.0::DOUBLE", precision, truncate, marks)


@query(
    "sexagesimal_strings",
    f"""{C} SELECT id, {_hms_sql("ra", 2, False)} AS hms2, {_hms_sql("ra", 0, False)} AS hms0, {_hms_sql("ra", 1, True)} AS hms1_cut,
    {_hms_sql("ra", 2, False, ("h", "m", "s"))} AS hms_letters, {_dms_sql("dec", 2, False)} AS dms2, {_dms_sql("dec", 0, True)} AS dms0_cut,
    {_dms_sql("dec", 3, False, ("d", "m", "s"))} AS dms_letters FROM c""",
)
def sexagesimal_strings(spark, sf_dir):
    c = sky_rows(spark, sf_dir, "customer", "c_custkey")
    return c.select(
        "id",
        coords.degrees_to_hms("ra", 2).alias("hms2"),
        coords.degrees_to_hms("ra", 0).alias("hms0"),
        coords.degrees_to_hms("ra", 1, truncate=True).alias("hms1_cut"),
        coords.degrees_to_hms("ra", 2, letters=True).alias("hms_letters"),
        coords.degrees_to_dms("dec", 2).alias("dms2"),
        coords.degrees_to_dms("dec", 0, truncate=True).alias("dms0_cut"),
        coords.degrees_to_dms("dec", 3, letters=True).alias("dms_letters"),
    )


POSITION_NAME_SQL = f"'J' || replace({_hms_sql('ra', 1, True)} || {_dms_sql('dec', 0, True)}, ':', '')"


@query("position_names", f"{C} SELECT id, {POSITION_NAME_SQL} AS name FROM c")
def position_names(spark, sf_dir):
    return sky_rows(spark, sf_dir, "customer", "c_custkey").select("id", coords.position_name("ra", "dec").alias("name"))


def _rotated_sql(matrix) -> list[str]:
    xyz = ("cos(radians({b})) * cos(radians({a}))", "cos(radians({b})) * sin(radians({a}))", "sin(radians({b}))")
    return ["(" + " + ".join(f"{v!r}::DOUBLE * {c}" for v, c in zip(row, xyz)) + ")" for row in matrix]


def _rotation_sql(a: str, b: str, matrix) -> tuple[str, str]:
    u, v, w = (s.format(a=a, b=b) for s in _rotated_sql(matrix))
    lon = f"degrees(atan2({v}, {u}))"
    return f"({lon} - 360 * floor({lon} / 360))", f"degrees(asin(least(1.0::DOUBLE, greatest(-1.0::DOUBLE, {w}))))"


_L, _B = _rotation_sql("ra", "dec", sky.GALACTIC_ROTATION)


@query("galactic_positions", f"{C} SELECT id, {rnd(_L, 7)} AS l, {rnd(_B, 7)} AS b, {rnd('ra', 7)} AS ra_back, {rnd('dec', 7)} AS dec_back FROM c")
def galactic_positions(spark, sf_dir):
    c = sky_rows(spark, sf_dir, "customer", "c_custkey")
    lon, lat = sky.to_galactic("ra", "dec")
    c = c.withColumns({"l": lon, "b": lat})
    ra, dec = sky.from_galactic("l", "b")
    # The way there and back must return the position itself.
    ra = F.when(ra > 359.99999995, ra - 360.0).otherwise(ra)
    return rounded(c.select("id", "l", "b", (ra + 1e-9).alias("ra_back"), (dec + 1e-9).alias("dec_back")), 7)


_PARTS = "CAST(id % 24 AS BIGINT) AS h, CAST(id % 60 AS BIGINT) AS mi, CAST(id % 59 AS BIGINT) AS s, CAST(id % 80 AS BIGINT) AS d"


@query(
    "parsed_positions",
    f"""{C}, t AS (SELECT id, {_PARTS} FROM c) SELECT id,
    {rnd("(h + mi / 60::DOUBLE + (s + 0.25::DOUBLE) / 3600) * 15", 7)} AS ra, {rnd("-(d + mi / 60::DOUBLE + s / 3600::DOUBLE)", 7)} AS dec,
    {rnd("(h + mi / 60::DOUBLE + (s + 0.25::DOUBLE) / 3600) * 15", 7)} AS ra_marked, {rnd("h + 0.5::DOUBLE", 7)} AS lon_plain, {rnd("d", 7)} AS lat_plain,
    {rnd("h + mi / 60::DOUBLE + s / 3600::DOUBLE", 7)} AS lon_galactic, CAST(NULL AS DOUBLE) AS bad FROM t""",
)
def parsed_positions(spark, sf_dir):
    c = sky_rows(spark, sf_dir, "customer", "c_custkey")
    t = c.select("id", (F.col("id") % 24).alias("h"), (F.col("id") % 60).alias("mi"), (F.col("id") % 59).alias("s"), (F.col("id") % 80).alias("d"))
    bare = F.format_string("%d:%d:%d.25 -%d:%d:%d", "h", "mi", "s", "d", "mi", "s")
    marked = F.format_string("%dh%dm%d.25s -%dd%dm%ds", "h", "mi", "s", "d", "mi", "s")
    plain = F.format_string("%d.5 %d", "h", "d")
    galactic = F.format_string("%d:%d:%d +%d:%d:%d", "h", "mi", "s", "d", "mi", "s")
    ra, dec = coords.parse_position(bare)
    ra_marked, _ = coords.parse_position(marked)
    lon, lat = coords.parse_position(plain)
    lon_g, _ = coords.parse_position(galactic, "galactic")
    bad, _ = coords.parse_position(F.lit("not a position"))
    return rounded(
        t.select(
            "id", ra.alias("ra"), dec.alias("dec"), ra_marked.alias("ra_marked"), lon.alias("lon_plain"),
            lat.alias("lat_plain"), lon_g.alias("lon_galactic"), bad.alias("bad"),
        ),
        7,
    )


@query(
    "path_angles",
    f"""{C}, t AS (SELECT id, {_PARTS} FROM c) SELECT id, {rnd("(h + mi / 60::DOUBLE + s / 3600::DOUBLE) * 15", 7)} AS ra_sexagesimal,
    {rnd("h + 0.25::DOUBLE", 7)} AS ra_decimal, {rnd("-(d + mi / 60::DOUBLE + s / 3600::DOUBLE)", 7)} AS dec, {rnd("mi / 3600::DOUBLE", 9)} AS arcsec,
    {rnd("mi / 60::DOUBLE", 9)} AS arcmin, {rnd("mi", 9)} AS deg FROM t""",
)
def path_angles(spark, sf_dir):
    c = sky_rows(spark, sf_dir, "customer", "c_custkey")
    t = c.select("id", (F.col("id") % 24).alias("h"), (F.col("id") % 60).alias("mi"), (F.col("id") % 59).alias("s"), (F.col("id") % 80).alias("d"))
    r = display.round_to
    return t.select(
        "id",
        r(coords.path_right_ascension(F.format_string("%d:%d:%d", "h", "mi", "s")), 7).alias("ra_sexagesimal"),
        r(coords.path_right_ascension(F.format_string("%d.25", "h")), 7).alias("ra_decimal"),
        r(coords.path_declination(F.format_string("-%d:%d:%d", "d", "mi", "s")), 7).alias("dec"),
        r(coords.path_angle(F.format_string("%darcsec", "mi")), 9).alias("arcsec"),
        r(coords.path_angle(F.format_string("%d arcmin", "mi")), 9).alias("arcmin"),
        r(coords.path_angle(F.format_string("%ddeg", "mi")), 9).alias("deg"),
    )


@query(
    "two_epoch_metrics",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, {rnd("(l_extendedprice - l_quantity * 1000) / sqrt(pow(l_quantity + 1, 2) + pow(l_tax + 1, 2))")} AS vs,
    {rnd("2 * (l_extendedprice - l_quantity * 1000) / nullif(l_extendedprice + l_quantity * 1000, 0)")} AS m FROM lineitem""",
)
def two_epoch_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    other = F.col("l_quantity") * 1000
    vs = fluxes.vs_metric("l_extendedprice", other, F.col("l_quantity") + 1, F.col("l_tax") + 1)
    m = fluxes.m_metric("l_extendedprice", other)
    r = display.round_to
    return li.select("l_orderkey", F.col("l_linenumber"), "l_extendedprice", r(vs, 6).alias("vs"), r(m, 6).alias("m"))


@query("julian_dates", f"SELECT event_id, {rnd('epoch_us(ts) / 86400000000.0::DOUBLE + 2440587.5::DOUBLE', 7)} AS jd FROM events")
def julian_dates(spark, sf_dir):
    return rounded(table(spark, sf_dir, "events").select("event_id", sky.julian_date("ts").alias("jd")), 7)


def _tangent_sql() -> str:
    cosc = "(sin(radians(dec0)) * sin(radians(dec)) + cos(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0)))"
    f = f"(CASE WHEN id % 2 = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / {cosc} END)"
    x = f"degrees(cos(radians(dec)) * sin(radians(ra - ra0)) * {f})"
    y = f"degrees((cos(radians(dec0)) * sin(radians(dec)) - sin(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0))) * {f})"
    return (
        f"CAST(floor({y} / 0.0007::DOUBLE + 512.5::DOUBLE - 1 + 0.5::DOUBLE) AS BIGINT) AS i, "
        f"CAST(floor({x} / (-0.0007::DOUBLE) + 512.5::DOUBLE - 1 + 0.5::DOUBLE) AS BIGINT) AS j"
    )


@query(
    "sky_to_pixel",
    f"""{M}, w AS (SELECT id, ra, dec, (source * 137.508::DOUBLE) % 360.0::DOUBLE AS ra0, -80.0::DOUBLE + (source * 61.803::DOUBLE) % 160.0::DOUBLE AS dec0 FROM m)
    SELECT id, {_tangent_sql()} FROM w""",
)
def sky_to_pixel(spark, sf_dir):
    m = measurements(spark, sf_dir).withColumns({"ra0": key_ra(F.col("source")), "dec0": key_dec(F.col("source"))})
    projection = F.when(F.col("id") % 2 == 0, F.lit("SIN")).otherwise(F.lit("TAN"))
    i, j = sky.tangent_pixel("ra", "dec", projection, "ra0", "dec0", 512.5, 512.5, -0.0007, 0.0007)
    return m.select("id", i.alias("i"), j.alias("j"))


@query(
    "beam_pixels",
    "SELECT p_partkey, CAST(round_even(round_even(1.5::DOUBLE * (p_size / 3600::DOUBLE) / (2.5::DOUBLE / 3600), 0) * 1.2::DOUBLE, 0) AS BIGINT) AS npix FROM part",
)
def beam_pixels(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", sky.beam_pixels(F.col("p_size") / 3600.0, 2.5 / 3600.0, 3.0, 1.2).alias("npix"))


@query(
    "island_names",
    f"""{M} SELECT id, CAST(split_part(island_id, '_', 3) AS BIGINT) AS number, regexp_extract(island_id, '^(.*)_[^_]*$', 1) || '_' AS prefix,
    replace(island_id, 'island', 'component') || 'a' AS component, replace(island_id, 'island', 'component') || 'a_f_run007' AS forced_name,
    'IMG' || lpad(CAST(image_id AS VARCHAR), 5, '0') || '_' || island_id AS name FROM m""",
)
def island_names(spark, sf_dir):
    m = measurements(spark, sf_dir)
    component = naming.component_of_island("island_id")
    image = F.format_string("field.i.IMG%05d.cont.taylor.0", "image_id")
    return m.select(
        "id",
        naming.island_number("island_id").alias("number"),
        naming.island_prefix("island_id").alias("prefix"),
        component.alias("component"),
        naming.forced_name(component, 7).alias("forced_name"),
        naming.measurement_name(image, F.col("island_id")).alias("name"),
    )


@query(
    "display_values",
    f"""{M} SELECT id, {rnd("ra", 4)} AS ra, {rnd("dec", 4)} AS dec, {rnd("uncertainty_ew * 3600", 4)} AS uncertainty_ew, {rnd("flux_int", 3)} AS flux_int,
    {rnd("flux_peak", 3)} AS flux_peak, {rnd("snr", 2)} AS snr, {rnd("compactness", 3)} AS compactness, {rnd("flux_int_isl_ratio", 2)} AS flux_int_isl_ratio FROM m""",
)
def display_values(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return display.for_display(m.select("id", "ra", "dec", "uncertainty_ew", "flux_int", "flux_peak", "snr", "compactness", "flux_int_isl_ratio"))


@query(
    "basic_math",
    f"{M} SELECT id, {rnd('log10(flux_peak)', 8)} AS log_flux, {rnd('sqrt(flux_peak_err * flux_peak_err + 0.01 * flux_int * flux_int)', 8)} AS joint FROM m",
)
def basic_math(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return rounded(m.select("id", F.log10("flux_peak").alias("log_flux"), fluxes.joint_error("flux_peak_err", 0.1, "flux_int").alias("joint")), 8)


_A, _Bq = "[k % 5, k % 3, source % 5]", "[source % 3, k % 4]"


@query(
    "list_functions",
    f"""{M} SELECT id, CAST(len(list_distinct({_A} || {_Bq})) AS BIGINT) AS n_union,
    array_to_string(list_sort(list_filter(list_distinct({_A}), lambda x: NOT list_contains({_Bq}, x))), ',') AS difference,
    list_contains({_A}, k % 4) AS member FROM m""",
)
def list_functions(spark, sf_dir):
    m = measurements(spark, sf_dir)
    a = F.array(F.col("k") % 5, F.col("k") % 3, F.col("source") % 5)
    b = F.array(F.col("source") % 3, F.col("k") % 4)
    return m.select(
        "id",
        F.size(F.array_distinct(F.concat(a, b))).cast("long").alias("n_union"),
        F.concat_ws(",", F.transform(F.array_sort(F.array_except(a, b)), lambda x: x.cast("string"))).alias("difference"),
        F.array_contains(a, F.col("k") % 4).alias("member"),
    )


_NARROW = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "narrow_types",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN min({c}) >= -128 AND max({c}) < 128 THEN 'tinyint' WHEN min({c}) >= -32768 AND max({c}) < 32768 THEN 'smallint' "
        f"WHEN min({c}) >= -2147483648 AND max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END AS narrow_type, CAST(sum({c}) AS BIGINT) AS total FROM lineitem"
        for c in _NARROW
    ),
)
def narrow_types(spark, sf_dir):
    narrow = display.narrow_ints(table(spark, sf_dir, "lineitem").select(*_NARROW))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    totals = narrow.agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in _NARROW])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("narrow_type"), F.col(c).alias("total")) for c in _NARROW])
    return totals.select(F.inline(rows))


@query(
    "merged_settings",
    """SELECT CAST(p_partkey AS VARCHAR) AS key, coalesce(c_mktsegment, p_brand) AS value, c_custkey IS NOT NULL AS given
    FROM part LEFT JOIN customer ON p_partkey = c_custkey""",
)
def merged_settings(spark, sf_dir):
    defaults = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_brand").alias("value"))
    given = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value"))
    return settings_tables.merge_settings(defaults, given)


@query(
    "selection_lists",
    "SELECT c_custkey, replace(c_name, 'Customer#', '') AS name FROM customer UNION ALL SELECT c_custkey, c_mktsegment AS name FROM customer",
)
def selection_lists(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    text = F.concat(F.lit(" "), "c_name", F.lit(" , "), "c_mktsegment")
    return c.select("c_custkey", F.explode(naming.selection_names(text, "Customer#")).alias("name"))
