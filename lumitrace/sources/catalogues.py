"""Component catalogues: whitespace text, CSV and VOTable files, many at a time.

Columns are taken by the header of each file, so files with other column
orders can be read together. Every reader returns one row per component with
`catalogue_path` and the columns of the measurement table, before cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumitrace.workspace import materialize

# Catalogue column -> (measurement column, type).
COMPONENT_COLUMNS = {
    "island_id": ("island_id", "string"),
    "component_id": ("component_id", "string"),
    "rms_image": ("local_rms", "double"),
    "ra_deg_cont": ("ra", "double"),
    "ra_err": ("ra_err", "double"),
    "dec_deg_cont": ("dec", "double"),
    "dec_err": ("dec_err", "double"),
    "flux_peak": ("flux_peak", "double"),
    "flux_peak_err": ("flux_peak_err", "double"),
    "flux_int": ("flux_int", "double"),
    "flux_int_err": ("flux_int_err", "double"),
    "maj_axis": ("bmaj", "double"),
    "maj_axis_err": ("err_bmaj", "double"),
    "min_axis": ("bmin", "double"),
    "min_axis_err": ("err_bmin", "double"),
    "pos_ang": ("pa", "double"),
    "pos_ang_err": ("err_pa", "double"),
    "maj_axis_deconv": ("psf_bmaj", "double"),
    "min_axis_deconv": ("psf_bmin", "double"),
    "pos_ang_deconv": ("psf_pa", "double"),
    "flag_c4": ("flag_c4", "boolean"),
    "chi_squared_fit": ("chi_squared_fit", "double"),
    "spectral_index": ("spectral_index", "double"),
    "spectral_index_from_TT": ("spectral_index_from_TT", "boolean"),
    "has_siblings": ("has_siblings", "boolean"),
}

# Names and scales of other surveys' catalogues.
SURVEYS = {
    "AEGEAN": {
        "ra": "ra", "err_ra": "er_ra", "dec": "dec", "err_dec": "err_dec", "pos_err_ang_scale": 1.0,
        "peak_flux": "peak_flux", "err_peak_flux": "err_peak_flux", "total_flux": "int_flux", "err_total_flux": "err_int_flux",
        "flux_scale": 1000.0, "bmaj": "a", "bmin": "b", "ang_scale": 3600.0, "pa": "pa", "freq": 999.0,
    },
    "MWACS": {
        "ra": "RAJ2000", "err_ra": "e_RAJ2000", "dec": "DEJ2000", "err_dec": "e_DEJ2000", "pos_err_ang_scale": 1.0,
        "peak_flux": "S180", "err_peak_flux": "e_S180", "total_flux": "S180", "err_total_flux": "e_S180",
        "flux_scale": 1000.0, "bmaj": "MajAxis", "bmin": "MinAxis", "ang_scale": 60.0, "pa": "PABeam", "freq": 180.0,
    },
    "GLEAM": {
        "ra": "RAJ2000", "err_ra": "err_RAJ2000", "dec": "DEJ2000", "err_dec": "err_DEJ2000", "pos_err_ang_scale": 1.0,
        "peak_flux": "peak_flux_wide", "err_peak_flux": "err_peak_flux_wide", "total_flux": "int_flux_wide", "err_total_flux": "err_int_flux_wide",
        "flux_scale": 1000.0, "bmaj": "a_wide", "bmin": "b_wide", "ang_scale": 1.0 / 3600, "pa": "pa_wide", "freq": 200.0,
    },
    "SUMSS": {
        "ra": "_RAJ2000", "err_ra": "e_RAJ2000", "dec": "_DEJ2000", "err_dec": "e_DEJ2000", "pos_err_ang_scale": 1.0 / 3600,
        "peak_flux": "Sp", "err_peak_flux": "e_Sp", "total_flux": "St", "err_total_flux": "e_St",
        "flux_scale": 1.0, "bmaj": "MajAxis", "bmin": "MinAxis", "ang_scale": 1.0 / 3600, "pa": "PA", "freq": 843.0,
    },
    "NVSS": {
        "ra": "_RAJ2000", "err_ra": "e_RAJ2000", "dec": "_DEJ2000", "err_dec": "e_DEJ2000", "pos_err_ang_scale": 1.0 / 3600,
        "peak_flux": "S1.4", "err_peak_flux": "e_S1.4", "total_flux": "S1.4", "err_total_flux": "e_S1.4",
        "flux_scale": 1.0, "bmaj": "MajAxis", "bmin": "MinAxis", "ang_scale": 1.0 / 3600, "pa": "PA", "freq": 1400.0,
    },
}

def _path() -> Column:
    return F.regexp_replace("_metadata.file_path", "^file:/+", "/")


def _canonical(name: Column) -> Column:
    """Header names, with the one all-lower-case spelling restored."""
    clean = F.trim(name)
    return F.when(F.lower(clean) == "spectral_index_from_tt", F.lit("spectral_index_from_TT")).otherwise(clean)


def _number(text: Column, name: str, kind: str) -> Column:
    """NULL for an empty or absent field; a field that cannot be read raises."""
    value = text.try_cast(kind)
    wrong = F.concat(F.lit("catalogue "), F.col("catalogue_path"), F.lit(f" has an unreadable {name}: "), text)
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(None)).when(value.isNull(), F.raise_error(wrong).cast(kind)).otherwise(value)


def _boolean(text: Column, name: str) -> Column:
    low = F.lower(text)
    return F.when(low.isin("true", "t"), True).when(low.isin("false", "f"), False).otherwise(_number(text, name, "double") != 0)


def _pick(rows: DataFrame, headers: DataFrame, among: bool = False) -> DataFrame:
    """Rows (catalogue_path, values) to typed columns by each file's header (catalogue_path, names), which may be `among` the rows."""
    required = F.array(*[F.lit(c) for c in COMPONENT_COLUMNS])
    headers = headers.select("catalogue_path", F.transform("names", _canonical).alias("names"))
    # Every file has to have a header, and every header all columns, before a row is read by one.
    known = rows.select("catalogue_path").distinct().join(headers, "catalogue_path", "full")
    absent = F.array_except(required, F.coalesce("names", F.array().cast("array<string>")))
    broken = known.select("catalogue_path", absent.alias("absent")).filter(F.size("absent") > 0).limit(1).collect()
    if broken:
        raise KeyError(f"catalogue {broken[0]['catalogue_path']} lacks columns {broken[0]['absent']}")
    # Names are looked up once a file, not once a row. All columns are known to be there by now.
    places = F.array(*[F.array_position("names", F.lit(name)).cast("int") - 1 for name in COMPONENT_COLUMNS])
    joined = rows.join(headers.select("catalogue_path", places.alias("places")), "catalogue_path")
    field = {name: F.get("values", F.get("places", F.lit(i))) for i, name in enumerate(COMPONENT_COLUMNS)}
    if among:
        joined = joined.filter(F.coalesce(_canonical(field["island_id"]) != "island_id", F.lit(True)))
    out = []
    for name, (target, kind) in COMPONENT_COLUMNS.items():
        text = F.trim(field[name])
        value = text if kind == "string" else _boolean(text, name) if kind == "boolean" else _number(text, name, kind)
        out.append(value.alias(target))
    return joined.select("catalogue_path", *out)


def _is_header(values: str) -> Column:
    """Names of columns among the values: one will do, so that a header that lacks some is seen and refused."""
    return F.exists(values, lambda v: F.coalesce(_canonical(v).isin(*COMPONENT_COLUMNS), F.lit(False)))


def _may_be_header(line: str) -> Column:
    """Whether a line holds the text of a column's name; quick, and true of every header."""
    names = {name.lower() for name in COMPONENT_COLUMNS}
    least = sorted(n for n in names if not any(other != n and other in n for other in names))
    low = F.lower(line)
    out = F.lit(False)
    for name in least:
        out = out | low.contains(name)
    return out


def read_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whitespace-separated catalogues: a `#` line with names, a `#` line with units, then rows."""
    lines = spark.read.text(paths).select(_path().alias("catalogue_path"), F.trim("value").alias("line")).filter("line <> ''")
    words = F.split(F.trim(F.regexp_replace("line", "^#", "")), r"\s+")
    lines = lines.select("catalogue_path", F.col("line").startswith("#").alias("marked"), words.alias("values"))
    headers = lines.filter("marked").filter(_is_header("values"))
    return _pick(lines.filter("NOT marked").drop("marked"), headers.select("catalogue_path", F.col("values").alias("names")))


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV catalogues with a header line each, of any width; short rows are filled with NULL."""
    text = spark.read.text(paths).select(_path().alias("catalogue_path"), "value")
    # No line has more fields than commas and one; quoted commas only make the bound larger.
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    width = text.agg(F.max(commas)).first()[0]
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range((width or 0) + 1)])

    def fields(c):
        return F.array(*[F.col(f"{c}{f.name}") for f in schema.fields])

    # Lines that may be headers are few; only their fields are held against the names, and all files are read once for them.
    parsed = text.filter(_may_be_header("value")).select("catalogue_path", F.from_csv("value", ", ".join(f"{f.name} string" for f in schema.fields)).alias("f"))
    found = parsed.select("catalogue_path", fields("f.").alias("values")).filter(_is_header("values"))
    # The header array may hold NULLs for unused places; empty names match nothing.
    headers = materialize(found.select("catalogue_path", F.transform("values", lambda v: F.coalesce(v, F.lit(""))).alias("names")), "headers")
    raw = spark.read.csv(paths, schema=schema, header=False, mode="PERMISSIVE")
    lines = raw.select(_path().alias("catalogue_path"), fields("").alias("values"))
    return _pick(lines, headers, among=True)


def read_votable(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """VOTable XML catalogues: FIELD elements give the order of the TD values of each TR."""
    paths = [paths] if isinstance(paths, str) else paths
    field = T.StructType([T.StructField("_name", T.StringType())])
    fields = spark.read.format("xml").options(rowTag="FIELD").schema(field).load(paths)
    # Field order inside a file is the order the reader meets them in: one file
    # is one task here, as row tags are found by scanning the file from its start.
    ordered = fields.select(_path().alias("catalogue_path"), F.struct(F.monotonically_increasing_id().alias("i"), F.col("_name").alias("n")).alias("f"))
    headers = ordered.groupBy("catalogue_path").agg(F.array_sort(F.collect_list("f")).alias("f"))
    cell = T.StructType([T.StructField("TD", T.ArrayType(T.StringType()))])
    rows = spark.read.format("xml").options(rowTag="TR").schema(cell).load(paths)
    rows = rows.select(_path().alias("catalogue_path"), F.col("TD").alias("values"))
    return _pick(rows, headers.select("catalogue_path", F.transform("f", lambda f: f["n"]).alias("names")))


def read_components(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Catalogues of any of the three formats, told apart by their endings; globs are allowed."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    readers = {read_votable: (".xml", ".vot"), read_csv: (".csv",)}
    frames = []
    for reader, endings in readers.items():
        mine = [p for p in paths if p.endswith(endings)]
        paths = [p for p in paths if p not in mine]
        if mine:
            frames.append(reader(spark, mine))
    if paths:
        frames.append(read_text(spark, paths))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def translate(df: DataFrame, survey: str) -> DataFrame:
    """Another survey's catalogue in common names: mJy fluxes, scaled axes and position errors."""
    t = SURVEYS[survey]
    col = lambda name: F.col(f"`{t[name]}`").cast("double")
    return df.select(
        col("ra").alias("ra"),
        (col("err_ra") * t["pos_err_ang_scale"]).alias("ra_err"),
        col("dec").alias("dec"),
        (col("err_dec") * t["pos_err_ang_scale"]).alias("dec_err"),
        (col("peak_flux") * t["flux_scale"]).alias("flux_peak"),
        (col("err_peak_flux") * t["flux_scale"]).alias("flux_peak_err"),
        (col("total_flux") * t["flux_scale"]).alias("flux_int"),
        (col("err_total_flux") * t["flux_scale"]).alias("flux_int_err"),
        (col("bmaj") * t["ang_scale"]).alias("bmaj"),
        (col("bmin") * t["ang_scale"]).alias("bmin"),
        col("pa").alias("pa"),
        F.lit(t["freq"]).alias("frequency"),
    )
