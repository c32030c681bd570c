"""Source statistics, pair metrics, distribution fits."""

from pyspark.sql import functions as F

from lumitrace.operators import analysis, pairs, stats
from lumitrace.registry.base import lifted_sql, query, rnd, rnds, rounded
from lumitrace.sources.driver_tables import measurements, measurements_sql

M = f"WITH m AS ({measurements_sql()})"

_WAVG_RA = f"sum(weight_ew * {lifted_sql('ra')}) FILTER (NOT forced) / sum(weight_ew) FILTER (NOT forced)"


def eta_sql(kind: str) -> str:
    f, w = f"flux_{kind}", f"(1.0::DOUBLE / (flux_{kind}_err * flux_{kind}_err))"
    return (
        f"CASE WHEN count(*) = 1 THEN 0.0::DOUBLE ELSE count(*)::DOUBLE / (count(*) - 1) * "
        f"(avg({w} * {f} * {f}) - avg({w} * {f}) * avg({w} * {f}) / avg({w})) END"
    )


def v_sql(kind: str) -> str:
    return f"coalesce(stddev_samp(flux_{kind}) / avg(flux_{kind}), 0.0::DOUBLE)"


def _flux_sql(kind: str, r) -> str:
    f = f"flux_{kind}"
    return (
        f"{r(f'avg({f})')} AS avg_{f}, {r(f'max({f})')} AS max_{f}, {r(f'min({f})')} AS min_{f}, "
        f"{r(f'min({f}_isl_ratio)')} AS min_{f}_isl_ratio, {r(v_sql(kind))} AS v_{kind}, {r(eta_sql(kind))} AS eta_{kind}"
    )


def statistics_body(r=rnd) -> str:
    """Statistics per source of CTE m; `r` rounds an expression."""
    return f"""SELECT source, count(id) AS n_meas, CAST(sum(forced::INT) AS BIGINT) AS n_meas_forced,
  CAST(sum((NOT forced)::INT) AS BIGINT) AS n_meas_sel, CAST(sum(has_siblings::INT) AS BIGINT) AS n_sibl,
  {r(f"CASE WHEN {_WAVG_RA} >= 360 THEN {_WAVG_RA} - 360 ELSE {_WAVG_RA} END")} AS wavg_ra,
  {r("sum(weight_ns * dec) FILTER (NOT forced) / sum(weight_ns) FILTER (NOT forced)")} AS wavg_dec,
  {r("avg(compactness) FILTER (NOT forced)")} AS avg_compactness,
  {r("min(snr) FILTER (NOT forced)")} AS min_snr, {r("max(snr) FILTER (NOT forced)")} AS max_snr,
  {r("1 / sqrt(sum(weight_ew))")} AS wavg_uncertainty_ew, {r("1 / sqrt(sum(weight_ns))")} AS wavg_uncertainty_ns,
  {_flux_sql("int", r)}, {_flux_sql("peak", r)}
FROM m GROUP BY source"""


SOURCE_STATISTICS_SQL = f"{M} {statistics_body()}"


@query("source_statistics", SOURCE_STATISTICS_SQL)
def source_statistics(spark, sf_dir):
    return rounded(stats.source_statistics(measurements(spark, sf_dir)))


@query("eta_metric", f"{M} SELECT source, {rnd(eta_sql('peak'))} AS eta_peak, {rnd(eta_sql('int'))} AS eta_int FROM m GROUP BY source")
def eta_metric(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return rounded(m.groupBy("source").agg(stats.eta("peak").alias("eta_peak"), stats.eta("int").alias("eta_int")))


@query("modulation_metric", f"{M} SELECT source, {rnd(v_sql('peak'))} AS v_peak, {rnd(v_sql('int'))} AS v_int FROM m GROUP BY source")
def modulation_metric(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return rounded(m.groupBy("source").agg(stats.modulation("peak").alias("v_peak"), stats.modulation("int").alias("v_int")))


def _vs_sql(kind: str, a: str, b: str) -> str:
    f = f"flux_{kind}"
    return f"({a}.{f} - {b}.{f}) / sqrt({a}.{f}_err * {a}.{f}_err + {b}.{f}_err * {b}.{f}_err)"


def _m_sql(kind: str, a: str, b: str) -> str:
    f = f"flux_{kind}"
    return f"2 * ({a}.{f} - {b}.{f}) / ({a}.{f} + {b}.{f})"


PAIRS_CTE = f"""{M}, p AS (
  SELECT a.source, a.id AS meas_id_a, b.id AS meas_id_b, a.image_id AS image_id_a, b.image_id AS image_id_b,
    a.flux_peak AS flux_peak_a, a.flux_peak_err AS flux_peak_err_a, a.flux_int AS flux_int_a, a.flux_int_err AS flux_int_err_a,
    b.flux_peak AS flux_peak_b, b.flux_peak_err AS flux_peak_err_b, b.flux_int AS flux_int_b, b.flux_int_err AS flux_int_err_b,
    {_vs_sql("peak", "a", "b")} AS vs_peak, {_m_sql("peak", "a", "b")} AS m_peak,
    {_vs_sql("int", "a", "b")} AS vs_int, {_m_sql("int", "a", "b")} AS m_int
  FROM m a JOIN m b ON a.source = b.source AND (a.datetime < b.datetime OR (a.datetime = b.datetime AND a.id < b.id)))"""

_PAIR_COLS = [f"{f}_{s}" for s in "ab" for f in ("flux_peak", "flux_peak_err", "flux_int", "flux_int_err")]
_PAIR_COLS += ["vs_peak", "m_peak", "vs_int", "m_int"]


@query(
    "significant_pairs",
    f"""{PAIRS_CTE} SELECT source, meas_id_a, meas_id_b, image_id_a, image_id_b, {rnds(*_PAIR_COLS)}
    FROM p WHERE abs(vs_peak) >= 4.3::DOUBLE OR abs(vs_int) >= 4.3::DOUBLE""",
)
def significant_pairs(spark, sf_dir):
    return rounded(pairs.significant_pairs(measurements(spark, sf_dir)))


def _best_pair_sql(kind: str) -> str:
    return f"""SELECT source, abs(vs_{kind}) AS vs_abs_significant_max_{kind}, abs(m_{kind}) AS m_abs_significant_max_{kind}
      FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(m_{kind}) DESC, meas_id_a, meas_id_b) AS rn
            FROM p WHERE abs(vs_{kind}) >= 4.3::DOUBLE) WHERE rn = 1"""


_AGG_NAMES = [f"{m}_abs_significant_max_{k}" for k in ("peak", "int") for m in ("vs", "m")]


@query(
    "pair_aggregates",
    f"""{PAIRS_CTE} SELECT source, {", ".join(f"{rnd(f'coalesce({n}, 0)')} AS {n}" for n in _AGG_NAMES)}
    FROM ({_best_pair_sql("peak")}) FULL JOIN ({_best_pair_sql("int")}) USING (source)""",
)
def pair_aggregates(spark, sf_dir):
    return rounded(pairs.pair_aggregates(measurements(spark, sf_dir)))


@query(
    "candidate_edges",
    f"""{PAIRS_CTE} SELECT source, meas_id_a, meas_id_b, {rnds("vs_peak", "m_peak")} FROM p
    WHERE abs(vs_peak) >= 4.3::DOUBLE AND abs(m_peak) >= 0.26::DOUBLE""",
)
def candidate_edges(spark, sf_dir):
    found = pairs.candidate_edges(pairs.significant_pairs(measurements(spark, sf_dir)))
    return rounded(found.select("source", "meas_id_a", "meas_id_b", "vs_peak", "m_peak"))


@query(
    "average_position",
    f"""{M} SELECT source, {rnd(f"CASE WHEN {_WAVG_RA} >= 360 THEN {_WAVG_RA} - 360 ELSE {_WAVG_RA} END")} AS wavg_ra,
    {rnd("sum(weight_ns * dec) FILTER (NOT forced) / sum(weight_ns) FILTER (NOT forced)")} AS wavg_dec FROM m GROUP BY source""",
)
def average_position(spark, sf_dir):
    return rounded(stats.average_position(measurements(spark, sf_dir)))


@query(
    "seen_images",
    f"{M} SELECT source, image_id, min(epoch) AS epoch, min(datetime) AS datetime FROM m GROUP BY source, image_id",
)
def seen_images(spark, sf_dir):
    return stats.seen_images(measurements(spark, sf_dir))


@query(
    "robust_fit_one_round",
    f"""{M}, s AS ({statistics_body(lambda e: e)}), v AS (SELECT 'eta' AS metric, log10(eta_peak) AS value FROM s WHERE n_meas > 1 AND eta_int > 0 AND eta_peak > 0 AND v_int > 0 AND v_peak > 0
      UNION ALL SELECT 'v', log10(v_peak) FROM s WHERE n_meas > 1 AND eta_int > 0 AND eta_peak > 0 AND v_int > 0 AND v_peak > 0),
     a AS (SELECT v.*, abs(value - median(value) OVER (PARTITION BY metric)) AS dev FROM v),
     b AS (SELECT a.*, median(dev) OVER (PARTITION BY metric) AS mad FROM a)
    SELECT metric, {rnd("avg(value)", 7)} AS mean, {rnd("stddev_pop(value)", 7)} AS sigma FROM b WHERE dev <= 3 * 1.482602218505602::DOUBLE * mad GROUP BY metric""",
)
def robust_fit_one_round(spark, sf_dir):
    usable = analysis.variable_candidates(stats.source_statistics(measurements(spark, sf_dir)))
    return rounded(analysis.robust_fit(analysis.log_metrics(usable, "peak"), rounds=1), 7)


_USABLE_SQL = "SELECT * FROM s WHERE n_meas > 1 AND eta_int > 0 AND eta_peak > 0 AND v_int > 0 AND v_peak > 0"


def _long_sql(kind: str) -> str:
    return f"SELECT 'eta' AS metric, log10(eta_{kind}) AS value FROM u UNION ALL SELECT 'v', log10(v_{kind}) FROM u"


def _clipped_sql(first: str, rounds: int = analysis.CLIP_ROUNDS) -> str:
    """CTEs c1, c2, ... of the values left after each round of clipping CTE `first`."""
    out, before = [], first
    for i in range(1, rounds + 1):
        out.append(f"a{i} AS (SELECT metric, value, abs(value - median(value) OVER (PARTITION BY metric)) AS dev FROM {before})")
        out.append(f"b{i} AS (SELECT *, median(dev) OVER (PARTITION BY metric) AS mad FROM a{i})")
        out.append(f"c{i} AS (SELECT metric, value FROM b{i} WHERE dev <= {analysis.CLIP_SIGMA}::DOUBLE * {analysis.MAD_TO_STD}::DOUBLE * mad)")
        before = f"c{i}"
    return ", ".join(out)


_FITTED = f"c{analysis.CLIP_ROUNDS}"


@query(
    "metric_histogram",
    f"""{M}, s AS ({statistics_body(lambda e: e)}), u AS ({_USABLE_SQL}), v AS (SELECT 'peak' AS kind, * FROM ({_long_sql("peak")}) UNION ALL SELECT 'int', * FROM ({_long_sql("int")})),
     e AS (SELECT kind, metric, min(value) AS lo, (max(value) - min(value)) / 50 AS w, count(*) AS n FROM v GROUP BY kind, metric),
     b AS (SELECT kind, metric, least(CAST(floor((value - lo) / w) AS BIGINT), 49) AS bin, lo, w, n FROM v JOIN e USING (kind, metric))
    SELECT kind, metric, bin, {rnd("lo + bin * w", 6)} AS "left", {rnd("count(*) / (n * w)", 6)} AS density FROM b GROUP BY kind, metric, bin, lo, w, n""",
)
def metric_histogram(spark, sf_dir):
    usable = analysis.variable_candidates(stats.source_statistics(measurements(spark, sf_dir)))
    peak, whole = (rounded(analysis.histogram(analysis.log_metrics(usable, kind))).withColumn("kind", F.lit(kind)) for kind in ("peak", "int"))
    return peak.unionByName(whole)


@query(
    "eta_v_candidates",
    f"""{M}, s AS ({statistics_body(lambda e: e)}), u AS ({_USABLE_SQL}), l AS ({_long_sql("peak")}), {_clipped_sql("l")},
     f AS (SELECT metric, avg(value) AS mean, stddev_pop(value) AS sigma FROM {_FITTED} GROUP BY metric),
     c AS (SELECT max(pow(10, mean + sigma)) FILTER (metric = 'eta') AS ec, max(pow(10, mean + sigma)) FILTER (metric = 'v') AS vc FROM f)
    SELECT source, {rnds("eta_peak", "v_peak")}, {rnd("ec", 5)} AS eta_cutoff, {rnd("vc", 5)} AS v_cutoff, eta_peak >= ec AND v_peak >= vc AS candidate FROM u, c""",
)
def eta_v_candidates(spark, sf_dir):
    # The smallest tables hold fewer sources than an analysis asks for by default.
    out = analysis.eta_v_analysis(stats.source_statistics(measurements(spark, sf_dir)), 1.0, 1.0, min_sources=2)
    cut = lambda c: (F.floor(F.col(c) * 1e5 + 0.5) / 1e5).alias(c)
    return rounded(out.select("source", "eta_peak", "v_peak", cut("eta_cutoff"), cut("v_cutoff"), "candidate"))


@query(
    "robust_fit",
    f"""{M}, s AS ({statistics_body(lambda e: e)}), u AS ({_USABLE_SQL}), l AS ({_long_sql("int")}), {_clipped_sql("l")}
    SELECT metric, {rnd("avg(value)", 7)} AS mean, {rnd("stddev_pop(value)", 7)} AS sigma FROM {_FITTED} GROUP BY metric""",
)
def robust_fit(spark, sf_dir):
    usable = analysis.variable_candidates(stats.source_statistics(measurements(spark, sf_dir)))
    return rounded(analysis.robust_fit(analysis.log_metrics(usable, "int")), 7)


@query(
    "run_counters",
    f"""{M} SELECT (SELECT count(DISTINCT image_id) FROM m) AS n_images, (SELECT count(DISTINCT source) FROM m) AS n_sources,
    (SELECT count(*) FROM (SELECT source FROM m GROUP BY source HAVING max(flux_peak) > 80::DOUBLE)) AS n_new_sources,
    (SELECT count(DISTINCT id) FROM m WHERE NOT forced) AS n_selavy_measurements, (SELECT count(DISTINCT id) FROM m WHERE forced) AS n_forced_measurements""",
)
def run_counters(spark, sf_dir):
    m = measurements(spark, sf_dir)
    sources = m.groupBy("source").agg((F.max("flux_peak") > 80).alias("new"))
    return stats.run_counters(m.select("image_id").distinct(), sources, m)


EDGES_SQL = "SELECT source AS from_source_id, (source * 7 + k) % 120 AS to_source_id FROM m WHERE has_siblings"


def edges(m):
    return m.filter("has_siblings").select(F.col("source").alias("from_source_id"), ((F.col("source") * 7 + F.col("k")) % 120).alias("to_source_id"))


@query(
    "relation_counts",
    f"{M}, e AS ({EDGES_SQL}) SELECT from_source_id AS source, count(DISTINCT to_source_id) AS n_rel FROM e WHERE from_source_id <> to_source_id GROUP BY 1",
)
def relation_counts(spark, sf_dir):
    return stats.relation_counts(edges(measurements(spark, sf_dir)))


@query(
    "distinct_counts",
    f"{M} SELECT epoch, count(DISTINCT source) AS n_sources, count(DISTINCT image_id) AS n_images, count(*) AS n FROM m GROUP BY epoch",
)
def distinct_counts(spark, sf_dir):
    return measurements(spark, sf_dir).groupBy("epoch").agg(
        F.count_distinct("source").alias("n_sources"), F.count_distinct("image_id").alias("n_images"), F.count(F.lit(1)).alias("n")
    )
