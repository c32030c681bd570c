"""Pair metrics against all pairs, with fluxes of both signs."""

import itertools
import math
import random

import numpy as np
import pytest
from helpers import frame
from pyspark.sql import functions as F

from lumitrace.operators import pairs


def rows(seed=4):
    rng = random.Random(seed)
    out = []
    for source in range(12):
        for i in range(rng.randint(1, 25)):
            base = 10.0 + 5 * source
            flux = rng.gauss(base, 4) if source % 3 else rng.gauss(0, 6)
            err = 1.0 if source == 4 else rng.choice([0.5, 1.0, rng.uniform(0.3, 2)])
            out.append((100 * source + i, source, rng.randint(1, 9), 10 * source + i % 4, flux, err, flux * rng.uniform(0.9, 1.4), err))
    return out


SCHEMA = "id long, source long, datetime long, image_id long, flux_peak double, flux_peak_err double, flux_int double, flux_int_err double"


def expected(data, kind, limit):
    f, e = (4, 5) if kind == "peak" else (6, 7)
    best, found = {}, {}
    for a, b in itertools.combinations(sorted(data, key=lambda r: (r[2], r[0])), 2):
        if a[1] != b[1]:
            continue
        vs = (a[f] - b[f]) / math.hypot(a[e], b[e])
        m = 2 * (a[f] - b[f]) / (a[f] + b[f])
        if abs(vs) >= limit:
            found[(a[0], b[0])] = (vs, m)
            best[a[1]] = min(best.get(a[1], (1, 0, 0, 0)), (-abs(m), a[0], b[0], abs(vs)))
    return found, best


@pytest.mark.parametrize("salt,leaf", [(20_000, 4096), (3, 2)])
def test_pairs(spark, monkeypatch, salt, leaf):
    monkeypatch.setattr(pairs, "ROWS_PER_SALT", salt)
    monkeypatch.setattr(pairs, "LEAF", leaf)
    data = rows()
    df = frame(spark, data, SCHEMA)
    peak, best_peak = expected(data, "peak", 2.5)
    integrated, best_int = expected(data, "int", 2.5)
    got = {(r["meas_id_a"], r["meas_id_b"]): r for r in pairs.significant_pairs(df, 2.5).collect()}
    assert set(got) == set(peak) | set(integrated)
    for key, (vs, m) in peak.items():
        assert (got[key]["vs_peak"], got[key]["m_peak"]) == pytest.approx((vs, m))
    for kind, best in (("peak", best_peak), ("int", best_int)):
        one = {r["source"]: (r[1], r[2]) for r in pairs.most_significant_pair(df, kind, 2.5).collect()}
        assert set(one) == set(best)
        for source, (neg_m, _, _, vs) in best.items():
            assert one[source] == pytest.approx((vs, -neg_m))


def long_source(n, shape, seed=9):
    """(flux, err) of one source that keeps simple bounds busy."""
    rng = np.random.default_rng(seed)
    if shape == "both signs":
        return rng.normal(0, 5, n), rng.uniform(0.3, 3, n)
    if shape == "errors grow with flux":
        flux = rng.uniform(1, 100, n)
        return flux, 0.1 * flux * rng.uniform(0.9, 1.1, n)
    if shape == "all negative":
        flux = -rng.lognormal(2, 1, n)
        return flux, 0.2 * np.abs(flux) + 0.1
    # Faint ends of both signs that are not significant among themselves, few bright ones.
    flux = rng.normal(0, 1, n)
    flux[:: n // 20] *= 40
    return flux, np.ones(n)


@pytest.mark.parametrize("shape", ["both signs", "errors grow with flux", "all negative", "faint"])
def test_pairs_formed_in_long_sources_grow_about_linearly(spark, monkeypatch, shape):
    monkeypatch.setattr(pairs, "LEAF", 256)
    formed, real = [], pairs._candidate_cells

    def counting(rows, limit):
        out = real(rows, limit)
        formed.append(sum(cells.agg(F.sum(F.col("h_n") * F.col("l_n"))).first()[0] or 0 for _, cells in out))
        return out

    monkeypatch.setattr(pairs, "_candidate_cells", counting)
    for n in (1000, 4000):
        flux, err = long_source(n, shape)
        data = [(i, 7, i, 1, float(f), float(e)) for i, (f, e) in enumerate(zip(flux, err))]
        df = frame(spark, data, "id long, source long, datetime long, image_id long, flux_peak double, flux_peak_err double")
        got = pairs.most_significant_pair(df, "peak", 4.3).collect()
        with np.errstate(divide="ignore", invalid="ignore"):
            vs = np.abs(flux[:, None] - flux) / np.hypot(err[:, None], err)
            m = np.where(vs >= 4.3, np.abs(2 * (flux[:, None] - flux) / (flux[:, None] + flux)), -1.0)
        at = np.unravel_index(m.argmax(), m.shape)
        assert [(r[1], r[2]) for r in got] == [(pytest.approx(vs[at]), pytest.approx(m[at]))]
    # Of some 500 thousand and 8 million pairs.
    assert max(formed, default=0) <= 40_000


def test_ends_with_flux_zero_and_equal_rows(spark):
    flux = [0.0, 0.0, -8.0, 8.0, 20.0, 20.0, 20.0, -3.0]
    data = [(i, 1, 10 - i, 1, f, 1.0, f, 1.0) for i, f in enumerate(flux)] + [(20 + i, 2, i, 1, f, 1.0, f, 1.0) for i, f in enumerate([0.0, 9.0, 12.0, 0.0])]
    got = {r["source"]: (r[1], r[2]) for r in pairs.most_significant_pair(frame(spark, data, SCHEMA), "peak", 4.3).collect()}
    # All pairs with a flux of 0 have |m| = 2: the first two ids win.
    assert got[2] == pytest.approx((9 / 2**0.5, 2.0))
    # 8 and -8 have no m; of the others 20 and -8 have the largest.
    assert got[1] == pytest.approx((28 / 2**0.5, 56 / 12))


def test_a_positive_threshold_is_needed(spark):
    with pytest.raises(ValueError):
        pairs.significant_pairs(frame(spark, rows(), SCHEMA), 0.0)


@pytest.mark.parametrize("sign", [1, -1])
def test_fluxes_a_rounding_apart_tie(spark, sign):
    """Fluxes that differ in their last bit give one |m|; then ids decide, not the error."""
    bright, faint = 44.0, 3.0
    above = math.nextafter(bright, math.inf)
    assert 2 * (bright - faint) / (bright + faint) == 2 * (above - faint) / (above + faint)
    flux, err = [bright, above, faint], [2.0, 0.5, 1.0]
    data = [(i, 1, i, 1, sign * f, e, sign * f, e) for i, (f, e) in enumerate(zip(flux, err))]
    got = pairs.pair_aggregates(frame(spark, data, SCHEMA), 4.3).collect()
    assert [tuple(r) for r in got] == [(1, *[pytest.approx(41 / 5**0.5), pytest.approx(82 / 47)] * 2)]


def test_a_row_travels_once_to_each_side(spark):
    # By peak and by integrated flux the ends lie the other way round in source 1; in 2 the integrated flux alone tells them apart.
    data = [(1, 1, 1, 1, 50.0, 1.0, 10.0, 1.0), (2, 1, 2, 2, 10.0, 1.0, 50.0, 1.0), (3, 2, 1, 1, 10.5, 1.0, 10.0, 1.0), (4, 2, 2, 2, 10.0, 1.0, 50.0, 1.0)]
    found = pairs.significant_pairs(frame(spark, data, SCHEMA), 2.5)
    assert sorted((r["meas_id_a"], r["meas_id_b"]) for r in found.collect()) == [(1, 2), (3, 4)]

    def shuffles(plan):
        below = sum(shuffles(plan.children().apply(i)) for i in range(plan.children().size()))
        # Only shuffles that carry measurements, not counts per source, hold fluxes.
        return below + (plan.nodeName() == "Exchange" and "flux_peak_err" in plan.output().toString())

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pairs.significant_pairs(frame(spark, data, SCHEMA), 2.5)._jdf.queryExecution().executedPlan()
        assert shuffles(plan.initialPlan() if "Adaptive" in plan.nodeName() else plan) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
