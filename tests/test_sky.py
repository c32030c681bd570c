"""Coordinate strings, and sky joins against brute force on the whole sphere."""

import math
import random

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from lumitrace.functions import coords, sky
from lumitrace.operators import cells, ranking, skyjoin

HMS = {
    "23:16:09.951": {(2, False): "23:16:09.95", (1, False): "23:16:10.0", (0, False): "23:16:10", (2, True): "23:16:09.95", (1, True): "23:16:09.9", (0, True): "23:16:09"},
    "02:01:59.999": {(2, False): "02:02:00.00", (1, False): "02:02:00.0", (0, False): "02:02:00", (2, True): "02:01:59.99", (1, True): "02:01:59.9", (0, True): "02:01:59"},
}
DMS = {
    "-22:57:28.8905": {(3, False): "-22:57:28.891", (2, False): "-22:57:28.89", (0, False): "-22:57:29", (3, True): "-22:57:28.890", (1, True): "-22:57:28.8", (0, True): "-22:57:28"},
    "75:32:28.9994": {(3, False): "+75:32:28.999", (2, False): "+75:32:29.00", (1, False): "+75:32:29.0", (3, True): "+75:32:28.999", (0, True): "+75:32:28"},
}


def test_sexagesimal_strings(spark):
    one = spark.range(1)
    checks, expected = [], []
    for text, cases in HMS.items():
        for (precision, truncate), out in cases.items():
            checks.append(coords.degrees_to_hms(coords.angle_to_degrees(F.lit(text), True), precision, truncate))
            expected.append(out)
    for text, cases in DMS.items():
        for (precision, truncate), out in cases.items():
            checks.append(coords.degrees_to_dms(coords.angle_to_degrees(F.lit(text), False), precision, truncate))
            expected.append(out)
    checks += [coords.degrees_to_hms(F.lit(349.0414537083333), 2, letters=True), coords.degrees_to_dms(F.lit(-22.958025), 2, letters=True)]
    expected += ["23h16m09.95s", "-22d57m28.89s"]
    checks.append(coords.position_name(F.lit(349.0414625), F.lit(-22.95802)))
    expected.append("J231609.9-225728")
    assert list(one.select(*[c.alias(f"c{i}") for i, c in enumerate(checks)]).first()) == expected


def test_positions_are_parsed(spark):
    texts = ["21h52m03.1s -62d08m19.7s", "18.4d +43.1d", "18.4 43.1", "21:52:03.1 -62:08:19.7", "10 20 30 -5 6 7", "10 95", "word -3", "10:61:00 +01:00:00", ""]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)], "i int, t string")
    ra, dec = coords.parse_position("t")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", ra, dec).collect()}
    right = {0: (328.0129166667, -62.1388055556), 1: (18.4, 43.1), 2: (18.4, 43.1), 3: (328.0129166667, -62.1388055556), 4: (10.3416666667, -5.1019444444)}
    for i, (a, d) in right.items():
        assert got[i] == pytest.approx((a, d), abs=1e-9)
    assert all(got[i] == (None, None) for i in range(5, len(texts)))


def test_galactic_pole_and_centre(spark):
    lon, lat = sky.to_galactic(F.lit(266.4049882865447), F.lit(-28.936177761791473))
    a, b = spark.range(1).select(lon, lat).first()
    assert min(a, 360 - a) < 1e-6 and abs(b) < 1e-6


def sep(p, q):
    a, b, c, d = (math.radians(v) for v in (*p, *q))
    h = math.sin((b - d) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((a - c) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(h))))


def points(seed, n):
    rng = random.Random(seed)
    out = [(0.0, 90.0), (0.0, -90.0), (359.9999, 0.0), (0.0001, 0.0), (123.0, 89.9999), (303.0, 89.9999)]
    out += [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(n)]
    # A clump of points within milli-arcsec, two of them at the same place.
    return out + [(50.0 + i * 1e-7, 20.0) for i in range(15)] + [(50.0, 20.0)]


def tables(spark, n=150):
    left = frame(spark, [(i, *p) for i, p in enumerate(points(1, n))], "id long, ra double, dec double")
    right = frame(spark, [(i, *p) for i, p in enumerate(points(2, n))], "id_2 long, ra_2 double, dec_2 double")
    return left, right


@pytest.mark.parametrize("radius,hot", [(5.0, True), (0.0, False), (100.0, False)])
def test_radius_join(spark, radius, hot, monkeypatch):
    monkeypatch.setattr(skyjoin, "ROWS_PER_SALT", 4)
    left, right = tables(spark, 60 if radius == 100.0 else 150)
    n = 60 if radius == 100.0 else 150
    got = rows_of(skyjoin.radius_join(left, right, radius, spread_hot=hot), "id", "id_2")
    expected = sorted((i, j) for i, p in enumerate(points(1, n)) for j, q in enumerate(points(2, n)) if sep(p, q) <= radius)
    assert got == expected


@pytest.mark.parametrize("radius", [5.0, 60.0])
def test_joins_dealt_by_pairs(spark, radius, monkeypatch):
    """Cubes are cut on both sides, and as many tasks share their pairs as these ask for."""
    for name, value in (("PAIRS_PER_TASK", 40), ("PAIRS_PER_PART", 6), ("COPIES_PER_PART", 3)):
        monkeypatch.setattr(skyjoin, name, value)
    left, right = tables(spark, 60)
    near = skyjoin.radius_join(left, right, radius, deal=True)
    assert rows_of(near, "id", "id_2") == sorted((i, j) for i, p in enumerate(points(1, 60)) for j, q in enumerate(points(2, 60)) if sep(p, q) <= radius)
    assert near.columns == ["id", "ra", "dec", "id_2", "ra_2", "dec_2", "sep"]
    filed = left.select("id", F.lit(1).alias("cube"))
    copied = right.select("id_2", F.lit(1).alias("cube"))
    filed, copied, tasks = skyjoin._dealt(filed, copied, ["cube"])
    assert tasks == -(-left.count() * right.count() // 40)
    parts = filed.join(copied, ["cube", "_along", "_across"]).groupBy("_along", "_across").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id_2").alias("copies"))
    assert parts.agg(F.sum("n")).first()[0] == left.count() * right.count() and parts.count() > 100


def test_rows_sent_to_crowded_cubes_grow_with_the_tables(spark, monkeypatch):
    """Not with their pairs; and copies of rows that lie in one file are made by many tasks."""
    for name, value in (("PAIRS_PER_PART", 1000), ("PARTS", 16), ("COPIES_PER_TASK", 100)):
        monkeypatch.setattr(skyjoin, name, value, raising=False)
    for n in (300, 900):
        filed = spark.range(n).select("id", F.lit(1).alias("cube"))
        copied = spark.range(0, n, 1, 1).select(F.col("id").alias("id_2"), F.lit(1).alias("cube"))
        filed, copied, _ = skyjoin._dealt(filed, copied, ["cube"])
        assert copied.count() <= 6 * n and filed.count() <= 6 * n
        assert copied.rdd.getNumPartitions() >= n // 100
        pairs = filed.join(copied, ["cube", "_along", "_across"]).groupBy("id", "id_2").count()
        assert pairs.count() == n * n and pairs.agg(F.max("count")).first()[0] == 1


def test_nearest_join_through_crowded_cubes(spark, monkeypatch):
    monkeypatch.setattr(skyjoin, "CROWDED", 5)
    left, right = tables(spark)
    got = {r["id"]: (r["id_2"], r["sep"]) for r in skyjoin.nearest_join(left, right, 12.0).collect()}
    for i, p in enumerate(points(1, 150)):
        best = min((sep(p, q), j) for j, q in enumerate(points(2, 150)))
        if best[0] <= 12.0:
            assert got[i][1] == pytest.approx(best[0], abs=1e-12)
        else:
            assert i not in got


def test_nearest_other(spark, monkeypatch):
    monkeypatch.setattr(skyjoin, "CROWDED", 8)
    left, _ = tables(spark, 80)
    pts = points(1, 80)
    got = {r["id"]: r["sep"] for r in skyjoin.nearest_other(left).collect()}
    for i, p in enumerate(pts):
        assert got[i] == pytest.approx(min(sep(p, q) for j, q in enumerate(pts) if j != i), abs=1e-11)


def test_regions_with_their_own_radius(spark):
    left, right = tables(spark)
    regions = right.filter("id_2 % 6 = 0").withColumn("xtr_radius", 2.0 + F.col("id_2") % 40).withColumnsRenamed({"ra_2": "centre_ra", "dec_2": "centre_dec"})
    got = rows_of(skyjoin.region_join(left, regions), "id", "id_2")
    expected = sorted((i, j) for i, p in enumerate(points(1, 150)) for j, q in enumerate(points(2, 150)) if j % 6 == 0 and sep(p, q) < 2.0 + j % 40)
    assert got == expected


@pytest.mark.parametrize("salt", [1_000_000, 3])
def test_regions_from_arcseconds_to_the_whole_sky(spark, monkeypatch, salt):
    monkeypatch.setattr(skyjoin, "ROWS_PER_SALT", salt)
    left, right = tables(spark)
    radii = [1e-5, 0.1, 0.7, 3.0, 20.0, 90.0, 179.0, 180.0, 200.0, 0.0]
    widths = F.element_at(F.array(*[F.lit(r) for r in radii]), (F.col("id_2") % len(radii) + 1).cast("int"))
    regions = right.withColumn("xtr_radius", widths).withColumnsRenamed({"ra_2": "centre_ra", "dec_2": "centre_dec"})
    got = rows_of(skyjoin.region_join(left, regions), "id", "id_2")
    assert got == sorted((i, j) for i, p in enumerate(points(1, 150)) for j, q in enumerate(points(2, 150)) if sep(p, q) < radii[j % len(radii)])
    assert skyjoin.region_join(left, regions.limit(0)).isEmpty()


def test_regions_of_all_sizes_on_one_crowded_spot(spark, monkeypatch):
    monkeypatch.setattr(skyjoin, "ROWS_PER_SALT", 100_000)
    rows = spark.range(1_000_000).select("id", F.lit(10.0).alias("ra"), F.lit(-30.0).alias("dec"))
    discs = frame(spark, [(k, 10.0 + 0.05 * (k % 2), -30.0, r) for k, r in enumerate([0.1, 0.02, 5.0, 0.04, 90.0, 45.0])], "other long, centre_ra double, centre_dec double, xtr_radius double")
    counts = skyjoin.region_join(rows, discs).groupBy("other").count()
    assert rows_of(counts, "other", "count") == [(k, 1_000_000) for k in (0, 2, 4, 5)]


@pytest.mark.parametrize("ra,dec,radius", [(0.0, 0.0, 20.0), (123.0, 89.0, 5.0), (359.0, -60.0, 15.0), (10.0, 5.0, 170.0)])
def test_cones(spark, ra, dec, radius):
    left, _ = tables(spark)
    got = rows_of(skyjoin.cone_search(left, ra, dec, radius), "id")
    assert got == [(i,) for i, p in enumerate(points(1, 150)) if sep(p, (ra, dec)) <= radius]


def test_dense_index_and_median(spark):
    rows = [(i, i % 3, float((i * 37) % 101)) for i in range(200)]
    df = frame(spark, rows, "id long, g long, v double").repartition(7)
    got = [r[0] for r in ranking.dense_index(df, ["v", "id"], "idx", 5).orderBy("idx").select("id").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    import statistics

    medians = dict(rows_of(ranking.group_median(df, ["g"], "v"), "g", "median"))
    assert medians == {g: statistics.median(r[2] for r in rows if r[1] == g) for g in range(3)}


def test_grid_keeps_pairs_at_the_exact_radius():
    assert cells.cell_size(10.0) >= 2 * 2 * math.sin(math.radians(5.0))


def test_few_copies_of_a_row(spark):
    """A row is copied into the cubes that its ball and the sphere share; all places of the ball lie in one of them."""
    rng = random.Random(5)
    rows = [(i, rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for i in range(400)]
    near = [(i, ra, min(max(dec + step, -90.0), 90.0)) for i, ra, dec in rows for step in (-0.001, 0.0, 0.001)]
    size, reach = cells.cell_size(0.001), cells.chord(0.001)
    copies = cells.with_cells_touched(frame(spark, rows, "id long, ra double, dec double"), "ra", "dec", size, reach, near_only=True)
    assert copies.count() < 3 * len(rows)
    places = cells.with_cell(frame(spark, near, "id long, ra double, dec double"), "ra", "dec", size)
    assert places.join(copies, ["id", *cells.CELL_KEYS], "left_anti").isEmpty()


def test_pixels_of_projections(spark):
    for projection in ("SIN", "TAN"):
        ra, dec = sky.pixel_to_sky(F.lit(120.0), F.lit(40.0), F.lit(projection), 30.0, -40.0, 100.0, 80.0, -0.1, 0.1)
        at = spark.range(1).select(ra.alias("ra"), dec.alias("dec"))
        i, j = sky.tangent_pixel("ra", "dec", F.lit(projection), 30.0, -40.0, 100.0, 80.0, -0.1, 0.1)
        assert tuple(at.select(i, j).first()) == (39, 119)
