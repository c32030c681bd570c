"""The sky key, the ranges of cones, and how little of a stored table a cone reads."""

import math
import random

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F
from test_sky import points, sep
from test_stored import scans

from lumitrace.operators import sky_curve
from lumitrace.operators.skyjoin import cone_search
from lumitrace.sources.sky_table import SkyTable
from lumitrace.sources.tables import RunStore

CONES = [(0.0, 90.0, 1.0), (77.0, -90.0, 0.2), (0.0, 0.0, 0.5), (359.9999, 12.0, 1.0), (45.0, 35.26439, 2.0), (10.0, 5.0, 170.0), (50.0, 20.0, 0.0), (200.0, -30.0, 1e-5), (3.0, 3.0, 180.0)]


def around(cone, n, seed):
    """Positions inside a cone, its edge among them."""
    ra, dec, radius = cone
    rng = random.Random(seed)
    a, d = math.radians(ra), math.radians(dec)
    c = (math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d))
    e = (-math.sin(a), math.cos(a), 0.0)
    f = (c[1] * e[2] - c[2] * e[1], c[2] * e[0] - c[0] * e[2], c[0] * e[1] - c[1] * e[0])
    out = []
    for _ in range(n):
        r, t = math.radians(radius * rng.choice([1.0, rng.random()])), rng.uniform(0, 2 * math.pi)
        v = [math.cos(r) * x + math.sin(r) * (math.cos(t) * y + math.sin(t) * z) for x, y, z in zip(c, e, f)]
        out.append((math.degrees(math.atan2(v[1], v[0])) % 360, math.degrees(math.asin(max(-1, min(1, v[2]))))))
    return out


def test_ranges_hold_every_position_of_a_cone(spark):
    rows = [(k, *p) for k, cone in enumerate(CONES) for p in around(cone, 300, k)]
    keyed = frame(spark, rows, "cone long, ra double, dec double").withColumn("key", sky_curve.sky_key("ra", "dec"))
    for k, cone in enumerate(CONES):
        ranges = sky_curve.cone_ranges(*cone)
        assert 0 < len(ranges) <= sky_curve.RANGES and all(a <= b for a, b in ranges)
        assert all(b + 1 < a for (_, b), (a, _) in zip(ranges, ranges[1:]))
        assert keyed.filter(F.col("cone") == k).filter(~sky_curve.in_ranges(ranges, "key", "key")).isEmpty()
    # A cone of all sky takes all keys, small ones few.
    everything = 6 << 2 * sky_curve.DEPTH
    share = [sum(b - a + 1 for a, b in sky_curve.cone_ranges(*cone)) / everything for cone in CONES]
    assert share[-1] == 1.0
    for cone, part in zip(CONES, share):
        cap = (1 - math.cos(math.radians(cone[2]))) / 2
        assert part <= 2.5 * cap + 1e-10


def test_keys_of_the_whole_sphere(spark):
    pts = points(3, 400) + [(45.0 * k, math.degrees(math.atan(x))) for k in range(8) for x in (-1, 0, 1)]
    got = frame(spark, [(i, *p) for i, p in enumerate(pts)] + [(-1, None, 2.0)], "id long, ra double, dec double").select("id", sky_curve.sky_key("ra", "dec").alias("key"))
    keys = dict(rows_of(got, "id", "key"))
    assert keys.pop(-1) is None and all(0 <= k < 6 << 2 * sky_curve.DEPTH for k in keys.values())
    # Positions 1e-7 degrees apart share a key or its neighbourhood, those on different faces do not.
    assert len({k >> 2 * sky_curve.DEPTH for k in keys.values()}) == 6


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(11)
    pts = points(1, 150) + [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(20_000)]
    table = SkyTable(spark, str(tmp_path_factory.mktemp("sky") / "t"))
    table.write(frame(spark, [(i, *p) for i, p in enumerate(pts)] + [(-1, None, None)], "id long, ra double, dec double"), files=64)
    return table, pts


@pytest.mark.parametrize("cone", CONES)
def test_cones_read_few_files(spark, stored, cone):
    table, pts = stored
    found = table.cone(*cone)
    got = found.collect()
    assert sorted(r["id"] for r in got) == [i for i, p in enumerate(pts) if sep(p, cone[:2]) <= cone[2]]
    assert [r["distance"] for r in got] == sorted(r["distance"] for r in got) and found.columns == ["id", "ra", "dec", "distance"]
    read = max(scans(found).values(), default=0)
    assert table.files().count() == 64 and table.rows().count() == len(pts) + 1
    if cone[2] <= 2.0:
        assert read <= 4


def test_cones_of_a_stored_run(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "a b"))
    rows = frame(spark, [(i, *p) for i, p in enumerate(points(1, 150))], "id long, ra double, dec double")
    store.save("r", {"measurements": rows, "sources": rows.withColumnsRenamed({"ra": "wavg_ra", "dec": "wavg_dec"}), "plain": rows.select("id")})
    for cone in CONES[:3]:
        inside = [i for i, p in enumerate(points(1, 150)) if sep(p, cone[:2]) <= cone[2]]
        for table in ("measurements", "sources"):
            assert sorted(r["id"] for r in store.cone("r", table, *cone).collect()) == inside
    assert store.read("r", "measurements").columns == ["id", "ra", "dec"]
    for run, table in (("r", "plain"), ("other", "measurements")):
        with pytest.raises(KeyError):
            store.cone(run, table, 1.0, 2.0, 3.0)


def test_a_table_without_rows_and_a_clashing_column(spark, tmp_path):
    table = SkyTable(spark, str(tmp_path / "none"))
    empty = spark.createDataFrame([], "id long, ra double, dec double")
    table.write(empty)
    assert table.cone(1.0, 2.0, 3.0).collect() == [] and table.rows().columns == ["id", "ra", "dec"]
    with pytest.raises(ValueError):
        SkyTable(spark, str(tmp_path / "clash")).write(empty.withColumn("sky_key", F.lit(1)))


def test_rows_on_the_edge_are_in_the_cone(spark, tmp_path):
    """All positions of one declination are equally far from the pole, whatever rounding says of some."""
    df = frame(spark, [(k, (k * 137.508) % 360.0, 65.0) for k in (115000, 275000, 435000, 595000, 755000)], "id long, ra double, dec double")
    table = SkyTable(spark, str(tmp_path / "edge"))
    table.write(df)
    assert table.cone(120.0, 90.0, 25.0).count() == 5
    assert cone_search(df, 120.0, 90.0, 25.0).count() == 5
    assert table.cone(120.0, 90.0, 25.0 - 1e-9).count() == 0
