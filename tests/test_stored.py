"""Files under a manifest, pixels by tile, medians by radix selection, prefix sums."""

import random
import statistics

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from lumitrace.operators import ranking
from lumitrace.operators.pixels import sample_noise, stamp
from lumitrace.sources.file_manifest import FileManifest, globbed, input_lists
from lumitrace.sources.pixel_tiles import PixelTiles


def rows_for(spark, ids):
    return frame(spark, [(i, i % 4) for i in ids], "id long, image_id long")


def test_versions_of_files(spark, tmp_path, monkeypatch):
    store = FileManifest(spark, str(tmp_path / "m"))
    assert store.versions() == [] and store.files().isEmpty()
    assert store.append("forced", rows_for(spark, range(10))) == 1
    with monkeypatch.context() as m:
        m.setattr(FileManifest, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.append("forced", rows_for(spark, range(100, 120)))
    assert store.versions() == [1] and rows_of(store.read("forced"), "id") == [(i,) for i in range(10)]
    assert store.append("forced", rows_for(spark, [20, 21])) == 2
    assert rows_of(store.read("forced"), "id") == [(i,) for i in [*range(10), 20, 21]]
    assert rows_of(store.previous("forced"), "id") == [(i,) for i in range(10)]
    assert store.remove("forced", rows_for(spark, [1])) == 3
    assert rows_of(store.read("forced"), "id") == [(i,) for i in [0, 2, 3, 4, 6, 7, 8, 20]]
    assert rows_of(store.files("forced"), "image_id", "written") == [(0, 1), (0, 2), (2, 1), (3, 1)]
    with pytest.raises(KeyError):
        store.read("forced", 9)
    # Only files of the manifest are read.
    read = store.read("forced", 2).filter("written = 2")
    assert read.count() == 2


def test_input_lists(spark, tmp_path):
    for name in ("b1.fits", "b0.fits", "a.fits", "c.txt"):
        (tmp_path / name).write_text("x")
    at = lambda *names: [str(tmp_path / n) for n in names]
    assert globbed(spark, at("b*.fits", "a.fits")) == at("b0.fits", "b1.fits", "a.fits")
    with pytest.raises(FileNotFoundError):
        globbed(spark, at("z*.fits"))
    lists = input_lists(spark, {"image": {"1": at("a.fits"), "2": at("b*.fits")}, "noise": at("c.txt")})
    assert rows_of(lists, "epoch", "kind") == [("", "noise"), ("1", "image"), ("2", "image")]


def scans(df):
    """Files read by the Parquet scans of a query that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    out, todo = {}, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet") and node.metrics().contains("numFiles"):
            out[node.simpleString(1000)] = node.metrics().get("numFiles").get().value()
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return out


def test_only_tiles_that_are_asked_for_are_read(spark, tmp_path):
    grid = spark.range(6400).select(F.explode(F.array(*[F.lit(k).cast("long") for k in (1, 2, 3)])).alias("image_id"), F.floor(F.col("id") / 80).alias("i"), (F.col("id") % 80).alias("j"))
    pixels = grid.withColumn("value", (F.col("i") * 100 + F.col("j")) / 1e6)
    tiles = PixelTiles(spark, str(tmp_path / "px"), 10)
    tiles.write(pixels)
    boxes = frame(spark, [(1, 5, 5, 2), (1, 5, 5, 2), (2, 39, 71, 3), (3, None, None, 3), (2, -5, 4, 1)], "image_id long, i long, j long, half long")
    near = tiles.near(boxes)
    # The second box lies on the corner of four tiles.
    assert near.count() == 100 + 400
    near.collect()
    assert max(scans(near).values()) == 5 and sum(1 for _ in (tmp_path / "px").rglob("*.parquet")) == 192

    wcs = frame(spark, [(k, "SIN", 10.0, 0.0, 40.5, 40.5, -0.01, 0.01, 80, 80, 0.03) for k in (1, 2, 3)], "image_id long, projection string, crval1 double, crval2 double, crpix1 double, crpix2 double, cdelt1 double, cdelt2 double, naxis1 int, naxis2 int, bmaj double")
    spots = frame(spark, [(k, k, 1 + k % 3, 10 + 0.07 * (k % 11 - 5), 0.06 * (k % 13 - 6)) for k in range(40)], "source long, id long, image_id long, ra double, dec double")
    for fn, args in ((sample_noise, ()), (stamp, (3.0,))):
        assert rows_of(fn(spots, wcs, tiles, *args), "*") == rows_of(fn(spots, wcs, pixels, *args), "*")


@pytest.mark.parametrize("bins, few", [(4096, 4096), (4, 1), (3, 2)])
def test_medians(spark, monkeypatch, bins, few):
    monkeypatch.setattr(ranking, "BINS", bins)
    monkeypatch.setattr(ranking, "FEW", few)
    rng = random.Random(5)
    groups = {
        "one": [7.25],
        "two": [1.0, 2.0],
        "zeros": [0.0] * 30 + [-0.0] * 5 + [1e-300],
        "mixed": [rng.gauss(0, 1) for _ in range(101)],
        "equal": [3.5] * 200,
        "huge": [1.7e308, -1.7e308, 1e308, -1e308, 1.0],
        "tiny": [5e-324 * k for k in range(9)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(200)],
        "close": [1 + k * 2.0**-52 for k in range(64)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("mixed", None), ("mixed", float("nan")), (None, 1.0)]
    got = dict(rows_of(ranking.group_median(frame(spark, rows, "g string, v double"), ["g"], "v"), "g", "median"))
    for g, values in groups.items():
        middle = sorted(values)
        lo, hi = middle[(len(middle) - 1) // 2], middle[len(middle) // 2]
        assert got[g] == (lo + hi) / 2 if lo != hi else got[g] == lo, g
    assert got["mixed"] == statistics.median(groups["mixed"]) and len(got) == len(groups)


def test_prefix_sums(spark):
    rows = [(k, k % 7) for k in range(500)]
    got = rows_of(ranking.prefix_sums(frame(spark, rows, "k long, v long"), ["k"], "v", "before"), "k", "before")
    assert got == [(k, sum(j % 7 for j in range(k))) for k in range(500)]
