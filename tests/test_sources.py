"""Catalogue files, stored tables, exports."""

import json

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from lumitrace.operators import clean, images
from lumitrace.plans import pipeline
from lumitrace.settings import RunSettings
from lumitrace.sources import catalogues, exports
from lumitrace.sources.tables import RunStore, read_measurements, write_by_image

NAMES = [
    "island_id", "component_id", "component_name", "ra_deg_cont", "dec_deg_cont", "ra_err", "dec_err", "flux_peak", "flux_peak_err", "flux_int", "flux_int_err",
    "maj_axis", "min_axis", "pos_ang", "maj_axis_err", "min_axis_err", "pos_ang_err", "maj_axis_deconv", "min_axis_deconv", "pos_ang_deconv", "chi_squared_fit",
    "spectral_index", "rms_image", "has_siblings", "spectral_index_from_TT", "flag_c4", "comment",
]


def component(n, **changes):
    row = dict.fromkeys(NAMES, "0.5") | {
        "island_id": f"island_{n}", "component_id": f"component_{n}a", "component_name": f"J{n}", "ra_deg_cont": str(150 + n / 100), "dec_deg_cont": "-30.0",
        "flux_peak": str(10 + n), "flux_int": str(12 + n), "maj_axis": "15.0", "min_axis": "10.0", "has_siblings": "0", "spectral_index_from_TT": "1", "flag_c4": "0", "comment": "",
    }
    return row | {k: str(v) for k, v in changes.items()}


def write_text(path, rows, names=NAMES):
    lines = ["# " + "  ".join(names), "# " + "  ".join("--" for _ in names)]
    path.write_text("\n".join(lines + ["   " + "   ".join(r[n] for n in names) for r in rows]) + "\n")


def write_csv(path, rows, names):
    names = ["id", *names, "quality_level"]
    lines = [",".join("spectral_index_from_tt" if n == "spectral_index_from_TT" else n for n in names)]
    for i, r in enumerate(rows):
        full = {"id": str(i), "quality_level": "GOOD"} | r
        text = ",".join(full[n] for n in names)
        lines.append(text if i else text.rsplit(",", 1)[0])  # one short row
    path.write_text("\n".join(lines) + "\n")


def write_xml(path, rows, names=NAMES):
    fields = "\n".join(f'<FIELD name="{n}" ID="col_{n}" datatype="char"/>' for n in names)
    body = "\n".join("<TR>\n" + "".join(f"<TD>  {r[n]}</TD>" for n in names) + "\n</TR>" for r in rows)
    path.write_text(f'<?xml version="1.0"?>\n<VOTABLE version="1.3"><RESOURCE><TABLE>\n{fields}\n<DATA><TABLEDATA>\n{body}\n</TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>\n')


def test_formats_agree(spark, tmp_path):
    rows = [component(i, has_siblings=i % 2) for i in range(5)]
    write_text(tmp_path / "a.txt", rows)
    write_csv(tmp_path / "b.csv", rows, NAMES[::-1])
    write_xml(tmp_path / "c.xml", rows)
    read = catalogues.read_components(spark, [f"{tmp_path}/a.t*t", f"{tmp_path}/b.csv", f"{tmp_path}/c.xml"])
    by_file = {}
    for r in read.collect():
        by_file.setdefault(r["catalogue_path"].rsplit("/", 1)[1], []).append(tuple(r)[1:])
    assert set(by_file) == {"a.txt", "b.csv", "c.xml"}
    assert sorted(by_file["a.txt"]) == sorted(by_file["b.csv"]) == sorted(by_file["c.xml"])
    one = read.filter("component_id = 'component_3a' AND catalogue_path LIKE '%txt'").first()
    assert (one["flux_peak"], one["bmaj"], one["has_siblings"], one["spectral_index_from_TT"], one["flag_c4"]) == (13.0, 15.0, True, True, False)


def test_missing_columns_are_refused(spark, tmp_path):
    short = [n for n in NAMES if n not in ("flux_int", "maj_axis")]
    write_text(tmp_path / "bad.txt", [component(1)], short)
    with pytest.raises(KeyError, match="flux_int"):
        catalogues.read_text(spark, f"{tmp_path}/bad.txt")


@pytest.mark.parametrize("reader, name", [("read_text", "a.txt"), ("read_csv", "a.csv"), ("read_votable", "a.xml")])
def test_files_without_island_ids_are_refused(spark, tmp_path, reader, name):
    write = {"read_text": write_text, "read_csv": write_csv, "read_votable": write_xml}[reader]
    write(tmp_path / f"good-{name}", [component(1)], NAMES)
    write(tmp_path / f"bad-{name}", [component(2)], [n for n in NAMES if n != "island_id"])
    with pytest.raises(KeyError, match="island_id"):
        getattr(catalogues, reader)(spark, [f"{tmp_path}/good-{name}", f"{tmp_path}/bad-{name}"])


def test_files_without_a_header_are_refused(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2 3\n")
    (tmp_path / "a.csv").write_text("1,2,3\n")
    for reader, name in ((catalogues.read_text, "a.txt"), (catalogues.read_csv, "a.csv")):
        with pytest.raises(KeyError, match="lacks columns"):
            reader(spark, f"{tmp_path}/{name}")


def test_wide_csv_files_keep_their_columns(spark, tmp_path):
    more = {f"x{i}": str(i) for i in range(200)}
    write_csv(tmp_path / "wide.csv", [component(1) | more, component(2) | more], [*more, *NAMES])
    read = catalogues.read_csv(spark, f"{tmp_path}/wide.csv")
    assert rows_of(read, "component_id", "flux_peak") == [("component_1a", 11.0), ("component_2a", 12.0)]


@pytest.mark.parametrize("column", ["ra_deg_cont", "has_siblings"])
def test_unreadable_numbers_are_refused_and_empty_ones_are_null(spark, tmp_path, column):
    write_csv(tmp_path / "a.csv", [component(1), component(2, **{column: ""})], NAMES)
    target = catalogues.COMPONENT_COLUMNS[column][0]
    assert catalogues.read_csv(spark, f"{tmp_path}/a.csv").filter(F.col(target).isNull()).count() == 1
    write_csv(tmp_path / "b.csv", [component(1), component(2, **{column: "oops"})], NAMES)
    with pytest.raises(Exception, match="unreadable"):
        catalogues.read_csv(spark, f"{tmp_path}/b.csv").collect()


def test_images_outside_all_regions_keep_their_rows(spark):
    from lumitrace.operators.association import prepare_rows
    from lumitrace.operators.components import attach_groups

    images = frame(spark, [(1, 1, 10.0, 0.0, 0.004, 5), (2, 1, 50.0, 0.0, 0.004, 9)], "image_id long, epoch long, ra double, dec double, beam_bmaj double, skyreg_id long")
    grouped = attach_groups(images, frame(spark, [(5, 1)], "id long, skyreg_group long"))
    assert rows_of(grouped, "image_id", "skyreg_group") == [(1, 1), (2, 0)]
    rows = frame(spark, [(1, 1, 10.0, 0.0), (2, 2, 50.0, 0.0)], "id long, image_id long, ra double, dec double")
    rows = rows.withColumns({c: F.lit(1.0) for c in ("uncertainty_ew", "uncertainty_ns", "weight_ew", "weight_ns")})
    for group in (F.col("skyreg_group"), F.lit(None).cast("long")):
        assert prepare_rows(rows, grouped.withColumn("skyreg_group", group), RunSettings()).count() == 2


def test_cleaning_drops_and_floors(spark, tmp_path):
    rows = [component(1), component(2, flux_int=0), component(3, maj_axis=0.5), component(4, rms_image=0, flux_peak_err=0, ra_err=0)]
    write_text(tmp_path / "a.txt", rows)
    image = frame(spark, [(7, "field.i.SB1.cont.fits", "2020-01-01", 0.004, 0.003)], "image_id long, name string, datetime string, beam_bmaj double, beam_bmin double")
    raw = catalogues.read_text(spark, f"{tmp_path}/a.txt").withColumn("image_id", F.lit(7).cast("long"))
    out = clean.clean_components(raw, image, RunSettings(condon_errors=False))
    got = {r["component_id"]: r for r in out.collect()}
    assert set(got) == {"component_1a", "component_4a"}
    last = got["component_4a"]
    assert last["name"] == "SB1_component_4a"
    assert (last["local_rms"], last["flux_peak_err"]) == (0.2, 0.001)
    assert last["ra_err"] == pytest.approx(0.01 / 3600)
    assert last["flux_int_isl_ratio"] == 1.0
    with pytest.raises(ValueError):
        clean.clean_components(raw.unionByName(raw), image, RunSettings())


def test_ingest_skips_known_images(spark, tmp_path):
    write_text(tmp_path / "a.txt", [component(i) for i in range(3)])
    image = frame(spark, [(7, "f.i.SB1.fits", "2020", 0.004, 0.003), (8, "f.i.SB2.fits", "2020", 0.004, 0.003)], "image_id long, name string, datetime string, beam_bmaj double, beam_bmin double")
    raw = catalogues.read_text(spark, f"{tmp_path}/a.txt")
    root = str(tmp_path / "store")
    first = pipeline.ingest(raw.withColumn("image_id", F.lit(7).cast("long")), image, RunSettings(), root)
    assert rows_of(first, "id", "component_id") == [(1, "component_0a"), (2, "component_1a"), (3, "component_2a")]
    forced = frame(spark, [(4, 7, True)], "id long, image_id long, forced boolean")
    known = read_measurements(spark, root, ["id", "image_id", "forced"]).withColumn("image_id", F.col("image_id").cast("long")).unionByName(forced)
    both = F.explode(F.array(F.lit(7).cast("long"), F.lit(8).cast("long")))
    second = pipeline.ingest(raw.withColumn("image_id", both), image, RunSettings(), root, known)
    assert rows_of(second, "id", "image_id") == [(5, 8), (6, 8), (7, 8)]
    assert read_measurements(spark, root).count() == 6


def test_bands_join_known_ones(spark):
    known = frame(spark, [(1, 888.0), (2, 1400.0)], "id long, frequency double")
    f = frame(spark, [(890, 1), (943, 2), (950, 3), (1410, 4), (2000, 5)], "frequency long, first_seen long")
    of, bands = images.assign_bands(f, known)
    assert rows_of(of, "frequency", "band_frequency") == [(890, 888.0), (943, 943.0), (950, 943.0), (1410, 1400.0), (2000, 2000.0)]
    assert rows_of(bands, "band_order", "band_frequency") == [(1, 888.0), (2, 1400.0), (3, 943.0), (4, 2000.0)]


def test_versions_of_a_run(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "runs"))
    assert store.current_version("r") is None
    store.save("r", {"sources": spark.range(3)})
    store.save("r", {"sources": spark.range(5)})
    assert store.read("r", "sources").count() == 5
    assert store.previous("r", "sources").count() == 3
    assert store.restore("r") == 1
    assert store.read("r", "sources").count() == 3
    assert store.save("r", {"sources": spark.range(7)}) == 3
    assert store.current_version("r") == 3


def test_measurements_by_image(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 4).alias("image_id"), (F.col("id") * 0.5).alias("flux"))
    write_by_image(rows, str(tmp_path / "m"))
    write_by_image(rows.withColumns({"id": F.col("id") + 100, "image_id": F.lit(9).cast("long")}), str(tmp_path / "m"))
    read = read_measurements(spark, str(tmp_path / "m"), ["id", "flux"], [1, 9])
    assert read.count() == 125
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [image_id" in plan and "ReadSchema: struct<id:bigint,flux:double>" in plan


def test_feature_collection_is_one_document(spark, tmp_path):
    regions = frame(spark, [(1, 200.0, 5.0, 4.0, 2.0), (12, 20.0, -5.0, 4.0, 2.0)], "id long, centre_ra double, centre_dec double, width_ra double, width_dec double")
    exports.write_feature_collection(regions, str(tmp_path / "g"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    doc = json.loads(text)
    assert [f["id"] for f in doc["features"]] == ["SkyRegion1", "SkyRegion12"]
    assert doc["features"][0]["properties"] == {"n": "01", "loc": [-160.0, 5.0]}
    assert doc["features"][0]["geometry"]["coordinates"][0][0] == [-158.0, 6.0]


def test_cards_are_dealt_by_image(spark, monkeypatch):
    """As many tasks as there are cards for, each image in one; other keywords make a row without values."""
    monkeypatch.setattr(images, "CARDS_PER_TASK", 20)
    cards = [(f"i{n}", k, f"{k}{n}") for n in range(40) for k in ("TELESCOP", "bmaj", "BPA")] + [("odd", "HISTORY", "x")]
    wide = images.pivot_cards(frame(spark, cards, "image string, keyword string, value string"))
    assert wide.rdd.getNumPartitions() == 7
    assert rows_of(wide, "image", "BMAJ", "BMIN") == sorted([(f"i{n}", f"bmaj{n}", None) for n in range(40)] + [("odd", None, None)])
    ours = [(i, k, "ASKAP" if k == "TELESCOP" else v) for i, k, v in cards]
    missing = rows_of(images.header_problems(frame(spark, ours, "image string, keyword string, value string")), "image", "missing")
    assert missing == sorted((f"i{n}", k) for n in range(40) for k in ("DATE-OBS", "TIMESYS", "BMIN"))


def test_headers_of_csv_files_are_found_once(spark, tmp_path):
    """Rows are not held against the names of columns again when they are read; quoted and odd headers are still known."""
    write_csv(tmp_path / "a.csv", [component(1), component(2, comment="flux_peak_of_it")], NAMES)
    first, text = (tmp_path / "a.csv").read_text().split("\n", 1)
    names = [f'"{n}"' if n == "ra_err" else n.lower() if n == "spectral_index_from_TT" else n for n in first.strip().split(",")]
    (tmp_path / "b.csv").write_text(",".join(names) + "\n" + text)
    read = catalogues.read_csv(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"])
    assert rows_of(read, "component_id", "flux_peak") == [("component_1a", 11.0)] * 2 + [("component_2a", 12.0)] * 2
    assert "exists(" not in read._jdf.queryExecution().toString()


def test_tiles_are_written_by_as_many_tasks_as_they_ask_for(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from lumitrace.sources import pixel_tiles

    asked, real = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *a: asked.append(a) or real(self, *a))
    monkeypatch.setattr(pixel_tiles, "TILES_PER_TASK", 4)
    pixels = frame(spark, [(1, i, j, float(i + j)) for i in range(12) for j in range(12)], "image_id long, i long, j long, value double")
    tiles = pixel_tiles.PixelTiles(spark, str(tmp_path / "t"), 2)
    tiles.write(pixels)
    assert asked == [(9, "tile")]
    near = tiles.near(frame(spark, [(1, 5, 5, 0)], "image_id long, i long, j long, half long"))
    assert rows_of(near, "i", "j") == [(4, 4), (4, 5), (5, 4), (5, 5)]


def test_statistics_are_worked_out_once_for_all_ranges(spark):
    from lumitrace.registry.searching import sources_by_every_range

    assert "events" not in sources_by_every_range(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
