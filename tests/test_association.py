"""Association decisions on small tables, and properties of whole runs."""

import random

import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from lumitrace.operators import association as A
from lumitrace.operators.components import group_regions
from lumitrace.operators.duplicates import drop_epoch_duplicates
from lumitrace.operators.search import related_sources
from lumitrace.operators.stats import relation_counts
from lumitrace.settings import RunSettings

PAIRS = "id long, source long, d2d double, dr double"


def test_forks_take_new_ids_and_history(spark):
    matched = frame(spark, [(10, 1, 3.1, 0.0), (11, 2, 4.2, 0.0), (12, 2, 2.3, 0.0), (13, 3, 3.3, 0.0), (14, 3, 5.6, 0.0), (15, 3, 4.0, 0.0)], PAIRS)
    marked = A.mark_forks(matched, "d2d")
    numbered, next_id = A.number_sources(marked, 4, ["d2d", "id"])
    assert rows_of(numbered, "id", "source") == [(10, 1), (11, 4), (12, 2), (13, 3), (14, 6), (15, 5)]
    assert next_id == 7
    assert rows_of(A.fork_relations(numbered), "from_source_id", "to_source_id") == [(2, 4), (3, 5), (3, 6), (4, 2), (5, 3), (6, 3)]
    log = frame(spark, [(1, 1, 0.0, 0.0, 1), (2, 2, 0.0, 0.0, 1), (2, 3, 0.0, 0.0, 2), (2, 4, 0.0, 0.0, 3), (3, 5, 0.0, 0.0, 1)], "source long, meas_id long, d2d double, dr double, step long")
    forks = numbered.filter("parent is not null").select(F.col("source").alias("child"), "parent", F.lit(4).cast("long").alias("step"))
    whole = A.inherit_history(log, forks)
    assert rows_of(whole.filter("source > 3"), "source", "meas_id") == [(4, 2), (4, 3), (4, 4), (5, 5), (6, 5)]


def test_history_follows_chains_of_forks(spark):
    schema = "source long, meas_id long, d2d double, dr double, step long"
    log = frame(spark, [(1, 1, 0.0, 0.0, 1), (2, 2, 0.0, 0.0, 2), (1, 3, 0.0, 0.0, 2), (3, 4, 0.0, 0.0, 3), (2, 5, 0.0, 0.0, 3), (4, 6, 0.0, 0.0, 4)], schema)
    forks = frame(spark, [(2, 1, 2), (3, 2, 3), (4, 3, 4)], "child long, parent long, step long")
    whole = A.inherit_history(log, forks)
    assert rows_of(whole, "source", "meas_id") == [(1, 1), (1, 3), (2, 1), (2, 2), (2, 5), (3, 1), (3, 2), (3, 4), (4, 1), (4, 2), (4, 4), (4, 6)]


TANGLED = [
    (1, 1, 12.0, 1.0), (1, 2, 10.0, 3.0), (2, 2, 3.0, 2.0), (2, 1, 3.0, 2.0),
    (3, 3, 7.0, 4.0), (4, 4, 1.0, 9.0), (4, 5, 2.0, 1.0), (5, 6, 1.0, 1.0),
]


def test_untangle_keeps_the_minimum_of_each_measurement(spark):
    pairs = frame(spark, TANGLED, PAIRS)
    # Measurements 1 and 2 share sources 1 and 2; 4 has two sources that occur once.
    assert rows_of(A.untangle(pairs, "d2d"), "id", "source") == [(1, 2), (2, 1), (2, 2), (3, 3), (4, 4), (4, 5), (5, 6)]
    assert rows_of(A.untangle(pairs, "dr"), "id", "source") == [(1, 1), (2, 1), (2, 2), (3, 3), (4, 4), (4, 5), (5, 6)]


@pytest.mark.parametrize("dist,forked", [("d2d", {(1, 12), (2, 13)}), ("dr", {(2, 12), (1, 13)})])
def test_the_closest_pair_keeps_the_source(spark, dist, forked):
    pairs = frame(spark, [(11, 1, 1.0, 5.0), (12, 1, 2.0, 6.0), (13, 2, 4.0, 2.0), (14, 2, 3.0, 1.0)], PAIRS)
    numbered, next_id = A.number_sources(A.mark_forks(pairs, dist), 3, [dist, "id"])
    kept = {r["id"]: r["source"] for r in numbered.filter("parent is null").collect()}
    assert kept == {11: 1, 14: 2}
    assert next_id == 5


def test_sources_sharing_a_measurement_are_related(spark):
    rows = frame(spark, [(1, 1), (1, 2), (1, 2), (1, 7), (2, 9), (2, 9), (3, 5)], "id long, source long")
    assert rows_of(A.sharing_relations(rows), "from_source_id", "to_source_id") == [(1, 2), (1, 7), (2, 1), (2, 7), (7, 1), (7, 2)]


def test_pairs_without_a_tangle_are_left_as_they_are(spark):
    pairs = frame(spark, [(1, 1, 1.0, 0.0), (1, 2, 2.0, 0.0), (2, 3, 1.0, 0.0), (3, 3, 2.0, 0.0)], PAIRS)
    assert A.untangle(pairs, "d2d") is pairs


def test_a_clump_of_sources_has_a_row_per_member(spark):
    n = 10_000
    clump = spark.range(n).select(F.lit(7).cast("long").alias("id"), F.col("id").alias("source"))
    # The same sources on two more measurements are the same class; a measurement of one source is none.
    rows = clump.unionByName(clump.withColumn("id", F.col("id") + 1)).unionByName(clump.withColumn("id", F.col("id") - 2)).unionByName(frame(spark, [(1, 3)], "id long, source long"))
    classes = A.sharing_classes(rows)
    assert classes.count() == n and {tuple(r) for r in classes.select("class_id", "size").distinct().collect()} == {(5, n)}
    # Links inside the class add nothing, one that leaves it adds one at either end.
    links = frame(spark, [(1, 2), (2, 1), (3, n), (n, 3)], "from_source_id long, to_source_id long")
    counts = {r["source"]: r["n_rel"] for r in relation_counts(links, classes).collect()}
    assert counts == {i: n - 1 for i in range(n)} | {3: n, n: 1}
    sources = spark.range(n + 1)
    assert related_sources(sources, links, 3, classes).count() == n and rows_of(related_sources(sources, links, n, classes), "id") == [(3,)]


def test_counts_by_class_equal_counts_by_pair(spark):
    rng = random.Random(5)
    rows = frame(spark, [(rng.randrange(25), rng.randrange(30)) for _ in range(60)], "id long, source long")
    links = frame(spark, [(rng.randrange(30), rng.randrange(40)) for _ in range(30)], "from_source_id long, to_source_id long")
    classes = A.sharing_classes(rows)
    related = {(a, b) for a, b in rows_of(links, "from_source_id", "to_source_id") if a != b}
    held = {}
    for meas, source in set(rows_of(rows, "id", "source")):
        held.setdefault(meas, set()).add(source)
    related |= {(a, b) for group in held.values() for a in group for b in group if a != b}
    pairs = A.related_pairs(links, classes)
    assert {r for r in rows_of(pairs, "from_source_id", "to_source_id") if r[0] != r[1]} == related
    expected = sorted((s, sum(a == s for a, _ in related)) for s in {a for a, _ in related})
    assert rows_of(relation_counts(links, classes), "source", "n_rel") == rows_of(relation_counts(pairs), "source", "n_rel") == expected


MEAS = "id long, image_id long, ra double, dec double, uncertainty_ew double, uncertainty_ns double, weight_ew double, weight_ns double, forced boolean"
IMG = "image_id long, epoch long, ra double, dec double, beam_bmaj double"


def meas(i, image, ra, dec, unc=1 / 3600):
    return (i, image, ra, dec, unc, unc, 1 / unc**2, 1 / unc**2, False)


def images_of(spark, *numbers):
    return frame(spark, [(n, n, 150.0, -30.0, 0.004) for n in numbers], IMG)


def grid_run(spark):
    """Four epochs of a small field; the fourth is shifted by about an arcsec."""
    a, b, c, d = (149.9833, -29.9778), (150.0205, -30.0161), (149.9833, -30.0161), (150.0, -30.0)
    extra = [(150.0205, -29.9778), (150.0038, -30.0), (150.0205, -30.0)]
    epochs = {1: [a, b, c, d], 2: [a, b, c, d, *extra], 3: [a, b, c, d], 4: [(x + 0.0003, y) for x, y in (a, b, c, d, extra[0])]}
    rows = [meas(100 * e + i, e, x, y) for e, spots in epochs.items() for i, (x, y) in enumerate(spots)]
    return frame(spark, rows, MEAS), images_of(spark, *epochs)


@pytest.mark.parametrize("method", ["basic", "advanced", "deruiter"])
def test_field_of_four_epochs(spark, method):
    m, im = grid_run(spark)
    out = A.associate(m, im, RunSettings(method=method, radius=10.0))
    sizes = sorted(r["count"] for r in out.associations.groupBy("source").count().collect())
    assert out.next_id == 8
    assert sizes == [1, 1, 2, 4, 4, 4, 4]
    assert out.relations.count() == 0


@pytest.mark.parametrize("method", ["basic", "advanced"])
def test_zero_limit_makes_every_row_a_source(spark, method):
    rows = [meas(1, 1, 10.0, 0.0), meas(2, 1, 11.0, 0.0), meas(3, 2, 10.000001, 0.0), meas(4, 2, 11.000001, 0.0), meas(5, 2, 12.0, 0.0)]
    out = A.associate(frame(spark, rows, MEAS), images_of(spark, 1, 2), RunSettings(method=method, radius=0.0))
    assert rows_of(out.associations, "source", "meas_id") == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    out = A.associate(frame(spark, rows, MEAS), images_of(spark, 1, 2), RunSettings(method=method, radius=10.0))
    assert rows_of(out.associations, "source", "meas_id") == [(1, 1), (1, 3), (2, 2), (2, 4), (3, 5)]


def random_run(spark, seed=5, epochs=3, per_epoch=50):
    rng = random.Random(seed)
    spots = [(rng.uniform(0, 0.02) if i % 2 else rng.uniform(200, 200.02), rng.uniform(-0.01, 0.01)) for i in range(12)]
    rows, n = [], 0
    for e in range(1, epochs + 1):
        for _ in range(per_epoch):
            n += 1
            x, y = rng.choice(spots)
            rows.append(meas(n, e, (x + rng.gauss(0, 1.5 / 3600)) % 360, y + rng.gauss(0, 1.5 / 3600), rng.uniform(0.5, 2) / 3600))
    return rows


def brute_force(rows, radius, method):
    """The same rules on plain lists: sources as dicts of rows and related ids."""
    import math

    def sep(a, b, c, d):
        a, b, c, d = (math.radians(v) for v in (a, b, c, d))
        h = math.sin((b - d) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((a - c) / 2) ** 2
        return math.degrees(2 * math.asin(min(1, math.sqrt(h))))

    sources, related, n = {}, set(), 0
    for e in sorted({r[1] for r in rows}):
        todo = sorted(r for r in rows if r[1] == e)
        if not sources:
            for r in todo:
                n += 1
                sources[n] = [r]
            continue
        spots = {}
        for s, members in sources.items():
            w = [1 / x[4] ** 2 for x in members]
            ra = sum(wi * (x[2] + 360 if x[2] <= 0.1 else x[2]) for wi, x in zip(w, members)) / sum(w)
            spots[s] = (ra % 360, sum(wi * x[3] for wi, x in zip(w, members)) / sum(w))
        pairs = [(r, s, sep(r[2], r[3], *spots[s])) for r in todo for s in spots]
        pairs = [p for p in pairs if p[2] <= radius]
        if method == "basic":
            best = {}
            for p in pairs:
                best[p[0][0]] = min(best.get(p[0][0], p), p, key=lambda q: (q[2], q[1]))
            pairs = list(best.values())
        else:
            ids, srcs = [p[0][0] for p in pairs], [p[1] for p in pairs]
            tangled = [p for p in pairs if ids.count(p[0][0]) > 1 and srcs.count(p[1]) > 1]
            least = {}
            for p in tangled:
                least[p[0][0]] = min(least.get(p[0][0], p[2]), p[2])
            pairs = [p for p in pairs if p not in tangled or p[2] == least[p[0][0]]]
        before = {s: list(m) for s, m in sources.items()}
        taken, links = set(), {}
        for r, s, d in sorted(pairs, key=lambda p: (p[1], p[2], p[0][0])):
            target = s
            if s in taken:
                n += 1
                target = n
                sources[n] = list(before[s])
                related |= {(s, n), (n, s)}
            taken.add(s)
            sources[target] = sources[target] + [r]
            links.setdefault(r[0], []).append(target)
        for group in links.values():
            related |= {(a, b) for a in group for b in group if a != b}
        for r in todo:
            if r[0] not in links:
                n += 1
                sources[n] = [r]
    return {(s, r[0]) for s, members in sources.items() for r in members}, related


@pytest.mark.parametrize("method", ["basic", "advanced"])
def test_whole_runs_agree_with_brute_force(spark, method):
    rows = random_run(spark)
    expected, related = brute_force(rows, 3.0 / 3600, method)
    out = A.associate(frame(spark, rows, MEAS), images_of(spark, 1, 2, 3), RunSettings(method=method, radius=3.0))
    assert set(rows_of(out.associations, "source", "meas_id")) == expected
    assert set(rows_of(out.relations, "from_source_id", "to_source_id")) == related


@pytest.mark.parametrize("method", ["deruiter"])
def test_adding_images_equals_one_run(spark, method):
    rows = random_run(spark, seed=8)
    m = frame(spark, rows, MEAS)
    settings = RunSettings(method=method, radius=3.0)
    whole = A.associate(m, images_of(spark, 1, 2, 3), settings)
    first = A.associate(m, images_of(spark, 1, 2), settings)
    prior = A.rebuild(first.associations, m, first.relations, images_of(spark, 1, 2))
    later = A.associate(m, images_of(spark, 3), settings, prior)
    assert rows_of(later.associations, "source", "meas_id") == rows_of(whole.associations, "source", "meas_id")
    assert rows_of(later.relations, "from_source_id", "to_source_id") == rows_of(whole.relations, "from_source_id", "to_source_id")


def test_row_order_does_not_matter(spark):
    rows = random_run(spark, seed=3, epochs=2)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    settings = RunSettings(method="advanced", radius=3.0)
    runs = [A.associate(frame(spark, r, MEAS), images_of(spark, 1, 2), settings) for r in (rows, shuffled)]
    assert rows_of(runs[0].associations, "source", "meas_id") == rows_of(runs[1].associations, "source", "meas_id")


def test_groups_do_not_see_each_other(spark):
    rows = [meas(1, 1, 10.0, 0.0), meas(2, 2, 10.0, 0.0), meas(3, 3, 10.0, 0.0)]
    images = frame(spark, [(1, 1, 10.0, 0.0, 0.004, 1), (2, 2, 10.0, 0.0, 0.004, 2), (3, 3, 10.0, 0.0, 0.004, 1)], IMG + ", skyreg_group long")
    out = A.associate(frame(spark, rows, MEAS), images, RunSettings())
    assert rows_of(out.associations, "source", "meas_id") == [(1, 1), (1, 3), (2, 2)]


def test_epoch_duplicates(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(1, 4), rng.uniform(0, 0.003), rng.uniform(0, 0.003), rng.choice([0.1, 0.2, rng.random()]), 1) for i in range(300)]
    # A clump: many rows of several images at one spot.
    rows += [(300 + i, 1 + i % 3, 0.01 + i * 1e-8, 0.01, 0.5 + i * 1e-3, 1) for i in range(60)]
    lim = 2.5 / 3600
    df = frame(spark, rows, "id long, image_id long, ra double, dec double, dist_from_centre double, epoch long")
    from math import asin, cos, degrees, radians, sin, sqrt

    def sep(p, q):
        h = sin(radians(p[3] - q[3]) / 2) ** 2 + cos(radians(p[3])) * cos(radians(q[3])) * sin(radians(p[2] - q[2]) / 2) ** 2
        return degrees(2 * asin(sqrt(h)))

    kept = [r[0] for r in rows if not any(q[1] != r[1] and (q[4], q[0]) < (r[4], r[0]) and sep(q, r) <= lim for q in rows)]
    assert [r[0] for r in rows_of(drop_epoch_duplicates(df, lim), "id")] == sorted(kept)


def test_epoch_duplicates_take_one_join(spark):
    """Rows are dealt once and their rivals once; a row without a position is nobody's duplicate."""
    rows = [(1, 1, 10.0, 0.0, 0.1, 1), (2, 2, 10.0, 0.0, 0.2, 1), (3, 2, None, None, None, 1)]
    df = frame(spark, rows, "id long, image_id long, ra double, dec double, dist_from_centre double, epoch long")
    kept = drop_epoch_duplicates(df, 2.5 / 3600)
    assert [r[0] for r in rows_of(kept, "id")] == [1, 3]
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2


def test_rows_are_prepared_once(spark):
    """Images derived from the measurements are worked out once, and a file holds the rows of one part of an epoch."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    m = frame(spark, [meas(i, 1 + i % 2, 10.0 + i, 0.0) for i in range(20)], MEAS).mapInArrow(count, MEAS)
    images = m.groupBy("image_id").agg(F.first("image_id").alias("epoch"), F.lit(0.0).alias("ra"), F.lit(0.0).alias("dec"), F.lit(0.004).alias("beam_bmaj"))
    A.associate(m, images, RunSettings())
    assert seen.value == 40


def test_id_corrections(spark):
    rows = frame(spark, [(1, [2, 3]), (2, None)], "source long, related array<long>")
    shifted = A.shift_ids(rows, 2, ("source", "related"))
    assert [tuple(r) for r in shifted.orderBy("source").collect()] == [(3, [4, 5]), (4, None)]
    assert [tuple(r) for r in A.shift_ids(rows, 0, ("source", "related")).orderBy("source").collect()] == [(1, [2, 3]), (2, None)]
    grouped = frame(spark, [(1, 1), (1, 2), (2, 1), (3, 1), (3, 5)], "skyreg_group long, source long")
    assert rows_of(A.chain_group_ids(grouped), "skyreg_group", "source") == [(1, 1), (1, 2), (2, 3), (3, 4), (3, 8)]
    done = frame(spark, [(1,), (2,)], "source long")
    r = frame(spark, [(1, 10), (7, 11), (9, 12)], "source long, meas_id long")
    rel = frame(spark, [(1, 7), (9, 7)], "from_source_id long, to_source_id long")
    new_rows, new_rel = A.renumber_added(r, rel, done, 3)
    assert rows_of(new_rows, "source", "meas_id") == [(1, 10), (3, 11), (4, 12)]
    assert rows_of(new_rel, "from_source_id", "to_source_id") == [(1, 3), (4, 3)]


def test_region_groups(spark):
    regions = frame(spark, [(2, 319.652, 0.003, 6.7), (3, 319.652, -6.3, 6.7), (1, 21.8, -73.1, 7.2), (5, 359.9, 0.0, 3.0), (6, 2.0, 0.0, 3.0), (7, 5.0, 0.0, 3.0)], "id long, centre_ra double, centre_dec double, xtr_radius double")
    assert rows_of(group_regions(regions), "id", "skyreg_group") == [(1, 1), (2, 2), (3, 2), (5, 3), (6, 3), (7, 3)]


def test_unknown_method_is_refused():
    with pytest.raises(ValueError):
        RunSettings(method="unknown")


def test_rivals_are_copied_seldom(spark, monkeypatch):
    """Rivals of an epoch's rows are copied into little more than one cube each."""
    from lumitrace.operators import skyjoin

    copies, touched = [], skyjoin.with_cells_touched
    monkeypatch.setattr(skyjoin, "with_cells_touched", lambda *args, **kw: copies.append(touched(*args, **kw)) or copies[-1])
    rng = random.Random(8)
    rows = [(i, i % 3, rng.uniform(0, 360), rng.uniform(-60, 60), rng.random(), 1) for i in range(2000)]
    df = frame(spark, rows, "id long, image_id long, ra double, dec double, dist_from_centre double, epoch long")
    drop_epoch_duplicates(df, 2.5 / 3600)
    assert copies[0].count() < 1.5 * len(rows)


def test_without_new_images_no_measurement_is_read(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = frame(spark, [meas(i, 1, 10.0 + i, 0.0) for i in range(20)], MEAS)
    images = images_of(spark, 1)
    done = A.associate(plain, images, RunSettings(method="basic"))
    again = A.associate(plain.mapInArrow(count, MEAS), images.filter("false"), RunSettings(method="basic"), done)
    assert again is done and seen.value == 0
