"""Association of measurements into sources, epoch by epoch.

The base catalogue is a table of running sums per source (weights, weighted
positions). A step joins one epoch against it, decides which rows keep the
matched source, which fork off it and which are new, numbers the new ones,
and adds the epoch's sums. A fork starts from a copy of its parent's sums, so
no history is copied inside the loop; the measurements a fork inherits are
filled in once at the end, along the chain of parents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumitrace.functions.sky import de_ruiter
from lumitrace.operators.duplicates import drop_epoch_duplicates, with_centre_distance
from lumitrace.operators.ranking import dense_index, number_rows, ordered_table, prefix_sums, with_group_values
from lumitrace.operators.skyjoin import CROWDED, nearest_join, radius_join
from lumitrace.operators.stats import lifted_ra
from lumitrace.settings import ARCSEC_PER_DEG, RunSettings
from lumitrace.workspace import materialize, new_path, no_rows

# Rows of an epoch that one task prepares and one file holds.
ROWS_PER_PART = 100_000
# What a row of an epoch does to the source list.
KEEPS, FORKS, NEW = 0, 1, 2

SUMS = ["sum_w_ew", "sum_ra", "sum_w_ns", "sum_dec"]
STATE_SCHEMA = T.StructType(
    [T.StructField("source", T.LongType()), T.StructField("skyreg_group", T.LongType())]
    + [T.StructField(name, T.DoubleType()) for name in SUMS]
)
ASSOCIATION_COLUMNS = ["source", "meas_id", "d2d", "dr"]


@dataclass(frozen=True)
class Association:
    """Outcome of a run: who belongs to whom, and the catalogue to go on from."""

    associations: DataFrame  # source, meas_id, d2d (arcsec), dr
    links: DataFrame  # from_source_id, to_source_id
    state: DataFrame  # running sums per source
    next_id: int
    classes: DataFrame | None = None  # class_id, source, size: sources related by a shared measurement

    @property
    def relations(self) -> DataFrame:
        """All related pairs. A class of n sources has n squared of them; `links` and `classes` hold the same in n rows."""
        return self.links if self.classes is None else related_pairs(self.links, self.classes)


# --- decisions within one epoch -------------------------------------------------------------


def untangle(pairs: DataFrame, dist: str) -> DataFrame:
    """Resolve many-to-many matches.

    Among pairs whose measurement and whose source both occur in several
    pairs, keep for each measurement the pairs at its smallest distance.
    """
    # A pair of which one end occurs once is not tangled, so only pairs between the ends below can be.
    ends = {k: materialize(pairs.groupBy(k).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(k), f"several-{k}") for k in ("id", "source")}
    tangled = pairs.select("id", "source", dist).join(ends["id"], "id", "left_semi").join(ends["source"], "source", "left_semi")
    tangled = materialize(tangled, "tangled")
    if tangled.isEmpty():
        return pairs
    least = with_group_values(tangled, ["id"], _least=F.min(dist))
    return pairs.join(least.filter(F.col(dist) > F.col("_least")).select("id", "source"), ["id", "source"], "left_anti").select(*pairs.columns)


def mark_forks(pairs: DataFrame, dist: str) -> DataFrame:
    """`kind` per matched pair: the closest pair of a source keeps it, the others fork."""
    marked = with_group_values(pairs, ["source"], _best=F.min(F.struct(dist, "id")))
    return marked.withColumn("kind", F.when(F.col("id") == F.col("_best.id"), KEEPS).otherwise(FORKS)).drop("_best")


def number_sources(rows: DataFrame, next_id: int, order: list[str]) -> tuple[DataFrame, int]:
    """Give forks and new rows consecutive source ids, forks first.

    `rows` has source (NULL for new rows) and kind. Adds `parent` (the forked
    source) and returns the next free id. Only three counts reach the driver.
    """
    placed = ordered_table(rows, ["kind", "source", *order])
    counts = {r["kind"]: r["count"] for r in placed.groupBy("kind").count().collect()}
    shift = next_id - counts.get(KEEPS, 0)
    numbered = number_rows(placed, "_idx", shift)
    out = numbered.withColumns(
        {
            "parent": F.when(F.col("kind") == FORKS, F.col("source")),
            "source": F.when(F.col("kind") == KEEPS, F.col("source")).otherwise(F.col("_idx")),
        }
    ).drop("_idx")
    return out, next_id + counts.get(FORKS, 0) + counts.get(NEW, 0)


def fork_relations(rows: DataFrame) -> DataFrame:
    """A fork and its parent are related both ways."""
    forks = rows.filter("parent IS NOT NULL")
    return forks.select(F.col("parent").alias("from_source_id"), F.col("source").alias("to_source_id")).unionByName(
        forks.select(F.col("source").alias("from_source_id"), F.col("parent").alias("to_source_id"))
    )


def sharing_classes(rows: DataFrame) -> DataFrame:
    """Classes of sources that share a measurement: class_id, source, size, a row per member.

    Measurements with the same sources make one class, named by the smallest
    of their ids. Sets of sources are told apart by their size, their least and
    greatest source and 128 bits of hashes, so no list is collected.
    """
    ends = rows.select("id", "source").distinct()
    same = {"size": F.count(F.lit(1)), "_lo": F.min("source"), "_hi": F.max("source"), "_x": F.bit_xor(F.xxhash64("source")), "_y": F.bit_xor(F.xxhash64("source", F.lit(1)))}
    sets = ends.groupBy("id").agg(*[value.alias(name) for name, value in same.items()]).filter("size > 1")
    named = sets.groupBy(*same).agg(F.min("id").alias("id")).select("id", "size")
    return ends.join(named, "id").select(F.col("id").alias("class_id"), "source", "size")


def related_pairs(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Links and all ordered pairs of members of a class, each once."""
    a = classes.select("class_id", F.col("source").alias("from_source_id"))
    b = classes.select("class_id", F.col("source").alias("to_source_id"))
    pairs = a.join(b, "class_id").filter("from_source_id <> to_source_id").select("from_source_id", "to_source_id")
    return links.select("from_source_id", "to_source_id").unionByName(pairs).distinct()


def sharing_relations(rows: DataFrame) -> DataFrame:
    """Sources that share a measurement are related to each other."""
    classes = sharing_classes(rows)
    return related_pairs(classes.filter("false").select(F.col("source").alias("from_source_id"), F.col("source").alias("to_source_id")), classes)


# --- running sums ---------------------------------------------------------------------------


def contributions(rows: DataFrame) -> DataFrame:
    """Sums that measurements add to their sources."""
    return rows.select(
        "source",
        "skyreg_group",
        F.col("weight_ew").alias("sum_w_ew"),
        (F.col("weight_ew") * lifted_ra("ra")).alias("sum_ra"),
        F.col("weight_ns").alias("sum_w_ns"),
        (F.col("weight_ns") * F.col("dec")).alias("sum_dec"),
    )


def add_sums(*parts: DataFrame) -> DataFrame:
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.groupBy("source", "skyreg_group").agg(*[F.sum(name).alias(name) for name in SUMS])


def positions(state: DataFrame) -> DataFrame:
    """Weighted position and its uncertainty per source."""
    ra = F.col("sum_ra") / F.col("sum_w_ew")
    return state.select(
        "source",
        "skyreg_group",
        F.when(ra >= 360.0, ra - 360.0).otherwise(ra).alias("src_ra"),
        (F.col("sum_dec") / F.col("sum_w_ns")).alias("src_dec"),
        (1.0 / F.sqrt("sum_w_ew")).alias("src_ew"),
        (1.0 / F.sqrt("sum_w_ns")).alias("src_ns"),
    )


# --- one step -------------------------------------------------------------------------------


def match_basic(rows: DataFrame, state: DataFrame, limit_deg: float, n_sources: int | None = None) -> DataFrame:
    """Each measurement with its closest source within the limit."""
    # A catalogue smaller than one crowded cube needs no look for crowded cubes.
    radii = [limit_deg] if n_sources is not None and n_sources <= CROWDED else None
    near = nearest_join(rows, positions(state), limit_deg, "id", "source", right_pos=("src_ra", "src_dec"), by=("skyreg_group",), radii=radii, sparse=True)
    return near.select("id", "source", (F.col("sep") * ARCSEC_PER_DEG).alias("d2d"), F.lit(0.0).alias("dr"))


def match_advanced(rows: DataFrame, state: DataFrame, method: str, limit_deg: float, dr_limit: float) -> DataFrame:
    """All pairs within the row's own limit; for de Ruiter also within `dr_limit`; untangled."""
    right = positions(state)
    pairs = radius_join(right, rows, limit_deg, ("src_ra", "src_dec"), ("ra", "dec"), by=("skyreg_group",), spread_hot=True)
    pairs = pairs.filter("sep <= _limit")
    dr = F.lit(0.0)
    if method == "deruiter":
        dr = de_ruiter("src_ra", "src_dec", "src_ew", "src_ns", "ra", "dec", "uncertainty_ew", "uncertainty_ns")
    pairs = pairs.select("id", "source", (F.col("sep") * ARCSEC_PER_DEG).alias("d2d"), dr.alias("dr"))
    if method == "deruiter":
        pairs = pairs.filter(F.col("dr") <= dr_limit)
    return untangle(materialize(pairs, "pairs"), distance_column(method))


def distance_column(method: str) -> str:
    return "dr" if method == "deruiter" else "d2d"


def associate_epoch(
    rows: DataFrame, state: DataFrame, next_id: int, method: str, limit_deg: float, dr_limit: float
) -> tuple[DataFrame, int]:
    """One epoch against the base catalogue: its rows with source, parent, kind and distances."""
    dist = distance_column(method)
    if method == "basic":
        matched = match_basic(rows, state, limit_deg, next_id - 1)
    else:
        matched = match_advanced(rows, state, method, limit_deg, dr_limit)
    matched = mark_forks(matched, dist)
    full = rows.join(matched, "id", "left").withColumns(
        {
            "kind": F.coalesce("kind", F.lit(NEW)),
            "d2d": F.coalesce("d2d", F.lit(0.0)),
            "dr": F.coalesce("dr", F.lit(0.0)),
        }
    )
    return number_sources(full, next_id, [dist, "_ord", "id"])


def next_state(state: DataFrame, rows: DataFrame) -> DataFrame:
    """Catalogue after an epoch: forks start from their parent's sums, then all rows add theirs."""
    forks = rows.filter("parent IS NOT NULL").select(F.col("source").alias("_child"), "parent")
    copies = forks.join(state, forks["parent"] == state["source"]).select(
        F.col("_child").alias("source"), "skyreg_group", *SUMS
    )
    return add_sums(state, copies, contributions(rows))


# --- history --------------------------------------------------------------------------------


def ancestors(forks: DataFrame) -> DataFrame:
    """Every ancestor of every fork, with the step before which its rows are inherited.

    `forks` has child, parent, step. Rounds double the length of the chains
    followed, so the number of rounds is the logarithm of the longest chain.
    """
    links = materialize(forks.select("child", F.col("parent").alias("ancestor"), F.col("step").alias("before"), F.lit(1).cast("long").alias("depth")), "links")
    span = 1
    parts = [links]
    while True:
        links = reduce(DataFrame.unionByName, parts)
        upper = links.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("_up"), F.col("before").alias("_before"), F.col("depth").alias("_depth"))
        ends = links.filter(F.col("depth") == span)
        longer = ends.join(upper, "ancestor").select(
            "child", F.col("_up").alias("ancestor"), F.col("_before").alias("before"), (F.col("depth") + F.col("_depth")).alias("depth")
        )
        longer = materialize(longer, "links")
        if longer.isEmpty():
            return links
        parts.append(longer)
        span *= 2


def inherit_history(log: DataFrame, forks: DataFrame, since: int = 0, earlier: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The log from step `since` on, plus the rows each fork takes over from its ancestors.

    `log` has source, meas_id, d2d, dr, step. `earlier` gives the associations
    from before the log of the sources it is asked for (`source`).
    """
    chain = ancestors(forks)
    steps = log
    if earlier is not None:
        asked = chain.select(F.col("ancestor").alias("source")).distinct()
        steps = log.unionByName(earlier(asked).select(*ASSOCIATION_COLUMNS, F.lit(0).cast("long").alias("step")))
    rows = steps.select(F.col("source").alias("ancestor"), "meas_id", "d2d", "dr", "step")
    taken = chain.join(rows, "ancestor").filter("step < before")
    own = log.filter(F.col("step") >= since).select(*ASSOCIATION_COLUMNS)
    return own.unionByName(taken.select(F.col("child").alias("source"), "meas_id", "d2d", "dr"))


# --- the run --------------------------------------------------------------------------------


def prepare_rows(measurements: DataFrame, images: DataFrame, settings: RunSettings) -> DataFrame:
    """Measurements of the run, duplicates of multi-image epochs dropped, with all a step needs.

    `images` has image_id, epoch, ra, dec, beam_bmaj and optionally
    skyreg_group. `_ord` is the order new sources are numbered in: RA where
    an epoch has several images, else the id alone. `_parts` is the number
    of tasks that the rows of the epoch ask for.
    """
    # Images without a group share one; the group is a key of joins, where NULL would match nothing.
    group = F.coalesce(F.col("skyreg_group").cast("long"), F.lit(0)) if "skyreg_group" in images.columns else F.lit(0)
    images = images.withColumn("skyreg_group", group.cast("long"))
    # Images may be derived from all measurements; they are needed three times.
    images = materialize(images.select("image_id", "epoch", "skyreg_group", "ra", "dec", "beam_bmaj"), "images")
    if images.isEmpty():
        # Measurements need not be read to find that none is in an image.
        measurements = measurements.limit(0)
    per_epoch = images.groupBy("skyreg_group", "epoch").agg(F.count(F.lit(1)).alias("_images"), F.max("beam_bmaj").alias("_beam"))
    info = images.select("image_id", "epoch", "skyreg_group", "ra", "dec")
    needed = ["id", "image_id", "ra", "dec", "weight_ew", "weight_ns"]
    if settings.method == "deruiter":
        needed += ["uncertainty_ew", "uncertainty_ns"]
    rows = measurements.select(*needed).join(info.drop("ra", "dec"), "image_id")
    rows = materialize(with_centre_distance(rows, info), "rows")
    parts = rows.groupBy("epoch").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_PART).alias("_parts"))
    rows = drop_epoch_duplicates(rows, settings.epoch_duplicate_radius / ARCSEC_PER_DEG, ("skyreg_group", "epoch"))
    if settings.method == "deruiter":
        limit: Column = F.lit(settings.beamwidth_limit / 2) * F.col("_beam")
    else:
        limit = F.lit(settings.radius / ARCSEC_PER_DEG)
    rows = rows.join(per_epoch, ["skyreg_group", "epoch"]).join(parts, "epoch")
    order = F.when(F.col("_images") > 1, F.col("ra")).otherwise(F.lit(0.0))
    return rows.withColumns({"_limit": limit, "_ord": order}).drop("_images", "_beam", "dist_from_centre", "image_id")


def associate(
    measurements: DataFrame,
    images: DataFrame,
    settings: RunSettings,
    prior: Association | None = None,
    only_new: bool = False,
    earlier: Callable[[DataFrame], DataFrame] | None = None,
) -> Association:
    """Associate all epochs of `images` in order, starting from `prior` if given.

    With `prior`, pass only images that are not in it; their epochs are
    processed among themselves, after everything already there. With
    `only_new` the associations and relations returned are those this call
    adds, so that a store can append them. A store that need not read all of
    `prior.associations` passes `earlier`, which gives those of some sources.
    """
    spark = measurements.sparkSession
    rows = prepare_rows(measurements, images, settings)
    prepared = new_path(spark, "epochs")
    # Few files per epoch, and a large epoch over several tasks. Ranges would have all rows prepared twice, to find their bounds first.
    dealt = rows.repartition("epoch", F.pmod(F.xxhash64("id"), "_parts"))
    rows = rows.drop("_parts")
    dealt.select(*rows.columns).write.partitionBy("epoch").parquet(prepared)
    rows = spark.read.schema(rows.schema).parquet(prepared)
    # One number per epoch reaches the driver: the widest search radius.
    limits = rows.groupBy("epoch").agg(F.max("_limit").alias("limit")).orderBy("epoch").collect()

    state = prior.state if prior else no_rows(spark, STATE_SCHEMA)
    next_id = prior.next_id if prior else 1
    log_path = new_path(spark, "log")
    for step, (epoch, limit) in enumerate(limits, 1):
        todo = rows.filter(F.col("epoch") == epoch)
        assigned, next_id = associate_epoch(todo, state, next_id, settings.method, limit, settings.deruiter_radius)
        step_path = f"{log_path}/step={step}"
        assigned.write.parquet(step_path)
        done = spark.read.schema(assigned.schema).parquet(step_path)
        state = materialize(next_state(state, done), "state")

    if not limits:
        if prior is None:
            raise ValueError("no measurements to associate")
        return prior
    log_schema = T.StructType([*assigned.schema.fields, T.StructField("step", T.LongType())])
    log = spark.read.schema(log_schema).parquet(log_path)
    steps = log.select("source", F.col("id").alias("meas_id"), "d2d", "dr", "step")
    links = fork_relations(log)
    classes = materialize(sharing_classes(log), "classes") if settings.method != "basic" else None
    if prior:
        if earlier is None:
            before = prior.associations.select(*ASSOCIATION_COLUMNS, F.lit(0).cast("long").alias("step"))
            steps = before.unionByName(steps)
        if not only_new:
            links = links.unionByName(prior.links)
            if prior.classes is not None:
                classes = prior.classes if classes is None else classes.unionByName(prior.classes)
    forks = log.filter("parent IS NOT NULL").select(F.col("source").alias("child"), "parent", "step")
    # Rows of earlier calls are step 0.
    associations = materialize(inherit_history(steps, forks, 1 if only_new else 0, earlier), "associations")
    return Association(associations, materialize(links.distinct(), "links"), state, next_id, classes)


# --- ids of separate runs of the loop -------------------------------------------------------


def shift_ids(rows: DataFrame, offset: int | Column, columns: tuple[str, ...]) -> DataFrame:
    """Add an offset to id columns; arrays of ids are shifted element by element."""
    types = dict(rows.dtypes)
    offset = F.lit(offset) if isinstance(offset, int) else offset
    changes = {}
    for name in columns:
        if types[name].startswith("array"):
            changes[name] = F.transform(name, lambda x: x + offset)
        else:
            changes[name] = F.col(name) + offset
    return rows.withColumns(changes)


def chain_group_ids(rows: DataFrame) -> DataFrame:
    """Make ids that start at 1 in every group unique: add the maxima of all earlier groups.

    One row per group is summed up; the offsets are joined back.
    """
    tops = rows.groupBy("skyreg_group").agg(F.max("source").alias("_top"))
    offsets = prefix_sums(tops, ["skyreg_group"], "_top", "_earlier").drop("_top")
    joined = rows.join(offsets, "skyreg_group")
    return joined.withColumn("source", F.col("source") + F.col("_earlier")).drop("_earlier")


def renumber_added(rows: DataFrame, relations: DataFrame, done: DataFrame, start: int) -> tuple[DataFrame, DataFrame]:
    """Keep the ids of `done` (source), renumber all others from `start`, and map the relations."""
    fresh = rows.select("source").distinct().join(done, "source", "left_anti")
    mapping = materialize(dense_index(fresh, ["source"], "_new", start), "renumbered")

    def mapped(df: DataFrame, name: str) -> DataFrame:
        names = mapping.select(F.col("source").alias(name), "_new")
        return df.join(names, name, "left").withColumn(name, F.coalesce("_new", name)).drop("_new")

    return mapped(rows, "source"), mapped(mapped(relations, "from_source_id"), "to_source_id")


# --- adding images to a finished run --------------------------------------------------------


def rebuild(associations: DataFrame, measurements: DataFrame, relations: DataFrame, images: DataFrame, classes: DataFrame | None = None) -> Association:
    """The association state of a finished run, from its stored tables. `relations` are all pairs, or links beside `classes`.

    Sums come from measurements that are not forced; forced ones stay in the
    history. Without new images this is also the state to carry on with.
    """
    group = F.coalesce(F.col("skyreg_group").cast("long"), F.lit(0)) if "skyreg_group" in images.columns else F.lit(0)
    info = images.select("image_id", group.cast("long").alias("skyreg_group"))
    rows = associations.select("source", F.col("meas_id").alias("id")).join(measurements.filter("NOT forced"), "id")
    state = materialize(add_sums(contributions(rows.join(info, "image_id"))), "state")
    top = associations.agg(F.max("source")).first()[0] or 0
    return Association(associations.select(*ASSOCIATION_COLUMNS), relations.select("from_source_id", "to_source_id"), state, top + 1, classes)
