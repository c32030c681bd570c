"""A run that grows with the images that arrive.

Its tables are filed by patches of sky (`lumitrace.sources.patch_store`). A
batch reads the patches that its rows and, with coverage, the sky regions of its
images touch: the state there, and the history of the sources there if it is
needed. It writes these patches and what it adds, so its cost follows the sky it
covers and not the length of the run. It becomes visible with its line in the
log, so one that dies half way has changed nothing, and one that is handed over
twice is left out the second time.

A source's state is filed where the source is; what is added to a source stays
under its home, the patch it had when it was new, so a source that moves keeps
its history in one place.

With `Coverage` a batch also finds the images that should have shown a source,
flags new sources, fills gaps with forced measurements - in new images, and for
new sources in old ones - and replaces the final rows of all sources in the
patches it touched. Forced measurements have negative ids, which rows that
arrive later cannot have. A fork takes over the detections of its parent; its
gaps are filled for itself. Distances to neighbours depend on the whole sky and
are found when the tables are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from lumitrace.operators import association, coverage, finalise, forced
from lumitrace.operators.association import STATE_SCHEMA, Association
from lumitrace.operators.patches import WIDTH, patch, patch_list, patches_within
from lumitrace.operators.ranking import dense_index
from lumitrace.settings import ARCSEC_PER_DEG, RunSettings
from lumitrace.sources.patch_store import Commit, PatchStore
from lumitrace.workspace import materialize, no_rows

_STATE = T.StructType([*STATE_SCHEMA.fields, T.StructField("home", T.LongType())])
_RELATIONS = T.StructType([T.StructField("from_source_id", T.LongType()), T.StructField("to_source_id", T.LongType())])
_ASSOCIATIONS = T.StructType([T.StructField("source", T.LongType()), T.StructField("meas_id", T.LongType()), T.StructField("d2d", T.DoubleType()), T.StructField("dr", T.DoubleType())])
_ISLANDS = T.StructType([T.StructField("image_id", T.LongType()), T.StructField("prefix", T.StringType()), T.StructField("max_id", T.LongType())])


@dataclass(frozen=True)
class Coverage:
    """What a run needs beyond its measurements to fill gaps and flag new sources."""

    regions: DataFrame  # id, centre_ra, centre_dec, xtr_radius
    wcs: DataFrame
    noise_pixels: DataFrame
    fits: DataFrame  # source, image_id, flux, flux_err, chi2
    run_id: int = 1


class Increments:
    """One incremental run under a folder."""

    def __init__(self, spark: SparkSession, root: str, settings: RunSettings, width: float = WIDTH):
        """`width` is that of the patches, the same whenever the folder is opened."""
        self.spark, self.settings, self.width = spark, settings, width
        self.store = PatchStore(spark, root)

    # --- reading

    def load(self) -> Association | None:
        """State and all associations after the last commit."""
        last = self.store.last()
        if last is None:
            return None
        rows = self._curves(last).select("source", F.col("id").alias("meas_id"), "d2d", "dr")
        relations = self.store.added("relations", _RELATIONS, last).distinct()
        return Association(rows, relations, self._state(last).drop("home"), last.numbers["next_id"])

    def tables(self) -> dict[str, DataFrame]:
        """Light curves, relations and, of a run with coverage, final sources after the last commit."""
        last = self.store.last()
        if last is None:
            raise KeyError("nothing has arrived yet")
        out = {"curves": self._curves(last), "relations": self.store.added("relations", _RELATIONS, last).distinct()}
        if "sources" in last.copies:
            out["sources"] = finalise.with_neighbours(self.store.copies("sources", None, last))
        return out

    def _state(self, last: Commit | None, patches: list[int] | None = None) -> DataFrame:
        return self.store.copies("state", _STATE, last, patches)

    def _schema(self) -> StructType:
        """Columns of the light curves, which depend on the rows that arrive."""
        stored = self.spark.read.parquet(self.store._found("shape")[0]).schema
        return stored

    def _curves(self, last: Commit, homes: list[int] | None = None) -> DataFrame:
        return self.store.added("curves", self._schema(), last, homes)

    # --- one batch

    def _touched(self, rows: DataFrame, arrived: DataFrame, extra: Coverage | None) -> list[int]:
        """Patches within the search radius of the rows, and those that the images' regions reach."""
        if self.settings.method == "deruiter":
            widest = arrived.agg(F.max("beam_bmaj")).first()[0] or 0.0
            reach = self.settings.beamwidth_limit / 2 * widest
        else:
            reach = self.settings.radius / ARCSEC_PER_DEG
        touched = set(patch_list(patches_within(rows, "ra", "dec", reach, self.width)))
        if extra is not None:
            discs = extra.regions.join(arrived.select(F.col("skyreg_id").alias("id")).distinct(), "id", "left_semi")
            touched |= set(patch_list(patches_within(discs, "centre_ra", "centre_dec", F.col("xtr_radius"), self.width)))
        return sorted(touched)

    def process(self, rows: DataFrame, batch: int, images: DataFrame, extra: Coverage | None = None) -> None:
        """Add the images that have rows in this batch, after all earlier batches."""
        last = self.store.last()
        if (last and batch <= last.batch) or rows.isEmpty():
            return
        rows = materialize(rows, "arrived")
        if extra is not None and "forced" not in rows.columns:
            rows = rows.withColumn("forced", F.lit(False))
        if "datetime" not in images.columns:
            images = images.withColumn("datetime", F.lit(None).cast("timestamp"))
        arrived = images.join(rows.select("image_id").distinct(), "image_id", "left_semi")
        arrived = materialize(arrived, "images")
        touched = self._touched(rows, arrived, extra)
        state = materialize(self._state(last, touched), "state-before")

        taken: list[DataFrame] = []

        def earlier(asked: DataFrame) -> DataFrame:
            parents = state.join(asked, "source", "left_semi")
            held = self._curves(last, patch_list(parents, "home")).join(parents.select("source"), "source", "left_semi")
            taken.append(held.filter("NOT forced") if "forced" in held.columns else held)
            return taken[0].select("source", F.col("id").alias("meas_id"), "d2d", "dr")

        prior = None
        if last:
            none = no_rows(self.spark, _ASSOCIATIONS)
            prior = Association(none, no_rows(self.spark, _RELATIONS), state.drop("home"), last.numbers["next_id"])
        result = association.associate(rows, arrived, self.settings, prior, only_new=True, earlier=earlier if last else None)

        relations = materialize(result.relations, "relations")
        after = self._filed(result.state, state)
        moved = sorted(set(patch_list(after)) - set(touched))
        others = self._filed(self._state(last, moved).drop("home"), self._state(last, moved))
        curves = finalise.light_curves(result.associations, rows, arrived)
        if taken:
            old = taken[0].drop("source", "d2d", "dr").dropDuplicates(["id"])
            curves = curves.unionByName(result.associations.withColumnRenamed("meas_id", "id").join(old, "id").select(*curves.columns))
        if extra is not None:
            # Read several times.
            curves = materialize(curves, "curves")
        homes = after.select("source", F.col("home").alias("patch"))
        commit = Commit(batch, dict(last.copies) if last else {}, {"next_id": result.next_id, "next_forced": last.numbers["next_forced"] if last else 1})

        if extra is not None:
            curves, final = self._covered(extra, last, commit, state, curves, relations, images, arrived)
            placed = final.join(after.select("source", "patch"), "source")
            if last and moved:
                kept = self.store.copies("sources", None, last, moved) if any(p in last.copies.get("sources", {}) for p in moved) else None
                if kept is not None:
                    placed = placed.unionByName(kept.join(others.select("source", "patch"), "source"))
            self._replace("sources", placed, commit, touched + moved)
        self.store.add("curves", curves.join(homes, "source"), batch)
        if not self.store._found("shape"):
            curves.limit(0).coalesce(1).write.parquet(f"{self.store.root}/shape")
        ends = relations.join(homes.withColumnRenamed("source", "from_source_id"), "from_source_id")
        self.store.add("relations", ends, batch)
        self.store.put("images", arrived.select("image_id"), batch)
        self._replace("state", after.unionByName(others), commit, touched + moved)
        self.store.commit(commit)

    def _filed(self, rows: DataFrame, before: DataFrame) -> DataFrame:
        """State rows with their patch, and their home from before or, of new sources, the same patch."""
        spots = association.positions(rows).select("source", patch("src_ra", "src_dec", self.width).alias("patch"))
        homes = before.select("source", F.col("home"))
        joined = rows.join(spots, "source").join(homes, "source", "left")
        return materialize(joined.withColumn("home", F.coalesce("home", "patch")).select(*_STATE.fieldNames(), "patch"), "state-after")

    def _replace(self, name: str, rows: DataFrame, commit: Commit, patches: list[int]) -> None:
        """Write the touched patches of a replaced table anew and note where their copies are."""
        written = self.store.replace(name, rows, commit.batch)
        kept = {p: b for p, b in commit.copies.get(name, {}).items() if p not in patches}
        commit.copies[name] = kept | {p: commit.batch for p in written}

    def _covered(
        self, extra: Coverage, last: Commit | None, commit: Commit, state: DataFrame, added: DataFrame, relations: DataFrame, images: DataFrame, arrived: DataFrame
    ) -> tuple[DataFrame, DataFrame]:
        """What the batch adds to light curves, forced rows included, and the final rows of all sources in the touched patches."""
        settings = self.settings
        curves, done, edges = added, None, relations
        islands = self.store.plain("islands", _ISLANDS, last)
        if last:
            homes = patch_list(state, "home")
            history = self._curves(last, homes).join(state.select("source"), "source", "left_semi")
            # The whole history is written, so only what is made use of here.
            used = [c for c in added.columns if c in finalise.CURVE_COLUMNS]
            curves = materialize(history.select(*used).unionByName(added.select(*used)), "curves")
            edges = relations.unionByName(self.store.added("relations", _RELATIONS, last, homes)).distinct()
            done = self.store.plain("images", T.StructType([T.StructField("image_id", T.LongType())]), last)
        so_far = arrived if done is None else images.join(done, "image_id", "left_semi").unionByName(arrived.select(*images.columns))
        so_far = materialize(so_far, "images")
        seen = curves.filter("NOT forced")
        missing = materialize(coverage.missing_images(seen, so_far, extra.regions), "missing")
        new = coverage.new_sources(missing, seen, so_far, extra.wcs, extra.noise_pixels, settings.new_source_min_sigma, settings.monitor_edge_buffer)
        new = materialize(new, "new")

        gaps = missing if done is None else forced.candidates_when_adding(missing, done, state.select("source"))
        wanted = forced.forced_candidates(gaps, seen, so_far, settings.monitor_min_sigma)
        usable = materialize(forced.clean_fits(extra.fits).join(wanted.select("source", "image_id"), ["source", "image_id"], "left_semi"), "usable")
        first = forced.island_maxima(added, arrived)
        known = islands.unionByName(first.select(*_ISLANDS.fieldNames())).groupBy("image_id").agg(F.min("prefix").alias("prefix"), F.max("max_id").alias("max_id"))
        rows = forced.complete_forced(usable, wanted.select("source", "wavg_ra", "wavg_dec").distinct(), so_far, known, settings, extra.run_id)
        rows = dense_index(rows, ["image_id", "source"], "id", commit.numbers["next_forced"]).withColumn("id", -F.col("id"))
        rows = materialize(rows.join(so_far.select("image_id", "epoch", "datetime"), "image_id"), "forced")
        commit.numbers["next_forced"] += rows.count()
        # Island numbers go on after those given in this batch.
        given = rows.groupBy("image_id").agg(F.count(F.lit(1)).alias("_given"))
        numbered = arrived.select("image_id").unionByName(given.select("image_id")).distinct().join(given, "image_id", "left")
        numbered = known.join(numbered, "image_id").select("image_id", "prefix", (F.col("max_id") + F.coalesce("_given", F.lit(0))).alias("max_id"))
        self.store.put("islands", numbered, commit.batch)

        added = materialize(forced.append_forced(added, rows).select(*added.columns), "added")
        whole = forced.append_forced(curves, rows).select(*curves.columns)
        return added, materialize(finalise.final_sources(whole, edges, new, settings, neighbours=False), "sources")

    # --- arrival

    def start(
        self, measurements_root: str, schema: StructType, images: DataFrame, checkpoint: str, max_files: int | None = None, extra: Coverage | None = None
    ) -> StreamingQuery:
        """Process all files present and stop; run again for files that came later.

        Files of one image must land together, and images in time order;
        late images count as later epochs.
        """
        reader = self.spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        stream = reader.parquet(measurements_root)
        writer = stream.writeStream.foreachBatch(lambda rows, batch: self.process(rows, batch, images, extra))
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
