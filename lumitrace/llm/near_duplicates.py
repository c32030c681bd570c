"""Near-duplicate documents by MinHash in one permutation.

A document is the set of its distinct shingles of SIZE words. One hash per
shingle fills bins with their minimum; an empty bin borrows from the first full
one in a random order of its own, the same for all sets (optimal
densification). Bands of ROWS of the BINS coarse bins make buckets: two sets of
similarity 0.75 share none with a chance of (1 - 0.75**4)**32, about 5e-6. Sets
that are equal are one node from the start.

Candidates are stars first: in each bucket the member that meets most others in
all its buckets is the centre, and is compared with the rest, so a group of
near copies costs one comparison each. A bucket whose members are then in one
component is done. In the few others no link may be lost to the star shape, so
members of different components are held against each other, in blocks of at
most BLOCK of a bucket, and only pairs that may be links leave the block, from
the first bucket they share. Sets of up to WHOLE shingles are at hand and
compared exactly. Pairs with a larger one are judged by FINE finer bins of both
sets; sets of 0.75 agree in fewer than asked for with a chance of about 3e-6.
What that lets pass is confirmed on full sets, made from the texts again.

Defined results: a document without words or text has no shingles, is linked
with nothing and kept; one with fewer than SIZE words has its whole sequence as
one shingle; repeated rows are copies of each other; NULL doc_ids take part,
but are never a component's id unless it has no other; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames, words
from lumitrace.operators.components import connected_labels
from lumitrace.workspace import materialize

SIZE = 5
THRESHOLD = 75
BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Bins that only tell how alike two sets are; each keeps two bits.
FINE = 2048
#: Sets of up to so many shingles are compared whole wherever they meet.
WHOLE = 256
BLOCK = 2000
#: Sets that one copy of a text is compared with.
PART = 128
#: Where the order of 128 bins that an empty bin may borrow from is cut: the places between two cuts are looked at at once.
CUTS = (8, 24, 56)


def _orders(bins: int) -> list[np.ndarray]:
    whole = np.array([np.random.default_rng(1000 + b).permutation(bins)[:128] for b in range(bins)])
    return [part.copy() for part in np.split(whole, CUTS, axis=1)]


_EDGES = {n: np.arange(n, dtype=np.uint64) << np.uint64(64 - n.bit_length() + 1) for n in (BINS, FINE)}
_ORDERS = {n: _orders(n) for n in (BINS, FINE)}
_BAND_SEEDS = words.mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def minima(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Minimum of every bin of an ordered, non-empty set of hashes, empty ones filled."""
    first = np.append(np.searchsorted(shingles, _EDGES[bins]), len(shingles))
    full = first[1:] > first[:-1]
    out = np.zeros(bins, dtype=np.uint64)
    out[full] = shingles[first[:-1][full]]
    empty = np.flatnonzero(~full)
    if len(empty):
        rest = empty
        # Most bins find a full one early in their order, so few are looked at to its end.
        for order in _ORDERS[bins]:
            donors = order.take(rest, axis=0)
            hit = full[donors]
            place = np.arange(len(rest)) * order.shape[1] + hit.argmax(axis=1)
            met = hit.ravel().take(place)
            out[rest[met]] = out.take(donors.ravel().take(place[met]))
            rest = rest[~met]
            if not len(rest):
                break
        # No full bin among the first of the order: the next full one after a place of the bin's own.
        filled = np.flatnonzero(full)
        out[rest] = out[filled[np.searchsorted(filled, rest * 7919 % bins) % len(filled)]]
    return out


def buckets(shingles: np.ndarray) -> np.ndarray:
    """Buckets of the bands, signed 64-bit."""
    coarse = (minima(shingles, BINS) & np.uint64(0xFFFF)).astype("<u2").view("<u8")
    return words.mix(words.mix(coarse) ^ _BAND_SEEDS).view(np.int64)


def fine_bins(shingles: np.ndarray) -> bytes:
    """Two bits of every fine bin, packed."""
    f = (minima(shingles, FINE) & np.uint64(3)).astype(np.uint8).reshape(-1, 4)
    return (f[:, 0] | f[:, 1] << 2 | f[:, 2] << 4 | f[:, 3] << 6).tobytes()


_EQUAL = np.array([sum((x >> 2 * k) & 3 == 0 for k in range(4)) for x in range(256)], dtype=np.uint8)


def agreeing(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Fine bins in which packed rows agree."""
    return _EQUAL[one ^ others].sum(axis=-1, dtype=np.int64)


def _rows(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), FINE // 4)


def least_agreement(threshold: int) -> int:
    """Fine bins, of FINE, in which sets that are just similar enough agree, less 4.5 standard deviations."""
    p = threshold / 100
    p += (1 - p) / 4
    return math.floor(FINE * p - 4.5 * math.sqrt(FINE * p * (1 - p)))


def _similar(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= threshold * (len(x) + len(y) - both)


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of an ordered set."""
    place = np.arange(1, len(shingles) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = words.mix(np.array([words.mix(shingles ^ place).sum(dtype=np.uint64)], np.uint64) + np.uint64(len(shingles)))
    return int(total.view(np.int64)[0])


def signatures(docs: DataFrame, size: int = SIZE, among: DataFrame | None = None) -> DataFrame:
    """doc_id, text_key, n_shingles, set_id and buckets of every row; the last two are NULL for empty sets. `among`: of rows whose doc_id and text_key are there, and perhaps a few others."""
    few, rows = None, frames.keyed(docs)
    if among is not None:
        named = F.xxhash64("doc_id", "text_key", F.col("doc_id").isNull()).alias("named")
        few = docs.sparkSession.sparkContext.broadcast(frames.BitFilter.build(materialize(among.select(named), "among"), "named"))
        rows = rows.withColumn("named", named)

    def sign(batches):
        for batch in batches:
            if few is not None:
                batch = batch.filter(pa.array(few.value.has(batch.column("named").to_numpy().view(np.uint64))))
            for some in frames.chunks(batch):
                w = words.Words(some.column("text"), words.SPACED)
                counts, ids, signs = [], [], []
                for i in range(some.num_rows):
                    own = words.shingle_set(w.of(i), size)
                    counts.append(len(own))
                    ids.append(set_hash(own) if len(own) else None)
                    signs.append(buckets(own) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("text_key"), pa.array(counts, pa.int64()), pa.array(ids, pa.int64()), pa.array(signs, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_shingles", "set_id", "buckets"],
                )

    return frames.arrow_map(rows, sign, "doc_id long, text_key long, n_shingles long, set_id long, buckets array<long>")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id and text of the documents named in `wanted` (set_id, doc_id, text_key); others leave before any shuffle."""
    texts = frames.among(docs, wanted)
    # A shuffle lies between the Python that picks rows and the one that reads them: executors keep every worker that their tasks ever used at once.
    return frames.on_key(wanted.hint("shuffle_hash"), texts, ["doc_id", "text_key"], "inner").select("set_id", "text")


def looks(docs: DataFrame, wanted: DataFrame, size: int = SIZE) -> DataFrame:
    """set_id, n, buckets, fine bins and, of sets of up to WHOLE shingles, the shingles themselves."""

    def look(batches):
        for batch in batches:
            for some in frames.chunks(batch):
                w = words.Words(some.column("text"), words.SPACED)
                sets = [words.shingle_set(w.of(i), size) for i in range(some.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("set_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array([buckets(x) for x in sets], pa.list_(pa.int64())), pa.array([fine_bins(x) for x in sets], pa.binary()), pa.array([x.tobytes() if len(x) <= WHOLE else b"" for x in sets], pa.binary())],
                    names=["set_id", "n", "buckets", "fine", "whole"],
                )

    found = frames.arrow_map(_texts(docs, wanted), look, "set_id long, n long, buckets array<long>, fine binary, whole binary")
    return materialize(found.dropDuplicates(["set_id"]), "looks")


NO, MAYBE, YES = 0, 1, 2


def _judged(threshold: int):
    least = least_agreement(threshold)

    def judge(fa: pa.Array, fb: pa.Array, na: pa.Array, nb: pa.Array, wa: pa.Array, wb: pa.Array) -> pa.Array:
        if not len(fa):
            return pa.array([], pa.int32())
        n, m = na.to_numpy(), nb.to_numpy()
        out = np.where((agreeing(_rows(fa.to_pylist()), _rows(fb.to_pylist())) >= least) & (100 * np.minimum(n, m) >= threshold * np.maximum(n, m)), MAYBE, NO)
        for i in np.flatnonzero(np.maximum(n, m) <= WHOLE):
            out[i] = YES if _similar(np.frombuffer(wa[i].as_py(), np.uint64), np.frombuffer(wb[i].as_py(), np.uint64), threshold) else NO
        return pa.array(out.astype(np.int32))

    return judge


class Shared:
    """Numbers of shingles that a set shares with each of some small sets, exact."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]

    def with_(self, one: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.flat, one), np.searchsorted(self.flat, one, side="right")
        counts = hi - lo
        at = np.repeat(lo - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return np.bincount(self.owner[at], minlength=self.n)


def _across(threshold: int):
    """Rows (bucket, i, j, side, set_id, label, n, buckets, fine, whole), sorted by block: pairs of different labels that are or may be similar."""
    least = least_agreement(threshold)

    def pairs(bucket, own, other):
        """own, other: rows of the two sides; the same list for a block against itself."""
        if not own or not other:
            return
        bins = _rows([r["fine"] for r in other])
        labels, n = (np.array([r[c] for r in other]) for c in ("label", "n"))
        bands = np.array([r["buckets"] for r in other])
        small = n <= WHOLE
        # Two small sets are compared exactly, whatever their bins say.
        shared = Shared([np.frombuffer(r["whole"], np.uint64) for r in other])
        for x, row in enumerate(own):
            apart = (labels != row["label"]) & (100 * np.minimum(n, row["n"]) >= threshold * np.maximum(n, row["n"]))
            if own is other:
                apart[: x + 1] = False
            if not apart.any():
                continue
            exact = apart & small & (row["n"] <= WHOLE)
            judged = np.full(len(n), NO)
            if exact.any():
                both = shared.with_(np.frombuffer(row["whole"], np.uint64))
                judged[exact & (100 * both >= threshold * (n + row["n"] - both))] = YES
            at = np.flatnonzero(apart & ~exact)
            if len(at):
                judged[at[agreeing(np.frombuffer(row["fine"], np.uint8), bins[at]) >= least]] = MAYBE
            mine = np.array(row["buckets"])
            for y in np.flatnonzero(judged > NO):
                # The first bucket that both are in speaks for the pair.
                if mine[np.argmax(mine == bands[y])] == bucket:
                    yield row["set_id"], other[y]["set_id"], int(judged[y])

    def compare(batches):
        held, key = [], None

        def flush():
            own = [r for r in held if r["side"] == 0]
            other = [r for r in held if r["side"] == 1] if key[1] != key[2] else own
            found = list(pairs(key[0], own, other))
            return pa.RecordBatch.from_arrays([pa.array([min(p[:2]) for p in found], pa.int64()), pa.array([max(p[:2]) for p in found], pa.int64()), pa.array([p[2] for p in found], pa.int32())], names=["a", "b", "judged"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    now = (r["bucket"], r["i"], r["j"])
                    if key is not None and now != key:
                        yield flush()
                        held = []
                    key = now
                    held.append(r)
        if held:
            yield flush()

    return compare


def links(docs: DataFrame, sets: DataFrame, judged: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) that are judged YES, or MAYBE and similar enough on the full sets of their texts. `sets`: set_id, and doc_id and text_key of one document each."""

    def confirm(batches):
        # Rows of one (b, part) in a row, that of b first.
        key, centre = None, None
        for batch in batches:
            for some in frames.chunks(batch):
                w = words.Words(some.column("text"), words.SPACED)
                ids, bs, parts, sides = (some.column(c).to_pylist() for c in ("a", "b", "part", "side"))
                found = []
                for i in range(some.num_rows):
                    own = words.shingle_set(w.of(i), size)
                    if sides[i] == 0:
                        key, centre = (bs[i], parts[i]), own
                    elif key == (bs[i], parts[i]) and _similar(own, centre, threshold):
                        found.append((ids[i], bs[i]))
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

    judged = materialize(judged.filter(F.col("judged") > NO), "judged")
    maybe = judged.filter(F.col("judged") == MAYBE).select("a", "b")
    wanted = maybe.select(F.col("a").alias("set_id")).union(maybe.select("b")).distinct()
    wanted = materialize(wanted.join(sets, "set_id"), "wanted")
    texts = _texts(docs, wanted)
    # A set that many others are compared with meets them in parts of PART; its text travels once a part.
    parts = maybe.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    placed = maybe.join(parts, "b").select("a", "b", F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part"))
    placed = materialize(placed, "placed")
    others = placed.join(texts.select(F.col("set_id").alias("a"), "text"), "a").select("a", "b", "part", F.lit(1).alias("side"), "text")
    centres = placed.select("b", "part").distinct().join(texts.select(F.col("set_id").alias("b"), "text"), "b").select(F.col("b").alias("a"), "b", "part", F.lit(0).alias("side"), "text")
    both = centres.unionByName(others).repartition("b", "part").sortWithinPartitions("b", "part", "side")
    sure = judged.filter(F.col("judged") == YES).select("a", "b")
    return materialize(frames.arrow_map(both, confirm, "a long, b long").unionByName(sure).distinct(), "links")


def _merged(found: DataFrame) -> DataFrame:
    """set_id, label of all ends of the links (a, b)."""
    ends = found.select(F.col("a").alias("id"), F.col("b").alias("other"))
    ends = ends.unionByName(ends.select(F.col("other").alias("id"), F.col("id").alias("other")))
    return connected_labels(ends.select("id").distinct(), ends).withColumnRenamed("id", "set_id")


def _labelled(docs: DataFrame, size: int, threshold: int, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, the first document of every set, and the label (set_id, label) of every set that is linked."""
    frames.ship(docs.sparkSession)
    signed = materialize(signatures(docs, size, among), "signatures")
    named = signed.filter("set_id IS NOT NULL")
    # A NULL id is the last choice of a set's document.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    sets = materialize(named.groupBy("set_id").agg(least.alias("d")).select("set_id", "d.doc_id", "d.text_key"), "sets")

    distinct = named.groupBy("set_id").agg(F.first("buckets").alias("buckets"))
    filed = distinct.select("set_id", F.explode("buckets").alias("bucket")).repartition("bucket")
    shared = filed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(filed.join(shared, "bucket"), "members")
    seen = looks(docs, materialize(members.select("set_id").distinct().join(sets, "set_id"), "wanted"), size)

    # Stars: the centre of a bucket is the member that meets most others.
    met = members.groupBy("set_id").agg(F.sum("size").alias("met"))
    centres = members.join(met, "set_id").groupBy("bucket").agg(F.max(F.struct("met", "set_id")).alias("c")).select("bucket", "c.set_id")
    stars = members.select("bucket", F.col("set_id").alias("a")).join(centres.withColumnRenamed("set_id", "b"), "bucket").filter("a <> b").select("a", "b").distinct()
    side = {c: seen.select(F.col("set_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("fine", "n", "whole")]) for c in "ab"}
    # Else the filter on what is judged has every pair judged a second time, by a second worker.
    judge = F.arrow_udf(_judged(threshold), "int").asNondeterministic()
    judged = stars.join(side["a"], "a").join(side["b"], "b").select("a", "b", judge("fine_a", "fine_b", "n_a", "n_b", "whole_a", "whole_b").alias("judged"))
    labels = _merged(links(docs, sets, judged, size, threshold))

    # Buckets with several components left: members against those of other components.
    own = members.join(labels, "set_id", "left").select("bucket", "set_id", "size", F.coalesce("label", "set_id").alias("label"))
    left = own.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi AND lo IS NOT NULL").select("bucket")
    # The star of a bucket of two has compared all there is.
    left = materialize(own.join(left, "bucket").filter("size > 2"), "left")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(k, mine).alias("i"), F.greatest(k, mine).alias("j"), (mine > k).cast("int").alias("side")))
    laid = left.select("bucket", "set_id", "label", F.explode(meets).alias("m")).select("bucket", "m.i", "m.j", "m.side", "set_id", "label")
    laid = laid.join(seen, "set_id").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    more = links(docs, sets, frames.arrow_map(laid, _across(threshold), "a long, b long, judged int"), size, threshold)
    if not more.isEmpty():
        name = {c: labels.select(F.col("set_id").alias(c), F.col("label").alias(f"l_{c}")) for c in "ab"}
        between = more.join(name["a"], "a", "left").join(name["b"], "b", "left").select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b")).distinct()
        joined = _merged(between).select(F.col("set_id").alias("label"), F.col("label").alias("whole"))
        # A set that was alone so far is its own label.
        alone = joined.select(F.col("label").alias("set_id"), F.col("whole").alias("label")).join(labels, "set_id", "left_anti")
        labels = materialize(labels.join(joined, "label", "left").select("set_id", F.coalesce("whole", "label").alias("label")).unionByName(alone), "labels")
    return signed, sets, labels


def groups(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD, among: DataFrame | None = None) -> DataFrame:
    """text_key and group of every text with words, each text once: near copies are in one group, whatever their ids. `among`: only of rows with these doc_ids and text_keys."""
    signed, _, labels = _labelled(docs, size, threshold, among)
    named = signed.filter("set_id IS NOT NULL").select("text_key", "set_id").distinct()
    return named.join(labels, "set_id", "left").select("text_key", F.coalesce("label", "set_id").alias("group"))


def components(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id, kept."""
    signed, sets, labels = _labelled(docs, size, threshold)
    named = signed.filter("set_id IS NOT NULL")
    plain = sets.select("set_id", F.col("doc_id").alias("component_id"))
    in_component = sets.select("set_id", "doc_id").join(labels, "set_id")
    smallest = in_component.groupBy("label").agg(F.min("doc_id").alias("smallest"))
    linked = in_component.join(smallest, "label").select("set_id", "smallest")
    plain = plain.join(linked, "set_id", "left").select("set_id", F.coalesce("smallest", "component_id").alias("component_id"))
    out = named.drop("buckets").join(plain, "set_id").select("doc_id", "text_key", "n_shingles", "component_id")
    empty = signed.filter("set_id IS NULL").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """`docs` with one row of every component: that of the smallest id, and among rows of that id one."""
    found = materialize(components(docs, size, threshold), "components")
    dropped = found.filter("NOT kept").select("doc_id", "text_key")
    stay = found.filter("kept AND n_shingles > 0")
    several = stay.groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("n"), F.min("text_key").alias("text_key")).filter("n > 1")
    several = materialize(several.select("doc_id", "text_key"), "several")
    if several.isEmpty():
        return frames.without(docs, dropped)
    # Ids given to more than one row: the row chosen is taken once, all others of the id in a component go.
    repeated = frames.on_key(stay.select("doc_id", "text_key"), several.select("doc_id").distinct(), ["doc_id"], "left_semi")
    rest = frames.without(docs, dropped.unionByName(repeated))
    chosen = frames.on_key(frames.whole_rows(docs), several, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return rest.unionByName(frames.unpacked(chosen, docs.columns))
