"""Ordering without a single-task window: dense indexes, exact quantiles, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumitrace.workspace import materialize


def ordered_table(df: DataFrame, order: list) -> DataFrame:
    """`df` range-partitioned and sorted, written once with each row's place.

    `_part` and `_pos` say where a row landed. They are stored, because a
    second evaluation of the range partitioning could pick other bounds.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ordered.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    return materialize(placed, "ordered")


def number_rows(placed: DataFrame, name: str, start: int | Column = 0) -> DataFrame:
    """Consecutive numbers over a table made by `ordered_table`.

    Counts per partition give each partition its offset. That table has one
    row per partition, which bounds both its window and its broadcast.
    """
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    start = start if isinstance(start, Column) else F.lit(start).cast("long")
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, start + F.col("_offset") + F.col("_pos") - F.col("_first")).drop("_part", "_pos", "_first", "_offset")


def dense_index(df: DataFrame, order: list, name: str = "idx", start: int | Column = 0) -> DataFrame:
    """`start`, `start` + 1, ... in the given order, without a global window."""
    return number_rows(ordered_table(df, order), name, start)


def number_within(df: DataFrame, key: str, order: list, name: str) -> DataFrame:
    """0, 1, 2, ... inside each key, however many rows one key has."""
    indexed = dense_index(df, [key, *order], "_idx")
    firsts = indexed.groupBy(key).agg(F.min("_idx").alias("_start"))
    return indexed.join(firsts, key).withColumn(name, F.col("_idx") - F.col("_start")).drop("_idx", "_start")


#: Equal parts that a range of values is cut into, and values of one part that are sorted as a list.
BINS, FEW = 4096, 4096


def group_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group by radix selection; NULL and NaN values and NULL keys leave.

    A first histogram counts values by sign and half octave, further ones cut
    the part that holds a middle value into BINS. Counts merge before they are
    shuffled; the values themselves are neither sorted nor moved nor stored,
    but read once per histogram. Half octaves hold 2**51 doubles, so at most
    five histograms follow the first. Parts of up to FEW values, or of one
    value however often, end the search.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).dropna(subset=[*keys, "_v"])
    # Logarithms keep the order of their arguments, so a part holds all values between its least and greatest.
    octave = F.least(F.log2(F.abs("_v")), F.lit(1100.0)) + 1100.0
    part = F.when(F.col("_v") == 0, 0).otherwise(F.floor(F.signum("_v") * octave * 2)).cast("long").alias("_part")
    counts = rows.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # A few thousand parts of a group at most.
    up_to = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    both = F.array_distinct(F.array(F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)))
    ranked = counts.withColumns({"_to": up_to, "_total": total}).withColumn("_rank", F.explode(both))
    sought = [*keys, "_rank", "_n", "_lo", "_hi"]

    def holding(found: DataFrame) -> DataFrame:
        before = F.col("_to") - F.col("_n")
        inside = found.filter((before <= F.col("_rank")) & (F.col("_rank") < F.col("_to")))
        return materialize(inside.withColumn("_rank", F.col("_rank") - before).select(*sought), "medians")

    wanted = holding(ranked)
    ended = (F.col("_lo") == F.col("_hi")) | (F.col("_n") <= FEW)
    while True:
        open_ = wanted.filter(~ended)
        if open_.isEmpty():
            break
        spans = open_.select(*keys, "_lo", "_hi").distinct()
        width, past = F.col("_hi") - F.col("_lo"), F.col("_v") - F.col("_lo")
        # Halves where the width of a range is more than a double holds.
        place = F.when(width < float("inf"), past / width).otherwise((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2))
        inside = rows.join(spans, keys).filter("_v BETWEEN _lo AND _hi").withColumn("_part", F.least(F.floor(place * BINS), F.lit(BINS - 1)))
        of_span = [*keys, "_lo", "_hi"]
        counts = inside.groupBy(*of_span, "_part").agg(F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        counts = counts.withColumn("_to", F.sum("_in").over(Window.partitionBy(*of_span).orderBy("_part")))
        finer = open_.drop("_n").join(counts, of_span).select(*keys, "_rank", F.col("_in").alias("_n"), F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), "_to")
        wanted = materialize(wanted.filter(ended).unionByName(holding(finer)), "medians")
    few = wanted.filter("_lo < _hi")
    lists = rows.join(few.select(*keys, "_lo", "_hi").distinct(), keys).filter("_v BETWEEN _lo AND _hi")
    lists = lists.groupBy(*keys, "_lo", "_hi").agg(F.array_sort(F.collect_list("_v")).alias("_values"))
    picked = few.join(lists, [*keys, "_lo", "_hi"]).select(*keys, F.get("_values", F.col("_rank").cast("int")).alias("_v"))
    same = wanted.filter("_lo = _hi").select(*keys, F.col("_lo").alias("_v"))
    return picked.unionByName(same).groupBy(*keys).agg(F.avg("_v").alias(name))


def prefix_sums(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of `value` over all rows before each row, in two levels: sums of stored ranges, then inside each range."""
    placed = ordered_table(df, order)
    ranges = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = ranges.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_own")).drop("_part", "_pos", "_offset", "_own")


def previous_and_next(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Previous and next id of every row; a row at an end points to itself.

    Neighbours inside a stored range come from a window over it; the ids at
    the edges of ranges, one row per range, are attached to its ends.
    """
    placed = ordered_table(df.select(id_col), [id_col])
    inside = Window.partitionBy("_part").orderBy("_pos")
    near = placed.select(id_col, "_part", F.lag(id_col).over(inside).alias("_prev"), F.lead(id_col).over(inside).alias("_next"))
    edges = placed.groupBy("_part").agg(F.min(id_col).alias("_lo"), F.max(id_col).alias("_hi"))
    ranges = Window.orderBy("_part")
    edges = edges.select("_part", F.lag("_hi").over(ranges).alias("_before"), F.lead("_lo").over(ranges).alias("_after"))
    joined = near.join(F.broadcast(edges), "_part")
    return joined.select(
        id_col,
        F.coalesce("_prev", "_before", id_col).alias("previous_id"),
        F.coalesce("_next", "_after", id_col).alias("next_id"),
    )


def first_by(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row per key in the given order, as a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    pick = F.max if last else F.min
    best = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)


def with_group_values(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Group aggregates on every row, as an aggregation joined back.

    Unlike a window this combines map-side and leaves a hot key to the
    skew-join splitting of AQE.
    """
    values = df.groupBy(*keys).agg(*[value.alias(name) for name, value in aggregates.items()])
    return df.join(values, keys, "left")


def page(df: DataFrame, order: list, number: int, size: int = 100) -> DataFrame:
    """One page of an ordered table; pages start at 1."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)
