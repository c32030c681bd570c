"""Two-epoch pair metrics.

A source with n measurements has n (n - 1) / 2 pairs, so pairs are never
listed for their own sake. Every function here asks for pairs that are
significant, |Vs| >= min_abs_vs, and drops measurements that cannot be part
of one before any pair is formed:

    |Vs(a, b)| = |a - b| / hypot(err_a, err_b)
              <= max(flux_max - a, a - flux_min) / hypot(err_a, err_min)

with flux_min, flux_max and err_min taken over the source. The bound is
exact, so no significant pair is lost. For sources that do not vary it
removes every row, and the join sees nothing of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumitrace.functions.fluxes import m_metric, vs_metric
from lumitrace.settings import DEFAULTS, PAIR_EDGE_MIN_ABS_M, PAIR_EDGE_MIN_ABS_VS
from lumitrace.workspace import materialize

# Rows of one source on one salt of the pair join.
ROWS_PER_SALT = 20_000
# Row pairs of two cells that are formed rather than cut further; bits by which the first and later cells are cut, and where cutting ends.
LEAF, FIRST, STEP, DEEPEST = 4096, 9, 3, 42
# Slack that keeps the pruning safe against rounding.
_SLACK = 1 - 1e-9
# Ratios of the fluxes of a pair that differ by more than this give different |m| after rounding.
_APART = 1e-14

_FLUXES = ["flux_peak", "flux_peak_err", "flux_int", "flux_int_err"]


def _able(kind: str, min_abs_vs: float) -> dict[str, Column]:
    """Whether a row can be the brighter or the fainter end of a significant pair."""
    flux, err = F.col(f"flux_{kind}"), F.col(f"flux_{kind}_err")
    needed = F.hypot(err, F.col(f"_err_{kind}")) * (min_abs_vs * _SLACK)
    return {
        f"_high_{kind}": (flux - F.col(f"_min_{kind}")) >= needed,
        f"_low_{kind}": (F.col(f"_max_{kind}") - flux) >= needed,
    }


def _with_bounds(measurements: DataFrame, kinds: tuple[str, ...], min_abs_vs: float) -> DataFrame:
    bounds = []
    for kind in kinds:
        bounds += [
            F.min(f"flux_{kind}").alias(f"_min_{kind}"),
            F.max(f"flux_{kind}").alias(f"_max_{kind}"),
            F.min(f"flux_{kind}_err").alias(f"_err_{kind}"),
        ]
    per_source = measurements.groupBy("source").agg(*bounds, F.count(F.lit(1)).alias("_n"))
    # Sources whose extremes are not significant against each other have no pair.
    alive = None
    for kind in kinds:
        reach = F.col(f"_max_{kind}") - F.col(f"_min_{kind}") >= F.col(f"_err_{kind}") * (2**0.5 * min_abs_vs * _SLACK)
        alive = reach if alive is None else alive | reach
    per_source = per_source.filter(alive)
    rows = measurements.join(per_source, "source")
    flags = {}
    for kind in kinds:
        flags |= _able(kind, min_abs_vs)
    return rows.withColumns(flags)


def _ends(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Brighter and fainter ends of either flux type joined per source, with their flags.

    Both flux types share one join, so a row travels once a side. Where a
    source has many brighter ends left, they are split over salts and its
    fainter ends copied.
    """
    high, low = "_high_peak OR _high_int", "_low_peak OR _low_int"
    # Only a source of many rows can have many ends: at most one in ROWS_PER_SALT rows is in this list.
    split = rows.filter(F.col("_n") > ROWS_PER_SALT).groupBy("source").agg(F.ceil(F.count_if(F.expr(high)) / ROWS_PER_SALT).alias("_salts"))
    rows = rows.join(F.broadcast(split.filter("_salts > 1")), "source", "left").withColumn("_salts", F.coalesce("_salts", F.lit(1).cast("long")))
    highs = rows.filter(high).withColumn("_salt", F.pmod(F.xxhash64("id"), "_salts"))
    lows = rows.filter(low).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)))
    highs = highs.select("source", "_salt", "_high_peak", "_high_int", *[F.col(c).alias(f"{c}_h") for c in keep])
    lows = lows.select("source", "_salt", "_low_peak", "_low_int", *[F.col(c).alias(f"{c}_l") for c in keep])
    return highs.join(lows, ["source", "_salt"]).drop("_salt")


def significant_pairs(measurements: DataFrame, min_abs_vs: float = DEFAULTS["min_abs_vs"], min_abs_m: float = 0.0) -> DataFrame:
    """Pairs of one source that are significant in peak or integrated flux.

    Ends are ordered by time, then id. `min_abs_m` is applied to the same
    flux type as `min_abs_vs`.
    """
    if min_abs_vs <= 0:
        raise ValueError("min_abs_vs must be positive: the pairs of a source grow with the square of its rows")
    keep = ["id", "datetime", "image_id", *_FLUXES]
    rows = _with_bounds(measurements.select("source", *keep), ("peak", "int"), min_abs_vs)
    # Few rows are left and each is read several times below.
    rows = materialize(rows.filter("_high_peak OR _low_peak OR _high_int OR _low_int"), "ends")

    def listed(kind: str, size=lambda x: x) -> Column:
        vs = size(vs_metric(f"flux_{kind}_h", f"flux_{kind}_l", f"flux_{kind}_err_h", f"flux_{kind}_err_l"))
        m = F.abs(m_metric(f"flux_{kind}_h", f"flux_{kind}_l"))
        return (vs >= min_abs_vs) & ((m >= min_abs_m) if min_abs_m > 0 else F.lit(True))

    # A pair significant in both flux types, whose ends may be the other way
    # round in the second, must be listed once: as peak flux has it.
    peak = F.col("_high_peak") & F.col("_low_peak") & listed("peak")
    integrated = F.col("_high_int") & F.col("_low_int") & listed("int") & ~F.coalesce(listed("peak", F.abs), F.lit(False))
    both = _ends(rows, keep).filter(peak | integrated)
    first = F.struct("datetime_h", "id_h") < F.struct("datetime_l", "id_l")
    sides = {}
    for c in keep:
        sides[f"{c}_a"] = F.when(first, F.col(f"{c}_h")).otherwise(F.col(f"{c}_l"))
        sides[f"{c}_b"] = F.when(first, F.col(f"{c}_l")).otherwise(F.col(f"{c}_h"))
    pairs = both.select("source", *[v.alias(k) for k, v in sides.items()])
    metrics = {}
    for kind in ("peak", "int"):
        a, b = f"flux_{kind}_a", f"flux_{kind}_b"
        metrics[f"vs_{kind}"] = vs_metric(a, b, f"flux_{kind}_err_a", f"flux_{kind}_err_b")
        metrics[f"m_{kind}"] = m_metric(a, b)
    pairs = pairs.withColumns(metrics)
    order = ["source", "id_a", "id_b"] + [f"{c}_{s}" for s in "ab" for c in ("image_id", *_FLUXES)] + list(metrics)
    return pairs.select(*order).withColumnsRenamed({"id_a": "meas_id_a", "id_b": "meas_id_b"})


def _cells(rows: DataFrame, end: str, depth: int) -> DataFrame:
    """Cells of one kind of ends: extent in flux, least error and a row that has it, number of rows."""
    p = end[0]
    found = _with_cell(rows.filter(f"_{end}"), p, depth).groupBy("source", *_cell_keys(p)).agg(
        F.min("_f").alias(f"{p}_min"),
        F.max("_f").alias(f"{p}_max"),
        F.min(F.struct("_e", "_f")).alias("_row"),
        F.count(F.lit(1)).alias(f"{p}_n"),
        F.max("_e").alias(f"{p}_worst"),
    )
    return found.withColumns({f"{p}_e": F.col("_row._e"), f"{p}_f": F.col("_row._f")}).drop("_row")


def _cell_keys(p: str) -> list[str]:
    return [f"{p}_sign", f"{p}_cell"]


def _with_cell(rows: DataFrame, p: str, depth: int) -> DataFrame:
    cell = F.least(F.floor(F.col("_place") * 2**depth), F.lit(2**depth - 1))
    return rows.withColumns({f"{p}_sign": F.col("_sign"), f"{p}_cell": cell})


def _candidate_cells(rows: DataFrame, min_abs_vs: float) -> list[tuple[int, DataFrame]]:
    """Pairs of cells that may hold the winning pair of a source, by depth: branch and bound.

    Ends lie in cells of flux per source and sign. A pair of cells leaves when
    no pair of its rows can be significant, or none can have an |m| as large
    as that of a significant pair already met in the source. Cells with more
    than LEAF row pairs between them are cut finer. |m| of ends of one sign
    grows with the brighter and falls with the fainter flux; across signs it
    is larger the closer the absolute values are, and without bound where
    those of two cells overlap.
    """
    kept, floors, depth, step, open_ = [], [], 0, FIRST, None
    promising = F.expr("_floor IS NULL OR _top >= _floor * (1 - 1e-12)")
    while True:
        high, low = _cells(rows, "high", depth), _cells(rows, "low", depth)
        if open_ is None:
            # Three signs on either side at most.
            pairs = high.join(low, "source")
        else:
            for p, cells in (("h", high), ("l", low)):
                cells = cells.withColumn("_parent", F.shiftright(F.col(f"{p}_cell"), step))
                open_ = open_.withColumnRenamed(f"{p}_cell", "_parent").join(cells, ["source", f"{p}_sign", "_parent"]).drop("_parent")
            pairs = open_
        needed = F.hypot("h_e", "l_e") * (min_abs_vs * _SLACK)
        pairs = pairs.filter((F.col("h_max") - F.col("l_min") >= needed) & (F.col("h_max") > F.col("l_min")))
        across = (F.col("h_sign") > 0) & (F.col("l_sign") < 0)
        overlap = (F.col("h_min") <= -F.col("l_min")) & (-F.col("l_max") <= F.col("h_max"))
        closest = F.when(F.col("h_min") > -F.col("l_min"), m_metric("h_min", "l_min")).otherwise(m_metric("h_max", "l_max"))
        top = F.when(across & overlap, F.lit(float("inf"))).when(across, F.abs(closest)).otherwise(F.abs(m_metric("h_max", "l_min")))
        seen = F.when(vs_metric("h_f", "l_f", "h_e", "l_e") >= min_abs_vs, F.abs(m_metric("h_f", "l_f")))
        pairs = materialize(pairs.withColumns({"_top": top, "_seen": seen}), "cells")
        floors.append(pairs.groupBy("source").agg(F.max("_seen").alias("_floor")))
        floor = reduce(DataFrame.unionByName, floors).groupBy("source").agg(F.max("_floor").alias("_floor"))
        one_point = "h_min = h_max AND l_min = l_max AND h_e = h_worst AND l_e = l_worst"
        small = F.expr(f"h_n * l_n <= {LEAF} OR ({one_point})") | F.lit(depth >= DEEPEST)
        keys = ["source", *_cell_keys("h"), *_cell_keys("l")]
        kept.append((depth, pairs.filter(small).select(*keys, "_top", "h_n", "l_n")))
        if pairs.filter(~small).isEmpty():
            break
        large = pairs.filter(~small).join(floor, "source").filter(promising)
        open_ = materialize(large.select(*keys), "open")
        step = STEP if depth else FIRST
        depth += step
    # What was kept early is held against the best pair met since.
    return [(d, pairs.join(floor, "source").filter(promising).drop("_floor")) for d, pairs in kept]


def _placed(rows: DataFrame) -> DataFrame:
    """Adds `_sign` and `_place`, 0 to 1 by the logarithm of the absolute flux, which is -745 to 710 for any double."""
    log = F.coalesce(F.log(F.nullif(F.abs("_f"), F.lit(0.0))), F.lit(-745.0))
    return rows.withColumns({"_sign": F.signum("_f").cast("int"), "_place": (log + 745.0) / 1456.0})


def _undominated(rows: DataFrame) -> DataFrame:
    """Drop ends that cannot be in the pair with the largest |m|.

    Against any end of its own sign, a brighter high end with no larger error
    gives a larger |m| and a larger |Vs|, and so does a fainter low end. Fluxes
    so close that |m| may be rounded to one value beat nothing, as ids decide
    between equal |m|: the ratio of the fluxes must differ by more than _APART
    against the end where it differs least. Ends
    that may also meet the other sign, or a flux of 0, are left. Rows beaten
    inside their own salt are unmarked; a salt holds at most about
    ROWS_PER_SALT rows, so its window is bounded.
    """
    salts = F.ceil(F.col("_n") / ROWS_PER_SALT)
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64("id"), salts))
    chunk = Window.partitionBy("source", "_sign", "_chunk")
    before = (Window.unboundedPreceding, -1)
    e, f = F.col("_e"), F.col("_f")
    brighter = F.min(F.struct(e.alias("e"), (-f).alias("f"))).over(chunk.orderBy(f.desc(), e.desc()).rowsBetween(*before))
    fainter = F.min(F.struct(e.alias("e"), f.alias("f"))).over(chunk.orderBy(f.asc(), e.desc()).rowsBetween(*before))
    rows = rows.withColumns({"_brighter": brighter, "_fainter": fainter})

    def beaten(best: str, gain: Column, among: Column) -> Column:
        return F.coalesce(among & (F.col(f"{best}.e") <= e) & (gain > _APART), F.lit(False))

    least, most, positive = F.col("_least"), F.col("_most"), F.col("_sign") > 0
    alone_high = (F.col("_sign") < 0) | (positive & (least > 0))
    alone_low = positive | ((F.col("_sign") < 0) & (most < 0))
    # By how much the ratio of fainter to brighter absolute flux falls, against the end where it falls least.
    up, down = -F.col("_brighter.f"), F.col("_fainter.f")
    gain_high = F.when(positive, F.try_divide(least, f) - F.try_divide(least, up)).otherwise(F.try_divide(f, least) - F.try_divide(up, least))
    gain_low = F.when(positive, F.try_divide(f, most) - F.try_divide(down, most)).otherwise(F.try_divide(most, f) - F.try_divide(most, down))
    flags = {"_high": F.col("_high") & ~beaten("_brighter", gain_high, alone_high), "_low": F.col("_low") & ~beaten("_fainter", gain_low, alone_low)}
    return rows.withColumns(flags).filter("_high OR _low").drop("_brighter", "_fainter", "_chunk", "_n", "_least", "_most")


def most_significant_pair(measurements: DataFrame, kind: str, min_abs_vs: float = DEFAULTS["min_abs_vs"]) -> DataFrame:
    """|Vs| and |m| of the pair with the largest |m| among the significant ones, for fluxes of any sign.

    Pairs are formed in cells that can hold the winner only, and folded
    map-side. Ties go to the smaller (a, b) ids in time order; pairs that tie
    for the first place are all formed, as between many rows of one flux and
    error, or with an end whose flux is exactly 0.
    """
    if min_abs_vs <= 0:
        raise ValueError("min_abs_vs must be positive")
    flux, err = f"flux_{kind}", f"flux_{kind}_err"
    bounded = _with_bounds(measurements.select("source", "id", "datetime", flux, err), (kind,), min_abs_vs)
    ends = bounded.filter(f"_high_{kind} OR _low_{kind}").select(
        "source", "id", "datetime", F.col(flux).alias("_f"), F.col(err).alias("_e"), F.col(f"_high_{kind}").alias("_high"), F.col(f"_low_{kind}").alias("_low"),
        "_n", F.col(f"_min_{kind}").alias("_least"), F.col(f"_max_{kind}").alias("_most"),
    )
    rows = materialize(_undominated(_placed(ends)), "ends")
    counts = rows.groupBy("source").agg((F.count_if("_high") * F.count_if("_low")).alias("_pairs"))

    def end(name: str, chosen: DataFrame, on: list[str], of: DataFrame) -> DataFrame:
        p = name[0]
        return chosen.join(of.filter(f"_{name}").select(*on, *[F.col(c).alias(f"{c}_{p}") for c in ("id", "datetime", "_f", "_e")]), on)

    few = counts.filter(f"_pairs BETWEEN 1 AND {LEAF}").select("source")
    found = [end("low", end("high", few, ["source"], rows), ["source"], rows)]
    many = counts.filter(f"_pairs > {LEAF}").select("source")
    if not many.isEmpty():
        rows = materialize(rows.join(many, "source", "left_semi"), "ends")
        for depth, pairs in _candidate_cells(rows, min_abs_vs):
            for name in ("high", "low"):
                pairs = end(name, pairs, ["source", *_cell_keys(name[0])], _with_cell(rows, name[0], depth))
            found.append(pairs.select(found[0].columns))
    ends = reduce(DataFrame.unionByName, found).filter("_f_h > _f_l")
    vs = F.abs(vs_metric("_f_h", "_f_l", "_e_h", "_e_l"))
    m = F.abs(m_metric("_f_h", "_f_l"))
    first = F.struct("datetime_h", "id_h") < F.struct("datetime_l", "id_l")
    pairs = ends.select(
        "source",
        vs.alias("_vs"),
        (-m).alias("_neg_m"),
        F.when(first, F.col("id_h")).otherwise(F.col("id_l")).alias("_a"),
        F.when(first, F.col("id_l")).otherwise(F.col("id_h")).alias("_b"),
    ).filter((F.col("_vs") >= min_abs_vs) & F.col("_neg_m").isNotNull())
    best = pairs.groupBy("source").agg(F.min(F.struct("_neg_m", "_a", "_b", "_vs")).alias("_best"))
    return best.select(
        "source",
        F.col("_best._vs").alias(f"vs_abs_significant_max_{kind}"),
        (-F.col("_best._neg_m")).alias(f"m_abs_significant_max_{kind}"),
    )


def pair_aggregates(measurements: DataFrame, min_abs_vs: float = DEFAULTS["min_abs_vs"]) -> DataFrame:
    """Both flux types of `most_significant_pair` per source with any such pair."""
    peak = most_significant_pair(measurements, "peak", min_abs_vs)
    integrated = most_significant_pair(measurements, "int", min_abs_vs)
    names = [f"{m}_abs_significant_max_{k}" for k in ("peak", "int") for m in ("vs", "m")]
    return peak.join(integrated, "source", "full").select("source", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names])


def candidate_edges(pairs: DataFrame, kind: str = "peak") -> DataFrame:
    """Pairs that count as variable in the pair plot."""
    return pairs.filter((F.abs(f"m_{kind}") >= PAIR_EDGE_MIN_ABS_M) & (F.abs(f"vs_{kind}") >= PAIR_EDGE_MIN_ABS_VS))
