"""Secrets in texts, with DataFrame functions only.

Three kinds have a pattern: `assign`, `access` and `hex`. A fourth, `random`,
takes runs of at least RUN token characters with a letter and a digit in them
that no pattern covers and asks whether they look drawn at random. The encoding
is inferred from the characters (hex, base 32, 36, 62 or 64). The battery has a
chi-squared test of a uniform alphabet, a runs test of characters from the
lower and upper half of the alphabet, and a serial correlation test of
neighbours; a run that any of them rejects at LEVEL / 3 is not random.

What passes may still be an ordinary word or name that is too short to be told
apart. Its p-value is the chance that text with the COINCIDENCE of natural
language looks as even as the run does, which falls with the length. Within
each class of lengths (doubling from RUN) these p-values are held to a false
discovery rate of RATE by the Benjamini-Hochberg rule over the whole corpus, on
a histogram of their logarithms.

Defined results: NULL text is empty and has no spans; repeated rows are scanned
one by one; an empty table gives no rows; extra columns are ignored. Places
count code points, the end is exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

# The patterns of the three kinds, and how long the part that counts has to be.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 12
# A run of the class is taken whole from its first place, so a least length inside the pattern drops the same matches as one after it.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

RUN = 20
LEVEL = 0.003
RATE = 0.01
#: Chance that two characters of natural language are the same, and of its words that are spelled with hex digits alone.
COINCIDENCE, HEX_COINCIDENCE = 0.06, 0.2
TOKEN = "[A-Za-z0-9+/_-]{%d,}"
#: Bins of -log10(p) are a tenth wide; everything beyond the last is as good.
BINS = 400

_DIGITS, _UPPER, _LOWER = "0123456789", frames.UPPER, frames.LOWER
# Encodings with their characters in order of value, and the pattern that a run of theirs matches, the narrowest first.
ENCODINGS = [
    ("hex", _DIGITS + "abcdef", "^[0-9a-f]+$"),
    ("HEX", _DIGITS + "ABCDEF", "^[0-9A-F]+$"),
    ("base32", _UPPER + "234567", "^[A-Z2-7]+$"),
    ("base36", _DIGITS + _LOWER, "^[0-9a-z]+$"),
    ("BASE36", _DIGITS + _UPPER, "^[0-9A-Z]+$"),
    ("base62", _DIGITS + _UPPER + _LOWER, "^[0-9A-Za-z]+$"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", "^[0-9A-Za-z_-]+$"),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", "^.*$"),
]


def matches(text: Column, pattern: str) -> Column:
    """(start, end, match) of all matches that do not overlap: what lies between matches tells where they are."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    lengths = F.transform(found, F.length)
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    place = F.transform(found, lambda m, i: F.struct((total(F.slice(gaps, 1, i + 1)) + total(F.slice(lengths, 1, i))).alias("start"), m.alias("match")))
    spans = F.transform(place, lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.length(s["match"])).alias("end"), s["match"].alias("match")))
    none = F.array().cast("array<struct<start: int, end: int, match: string>>")
    return F.when(text.rlike(pattern), spans).otherwise(none)


def normal_below(z: Column) -> Column:
    """P(Z < z), by the rational approximation 26.2.17 of Abramowitz and Stegun below zero, with the tail's leading term far out."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    tail = F.when(x > 6, density / F.greatest(x, F.lit(1.0))).otherwise(density * poly)
    return F.when(z < 0, tail).otherwise(1 - tail)


def encoding(token: Column, values: list) -> Column:
    """The value of the first encoding whose pattern the token matches."""
    out = F.lit(values[-1])
    for (_, _, pattern), value in list(zip(ENCODINGS, values))[-2::-1]:
        out = F.when(token.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def battery(runs: DataFrame, token: str = "token") -> DataFrame:
    """`runs` with encoding, n, p_random (least p-value of the three tests times three) and p_prose."""
    t = F.col(token)
    out = runs.withColumn("encoding", encoding(t, [e[0] for e in ENCODINGS])).withColumn("_letters", encoding(t, [e[1] for e in ENCODINGS]))
    # A character outside the alphabet (both signs of two base 64 variants) is no value: it is left out.
    out = out.withColumn("_size", F.length("_letters").cast("double"))
    chars = F.filter(F.split(t, ""), lambda c: F.length(c) > 0)
    values = F.transform(chars, lambda c: F.call_function("locate", c, F.col("_letters")).cast("double") - 1)
    out = out.withColumn("_values", F.filter(values, lambda v: v >= 0)).withColumn("n", F.size("_values").cast("double"))
    n, size = F.col("n"), F.col("_size")
    counts = F.transform(F.array_distinct("_values"), lambda v: F.size(F.filter("_values", lambda x: x == v)).cast("double"))
    chi = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * size / n - n
    out = out.withColumn("chi", chi)
    df = size - 1
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal.
    z_even = (F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    high = F.transform("_values", lambda v: (v >= size / 2).cast("int"))
    out = out.withColumn("_high", high).withColumn("_up", F.aggregate("_high", F.lit(0), lambda a, x: a + x).cast("double"))
    turns = F.zip_with(F.slice("_high", F.lit(1), F.size("_high") - 1), F.slice("_high", F.lit(2), F.size("_high") - 1), lambda a, b: (a != b).cast("int"))
    runs_n = 1 + F.aggregate(turns, F.lit(0), lambda a, x: a + x)
    up, down = F.col("_up"), n - F.col("_up")
    mean = 2 * up * down / n + 1
    variance = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
    z_runs = F.when((up == 0) | (down == 0), F.lit(9.0)).otherwise((runs_n - mean) / F.sqrt(variance))
    middle = (size - 1) / 2
    products = F.zip_with(F.slice("_values", F.lit(1), F.size("_values") - 1), F.slice("_values", F.lit(2), F.size("_values") - 1), lambda a, b: (a - middle) * (b - middle))
    z_serial = F.aggregate(products, F.lit(0.0), lambda a, x: a + x) / ((size * size - 1) / 12 * F.sqrt(n - 1))
    two_sided = lambda z: 2 * normal_below(-F.abs(z))
    p = F.least(normal_below(-z_even), two_sided(z_runs), two_sided(z_serial))
    excess = size * F.when(size == 16, HEX_COINCIDENCE).otherwise(COINCIDENCE) - 1
    prose = normal_below((F.col("chi") - df - n * excess) / F.sqrt(2 * df + 4 * n * excess))
    return out.withColumn("p_random", F.least(3 * p, F.lit(1.0))).withColumn("p_prose", prose).drop("_letters", "_size", "_values", "_high", "_up")


def length_class(n: Column) -> Column:
    return F.floor(F.log2(n / RUN)).cast("int")


def discoveries(tested: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of `tested` that pass the battery and keep the false discovery rate in their class of lengths."""
    bin_ = F.least(F.floor(-F.log10(F.greatest("p_prose", F.lit(1e-300))) * 10), F.lit(BINS)).cast("int")
    # What the battery rejects was a hypothesis as well, and counts among all of them.
    judged = tested.withColumn("_class", length_class(F.col("n"))).withColumn("_bin", F.when(F.col("p_random") >= LEVEL, bin_).otherwise(F.lit(-1)))
    # At most BINS + 2 rows for each doubling of the length.
    classes: dict[int, dict[int, int]] = {}
    for r in judged.groupBy("_class", "_bin").agg(F.count(F.lit(1)).alias("n")).collect():
        classes.setdefault(r["_class"], {})[r["_bin"]] = r["n"]
    keep = F.lit(False)
    for length, bins in classes.items():
        total, above, least = sum(bins.values()), 0, None
        for b in sorted((b for b in bins if b >= 0), reverse=True):
            above += bins[b]
            # All p-values of a bin count as its largest.
            if total * 10 ** (-b / 10) <= rate * above:
                least = b
        if least is not None:
            keep = keep | ((F.col("_class") == length) & (F.col("_bin") >= least))
    return judged.filter(keep).drop("_class", "_bin")


def _written(kind: str, s: Column) -> Column:
    return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("text"), s["end"].alias("end"))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, base and added: arrays of (start, k: index in KINDS, text: kind:start:end, end), both sorted."""
    rows = frames.keyed(docs).withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(F.arrays_zip(matches(text, ASSIGN).alias("m"), F.when(text.rlike(ASSIGN), values).otherwise(F.array().cast("array<string>")).alias("v")), lambda z: F.length(z["v"]) >= ASSIGN_LENGTH)
    base = F.concat(
        F.transform(assign, lambda z: _written("assign", z["m"])),
        F.transform(matches(text, ACCESS), lambda m: _written("access", m)),
        F.transform(matches(text, HEX), lambda m: _written("hex", m)),
    )
    digit_and_letter = lambda m: m["match"].rlike("[0-9]") & m["match"].rlike("[A-Za-z]")
    tokens = F.filter(matches(text, TOKEN % RUN), digit_and_letter)
    found = rows.select("doc_id", "text_key", F.array_sort(base).alias("base"), tokens.alias("tokens"))
    found = materialize(found, "spans")
    free = F.filter("tokens", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    runs = found.select("doc_id", "text_key", F.explode(free).alias("m")).select("doc_id", "text_key", "m.start", "m.end", F.col("m.match").alias("token")).distinct()
    added = discoveries(materialize(battery(runs), "runs"))
    span = F.struct(F.col("start"), F.col("end"))
    added = added.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(_written("random", span))).alias("added"))
    out = frames.on_key(found.drop("tokens"), added, ["doc_id", "text_key"])
    return out.withColumn("added", F.coalesce("added", F.slice("base", 1, 0)))
