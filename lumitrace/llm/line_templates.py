"""Line dedup with a log-template tree.

A line is parsed to fixed depth: its number of tokens, its leading tokens, then
the rest in SEGMENTS segments. Tokens with a digit are variable fields and read
as `<*>`, unless they are most of the line. That gives the line's own template and, for lines of LONG tokens or
more, one template for each segment taken as a variable field as a whole. A
template recurs if it stands in at least MIN_DOCUMENTS documents, or MIN_LONG
for lines of PASSAGE tokens or more, which do not meet by chance; lines of
MIN_TOKENS or more tokens that have a recurring template are dropped.

Copies of a document count as one document, else every line of a copied page
would recur. Copies are what `near_duplicates` links among the texts that hold a
template met in enough texts: texts whose word shingles agree, directly or
through other such texts. Pages that share lines but are not near copies as a
whole are different documents.

Defined results: NULL text stays NULL with no lines; an empty text is one
line, which is never dropped; a table without rows gives none; repeated rows are
copies; NULL doc_ids take part; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames, near_duplicates, words
from lumitrace.workspace import materialize

LEADING = 2
SEGMENTS = 4
MIN_TOKENS = 3
LONG = 12
MIN_DOCUMENTS = 5
PASSAGE = 20
MIN_LONG = 2

_DIGIT = re.compile(r"\d")
#: Texts that this does not match, told of a whole batch at once, have no digit.
_MAY_HAVE_DIGIT = r"[0-9]|[^\x00-\x7F]"


def _masked(tokens: list[str]) -> list[str]:
    """Tokens with variable fields as `<*>`; a line of little but variable fields has no template and stands for itself."""
    masked = [t if t.isalpha() or not _DIGIT.search(t) else "<*>" for t in tokens]
    variable = masked.count("<*>")
    return masked if 2 * variable <= len(masked) and len(masked) - variable >= MIN_TOKENS else tokens


def line_parts(line: str, digits: bool = True) -> tuple[int, list[int]]:
    """Number of tokens and hashes of the parts of a line: of all tokens if they are fewer than LONG, else of the leading ones and of each segment; none for a line with too few tokens."""
    tokens = line.split()
    n = len(tokens)
    if digits and _DIGIT.search(line):
        tokens = _masked(tokens)
    if n < MIN_TOKENS:
        return n, []
    digest, join = xxhash.xxh3_64_intdigest, " ".join
    if n < LONG:
        return n, [digest(join(tokens), n)]
    rest = n - LEADING
    cuts = [0, LEADING, *[LEADING + rest * s // SEGMENTS for s in range(1, SEGMENTS + 1)]]
    return n, [digest(join(tokens[x:y])) for x, y in zip(cuts, cuts[1:])]


def template_keys(sizes: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Keys of the templates of lines of LONG tokens or more, a row per line: all parts, or all but one segment. `parts`: a row of hashes per line."""
    keys = np.empty(parts.shape, np.uint64)
    for variable in range(SEGMENTS + 1):
        key = words.mix(sizes.astype(np.uint64) + np.uint64(variable << 40))
        for k in range(SEGMENTS + 1):
            key = words.mix(key if k and k == variable else key ^ parts[:, k]) + np.uint64(k)
        keys[:, variable] = key
    return keys


def keys_of(sizes: list[int], hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all templates of some lines, and how many each has. `sizes`: tokens of each line, MIN_TOKENS or more; `hashes`: its parts. Keys of lines of PASSAGE tokens are odd, others even."""
    sizes, hashes = np.array(sizes, np.int64), np.array(hashes, np.uint64)
    # A line has as many templates as parts: one, or its own and one for each segment.
    counts = np.where(sizes < LONG, 1, SEGMENTS + 1)
    long = np.flatnonzero(sizes >= LONG)
    at = (np.cumsum(counts) - counts)[long][:, None] + np.arange(SEGMENTS + 1)
    keys = hashes.copy()
    keys[at] = template_keys(sizes[long], hashes[at])
    return keys & ~np.uint64(1) | np.repeat(sizes >= PASSAGE, counts).astype(np.uint64), counts


def line_keys(line: str) -> list[int]:
    """Keys of the line's templates: its own, then those with one segment variable; none for a line with too few tokens."""
    n, parts = line_parts(line)
    return keys_of([n], parts)[0].tolist() if parts else []


def parsed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, n_lines, and (line, key) of each template of each line."""
    def parse(batches):
        for batch in batches:
            for some in frames.chunks(batch):
                texts = some.column("text")
                counts, ends, lines, sizes, hashes = [], [0], [], [], []
                for text, digits in zip(texts.to_pylist(), pc.match_substring_regex(texts, _MAY_HAVE_DIGIT).to_pylist()):
                    own = [] if text is None else text.split("\n")
                    counts.append(len(own))
                    for i, line in enumerate(own):
                        n, parts = line_parts(line, digits)
                        if parts:
                            lines.append(i)
                            sizes.append(n)
                            hashes += parts
                    ends.append(len(hashes))
                keys, each = keys_of(sizes, hashes)
                flat = pa.StructArray.from_arrays([pa.array(np.repeat(np.array(lines, np.int32), each)), pa.array(keys.view(np.int64))], names=["line", "key"])
                templates = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text_key"), pa.array(counts, pa.int32()), templates], names=["doc_id", "text_key", "n_lines", "templates"])

    return frames.arrow_map(frames.keyed(docs), parse, "doc_id long, text_key long, n_lines int, templates array<struct<line: int, key: long>>")


def _candidates(rows: DataFrame, enough) -> DataFrame:
    """doc_id, text_key, line, key of lines with a template that enough rows have; a few others may be among them."""
    keys = rows.select(F.explode(F.array_distinct(F.col("templates.key"))).alias("key"))
    often = materialize(keys.groupBy("key").agg(enough.alias("enough")).filter("enough").select("key"), "often")
    frames.ship(rows.sparkSession)
    few = rows.sparkSession.sparkContext.broadcast(frames.BitFilter.build(often, "key"))

    def pick(batches):
        for batch in batches:
            templates = batch.column("templates")
            flat = templates.flatten()
            sizes = np.diff(templates.offsets.to_numpy())
            hit = np.flatnonzero(few.value.has(flat.field("key").to_numpy(zero_copy_only=False).view(np.uint64)))
            owner = pa.array(np.repeat(np.arange(batch.num_rows), sizes)[hit])
            at = pa.array(hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("text_key").take(owner), flat.field("line").take(at), flat.field("key").take(at)], names=["doc_id", "text_key", "line", "key"]
            )

    picked = frames.arrow_map(rows.select("doc_id", "text_key", "templates"), pick, "doc_id long, text_key long, line int, key long")
    return materialize(picked, "candidates")


def recurring_lines(rows: DataFrame, docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_long: int = MIN_LONG) -> DataFrame:
    """doc_id, text_key, dropped (line numbers) of documents with recurring lines. `rows`: see `parsed`."""
    row = ["doc_id", "text_key"]
    enough = F.count(F.lit(1)) >= F.when(F.col("key").bitwiseAND(1) == 1, min_long).otherwise(min_documents)
    # Most templates stand in one row and leave here, before anything but their keys is shuffled.
    lines = _candidates(rows, enough)
    held = lines.select("text_key", "key").distinct()
    # Groups are no more than texts, so a template in too few texts cannot recur.
    often = held.groupBy("key").agg(enough.alias("enough")).filter("enough").select("key")
    often = materialize(held.join(often, "key", "left_semi"), "often")
    if often.isEmpty():
        return often.select(F.lit(None).cast("long").alias("doc_id"), "text_key", F.array().cast("array<int>").alias("dropped"))
    # Of rows with one text, that of the smallest id speaks for all.
    speaking = lines.join(often.select("text_key").distinct(), "text_key", "left_semi").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    counted = often.join(near_duplicates.groups(docs, among=speaking), "text_key").select("key", "group").distinct()
    recurring = materialize(counted.groupBy("key").agg(enough.alias("enough")).filter("enough").select("key"), "recurring")
    lines = lines.join(recurring, "key", "left_semi")
    return lines.groupBy(*row).agg(F.collect_set("line").alias("dropped"))


def kept_text(text: str = "text", dropped: str = "dropped"):
    """The text without the lines whose numbers are in `dropped`."""
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.array_contains(dropped, i))
    return F.when(F.col(dropped).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))


def dedupe_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_long: int = MIN_LONG) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, text without recurring lines, dropped (sorted line numbers)."""
    rows = materialize(parsed(docs), "lines")
    gone = recurring_lines(rows, docs, min_documents, min_long)
    out = frames.on_key(frames.keyed(docs), gone.hint("shuffle_hash"), ["doc_id", "text_key"])
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return out.select("doc_id", n_lines.alias("n_lines"), F.size(dropped).alias("n_dropped"), kept_text().alias("text"), F.array_sort(dropped).alias("dropped"))


def without_recurring_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_long: int = MIN_LONG) -> DataFrame:
    """`docs` with the recurring lines out of `text`, and n_chars, if there is one, counted anew."""
    gone = recurring_lines(materialize(parsed(docs), "lines"), docs, min_documents, min_long)
    rows = frames.on_key(frames.whole_rows(docs), gone.hint("shuffle_hash"), ["doc_id", "text_key"]).withColumn("text", kept_text())
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("dropped").isNull(), F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return frames.unpacked(rows, docs.columns, **changed)
