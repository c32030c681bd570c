"""Best-fit packing of documents into training sequences, by bin completion.

Lengths are at most the capacity, so their histogram is a bounded table. It is
solved on the driver: the largest length left is completed by undominated
fillings of the space beside it, a filling is used as often as the counts
allow, branches are pruned by the waste they may still have, and a best-fit
solution is the first incumbent. The solution is a list of patterns with
multiplicities; documents find their place by their rank within their length.

Defined results: NULL text is empty (its only id is the end id); an empty
table gives no rows; repeated rows and repeated doc_ids are packed one by one;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumitrace.llm import frames
from lumitrace.workspace import materialize

CAPACITY = 4096
END_ID = 1
#: Words, and runs inside words, whose ids a worker remembers; later ones are cut again each time.
CACHED_WORDS, CACHED_RUNS = 200_000, 500_000
#: Search steps after which the best packing found so far is taken.
SEARCH_STEPS = 20_000
#: Steps in one enumeration of fillings, and fillings tried for one largest document.
FILL_STEPS, FILLINGS = 400, 4

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])


class WordIds:
    """Ids of whole texts, by remembered words.

    The tokenizer drops white space and never joins over it, so a text's ids
    are those of its words. Words of ASCII and Latin letters are cut into runs
    of letters, digits and other signs as the tokenizer cuts them, and runs go
    to its merge table alone; every other word takes the whole tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.end = np.uint32(end_id).tobytes()
        # White space to Python, but not to the tokenizer.
        self.separators = re.compile("[\x1c-\x1f]")
        self.plain = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
        self.run = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
        # Bytes as the characters that stand for them in byte-level vocabularies: printable ones for themselves, the others from 256 on.
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = [b for b in range(256) if b not in set(printable)]
        self.signs = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    @staticmethod
    def _raw(encoding) -> bytes:
        return np.asarray(encoding.ids, dtype="<u4").tobytes()

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else "".join(map(self.signs.__getitem__, run.encode()))
        raw = b"".join([t.id.to_bytes(4, "little") for t in self.merge(spelled)])
        if len(self.runs) < CACHED_RUNS:
            self.runs[run] = raw
        return raw

    def _word(self, word: str) -> bytes:
        if "<|" in word or not self.plain.fullmatch(word):
            raw = self._raw(self.tokenizer.encode(word, add_special_tokens=False))
        else:
            runs = self.runs
            raw = b"".join([runs.get(r) or self._run(r) for r in self.run.findall(word.lower())])
        if len(self.words) < CACHED_WORDS:
            self.words[word] = raw
        return raw

    def ids(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids, the end id last."""
        if not text:
            return self.end
        if self.separators.search(text):
            return self._raw(self.tokenizer.encode(text, add_special_tokens=False)) + self.end
        words = self.words
        return b"".join([words[w] if w in words else self._word(w) for w in text.split()]) + self.end


@cache
def _word_ids(path: str, end_id: int) -> WordIds:
    """One per worker process, as its memory serves all tasks there."""
    return WordIds(path, end_id)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece of at most `capacity` ids: doc_id, piece, start, length, ids_crc32, and its place among pieces of its length in its task."""

    def cut(batches):
        words = _word_ids(tokenizer_path, end_id)
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            for some in frames.chunks(batch):
                rows = []
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    raw = words.ids(text)
                    for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                        ids = raw[at : at + 4 * capacity]
                        length = len(ids) // 4
                        place = seen.get(length, 0)
                        seen[length] = place + 1
                        rows.append((doc_id, piece, at // 4, length, zlib.crc32(ids), part, place))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PIECES.types)], schema=PIECES)

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return frames.arrow_map(wanted, cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: patterns and how often each is used."""
    groups: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        groups[room].append([pattern, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at == len(rooms):
                room, pattern, n = capacity, (), left
            else:
                room = rooms[at]
                pattern, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            each = min(left, room // length)
            used = min(n, left // each)
            put(room - each * length, pattern + (length,) * each, used)
            left -= each * used
            if n > used and pattern:
                put(room, pattern, n - used)
    return [(p, n) for some in groups.values() for p, n in some]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by total length, and by those too long to share one (Martello and Toth's L2)."""
    total = sum(k * n for k, n in counts.items())
    best = -(-total // capacity)
    for small in [0, *sorted(k for k in counts if 2 * k <= capacity)]:
        alone = sum(n for k, n in counts.items() if k > capacity - small)
        halves = [(k, n) for k, n in counts.items() if capacity - small >= k and 2 * k > capacity]
        rest = sum(k * n for k, n in counts.items() if 2 * k <= capacity and k >= small)
        room = sum((capacity - k) * n for k, n in halves)
        best = max(best, alone + sum(n for _, n in halves) + max(0, -(-(rest - room) // capacity)))
    return best


def fillings(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, ...]]:
    """Undominated sets of available lengths that fit into `room`, the fullest first. `lengths` ascend."""
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = 0
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, len(lengths), ())]
    while stack and steps < FILL_STEPS:
        space, below, chosen = stack.pop()
        steps += 1
        top = min(below, bisect_right(lengths, space))
        while top and counts[lengths[top - 1]] <= chosen.count(lengths[top - 1]):
            top -= 1
        if not top:
            # Nothing that may still be chosen fits: dominated if a longer one that was skipped does.
            fit = bisect_right(lengths, space)
            if not any(counts[lengths[i]] > chosen.count(lengths[i]) for i in range(max(0, fit - 3), fit)):
                found.append((space, chosen))
                if space == 0 and sum(1 for s, _ in found if s == 0) >= FILLINGS:
                    break
            continue
        if len(chosen) < 64:
            stack.append((space, top - 1, chosen))
        stack.append((space - lengths[top - 1], top, chosen + (lengths[top - 1],)))
        # The length that closes the gap at once is tried before the others.
        exact = bisect_right(lengths, space) - 1
        if exact < top - 1 and lengths[exact] == space and counts[space] > chosen.count(space):
            stack.append((0, exact + 1, chosen + (space,)))
    found.sort(key=lambda f: (f[0], tuple(-k for k in f[1])))
    return [f for _, f in found[:FILLINGS]] or [()]


def solve(counts: dict[int, int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with multiplicities that use every length as often as it occurs, in as few bins as the search finds."""
    incumbent = best_fit(counts, capacity)
    fewest, least = sum(n for _, n in incumbent), lower_bound(counts, capacity)
    left, total = dict(counts), sum(k * n for k, n in counts.items())
    lengths = sorted(left)
    bins = 0

    def options() -> list[tuple[int, ...]]:
        longest = lengths[-1]
        left[longest] -= 1
        found = [(longest, *f) for f in fillings(lengths, left, capacity - longest)]
        left[longest] += 1
        return found[::-1]

    # A level is the fillings still to try there, and the one in use.
    levels: list[list] = [[options(), None]] if lengths else []
    while levels and steps > 0 and fewest > least:
        steps -= 1
        level = levels[-1]
        if level[1]:
            pattern, n = level[1]
            bins, level[1] = bins - n, None
            for k in pattern:
                if not left[k]:
                    lengths.insert(bisect_right(lengths, k), k)
                left[k] += n
                total += k * n
        if not level[0]:
            levels.pop()
            continue
        pattern = level[0].pop()
        n = min(left[k] // pattern.count(k) for k in set(pattern))
        bins, level[1] = bins + n, (pattern, n)
        for k in pattern:
            left[k] -= n
            total -= k * n
            if not left[k]:
                lengths.remove(k)
        if not lengths:
            if bins < fewest:
                fewest, incumbent = bins, [lv[1] for lv in levels]
        elif bins + -(-total // capacity) < fewest:
            levels.append([options(), None])
    return incumbent


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with sequence_id and offset. See the module for how; ids are not kept, only their checksum."""
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(list(_spans(solve(counts, capacity))), dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    spans = spark.sparkContext.broadcast(table)
    # One row per task and length: the window of a length holds as many rows as there were tasks.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("place"))

    def place(batches):
        length, rank, first, each, offset = spans.value.T
        keys = (length << 44) + rank
        for batch in batches:
            ls, rs = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (ls << 44) + rs, side="right") - 1
            i = rs - rank[at]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            sequence, inside = first[at] + i // each[at], offset[at] + (i % each[at]) * ls
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(inside)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return frames.arrow_map(
        ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def _spans(patterns: list[tuple[tuple[int, ...], int]]):
    """Rows (length, first rank, first sequence, pieces of it per sequence, offset of the first)."""
    used: dict[int, int] = {}
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            yield length, used.get(length, 0), sequence, each, offset
            used[length] = used.get(length, 0) + n * each
            offset += length * each
        sequence += n
