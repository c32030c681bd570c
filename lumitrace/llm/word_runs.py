"""Runs of periodically repeated words, found in a grammar of the text.

A run is a stretch of words with smallest period q, at least `least` words and
two periods long, that no neighbouring word extends keeping the period.

Texts are worked on in chunks of bounded size. A run of SEED * 2 words or more
holds every SEED words of it twice, so words outside all stretches of SEED words
that their text repeats are left out first; what remains is the same for every
run. Word ids of the rest are compressed by Re-Pair: in each round pairs of
neighbours are replaced by new symbols in order of their frequency, all that do
not touch a more frequent one at once, until no pair occurs twice; what is left
of a stretch is joined pairwise. Every symbol but the words thus stands for two
others, and the boundary between them is looked at once, however often the
symbol occurs: its runs have a period at which the EDGE words before or after
the boundary recur inside the symbol, and reach as far as words agree at that
distance. Found runs are copied to all places where the symbol was put. A run is
whole in the smallest symbol that holds it; pieces of it that other symbols show
have the same period and overlap it by a period or more, and are merged.

How far words agree is read from ranks of stretches of 1, 2, 4 ... words, which
are exact, so no result depends on a hash.

Defined results: NULL text has no words and an empty collapsed text; repeated
rows give a row each; NULL doc_ids are kept; an empty table gives no rows; extra
columns are ignored. Words are compared as they are, case included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumitrace.llm import frames

LEAST = 12
#: A run holds every SEED words of it twice, as it has at least twice as many.
SEED = 6
#: Of the EDGE words before and those after a place inside a run, one recur in it a period away; SEED / 2 at most.
EDGE = 3
#: Candidates (symbol, period) that are held at once.
AT_ONCE = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15


def _ranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, bool]:
    """Numbers of pairs, equal for equal pairs, and whether any pair occurs twice."""
    values, numbers = np.unique(first.astype(np.int64) << 32 | second.astype(np.int64), return_inverse=True)
    return numbers.astype(np.int32), len(values) < len(first)


def repeated(ids: np.ndarray, text: np.ndarray, size: int = SEED) -> np.ndarray:
    """Which words lie in `size` words that occur twice in their text; a few others may be marked, none is missed."""
    n = len(ids) - size + 1
    out = np.zeros(len(ids), bool)
    if n <= 0:
        return out
    total = text[:n].astype(np.uint64) + np.uint64(1)
    for k in range(size):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(_MULTIPLIER) + ids[k : k + n].astype(np.uint64)
    inside = np.flatnonzero(text[:n] == text[size - 1 :])
    order = inside[np.argsort(total[inside], kind="stable")]
    twin = total[order][1:] == total[order][:-1]
    starts = np.zeros(len(ids) + 1, np.int64)
    hit = np.unique(np.concatenate([order[1:][twin], order[:-1][twin]]))
    starts[hit] += 1
    starts[hit + size] -= 1
    return np.cumsum(starts[:-1]) > 0


class Ranks:
    """Ranks of stretches of 1, 2, 4 ... words, up to the length at which no two are equal."""

    def __init__(self, ids: np.ndarray):
        self.n, self.levels = len(ids), [ids.astype(np.int32)]
        step, more = 1, True
        while more and 2 * step <= self.n:
            last = self.levels[-1]
            numbers, more = _ranked(last[: self.n - 2 * step + 1], last[step:])
            self.levels.append(numbers)
            step *= 2

    def grams(self, size: int) -> np.ndarray:
        """Numbers of all stretches of `size` words, equal for equal ones."""
        k = min(size.bit_length() - 1, len(self.levels) - 1)
        out, length = self.levels[k], 1 << k
        while length < size:
            # Two overlapping stretches cover a longer one.
            step = min(length, size - length)
            out, _ = _ranked(out[: self.n - length - step + 1], out[step:])
            length += step
        return out

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many words from i and from j on, i < j, the two agree."""
        i, j = i.copy(), j.copy()
        start = j.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            # At the highest level equal stretches may follow each other.
            while True:
                able = np.flatnonzero(j + step <= self.n)
                able = able[level[i[able]] == level[j[able]]]
                i[able] += step
                j[able] += step
                if k < len(self.levels) - 1 or not len(able):
                    break
        return j - start

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many words before i and before j, i < j, the two agree."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            while True:
                able = np.flatnonzero(i - step >= 0)
                able = able[level[i[able] - step] == level[j[able] - step]]
                i[able] -= step
                j[able] -= step
                if k < len(self.levels) - 1 or not len(able):
                    break
        return start - i


class Grammar:
    """Symbols that stand for two others each, by a place of theirs in the text, and all places where they were put."""

    def __init__(self, ids: np.ndarray, stretch: np.ndarray):
        """`stretch` numbers the stretches of the text; pairs do not cross them."""
        self.place, self.middle, self.end = [], [], []
        self.put_symbol, self.put_place = [], []
        self.count = 0
        symbol, place, size = ids.astype(np.int64), np.arange(len(ids)), np.ones(len(ids), np.int64)
        self.free = int(symbol.max(initial=-1)) + 1
        while True:
            chosen = self._frequent(symbol, stretch)
            if chosen is None:
                break
            symbol, place, size, stretch = self._replace(*chosen, symbol, place, size, stretch)
        while True:
            # Neighbours at even places of what is left of a stretch; each pair is a symbol of its own.
            at = np.arange(len(symbol)) - np.searchsorted(stretch, stretch)
            left = np.flatnonzero((at[:-1] % 2 == 0) & (stretch[:-1] == stretch[1:])) if len(symbol) else np.zeros(0, np.int64)
            if not len(left):
                break
            symbol, place, size, stretch = self._replace(left, np.arange(len(left)), symbol, place, size, stretch)

    @staticmethod
    def _frequent(symbol: np.ndarray, stretch: np.ndarray):
        """Places of the pairs to replace in this round, and the number of each one's pair; None if no pair occurs twice."""
        if len(symbol) < 2:
            return None
        same = (symbol[1:] == symbol[:-1]) & (stretch[1:] == stretch[:-1])
        # In x x x x only every second pair x x can be replaced.
        at = np.arange(len(same))
        begin = np.maximum.accumulate(np.where(same & ~np.concatenate([[False], same[:-1]]), at, 0))
        usable = np.flatnonzero((stretch[1:] == stretch[:-1]) & ~(same & ((at - begin) % 2 == 1)))
        _, pair, count = np.unique(symbol[usable] << 32 | symbol[usable + 1], return_inverse=True, return_counts=True)
        often = count[pair] > 1
        usable, pair = usable[often], pair[often]
        if not len(usable):
            return None
        # More frequent pairs first, ties by number.
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((np.arange(len(count)), -count))] = np.arange(len(count))
        mine = rank[pair]
        touching = usable[1:] == usable[:-1] + 1
        beaten = np.zeros(len(usable), bool)
        beaten[1:] |= touching & (mine[1:] > mine[:-1])
        beaten[:-1] |= touching & (mine[:-1] > mine[1:])
        usable, pair = usable[~beaten], pair[~beaten]
        stay = np.bincount(pair, minlength=len(count))[pair] > 1
        usable, pair = usable[stay], pair[stay]
        return (usable, np.unique(pair, return_inverse=True)[1]) if len(usable) else None

    def _replace(self, left, number, symbol, place, size, stretch):
        """Put symbol `number` for the pairs that begin at `left`."""
        kinds, first = np.unique(number, return_index=True)
        shown = left[first]
        self.place.append(place[shown])
        self.middle.append(place[shown] + size[shown])
        self.end.append(place[shown] + size[shown] + size[shown + 1])
        self.put_symbol.append(number + self.count)
        self.put_place.append(place[left])
        symbol, size = symbol.copy(), size.copy()
        symbol[left] = number + self.free
        size[left] += size[left + 1]
        self.count += len(kinds)
        self.free += len(kinds)
        stay = np.ones(len(symbol), bool)
        stay[left + 1] = False
        return symbol[stay], place[stay], size[stay], stretch[stay]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes in a row: the group of each member, and its place in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


def boundary_runs(grammar: Grammar, ranks: Ranks, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """symbol, start, end and period of the runs inside each symbol that cross its boundary, at the place it is shown by."""
    place, middle, end = (_joined(x) for x in (grammar.place, grammar.middle, grammar.end))
    grams = ranks.grams(EDGE)
    n = len(grams)
    order = np.argsort(grams, kind="stable")
    key = grams[order].astype(np.int64) * (n + 1) + order
    symbols = np.flatnonzero(end - place >= least)
    # The EDGE words after the boundary, and those before it, where the symbol holds them.
    at = np.concatenate([middle[symbols], middle[symbols] - EDGE])
    symbols = np.concatenate([symbols, symbols])
    holds = (at >= place[symbols]) & (at + EDGE <= end[symbols])
    at, symbols = at[holds], symbols[holds]
    gram = grams[at].astype(np.int64) * (n + 1)
    lo = np.searchsorted(key, gram + place[symbols])
    hi = np.searchsorted(key, gram + end[symbols] - EDGE, side="right")
    counts = hi - lo
    found = []
    # Slices of about AT_ONCE candidates; one symbol has at most as many as it has words.
    bounds = np.searchsorted(np.cumsum(counts), np.arange(AT_ONCE, counts.sum() + AT_ONCE, AT_ONCE)) + 1 if len(counts) else []
    for a, b in zip([0, *list(bounds)[:-1]], bounds):
        group, inner = _spread(counts[a:b])
        here, there = at[a:b][group], order[lo[a:b][group] + inner]
        owner = symbols[a:b][group]
        apart = here != there
        here, there, owner = here[apart], there[apart], owner[apart]
        i, j = np.minimum(here, there), np.maximum(here, there)
        q = j - i
        start = np.maximum(i - ranks.behind(i, j), place[owner])
        stop = np.minimum(j + ranks.ahead(i, j), end[owner])
        ok = (start < middle[owner]) & (stop > middle[owner]) & (stop - start >= np.maximum(least, 2 * q))
        found.append(np.unique(np.stack([owner[ok], start[ok], stop[ok], q[ok]], axis=1), axis=0))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    rows = np.unique(np.concatenate(found), axis=0)
    # Multiples of the smallest period show the same stretch.
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return tuple(rows[smallest].T)


def merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (start, end, period): pieces of one period that overlap by the period or more become one."""
    if not len(start):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    # Ends so far inside a period; a shift per period keeps them from looking at earlier ones.
    number = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]]))
    shift = number * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift) - shift
    new = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])])
    first = np.flatnonzero(new)
    return np.stack([start[first], reach[np.append(first[1:], len(start)) - 1], period[first]], axis=1)


def find_runs(ids: np.ndarray, text: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period; `text` numbers the text of each word, in order."""
    marked = np.flatnonzero(repeated(ids, text))
    if not len(marked):
        return np.zeros((0, 3), np.int64)
    words, owner = ids[marked].astype(np.int64), text[marked]
    stretch = np.cumsum(np.concatenate([[0], (np.diff(marked) > 1) | (np.diff(owner) != 0)]))
    # A word of its own between stretches, so that nothing agrees across them.
    gap = np.flatnonzero(np.diff(stretch)) + 1
    origin = np.insert(marked, gap, -1)
    lone = int(words.max()) + 1 + np.arange(len(gap))
    words, stretch = np.insert(words, gap, lone), np.insert(stretch, gap, -1 - np.arange(len(gap)))
    words = np.unique(words, return_inverse=True)[1]
    stretch = np.cumsum(np.concatenate([[0], stretch[1:] != stretch[:-1]]))
    ranks = Ranks(words)
    grammar = Grammar(words, stretch)
    symbol, start, stop, period = boundary_runs(grammar, ranks, least)
    # To all places of each symbol.
    shown = _joined(grammar.place)
    put_symbol, put_place = _joined(grammar.put_symbol), _joined(grammar.put_place)
    order = np.argsort(put_symbol, kind="stable")
    first = np.searchsorted(put_symbol[order], symbol)
    counts = np.searchsorted(put_symbol[order], symbol, side="right") - first
    run, inner = _spread(counts)
    moved = put_place[order][first[run] + inner] - shown[symbol[run]]
    rows = merged(start[run] + moved, stop[run] + moved, period[run])
    begin = origin[rows[:, 0]]
    rows = np.stack([begin, begin + rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _dropped(rows: np.ndarray, n: int) -> np.ndarray:
    """Which of n words a run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, rows[:, 0] + rows[:, 2], 1)
    np.add.at(depth, rows[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _chunk(some: pa.RecordBatch, least: int) -> pa.RecordBatch:
    texts = [(t or b"").split() for t in some.column("text").cast(pa.binary()).to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    words = [w for t in texts for w in t]
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False) if words else np.zeros(0, np.int64)
    rows = find_runs(ids, np.repeat(np.arange(len(texts)), sizes), least)
    gone = _dropped(rows, len(words))
    at = np.searchsorted(rows[:, 0], first)
    touched = np.add.reduceat(np.append(gone, False).astype(np.int64), first[:-1]) * (sizes > 0) if len(texts) else []
    collapsed = []
    for k, t in enumerate(texts):
        if touched[k]:
            t = [w for w, g in zip(t, gone[first[k] : first[k + 1]].tolist()) if not g]
        collapsed.append(b" ".join(t))
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    parts = [pa.array(x, pa.int64()) for x in (rows[:, 0] - first[text], rows[:, 1] - rows[:, 0], rows[:, 2])]
    runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(RUN)))
    return pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(sizes), runs, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and the text less what runs repeat, words joined by a space.

    `least` is the fewest words of a run, 2 * SEED or more.
    """
    if least < 2 * SEED:
        raise ValueError(f"runs of fewer than {2 * SEED} words are not looked for")

    def find(batches):
        for batch in batches:
            for some in frames.chunks(batch):
                yield _chunk(some, least)

    return frames.arrow_map(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), find, _SCHEMA)
