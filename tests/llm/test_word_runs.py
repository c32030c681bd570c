"""Runs of repeated words against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from lumitrace.llm import queries, word_runs
from samples import WORDS, docs, generator, prose


def brute_force(t, least=12):
    """(start, end, period) of all runs."""
    out = []
    for q in range(1, len(t) // 2 + 1):
        i = 0
        while i + q < len(t):
            j = i
            while j + q < len(t) and t[j] == t[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                s = t[i : i + length]
                if all(s[p:] != s[:-p] for p in range(1, q)):
                    out.append((i, i + length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequence(rng):
    letters, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.randrange(130)
    t = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 3:
            a = rng.randrange(n)
            p, stop = 1 + rng.randrange(max(1, (n - a) // 2)), rng.randrange(a, n) + 1
            t[a:stop] = [t[a + (i - a) % p] for i in range(a, stop)]
    kind = rng.random()
    if kind < 0.1:
        # A Fibonacci word has as many runs as words can have, nearly; a Thue-Morse word deceives sums of powers.
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        t = y[:n]
    elif kind < 0.2:
        t = [i.bit_count() % 2 for i in range(n)]
    return t


def runs_of(texts, least=12):
    ids = np.array([w for t in texts for w in t], np.int64)
    found = word_runs.find_runs(ids, np.repeat(np.arange(len(texts)), [len(t) for t in texts]), least)
    return [tuple(r) for r in found.tolist()]


@pytest.mark.parametrize("seed", range(8))
def test_sequences(seed):
    rng = generator(seed)
    for _ in range(40):
        texts = [sequence(rng) for _ in range(rng.randrange(1, 7))]
        wanted, first = [], 0
        for t in texts:
            wanted += [(first + a, first + b, q) for a, b, q in brute_force(t)]
            first += len(t)
        assert runs_of(texts) == wanted


def test_few_candidates_at_once(monkeypatch):
    monkeypatch.setattr(word_runs, "AT_ONCE", 3)
    rng = generator(20)
    for _ in range(20):
        t = sequence(rng)
        assert runs_of([t]) == brute_force(t)


def test_longer_least():
    rng = generator(21)
    for _ in range(40):
        t = sequence(rng)
        assert runs_of([t], 20) == brute_force(t, 20)
    with pytest.raises(ValueError):
        word_runs.periodic_runs(None, 11)


def test_a_long_text():
    rng = generator(22)
    page = [rng.randrange(1000) for _ in range(777)]
    ids = [rng.randrange(5000, 9000) for _ in range(3000)] + [page[i % 777] for i in range(200_000)] + [1] * 50_000
    found = runs_of([ids])
    assert (3000, 203_000, 777) in found and (203_000, 253_000, 1) in found and len(found) == 2


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    shown = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, digest("".join(f"{a},{b - a},{q}\n" for a, b, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark, tmp_path):
    rng = generator(23)
    rows = [(k, prose(rng, rng.randrange(200))) for k in range(150)]
    rows += [(1000 + k, "\t".join(rng.choice(WORDS[: rng.choice([1, 2, 3])]) for _ in range(rng.randrange(90))) + rng.choice([" ", "\n\r", "", "\x0b\x0c"])) for k in range(150)]
    # Spaces that are none here, words that differ in case, odd rows.
    rows += [(2000, "a b " * 30), (2001, "Ab aB " * 20), (2002, None), (2003, ""), (2004, " \n "), (None, "x y z " * 9), (2005, "é é \x00 \x1c " * 10)]
    rows += rows[:5]
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert sum(r[1] for r in map(lambda r: expected(*r), rows)) > 50


def test_spans_and_text(spark):
    row = word_runs.periodic_runs(docs(spark, [(1, "x " + "a b  c " * 5 + "a y")])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 16, 3)] and row["n_words"] == 18 and row["collapsed"] == "x a b c y"


def test_empty_table(spark):
    assert word_runs.periodic_runs(docs(spark, [(1, "a")]).limit(0)).collect() == []


def test_huge_word_and_deep_nesting(spark):
    text = "w" * 1_000_000 + " " + "p q " * 40_000
    row = word_runs.periodic_runs(docs(spark, [(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 80_000, 2)] and math.isclose(len(row["collapsed"]), 1_000_004)
