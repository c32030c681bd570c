"""Copies of equal text."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lumitrace.llm import exact_duplicates
from samples import docs, generator, prose

# What decides where rows meet: all bits, none, and a few, so that different texts share a digest.
MEETS = [exact_duplicates.whole_digest, lambda sha: F.substring(sha, 1, 0), lambda sha: F.expr("cast(ascii(hex(sha)) % 3 as string)")]


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[folded(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(folded(text).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_at_hand():
    rng = generator(11)
    rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "c"), (5, "c"), (None, "q"), (None, "q"), (6, "É"), (7, "é"), (8, "c "), (9, "ab"), (9, "zz"), (10, "\x00"), (11, "İ"), (12, "i̇")]
    long = prose(rng, 60_000)
    rows += [(100, long), (101, long.upper()), (102, long + " ")]
    rows += [(1000 + k, rng.choice(["one text", "One Text", "another"])) for k in range(600)]
    rows += [(2000 + k, prose(rng, 12)) for k in range(300)]
    return rows


@pytest.mark.parametrize("meet", MEETS)
def test_copies(spark, meet):
    rows = rows_at_hand()
    found = exact_duplicates.copies(docs(spark, rows).repartition(7), meet)
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_groups_too_small_to_be_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_duplicates, "HOT_SHARE", 4)
    rows = rows_at_hand()
    assert sorted(map(tuple, exact_duplicates.copies(docs(spark, rows)).collect()), key=str) == expected(rows)


def test_one_row_of_every_text(spark):
    rows = rows_at_hand()
    table = docs(spark, rows)
    left = exact_duplicates.without_copies(table)
    assert left.columns == table.columns
    wanted = {(d, t) for d, _, _, kept, t in expected(rows) if kept}
    assert sorted(((r["doc_id"], hashlib.sha256(folded(r["text"]).encode()).hexdigest()) for r in left.collect()), key=str) == sorted(wanted, key=str)


def test_empty_table(spark):
    none = docs(spark, [(1, "a")]).limit(0)
    assert exact_duplicates.copies(none).collect() == []
    assert exact_duplicates.without_copies(none).collect() == []


def test_no_python_in_the_plan(spark):
    plan = exact_duplicates.copies(docs(spark, rows_at_hand()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
