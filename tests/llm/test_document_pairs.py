"""Near duplicates and benchmark passages against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from samples import docs, generator, prose

from lumitrace.llm import decontamination, near_duplicates, words


def spaced(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(text):
    w = spaced(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * len(a | sets[j]):
                parent[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=str)


def near_rows():
    rng = generator(4)
    rows = []
    for base in range(14):
        text = prose(rng, rng.choice([3, 5, 8, 40, 120])).split()
        for _ in range(rng.randrange(1, 9)):
            copy = list(text)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(50))
            rows.append((len(rows) * 3 % 101, " ".join(copy)))
    chain = [f"link{i}" for i in range(60)]
    rows += [(200 + i, " ".join(chain[i : i + 50])) for i in range(8)]
    return rows + [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "One"), (305, "one two"), (306, "\x00 two"), (307, "ſ K"), (3, "twice the id"), (None, "no id at all"), (None, "one two")]


def test_components_match_brute_force(spark):
    rows = near_rows()
    found = near_duplicates.components(docs(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_large_group_of_near_copies_is_one_component(spark):
    rng = generator(9)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, "the same text for every one of these documents") for i in range(300)]
    found = near_duplicates.components(docs(spark, rows)).collect()
    assert {r["component_id"] for r in found} == {0, 1000}


def test_dissimilar_sets_in_one_bucket_keep_their_links(spark):
    # One half of all words is shared by all, so buckets hold many sets that are not linked.
    rng = generator(2)
    shared = [f"s{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = [f"t{i}-{k}" for k in range(34)]
        rows.append((2 * i, " ".join(shared + own)))
        rows.append((2 * i + 1, " ".join(shared + own[:-2] + [f"u{rng.random()}"])))
    found = near_duplicates.components(docs(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute_components(rows)


def test_one_of_each_keeps_one_row_and_all_columns(spark):
    table = docs(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (4, "A b c d e f"), (7, "other words are in here"), (8, None), (9, ""), (7, "other words are in here")])
    out = near_duplicates.one_of_each(table)
    assert out.columns == table.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.filter("text IS NOT NULL").collect()) == [(4, "A b c d e f"), (7, "other words are in here"), (9, "")]
    assert out.filter("text IS NULL").count() == 1


def test_empty_tables(spark):
    none = docs(spark, [(1, "x")]).limit(0)
    assert near_duplicates.components(none).count() == 0
    assert decontamination.contamination(none, bench(spark, [(1, "some item text")])).count() == 0
    assert near_duplicates.one_of_each(none).count() == 0


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def item_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(rows, items):
    out = []
    for doc_id, text in rows:
        w = item_words(text)
        hit, found = set(), set()
        for item_id, item in items:
            own = item_words(item)
            k = min(13, len(own))
            if not k or item_id is None:
                continue
            wanted = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)}
            for s in range(len(w) - k + 1):
                if tuple(w[s : s + k]) in wanted:
                    hit.update(range(s, s + k))
                    found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_matches_brute_force(spark, seed):
    rng = generator(seed)
    items = [(i, prose(rng, rng.choice([1, 3, 5, 9, 13, 14, 30]))) for i in range(25)]
    items += [(3, items[4][1]), (40, items[5][1]), (41, items[12][1] + " more"), (None, items[1][1]), (42, None), (43, "!!"), (44, "Straße ÉTÉ 日本 語")]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append(prose(rng, rng.randrange(30)))
            own = item_words(rng.choice(items)[1])
            lo = rng.randrange(len(own) + 1)
            parts.append(rng.choice([" ", "; "]).join(own[lo : lo + rng.randrange(1, 25)]).upper())
        rows.append((i, "\n".join(parts)))
    rows += [(70, None), (71, ""), (72, "..."), (73, items[20][1] * 3), (9, items[6][1]), (None, items[6][1]), (74, "straße ÉTÉ, 日本\t語")]
    found = decontamination.contamination(docs(spark, rows), bench(spark, items)).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in found), key=str) == brute_contamination(rows, items)


def test_no_items(spark):
    rows = docs(spark, [(1, "some text"), (2, None)])
    assert [r["n_hit"] for r in decontamination.contamination(rows, bench(spark, [])).collect()] == [0, 0]


def test_uncontaminated_keeps_clean_rows_whole(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    table = docs(spark, [(1, passage), (2, "clean text"), (2, "clean text"), (3, None), (4, " ".join(f"q{i}" for i in range(2000)) + " " + passage)])
    out = decontamination.uncontaminated(table, bench(spark, [(1, passage)]))
    assert out.columns == table.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 2, 3, 4]


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    texts = ["a b a", "", None, "B,a  é", "ab", "\x00a b"]
    w = words.Words(pa.array(texts), words.SPACED)
    assert [len(w.of(i)) for i in range(6)] == [3, 0, 0, 2, 1, 2]
    assert w.of(0)[0] == w.of(0)[2] != w.of(0)[1] and w.of(4)[0] not in w.of(0)
    strings = [s for t in texts for s in spaced(t)]
    assert w.strings(0, len(strings)) == strings
    assert len({int(h) for h in w.hashes}) == len(set(strings))
    many = [hashlib.md5(str(i).encode()).hexdigest()[: 1 + i % 12] for i in range(50000)]
    h = words.Words(pa.array([" ".join(many)]), words.SPACED).hashes
    assert len(set(h.tolist())) == len(set(many))


def short_texts(rng):
    """Texts of 3 to 25 words from few sequences, so that many are alike without being near copies."""
    bases = [[f"w{rng.randrange(60)}" for _ in range(25)] for _ in range(40)]
    out = []
    for _ in range(2000):
        base = rng.choice(bases)
        start = rng.randrange(3)
        words = base[start : start + rng.randrange(3, 26)]
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
        out.append(" ".join(words))
    return out


def linked_by_brute_force(texts):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        met = {}
        for g in s:
            for j in holders[g]:
                if j < i:
                    met[j] = met.get(j, 0) + 1
        for j, both in met.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def test_short_texts_keep_all_links(spark):
    texts = short_texts(generator(31))
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates.components(docs(spark, list(enumerate(texts)))).collect()}
    assert found == dict(enumerate(linked_by_brute_force(texts)))


def test_small_sets_of_one_block_are_compared_exactly():
    """Sets of 3 and 4 shingles whose bins disagree: the comparison inside a block must not ask the bins."""
    rng = np.random.default_rng(3)
    links = 0
    for _ in range(300):
        n = int(rng.integers(3, 21))
        whole = np.unique(rng.integers(0, 2**63, n + n // 3, dtype=np.uint64))
        part = np.sort(rng.choice(whole, n, replace=False))
        rows = [{"set_id": k, "label": k, "n": len(x), "buckets": [7] * near_duplicates.BANDS, "fine": near_duplicates.fine_bins(x), "whole": x.tobytes(), "bucket": 7, "i": 0, "j": 0, "side": 0} for k, x in enumerate((part, whole))]
        found = list(near_duplicates._across(75)([pa.RecordBatch.from_pylist(rows)]))
        assert sum(f.num_rows for f in found) == (100 * n >= 75 * len(whole))
        links += 100 * n >= 75 * len(whole)
    assert links > 250


def test_empty_bins_look_at_few_places():
    """Bins are filled as by the whole order of each, but most orders are left early."""
    rng = np.random.default_rng(3)
    looked = []

    class Order(np.ndarray):
        def take(self, *args, **kwargs):
            part = np.asarray(self).take(*args, **kwargs)
            looked.append(part.size)
            return part

    for n in (1, 3, 40, 600, 5000):
        own = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1))
        for bins in (near_duplicates.BINS, near_duplicates.FINE):
            order, edges = near_duplicates._ORDERS[bins], near_duplicates._EDGES[bins]
            whole = np.hstack(order)
            first = np.append(np.searchsorted(own, edges), len(own))
            full = first[1:] > first[:-1]
            slow = np.where(full, own[np.minimum(first[:-1], len(own) - 1)], np.uint64(0))
            filled = np.flatnonzero(full)
            for b in np.flatnonzero(~full):
                donors = whole[b][full[whole[b]]]
                slow[b] = slow[donors[0]] if len(donors) else slow[filled[np.searchsorted(filled, b * 7919 % bins) % len(filled)]]
            looked.clear()
            near_duplicates._ORDERS[bins] = [part.view(Order) for part in order]
            try:
                got = near_duplicates.minima(own, bins)
            finally:
                near_duplicates._ORDERS[bins] = order
            assert (got == slow).all()
            if n >= 600:
                assert sum(looked) < 32 * bins


def python_steps(plan):
    """Python evaluations that one task of a plan runs at once: most in its last stage, and most in any stage."""
    below = [python_steps(plan.children().apply(i)) for i in range(plan.children().size())]
    own = plan.nodeName() in ("ArrowEvalPython", "MapInArrow")
    here = own + (max if plan.nodeName() == "Union" else sum)([h for h, _ in below] or [0])
    most = max([here, *[m for _, m in below]])
    return (0, most) if "Exchange" in plan.nodeName() else (here, most)


def test_no_task_runs_two_python_evaluations(spark, monkeypatch):
    seen, write = {}, near_duplicates.materialize

    def noted(df, label, **options):
        plan = df._jdf.queryExecution().executedPlan()
        plan = plan.initialPlan() if "Adaptive" in plan.nodeName() else plan
        seen[label] = max(seen.get(label, 0), python_steps(plan)[1])
        return write(df, label, **options)

    monkeypatch.setattr(near_duplicates, "materialize", noted)
    near_duplicates.components(docs(spark, near_rows())).collect()
    assert seen["looks"] == 1 and seen["judged"] == 1
    assert max(seen.values()) == 1, seen
