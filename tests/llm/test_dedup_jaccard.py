import hashlib
import random
import re

import numpy as np

from skyledger.llm import dedup, jaccard
from skyledger.llm import text as tx

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi".split()) + str(r.randint(0, 400)) for _ in range(n))


def _corpus():
    """Copies, near copies around an original, a chain of links, a common passage, empty and long texts."""
    rows, k = [], 0
    def add(t):
        nonlocal k
        rows.append((k, t))
        k += 1
    for s in range(12):
        add(_words(60 + 5 * s, s))
    base = _words(120, 99).split()
    r = random.Random(1)
    for _ in range(25):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"edit{r.randint(0, 10 ** 6)}"
        add(" ".join(w))
    passage = _words(55, 7)
    for s in range(10):
        add(_words(80, 200 + s) + "\n" + passage)
    step = _words(100, 55).split()
    for s in range(6):  # each links with the next, the first not with the last
        add(" ".join(step[4 * s:4 * s + 80]))
    for t in (None, "", "   ", "one", "ONE", "one two three", "One\ttwo  three", rows[0][1].replace(" ", "\t "), rows[0][1], _words(8000, 5)):
        add(t)
    return rows


def _brute(rows, percent=75):
    sets = []
    for _, t in rows:
        w = tx.space_words(t)
        sets.append({b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {rows[i][0]: (len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


def test_components_equal_brute_force(spark, docs_of):
    rows = _corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicate_components(docs_of(rows)).collect()}
    assert got == _brute(rows)


def test_every_leader_round_count_is_exact(spark, docs_of, monkeypatch):
    rows = _corpus()
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 1)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicate_components(docs_of(rows), percent=60).collect()}
    assert got == _brute(rows, 60)


def test_jaccard_null_ids_repeats_and_empty(spark, docs_of):
    t = _words(40, 3)
    got = jaccard.near_duplicate_components(docs_of([(5, t), (5, t), (None, t), (None, None)])).collect()
    assert sorted((r["doc_id"] is None, r["component_id"], r["n_shingles"]) for r in got if r["n_shingles"]) == [
        (False, 5, 36), (False, 5, 36), (True, 5, 36)]
    assert [(r["doc_id"], r["component_id"]) for r in got if not r["n_shingles"]] == [(None, None)]
    assert jaccard.near_duplicate_components(docs_of([])).collect() == []
    kept = jaccard.keep_one_of_each(docs_of([(5, t), (6, t), (None, t), (7, None)]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "7", "None"]
    assert kept.columns == docs_of([]).columns


def test_exact_duplicates_equal_brute_force(spark, docs_of):
    rows = _corpus()
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    want = {}
    for t, ids in groups.items():
        for i in ids:
            want[i] = (min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in dedup.exact_duplicates(docs_of(rows)).collect()}
    assert got == want


def test_exact_duplicates_repeated_rows_and_nulls(spark, docs_of):
    d = docs_of([(1, "a b"), (1, "a b"), (2, "a  b"), (None, "a b"), (None, "q"), (None, "q"), (3, None), (4, "")])
    got = dedup.exact_duplicates(d).collect()
    assert len(got) == 8 and sum(r["kept"] for r in got) == 3
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {
        (1, 1, 4), (2, 1, 4), (None, 1, 4), (None, None, 2), (3, 3, 2), (4, 3, 2)}
    kept = dedup.keep_first_copies(d)
    assert kept.columns == d.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"]
    assert dedup.exact_duplicates(docs_of([])).collect() == []


def test_near_copies_are_dropped_by_row(spark, docs_of):
    """Rows that share an id go by their own text, and of near-copy rows with one id one stays."""
    a, b, c = _words(40, 11), _words(40, 12), _words(40, 13)
    d = docs_of([(1, a), (2, a + " x"), (2, b), (3, c), (3, c + " y"), (3, c), (4, b + " z"), (5, ""), (5, ""), (None, c)])
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one_of_each(d).collect()]
    assert sorted((i, t.split()[:1]) for i, t in kept if i) == sorted(
        [(1, a.split()[:1]), (2, b.split()[:1]), (3, c.split()[:1]), (5, []), (5, [])])
    assert [t for i, t in kept if i is None] == [c]


def test_quotient_filters_merge_without_loss():
    import pandas as pd
    fp = np.random.default_rng(0).integers(-2 ** 63, 2 ** 63 - 1, 500)
    parts = [np.r_[fp[:300], fp[:5]], np.r_[fp[200:], fp[10:12]]]
    filters = pd.concat([f for p in parts for f in dedup._filters([pd.DataFrame({"fp": p})])])
    many = np.concatenate([dedup._merge((k,), g)["fp"].to_numpy() for k, g in filters.groupby("slot")])
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert sorted(many) == sorted(values[counts > 1])
