"""Source divergence against whole-number sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import pytest

from skyledger.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, value int, item string"


def brute(rows, min_docs, top):
    """The contract, pair by pair and term by term."""
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups.add((lang, source))
        n[lang, source].update(words)
        n[lang, None].update(words)
        df[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in df[lang].items() if d >= min_docs]
        names = sorted(s for la, s in groups if la == lang)

        def shares(source):
            total = sum(n[lang, source][t] for t in kept)
            return {t: 1 + 10**9 * (n[lang, source][t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(s) for s in [*names, None]}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in names:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in names if o != s]
            terms = [(t, f(p[s][t], p[None][t])) for t in kept if n[lang, s][t] and p[s][t] > p[None][t]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                for k, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:last], 1):
                    out.add((lang, s, part, item, value, k))
    return out


def corpus(seed, sources=9, docs=120):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(60)] + ["É", "é", "日本", "A", "a", "x9y"]
    rows = []
    for i in range(docs):
        source = rng.choices([None, "", *[f"s{k}" for k in range(sources)], "ü"], [1, 1, *[40 if k == 0 else 3 for k in range(sources)], 1])[0]
        text = rng.choice([" ", "-", "1"]).join(rng.choices(words, range(1, len(words) + 1), k=rng.randrange(0, 40)))
        rows.append((i, rng.choice([text, text, text, None, ""]) if i % 7 == 0 else text, rng.choice(["en", "de", None]), source))
    return rows + rows[:3] + [(None, "lone words", "lone", "only"), (7, None, "empty", "a"), (8, "", "empty", "b")]


def run(spark, rows, min_docs=4, top=3):
    df = spark.createDataFrame([(*r, "t", 1, "i") for r in rows], SCHEMA)
    return divergence.source_divergence(df, min_docs, top)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = [tuple(r) for r in run(spark, rows).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, 4, 3)


def test_tiles_and_small_batches_give_the_same(spark, monkeypatch):
    """Several blocks of groups, buckets of terms, scatter steps and hand-overs change nothing."""
    rows = corpus(3, sources=14)
    want = brute(rows, 4, 3)
    real = divergence.placed
    monkeypatch.setattr(divergence, "placed", lambda g: real(g, block=3, per_tile=20))
    assert {tuple(r) for r in run(spark, rows).collect()} == want
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "FLAT", 7)
    assert {tuple(r) for r in run(spark, rows).collect()} == want


def test_shares_stay_whole_for_huge_counts():
    import numpy as np
    p, q = np.array([10**9 + 1, 1, 5]), np.array([1, 10**9 + 1, 5])
    assert divergence._f(p, q).tolist() == [10**18 // (10**9 + 2)] * 2 + [0]


def test_empty_table(spark):
    got = divergence.source_divergence(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and got.count() == 0
