"""Spelling variants against comparing all words with all."""

import random
import re
import zlib
from collections import Counter

import pytest

from skyledger.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, node string, side int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(rows, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def corpus(seed, alphabet="abé", docs=60):
    """Few letters, so that many words are near each other, of very unlike frequency."""
    rng = random.Random(seed)
    words = {"".join(rng.choices(alphabet, k=rng.randrange(5, 10))) for _ in range(150)}
    words = sorted(words | {w + rng.choice(alphabet) for w in list(words)[:40]} | {w[:3] + w[4:] for w in list(words)[:40]})
    weights = [rng.choice([1, 1, 1, 20, 400]) for _ in words]
    rows = []
    for i in range(docs):
        picked = [w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=rng.randrange(0, 300))]
        rows.append((i, rng.choice([" ", "\n", "-", "¿", "Ā", "1"]).join(picked)))
    chain = [(700 + i, " ".join(["yabbaabb"] * (i < 3) + ["xabbaabb"] * 20 + ["xabbaabbx"] * 400)) for i in range(10)]
    return rows + chain + rows[:4] + [(None, rows[0][1]), (None, None), (900, None), (901, ""), (902, "A" * 40), (902, "É" * 40 + " é")]


def check(spark, rows, **options):
    got = [tuple(r) for r in spelling.spelling_variants(spark.createDataFrame([(i, t, "w", 1, "x", 2) for i, t in rows], SCHEMA), **options).collect()]
    assert len(got) == len({r[0] for r in got})
    return set(got)


@pytest.mark.parametrize("seed, alphabet", [(1, "abé"), (2, "ab"), (3, "abcdefghÿ")])
def test_equals_brute_force(spark, seed, alphabet):
    rows = corpus(seed, alphabet)
    want = brute(rows)
    assert any(r[1] and r[2] != r[1] for r in want)      # some chains
    assert check(spark, rows) == want


@pytest.mark.parametrize("limit", [4, 7, 8])
def test_long_words_meet_by_deletions(spark, limit):
    """Words above any limit, and pairs across it, give the same."""
    rows = corpus(4)
    assert check(spark, rows, long=limit) == brute(rows)


def test_very_long_words(spark):
    rng = random.Random(6)
    base = "".join(rng.choices("abcd", k=20_000))
    texts = [base, base[:9_000] + "z" + base[9_001:], base + "a", base[1:], base[:-1] + "q", "".join(rng.choices("ab", k=64)), "a" * 64, "a" * 65, "a" * 66]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(100 + i, base) for i in range(40)]
    assert check(spark, rows) == brute(rows)


def test_shorter_words_and_other_bounds(spark):
    rows = corpus(8, "ab", 20)
    assert check(spark, rows, min_length=1, min_count=1, ratio=2) == brute(rows, 1, 1, 2)


def test_hand_over_of_counts(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(spelling, "HELD", 10)
    assert check(spark, rows) == brute(rows)


def test_empty_table(spark):
    got = spelling.spelling_variants(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0
