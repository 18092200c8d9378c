import numpy as np
import pytest

from skyledger.llm import mixing


def _docs(n=600):
    r = np.random.default_rng(3)
    return [(i, " ".join(["w"] * int(r.integers(1, 400)))) for i in range(n)]


def _source(i):
    return None if i is not None and i % 7 == 6 else "abcde"[(i or 0) % 5]


def _targets(sizes, weights=(1, 2, 3), most=3.0):
    """Plain water filling."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        t = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if t[s] > most * sizes[s]}
        if not over:
            return {**t, **{s: most * sizes[s] for s in full}}
        full |= over


def test_mix_meets_targets(spark, docs_of):
    rows = _docs()
    out = mixing.mix(docs_of(rows, _source), block=50).collect()
    assert len(out) == len(rows)
    sizes = {}
    for i, t in rows:
        sizes[_source(i)] = sizes.get(_source(i), 0) + len(t.split())
    want = _targets(sizes)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert own[0]["source_size"] == sizes[s]
        assert own[0]["target"] == pytest.approx(want[s])
        taken = sum(r["taken"] for r in own)
        assert abs(taken - want[s]) <= 0.02 * sizes[s] + 200
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in out)


def _off_target(out):
    """Largest distance of a source's taken words from its target, beyond its shortest text, as a share of the target."""
    worst = 0.0
    for s in {r["source"] for r in out}:
        own = [r for r in out if r["source"] == s]
        gap = abs(sum(r["taken"] for r in own) - own[0]["target"])
        if gap > min(r["size"] for r in own if r["size"]):
            worst = max(worst, gap / own[0]["target"])
    return worst


def test_every_source_of_the_tables_meets_its_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert _off_target(mixing.mix(docs).collect()) <= 0.001


@pytest.mark.parametrize("block", [30, 2000])
def test_one_text_of_a_tenth_of_its_source(spark, docs_of, block):
    rows = [(i, "w " * (1 + i * 7 % 120)) for i in range(900)]
    rows += [(1000 + k, "w " * 1200) for k in range(5)]
    out = mixing.mix(docs_of(rows, lambda i: "abcde"[i % 5]), block=block).collect()
    assert len(out) == len(rows) and _off_target(out) <= 0.001


def test_settle():
    size, p = np.array([5.0, 3.0, 8.0, 1.0, 1000.0]), np.array([1.0, 0.0, 1.0, 0.0, 0.0])
    assert mixing.settle(size, p, 3.0).tolist() == [1, 1, 1, 0, 0]      # one document more
    assert mixing.settle(size, p, -2.0).tolist() == [0, 1, 1, 0, 0]     # one for another
    assert mixing.settle(size, p, 0.2).tolist() == p.tolist()           # nothing fits better
    assert mixing.settle(size[:0], p[:0], 4.0).tolist() == []


def test_small_source_is_capped_and_its_excess_reshared(spark, docs_of):
    rows = [(i, "w " * 100) for i in range(60)] + [(100, "w " * 10)]
    out = mixing.mix(docs_of(rows, lambda i: "z" if i == 100 else "a")).collect()
    z = next(r for r in out if r["doc_id"] == 100)
    assert z["target"] == 30 and z["taken"] == 30
    assert out[0]["source_size"] in (10, 6000) and sum({r["source"]: r["target"] for r in out}.values()) == pytest.approx(6010)


def test_reruns_and_partitions_agree(spark, docs_of):
    d = docs_of(_docs(200), _source)
    key = lambda f: sorted(map(tuple, f.collect()), key=str)
    assert key(mixing.mix(d, block=30)) == key(mixing.mix(d.repartition(7), block=30))


def test_nulls_repeats_and_empty(spark, docs_of):
    out = mixing.mix(docs_of([(1, None), (1, None), (None, "a b"), (None, "a b"), (2, "")], lambda i: None)).collect()
    assert len(out) == 5 and sum(r["size"] for r in out) == 4
    assert mixing.mix(docs_of([])).collect() == []


def test_repeated_rows_part(spark, docs_of):
    """Copies of a row (ids null or not) fly in different blocks, and the mix meets its targets."""
    rows = [(None, "a b c")] * 300 + [(5, "d e")] * 300 + [(k, "w " * (k % 9 + 1)) for k in range(10, 310)]
    d = docs_of(rows, lambda i: "z" if i and i % 3 else "y")
    numbers = mixing.numbered_copies(d.select("doc_id", "text"), at_once=7).collect()
    assert sorted(r["copy"] for r in numbers if r["doc_id"] is None) == list(range(300))
    out = mixing.mix(d, block=40).collect()
    assert len(out) == 900
    for s in "yz":
        own = [r for r in out if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 30
    key = lambda f: sorted(map(tuple, f.collect()), key=str)
    assert key(mixing.mix(d, block=40)) == key(mixing.mix(d.repartition(5), block=40))


def test_flight_keeps_both_totals():
    r = np.random.default_rng(1)
    size, p = r.integers(1, 1000, 500).astype(float), np.full(500, 0.37)
    q = mixing.flight(size, p, r)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert q.sum() == pytest.approx(p.sum()) and (q * size).sum() == pytest.approx((p * size).sum())
    same = mixing.flight(np.full(9, 5.0), np.full(9, 0.5), r)
    assert ((same > 0) & (same < 1)).sum() <= 1


def test_expected_inclusion_is_the_probability():
    size, hits = np.array([3.0, 8, 5, 13, 2, 21]), np.zeros(6)
    for s in range(4000):
        r = np.random.default_rng(s)
        hits += mixing.flight(size, np.full(6, 0.4), r)
    assert np.allclose(hits / 4000, 0.4, atol=0.03)
