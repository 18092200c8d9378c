import math

import pytest
from pyspark.sql import functions as F

from sf_paths import SF_MID
from skyledger.operators import metrics, neighbours


def _brute(points, k):
    out = {}
    for i, a in points.items():
        cands = sorted((math.dist(a, b), j) for j, b in points.items() if j != i and math.dist(a, b) > 0)
        out[i] = [j for _, j in cands[:k]]
    return out


def test_knn_exact_with_many_pivots_matches_brute_force(spark):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    pts = {r["id"]: r["v"] for r in emb.collect()}
    got = {}
    for r in neighbours.knn(emb, "id", "v", 3, chunk=64).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["nbr_id"]))
    want = _brute(pts, 3)
    assert {i: [j for _, j in sorted(v)] for i, v in got.items()} == want


def test_knn_duplicates_are_not_neighbours(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 2.0]), (6, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = {}
    for r in neighbours.knn(df, "id", "v", 3, chunk=2).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["nbr_id"], r["distance"]))
    assert [x[1] for x in sorted(got[1])] == [3, 4, 5]        # copies of itself excluded
    assert [x[1] for x in sorted(got[3])] == [1, 2, 5]


def test_smote_points_lie_on_segments(spark):
    rows = [(i, [float(i), float(i % 3)], 1 if i < 8 else 0) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, v array<double>, y int")
    out = neighbours.smote(df, "id", "v", "y", 1, k=3, multiplier=3, seed=11, exact=True)
    orig = {r[0]: r[1] for r in rows}
    synth = [r for r in out.collect() if r["batch"] >= 0]
    assert len(synth) == 8 * 3 and all(r["label"] == 1 for r in synth)
    for r in synth:
        a = orig[r["id"]]
        # some minority point b with the synthetic point on segment [a, b]
        ok = False
        for j, b in orig.items():
            if j < 8 and j != r["id"]:
                d = [bb - aa for aa, bb in zip(a, b)]
                ts = [(x - aa) / dd for x, aa, dd in zip(r["features"], a, d) if dd != 0]
                if ts and all(abs(t - ts[0]) < 1e-9 for t in ts) and -1e-12 <= ts[0] <= 1 + 1e-12 and \
                        all(abs(x - aa) < 1e-12 for x, aa, dd in zip(r["features"], a, d) if dd == 0):
                    ok = True
        assert ok


def test_metrics_agree_with_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    rows = [(float(i % 7) / 7 + (0.3 if i % 3 == 0 else 0), float(i % 3 == 0), float(i % 5 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "score double, label double, prediction double")
    m = metrics.classification_metrics(df, "prediction", "label").head()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert m["accuracy"] == pytest.approx(ev.evaluate(df, {ev.metricName: "accuracy"}))
    assert m["weighted_precision"] == pytest.approx(ev.evaluate(df, {ev.metricName: "weightedPrecision"}))
    assert m["weighted_recall"] == pytest.approx(ev.evaluate(df, {ev.metricName: "weightedRecall"}))
    assert m["weighted_f1"] == pytest.approx(ev.evaluate(df, {ev.metricName: "f1"}))
    auc = metrics.auc_rank(df, "score", "label").head()["auc"]
    assert auc == pytest.approx(BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(df))
    hard = metrics.auc_rank(df, "prediction", "label").head()["auc"]
    bal = metrics.balanced_accuracy(df, "prediction", "label").head()["balanced_accuracy"]
    assert hard == pytest.approx(bal)


def test_blocks_meet_as_matrices_and_keep_odd_rows(spark):
    """Ties, copies, null and shorter vectors and large ids; the k best of blocks are those of all pairs; no array functions per pair."""
    rng = __import__("random").Random(4)
    rows = [(2 ** 60 + i, [float(rng.randint(0, 3)) for _ in range(3)], i % 2) for i in range(90)]
    odd = [(5, [1.0, None, 2.0], 0), (6, None, 0), (7, [1.0, 2.0], 1), (None, [9.0, 9.0, 9.0], 0), (8, [1.0, 1.0, 1.0], None)]
    plain = spark.createDataFrame(rows, "id long, v array<double>, g int")
    seen = {}
    for chunk in (7, 8192):
        near = neighbours.knn(plain, "id", "v", 3, chunk=chunk, group=["g"])
        plan = near._jdf.queryExecution().toString()
        assert "FlatMapCoGroupsInPandas" in plan and "zip_with" not in plan
        seen[chunk] = sorted((r["id"], r["rank"], r["nbr_id"], round(r["distance"], 9)) for r in near.collect())
    assert seen[7] == seen[8192]
    for g in (0, 1):
        points = {i: v for i, v, x in rows if x == g}
        first = {}
        for i in sorted(points):
            first.setdefault(tuple(points[i]), i)
        for i, v in points.items():       # by distance, then by the smallest id of the neighbour's vector, then by id
            want = sorted((math.dist(v, w), first[tuple(w)], j) for j, w in points.items() if w != v)[:3]
            got = [x[1:] for x in seen[7] if x[0] == i]
            assert got == [(n + 1, j, round(d, 9)) for n, (d, _, j) in enumerate(want)]
    near = neighbours.lsh_knn(plain, "id", "v", 3, bucket_length=100.0, group=["g"], chunk=16).collect()
    assert {(r["id"], r["rank"], round(r["distance"], 9)) for r in near} == {(i, n, d) for i, n, _, d in seen[7]}
    # As before: a null distance comes first, a vector of nulls has no rows of its own, null ids and groups meet nothing.
    out = neighbours.knn(spark.createDataFrame(rows + odd, "id long, v array<double>, g int"), "id", "v", 3, group=["g"]).collect()
    assert None not in {r["id"] for r in out} and {r["g"] for r in out} == {0, 1}
    assert {r["nbr_id"] for r in out if r["g"] == 1 and r["rank"] == 1 and r["id"] != 7} == {7}
