import datetime as dt

from pyspark.sql import functions as F

from skyledger.operators import ordering, sampling


def test_global_row_id_is_a_total_order(spark):
    rows = [(i, dt.date(2020, 1, 1 + (i * 7) % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, d date")
    got = [(r["d"], r["id"], r["row_id"]) for r in ordering.with_global_row_id(df, ["d", "id"], num_partitions=6).collect()]
    got.sort(key=lambda x: x[2])
    assert [x[2] for x in got] == list(range(1, 201))
    assert [(x[0], x[1]) for x in got] == sorted((x[0], x[1]) for x in got)


def test_hot_key_spreads_over_partitions(spark):
    # one date holds most rows: range partitioning on (date, id) still splits it
    rows = [(i, dt.date(2020, 1, 1) if i % 10 else dt.date(2020, 1, 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, d date")
    out = ordering.with_global_row_id(df, ["d", "id"], num_partitions=8)
    assert out.agg(F.min("row_id"), F.max("row_id"), F.countDistinct("row_id")).head() == (1, 3000, 3000)


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(100)], "k int, v double")
    got = {r["k"]: r["v_before"] for r in ordering.prefix_sums(df, ["k"], ["v"], num_partitions=5).collect()}
    run = 0.0
    for k in range(100):
        assert got[k] == run
        run += k % 3


def test_time_series_folds(spark):
    df = spark.createDataFrame([(i, dt.date(2020, 1, 1) + dt.timedelta(days=i // 3)) for i in range(103)], "id int, d date")
    folds = ordering.time_series_folds(df, ["d", "id"], k=3).collect()
    chunk = 103 // 4
    for f in range(3):
        train = sorted(r["row_id"] for r in folds if r["fold"] == f and r["role"] == "train")
        test = sorted(r["row_id"] for r in folds if r["fold"] == f and r["role"] == "test")
        assert train == list(range(chunk * f + 1, chunk * (f + 1) + 1))
        assert test == list(range(chunk * (f + 1) + 1, chunk * (f + 2) + 1))
        assert max(train) < min(test)


def test_upsample_counts_and_split(spark):
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(100)]  # 20 positives, 80 negatives
    df = spark.createDataFrame(rows, "id int, y int")
    up = sampling.upsample(df, "y")
    counts = dict(up.groupBy("y").count().collect())
    assert counts == {0: 80, 1: 80}
    down = sampling.downsample(df, "y", seed=3, key=["id"])
    dcounts = dict(down.groupBy("y").count().collect())
    assert dcounts[1] == 20 and 5 <= dcounts[0] <= 40
    a, b = sampling.random_split(df, [0.8, 0.2], seed=5, key=["id"])
    ids_a = {r[0] for r in a.select("id").collect()}
    ids_b = {r[0] for r in b.select("id").collect()}
    assert ids_a.isdisjoint(ids_b) and len(ids_a | ids_b) == 100


def test_absent_class_and_groups(spark):
    rows = [(i, 2020 + i % 2, 1 if i % 4 == 0 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, yr int, y int")
    out = sampling.rebalance_by(df, ["yr"], "y")
    c = {(r["yr"], r["y"]): r["count"] for r in out.groupBy("yr", "y").count().collect()}
    # 2020: 10 positives (i%4==0 are even) and 10 negatives -> balanced already; 2021: only negatives
    assert c[(2020, 1)] == 10 and c[(2020, 0)] == 10 and c[(2021, 0)] == 20 and (2021, 1) not in c


def test_sample_of_exact_size(spark):
    """Sizes hold exactly whatever the rounds; the rows are those of the smallest draws."""
    from skyledger.functions.hashing import draw_md5
    df = spark.createDataFrame([(i, ("a", "b", "c", None)[0 if i % 3 else i % 4]) for i in range(2000)], "id long, g string").persist()
    counts = dict(df.groupBy("g").count().collect())
    sizes = spark.createDataFrame([("a", 700), ("b", counts["b"] + 5), ("c", 0)], "g string, __k long")
    first = None
    for ranked in (100_000, 10, 0):     # one, two and three rounds
        out = sampling.sample_exact(df, sizes, ["g"], 9, ["id"], ranked_rows=ranked)
        assert out.columns == df.columns
        got = sorted(tuple(r) for r in out.collect())
        assert first is None or got == first
        first = got
    kept = [i for i, g in first if g == "a"]
    draws = [tuple(r) for r in df.filter("g = 'a'").select(draw_md5(9, "id"), "id").collect()]
    assert sorted(kept) == sorted(i for _, i in sorted(draws)[:700])
    assert len(first) == 700 + counts["b"]
    half = sampling.downsample(df, "g", 9, ["id"], fraction=0.25, exact=True).groupBy("g").count().collect()
    least = min(v for k, v in counts.items())
    assert {r["g"]: r["count"] for r in half} == {k: v if v == least else int(v * 0.25 + 0.5) for k, v in counts.items() if k}
    assert sampling.sample_exact(df.limit(0), sizes, ["g"], 9, ["id"]).count() == 0
