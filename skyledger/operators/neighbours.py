"""Nearest neighbours and SMOTE over-sampling.

Distances are Euclidean and above 0, so a point and its exact copies are never
neighbours. ``knn`` compares every pair of distinct vectors (quadratic, in
blocks on both sides); ``lsh_knn`` compares points that share a
random-projection bucket and is what scales. Top-k per point uses ``row_number`` with
a rank filter, which Spark turns into a partial top-k before the shuffle.
Spark deals the blocks of points that meet; a task takes one pair of blocks as
matrices (numpy) and keeps the k best of each point.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform_md5
from ..session import materialise

CELLS = 1_000_000        # pairs of points that a task measures at once


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance of two equal-length double arrays (JVM-side higher-order functions)."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v))


def top_k_per_group(df: DataFrame, part: list[str], order: list[Column | str], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (``row_number`` + filter).

    Spark plans this as a window group limit: each task keeps only its k best
    rows per group before the shuffle, so a huge group costs O(k) to move.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def pick_one_per_group(df: DataFrame, part: list[str], seed: int | str, key: list[str],
                       out_rank: str = "__pick") -> DataFrame:
    """One random row per group, drawn from an md5 of seed and key (repeatable; ties impossible
    as long as ``key`` is unique within the group)."""
    u = uniform_md5(seed, *key)
    w = Window.partitionBy(*part).orderBy(u.desc(), *[F.col(c) for c in key])
    return df.withColumn(out_rank, F.row_number().over(w)).filter(F.col(out_rank) == 1).drop(out_rank)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows paired up, summed dimension by dimension as :func:`euclidean` does."""
    out = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1])
    for d in range(a.shape[-1]):
        out += (a[..., d] - b[..., d]) ** 2
    return out


def _matrices(side: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length; -1: vectors that are null or hold a null."""
    size = np.array([-1 if o else len(v) for v, o in zip(side["v"], side["odd"], strict=True)], np.int64)
    places = {int(n): np.flatnonzero(size == n) for n in np.unique(size)}
    return {n: (at, np.stack([np.asarray(side["v"].iloc[i], np.float64) for i in at]) if n >= 0 else None) for n, at in places.items()}


def _candidates(a: pd.DataFrame, b: pd.DataFrame, k: int):
    """Pairs (place in ``a``, place in ``b``, squared distance, whether that is null), the k nearest of each row of ``a`` among them.

    A matrix product finds the k-th distance to within its rounding; pairs up to
    there are measured exactly. Distances to vectors of another length or with nulls are null and come first.
    """
    left, right = _matrices(a), _matrices(b)
    for n, (at, x) in left.items():
        others = np.concatenate([np.zeros(0, np.int64), *[to for m, (to, _) in right.items() if m != n or n < 0]])
        if len(others):
            yield np.repeat(at, len(others)), np.tile(others, len(at)), np.zeros(len(at) * len(others)), True
        if n < 0 or n not in right:
            continue
        to, y = right[n]
        plain = np.isfinite(x).all() and np.isfinite(y).all()
        xx, yy = (x * x).sum(1), (y * y).sum(1)
        with np.errstate(all="ignore"):
            slack = 1e-13 * (n + 4) * (xx.max() + yy.max())
        step = max(1, CELLS // len(to))
        for s in range(0, len(at), step):
            part = x[s:s + step]
            if plain and np.isfinite(slack) and len(to) > k:
                d = xx[s:s + step, None] + yy - 2 * (part @ y.T)
                # Copies at distance 0 may be left out later, the point itself too: they don't count towards the k.
                far = np.where(d > slack, d, np.inf)
                i, j = np.nonzero(d <= np.partition(far, k - 1, axis=1)[:, k - 1, None] + 2 * slack)
            else:
                i, j = (m.ravel() for m in np.indices((len(part), len(to))))
            with np.errstate(all="ignore"):
                yield at[s + i], to[j], _squared(part[i], y[j]), False


def _nearest(left: DataFrame, right: DataFrame, key: list[str], k: int, zero: bool) -> DataFrame:
    """``key, id, nbr_id, distance``: of every pair of blocks that share ``key`` the k nearest points of ``right`` to each of ``left``.

    Both have ``id, v``; rows with a null key or id meet nothing. Ties go to the
    smallest neighbour. ``zero``: whether distances of 0, and null ones, count; a point never meets its own id.
    """
    def sides(df):
        odd = F.col("v").isNull() | F.exists("v", lambda x: x.isNull())
        return df.filter(F.concat_ws("", *[F.col(c).isNull().cast("string") for c in [*key, "id"]]) == "false" * (len(key) + 1)) \
            .select(*[F.col(c).alias(c) for c in [*key, "id", "v"]], F.coalesce(odd, F.lit(True)).alias("odd")).groupBy(*key)

    def run(of, a, b):
        found = []
        if len(a) and len(b):
            own, other = a["id"].to_numpy(), b["id"].to_numpy()
            for i, j, d, null in _candidates(a, b, k):
                keep = np.asarray(own[i] != other[j], bool)
                if not zero:
                    keep &= (d > 0) & (not null)
                i, j, d = i[keep], j[keep], np.sqrt(d[keep])
                t = pd.DataFrame({"i": i, "nbr_id": other[j], "distance": d, "order": np.where(np.isnan(d), np.inf, d), "nan": np.isnan(d), "known": not null})
                t = t.sort_values(["i", "known", "order", "nan", "nbr_id"])
                found.append(t[t.groupby("i").cumcount() < k])
        if not found:
            return pd.DataFrame({c: [] for c in names})
        t = pd.concat(found).sort_values(["i", "known", "order", "nan", "nbr_id"])
        t = t[t.groupby("i").cumcount() < k]
        out = {c: [v] * len(t) for c, v in zip(key, of, strict=True)}
        out |= {"id": own[t["i"]], "nbr_id": t["nbr_id"].to_numpy(), "distance": t["distance"].where(t["known"], None).astype(object).to_numpy()}
        return pd.DataFrame(out)

    types = dict(left.dtypes) | {"nbr_id": dict(left.dtypes)["id"], "distance": "double"}
    names = [*key, "id", "nbr_id", "distance"]
    return sides(left).cogroup(sides(right)).applyInPandas(run, ", ".join(f"`{c}` {types[c]}" for c in names))


def _groups(group: list[str]) -> list[str]:
    return [f"__g{i}" for i in range(len(group))]


def knn(df: DataFrame, id_col: str, vec_col: str, k: int, chunk: int = 8192, group: list[str] = ()) -> DataFrame:
    """J6 exact: ``(id, nbr_id, rank, distance)``: the k nearest other points of every point (of its ``group``).

    Every pair of distinct vectors of a group is compared: work is quadratic,
    by design. Both sides are dealt into blocks of about ``chunk`` vectors (smaller
    ones while there are fewer than eight), so a task meets at most chunk x chunk pairs. Ordering is by distance, then by the
    smallest id of the neighbour's vector, then by id. Points whose vector has
    no other distinct vector get no rows.
    """
    g = _groups(group)
    pts = df.select(*[F.col(c).alias(x) for c, x in zip(group, g)], F.col(id_col).alias("__id"),
                    F.col(vec_col).cast("array<double>").alias("__v"))
    dv = materialise(pts.groupBy(*g, "__v").agg(F.min("__id").alias("vid"), F.count(F.lit(1)).alias("mult")))
    n = dv.count()
    blocks = max(1, -(-n // chunk), min(8, n // max(1, chunk // 16)))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    own = F.pmod(F.xxhash64("vid"), F.lit(blocks)).cast("int")
    members = dv.select(*g, F.col("vid").alias("id"), F.col("__v").alias("v"), own.alias("mb"), every.alias("cb"))
    cand = dv.select(*g, F.col("vid").alias("id"), F.col("__v").alias("v"), own.alias("cb"), every.alias("mb"))
    near = _nearest(members, cand, [*g, "mb", "cb"], k, zero=True).select(*g, F.col("id").alias("rid"), F.col("nbr_id").alias("vid"), "distance")

    key = [*g, "rid"]
    w = Window.partitionBy(*key).orderBy("distance", "vid")
    topv = top_k_per_group(near, key, [F.col("distance"), F.col("vid")], k, "__rank").join(dv.select(*g, "vid", "mult"), [*g, "vid"])
    topv = topv.withColumn("before", F.coalesce(
        F.sum("mult").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).filter(F.col("before") < k)

    ids = pts.join(dv.select(*g, "__v", "vid"), [*g, "__v"])
    first_ids = top_k_per_group(ids.select(*g, "vid", "__id"), [*g, "vid"], [F.col("__id")], k, "j")
    nbr = topv.join(first_ids, [*g, "vid"]).filter(F.col("before") + F.col("j") <= k) \
        .select(*key, F.col("__id").alias("nbr_id"), (F.col("before") + F.col("j")).cast("int").alias("rank"),
                "distance")
    owners = ids.select(*g, F.col("vid").alias("rid"), F.col("__id").alias("id"))
    out = owners.join(nbr, key)
    return out.select(*[F.col(x).alias(c) for c, x in zip(group, g)], "id", "nbr_id", "rank", "distance")


def lsh_knn(df: DataFrame, id_col: str, vec_col: str, k: int, bucket_length: float = 3.0, seed: int = 234,
            num_tables: int = 4, chunk: int = 4096, group: list[str] = ()) -> DataFrame:
    """J6 approximate: the k nearest points that share a random-projection bucket in any of ``num_tables``.

    Neighbours that share no bucket are missed (SURVEY Q9). A bucket of more
    than ``chunk`` points is cut on both sides, so no task holds a whole hot
    bucket; each task keeps its k best before rows move. Output as :func:`knn`.
    """
    g = _groups(group)
    pts = df.select(*[F.col(c).alias(x) for c, x in zip(group, g)], F.col(id_col).alias("id"),
                    F.col(vec_col).cast("array<double>").alias("__v"))
    vec = pts.withColumn("v", array_to_vector("__v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length, seed=seed,
                                        numHashTables=num_tables).fit(vec)
    hashed = materialise(model.transform(vec).select(*g, "id", "__v", F.posexplode("h").alias("t", "hv"))
                         .select(*g, "id", "__v", "t", vector_to_array("hv")[0].alias("b")))
    key = [*g, "t", "b"]
    sizes = hashed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("cuts"))
    cut = hashed.join(sizes, key)
    own, every = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    left = cut.select(*key, "id", F.col("__v").alias("v"), own.alias("ma"), every.alias("mb"))
    right = cut.select(*key, "id", F.col("__v").alias("v"), own.alias("mb"), every.alias("ma"))
    pairs = _nearest(left, right, [*key, "ma", "mb"], k, zero=False).select(*g, "t", "id", "nbr_id", "distance")
    order = [F.col("distance"), F.col("nbr_id")]
    # The k best of each table first: the k best of all are among them.
    best = top_k_per_group(pairs, [*g, "t", "id"], order, k).drop("t", "rank").distinct()
    best = top_k_per_group(best, [*g, "id"], order, k)
    return best.select(*[F.col(x).alias(c) for c, x in zip(group, g)], "id", "nbr_id", "rank", "distance")


def smote(df: DataFrame, id_col: str, vec_col: str, label: str, minority, k: int = 3, multiplier: int = 3,
          seed: int = 234, exact: bool = False, bucket_length: float = 3.0, num_tables: int = 4,
          group: list[str] = ()) -> DataFrame:
    """SMOTE. For each of ``multiplier`` batches, every minority point picks
    one of its k nearest minority neighbours (of its ``group``) at random and yields the
    synthetic point A + u * (B - A), u uniform in [0, 1) (textbook direction, SURVEY Q8).

    Neighbours come from :func:`lsh_knn`, or from the quadratic :func:`knn` with
    ``exact``. Output: ``(group..., id, batch, features array<double>, label)``;
    originals carry ``batch = -1`` and their own label, synthetic rows the
    minority label. Points without a neighbour give no synthetic row.
    """
    group = list(group)
    base = df.select(*group, F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("features"),
                     F.col(label).alias("label"))
    minority_rows = base.filter(F.col("label") == F.lit(minority))
    near = knn(minority_rows, "id", "features", k, group=group) if exact else \
        lsh_knn(minority_rows, "id", "features", k, bucket_length, seed, num_tables, group=group)
    batches = near.select(*group, "id", "nbr_id", F.explode(F.sequence(F.lit(0), F.lit(multiplier - 1))).alias("batch"))
    chosen = pick_one_per_group(batches, [*group, "id", "batch"], seed, ["id", "batch", "nbr_id"])
    a = minority_rows.select(*group, "id", F.col("features").alias("fa"))
    b = minority_rows.select(*group, F.col("id").alias("nbr_id"), F.col("features").alias("fb"))
    u = uniform_md5(f"{seed}-u", "id", "batch")
    synth = chosen.join(a, [*group, "id"]).join(b, [*group, "nbr_id"]).select(
        *group, "id", "batch", F.zip_with("fa", "fb", lambda x, y: x + u * (y - x)).alias("features"),
        F.lit(minority).cast(base.schema["label"].dataType).alias("label"))
    originals = base.select(*group, "id", F.lit(-1).alias("batch"), "features", "label")
    return originals.unionByName(synth)


__all__ = ["euclidean", "top_k_per_group", "pick_one_per_group", "knn", "lsh_knn", "smote"]
