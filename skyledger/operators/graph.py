"""Directed-graph centralities on DataFrames.

The graph is two DataFrames, ``vertices(id)`` and ``edges(src, dst)``; there is
no graph object and nothing is collected. Building it from the fact table is a
distributed ``distinct``; the heavy part at scale.

Shortest paths: a breadth-first search from a block of vertices at once. State
is one row per reachable (source, vertex) pair with its distance and number of
shortest paths; each level joins the frontier to the edges, sums path counts
per (source, vertex) and drops pairs already reached. Levels are written to
the shared folder and deleted when their block is summed.

Betweenness then accumulates Brandes dependencies from the farthest level
back to the sources, again one join per level. Work is O(V * E) rows in
total, with no all-pairs product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise


def build_graph(df: DataFrame, src: str, dst: str, attrs: dict[str, str] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """G1: vertices (``id``) and distinct directed edges (``src``, ``dst``); parallel edges collapse.

    ``attrs`` maps an output name to a column aggregated with ``max`` over the
    collapsed parallel edges.
    """
    edges = df.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
    if attrs:
        edges = edges.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(
            *[F.max(c).alias(name) for name, c in attrs.items()])
    else:
        edges = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    vertices = vertices_of(edges)
    return vertices, edges


def vertices_of(edges: DataFrame) -> DataFrame:
    """Union of both endpoint columns, distinct."""
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def _vertex_count(vertices: DataFrame):
    return vertices.select(F.count(F.lit(1)).cast("double")).scalar()


def degree_centrality(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(in-degree + out-degree) / (n - 1); a self-loop counts once in each direction."""
    e = edges.select("src", "dst").distinct()
    out_deg = e.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("__out"))
    in_deg = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("__in"))
    n = _vertex_count(vertices)
    deg = F.coalesce(F.col("__out"), F.lit(0)) + F.coalesce(F.col("__in"), F.lit(0))
    value = F.when(n > 1, deg / (n - 1)).otherwise(F.lit(1.0))
    return vertices.join(out_deg, "id", "left").join(in_deg, "id", "left") \
        .select("id", value.alias("degree_centrality"))


# Sources whose paths are held at once: their table has at most this many rows per vertex.
SOURCE_BLOCK = 256


def _checkpoint(df: DataFrame) -> DataFrame:
    return materialise(df)


def shortest_paths(vertices: DataFrame, edges: DataFrame, sources: DataFrame | None = None,
                   max_levels: int | None = None) -> DataFrame:
    """BFS from ``sources`` (default: every vertex): ``(source, id, dist, sigma)`` per reachable pair, ``dist`` 0 for itself.

    ``sigma`` is the number of shortest paths (a double: it can exceed 2^63).
    Each level is written once; the reached set is the union of the written levels.
    """
    e = edges.filter(F.col("src") != F.col("dst"))
    start = (sources if sources is not None else vertices).select("id")
    frontier = start.select(F.col("id").alias("source"), F.col("id"), F.lit(0).alias("dist"), F.lit(1.0).alias("sigma"))
    levels = [frontier]
    level = 0
    while max_levels is None or level < max_levels:
        level += 1
        reached = levels[0]
        for lv in levels[1:]:
            reached = reached.unionByName(lv)
        step = frontier.join(e, F.col("id") == F.col("src")) \
            .groupBy("source", F.col("dst").alias("id")).agg(F.sum("sigma").alias("sigma"))
        new = _checkpoint(step.join(reached.select("source", "id"), ["source", "id"], "left_anti")
                          .select("source", "id", F.lit(level).alias("dist"), "sigma"))
        if new.isEmpty():
            break
        levels.append(new)
        frontier = new
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    done = _checkpoint(out)
    discard(*levels[1:])
    return done


def _dependencies(edges: DataFrame, sp: DataFrame) -> DataFrame:
    """Brandes: ``(id, dependency)`` summed over the sources of ``sp``.

    delta(s, v) = sum over children w of v on shortest paths from s of
    sigma(s, v) / sigma(s, w) * (1 + delta(s, w)), level by level from the
    farthest distance down.
    """
    e = edges.filter(F.col("src") != F.col("dst"))
    max_d = sp.agg(F.max("dist")).head()[0] or 0
    parts = []
    deeper = None  # (source, id, sigma, delta) at level d + 1
    for d in range(max_d, 0, -1):
        here = sp.filter(F.col("dist") == d).select("source", "id", "sigma")
        if deeper is None:
            cur = here.withColumn("delta", F.lit(0.0))
        else:
            child = deeper.select(F.col("source").alias("__s"), F.col("id").alias("__w"),
                                  F.col("sigma").alias("__sw"), F.col("delta").alias("__dw"))
            contrib = here.join(e, F.col("id") == F.col("src")) \
                .join(child, (F.col("source") == F.col("__s")) & (F.col("dst") == F.col("__w"))) \
                .select("source", "id", (F.col("sigma") / F.col("__sw") * (1 + F.col("__dw"))).alias("c"))
            sums = contrib.groupBy("source", "id").agg(F.sum("c").alias("delta"))
            cur = here.join(sums, ["source", "id"], "left") \
                .select("source", "id", "sigma", F.coalesce(F.col("delta"), F.lit(0.0)).alias("delta"))
        cur = _checkpoint(cur)
        parts.append(cur)
        deeper = cur
    if not parts:
        return sp.select("id", F.lit(0.0).alias("dependency")).limit(0)
    total = parts[0].select("id", "delta")
    for p in parts[1:]:
        total = total.unionByName(p.select("id", "delta"))
    out = _checkpoint(total.groupBy("id").agg(F.sum("delta").alias("dependency")))
    discard(*parts)
    return out


def path_sums(vertices: DataFrame, edges: DataFrame, block: int = SOURCE_BLOCK) -> DataFrame:
    """``(id, reached, distance, dependency)`` per vertex over all sources.

    Sources go in hashed blocks of about ``block``: a block's paths are
    searched, summed per vertex and dropped, so what is stored at once is
    ``block`` x vertices, never one row for every pair of vertices. ``reached``
    counts the vertices that reach ``id`` (itself included), ``distance`` sums
    their distances. ``vertices`` and ``edges`` come from :func:`prepare`.
    """
    blocks = max(1, -(-vertices.count() // block))
    total = None
    for b in range(blocks):
        sources = vertices.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)
        sp = shortest_paths(vertices, edges, sources)
        near = sp.groupBy("id").agg(F.count(F.lit(1)).cast("double").alias("reached"),
                                    F.sum("dist").cast("double").alias("distance"))
        part = _checkpoint(near.join(_dependencies(edges, sp), "id", "left"))
        discard(sp)
        total = part if total is None else total.unionByName(part)
    return _checkpoint(total.groupBy("id").agg(F.sum("reached").alias("reached"), F.sum("distance").alias("distance"),
                                               F.sum("dependency").alias("dependency")))


def betweenness_centrality(vertices: DataFrame, edges: DataFrame, sums: DataFrame | None = None,
                           normalized: bool = True) -> DataFrame:
    """Directed, unweighted betweenness, endpoints excluded, scaled by 1/((n-1)(n-2))."""
    if sums is None:
        vertices, edges = prepare(vertices, edges)
        sums = path_sums(vertices, edges)
    n = _vertex_count(vertices)
    raw = F.coalesce(F.col("dependency"), F.lit(0.0))
    scale = F.when(n > 2, 1.0 / ((n - 1) * (n - 2))).otherwise(F.lit(1.0)) if normalized else F.lit(1.0)
    return vertices.join(sums, "id", "left").select("id", (raw * scale).alias("betweenness_centrality"))


def closeness_centrality(vertices: DataFrame, edges: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Closeness on incoming distances with the reachable-fraction correction.

    For v reached from r - 1 other vertices at total distance D:
    ((r - 1) / D) * ((r - 1) / (n - 1)); 0 when nothing reaches v.
    """
    if sums is None:
        vertices, edges = prepare(vertices, edges)
        sums = path_sums(vertices, edges)
    n = _vertex_count(vertices)
    r, d = F.col("reached"), F.col("distance")
    value = F.when((d > 0) & (n > 1), (r - 1) / d * ((r - 1) / (n - 1))).otherwise(F.lit(0.0))
    return vertices.join(sums, "id", "left").select("id", value.alias("closeness_centrality"))


def prepare(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write the vertex and distinct edge tables once.

    Both are bounded by the graph (not the fact rows); every BFS and Brandes
    level then reads them from files instead of re-deriving them from the facts.
    """
    return _checkpoint(vertices.select("id")), _checkpoint(edges.select("src", "dst").distinct())


def centralities(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree, betweenness and closeness per vertex (one search shared by the last two), written once."""
    vertices, edges = prepare(vertices, edges)
    sums = path_sums(vertices, edges)
    out = degree_centrality(vertices, edges)
    out = out.join(betweenness_centrality(vertices, edges, sums), "id")
    return _checkpoint(out.join(closeness_centrality(vertices, edges, sums), "id"))


def with_vertex_scores(df: DataFrame, scores: DataFrame, key: str, score_id: str = "id") -> DataFrame:
    """One left join of the combined per-vertex score table onto the facts.

    The score table has one row per vertex and is written, so its size is known:
    Spark broadcasts it below its threshold, else joins by key with skew splitting.
    """
    renamed = scores.withColumnRenamed(score_id, key)
    return df.join(renamed, on=[key], how="left")


def subgraph(edges: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Edges whose both endpoints are in ``ids`` (two semi joins)."""
    keep = ids.select(F.col(id_col).alias("__k"))
    out = edges.join(keep, edges["src"] == keep["__k"], "left_semi")
    return out.join(keep, out["dst"] == keep["__k"], "left_semi")
