from collections import deque

import pytest

from skyledger.operators import graph


def brandes(nodes, edges):
    """Plain-Python directed, unweighted betweenness (normalised) and closeness (incoming)."""
    succ = {v: set() for v in nodes}
    pred_in = {v: set() for v in nodes}
    for a, b in edges:
        if a != b:
            succ[a].add(b)
            pred_in[b].add(a)
    n = len(nodes)
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        stack, preds = [], {v: [] for v in nodes}
        sigma = dict.fromkeys(nodes, 0.0)
        dist = dict.fromkeys(nodes, -1)
        sigma[s], dist[s] = 1.0, 0
        q = deque([s])
        while q:
            v = q.popleft()
            stack.append(v)
            for w in succ[v]:
                if dist[w] < 0:
                    dist[w] = dist[v] + 1
                    q.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        while stack:
            w = stack.pop()
            for v in preds[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    bc = {v: x * scale for v, x in bc.items()}
    close = {}
    for v in nodes:  # incoming distances: BFS on reversed edges
        dist = {v: 0}
        q = deque([v])
        while q:
            x = q.popleft()
            for y in pred_in[x]:
                if y not in dist:
                    dist[y] = dist[x] + 1
                    q.append(y)
        tot, r = sum(dist.values()), len(dist)
        close[v] = (r - 1) / tot * ((r - 1) / (n - 1)) if tot > 0 and n > 1 else 0.0
    return bc, close


CASES = {
    "chain_and_branch": [(1, 2), (2, 3), (1, 3), (3, 4), (2, 4), (4, 5)],
    "disconnected_with_self_loop": [(1, 2), (2, 1), (3, 4), (4, 4), (5, 3), (4, 6)],
    "cycle": [(1, 2), (2, 3), (3, 4), (4, 1), (1, 3)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_centralities_match_brandes(spark, name):
    edges = CASES[name]
    df = spark.createDataFrame(edges, "a int, b int")
    v, e = graph.build_graph(df, "a", "b")
    got = {r["id"]: r for r in graph.centralities(v, e).collect()}
    nodes = sorted({x for ed in edges for x in ed})
    bc, close = brandes(nodes, edges)
    n = len(nodes)
    for node in nodes:
        deg = sum(1 for a, b in set(edges) if a == node) + sum(1 for a, b in set(edges) if b == node)
        assert got[node]["degree_centrality"] == pytest.approx(deg / (n - 1))
        assert got[node]["betweenness_centrality"] == pytest.approx(bc[node], abs=1e-12)
        assert got[node]["closeness_centrality"] == pytest.approx(close[node], abs=1e-12)


def test_subgraph_is_induced(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src int, dst int")
    ids = spark.createDataFrame([(1,), (3,)], "id int")
    assert sorted(tuple(r) for r in graph.subgraph(df, ids).collect()) == [(3, 1)]
