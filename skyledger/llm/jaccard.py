"""Exact set-similarity join on word shingles with set-relation skipping.

The index holds, for each shingle, the documents whose *prefix* has it. Shingles
are ordered from rare to frequent; two sets of Jaccard similarity t share a
shingle within their first ``n - ceil(t n) + 1``, and a shingle of one document
links nothing, so most documents leave the index empty.

Frequencies come from packed lists: chunks of documents deal 24-bit
fingerprints into hash ranges, each range counts them and answers each chunk.
A fingerprint that two shingles share only makes one look more frequent, which
costs a posting and loses no link.

Skipping by relation of sets (Jaccard distance is a metric):

1. sets that are equal count once;
2. each set is verified against one leader only (the first set of the list it
   shares most with), so a group of near copies becomes a tree around hubs;
3. index lists keep one block per hub, with the range of sizes, positions and
   distances to the hub; block pairs are skipped by size, by position, or because
   hub distance minus both radii exceeds 1 - t, which answers all their members
   from the hubs' answer. Members of the block pairs left are verified singly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx
from skyledger.llm.components import connected_components
from skyledger.llm.store import discard, save

CHUNK_BYTES = 12_000_000       # text that one counting group holds
RANGE_SHINGLES = 2_000_000     # shingles that one counting range holds
LEADER_ROUNDS = 3              # rounds that join trees of near copies; later steps are exact after any number
LEAST_GROUPS = 24              # groups and ranges at least, for parallelism
EPS = 1e-9

SETS = ("doc_id string, node binary, n int, items binary, "
        "posts array<struct<h: bigint, pos: int>>")


def _dealt(sets: list[np.ndarray], ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (range, fingerprint) keys of a chunk, their counts, and each occurrence's index."""
    h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    rng = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    keys = (rng << np.uint64(24)) | (h & np.uint64(0xFFFFFF))
    return np.unique(keys, return_inverse=True, return_counts=True)


def _pack(fp: np.ndarray) -> bytes:
    """Three bytes each."""
    return np.ascontiguousarray(fp.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def _count_chunk(ranges: int, width: int):
    def run(key, docs: pd.DataFrame) -> pd.DataFrame:
        words = tx.WordHash()
        keys, _, counts = _dealt([tx.shingle_set(t, words, width) for t in docs["text"]], ranges)
        rng = (keys >> np.uint64(24)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(rng)) + 1
        rows = [(int(key[0]), int(r[0]), _pack(k & np.uint64(0xFFFFFF)), np.minimum(c, 255).astype(np.uint8).tobytes())
                for r, k, c in zip(np.split(rng, cuts), np.split(keys, cuts), np.split(counts, cuts), strict=True) if len(r)]
        return pd.DataFrame(rows, columns=["chunk", "rng", "fp", "n"])
    return run


def _count_range(key, lists: pd.DataFrame) -> pd.DataFrame:
    """Document frequency (up to 255) of each fingerprint of a range, in each chunk's order."""
    fps = [_unpack(x) for x in lists["fp"]]
    _, inverse = np.unique(np.concatenate(fps), return_inverse=True)
    n = np.concatenate([np.frombuffer(x, np.uint8) for x in lists["n"]]).astype(np.float64)
    df = np.minimum(np.bincount(inverse, weights=n), 255).astype(np.uint8)[inverse]
    ends = np.cumsum([len(x) for x in fps])[:-1]
    return pd.DataFrame({"chunk": lists["chunk"], "rng": lists["rng"], "df": [x.tobytes() for x in np.split(df, ends)]})


def _index_chunk(ranges: int, width: int, percent: int):
    def run(key, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words = tx.WordHash()
        sets = [tx.shingle_set(t, words, width) for t in docs["text"]]
        _, inverse, _ = _dealt(sets, ranges)
        answers = answers.sort_values("rng")
        df = np.frombuffer(b"".join(answers["df"]), np.uint8)[inverse]
        rows, at = [], 0
        for doc_id, h in zip(docs["doc_id"], sets, strict=True):
            n = len(h)
            d, at = df[at:at + n], at + n
            raw = h.tobytes()
            node = xxhash.xxh3_128_digest(raw)
            posts = items = None
            prefix = n - -(-percent * n // 100) + 1 if n else 0
            if n and np.count_nonzero(d == 1) < prefix:
                order = np.argsort(d, kind="stable")[:prefix]  # h is sorted, so ties go by hash
                keep = np.flatnonzero(d[order] > 1)
                if len(keep):
                    posts = [{"h": int(x), "pos": int(p)} for x, p in zip(h[order[keep]].view(np.int64), keep, strict=True)]
                    items = raw
            rows.append((doc_id, node, n, items, posts))
        return pd.DataFrame(rows, columns=["doc_id", "node", "n", "items", "posts"])
    return run


def index_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its set's id and size; set and prefix postings where it may link."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    chunks = max(LEAST_GROUPS, total // CHUNK_BYTES)
    ranges = max(LEAST_GROUPS, total // (6 * RANGE_SHINGLES))
    # chunk ids are spread by hash, also for repeated rows and null ids
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    lists = dealt.groupBy("chunk").applyInPandas(_count_chunk(ranges, width), "chunk int, rng int, fp binary, n binary")
    answers = lists.groupBy("rng").applyInPandas(_count_range, "chunk int, rng int, df binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _index_chunk(ranges, width, percent), SETS)


def _intersections(batches):
    for b in batches:
        inter = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                 for x, y in zip(b["ia"], b["ib"], strict=True)]
        yield pd.DataFrame({"a": b["a"], "b": b["b"], "inter": np.array(inter, np.int64), "na": b["na"], "nb": b["nb"]})


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` with the Jaccard distance ``d`` (exact) and the pair's counts."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("ia"), F.col("n").alias("na"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("ib"), F.col("n").alias("nb"))
    met = pairs.select("a", "b").join(one, "a").join(two, "b").mapInPandas(
        _intersections, "a binary, b binary, inter long, na int, nb int")
    union = F.col("na") + F.col("nb") - F.col("inter")
    return met.select("a", "b", "inter", union.alias("uni"), (1 - F.col("inter") / union).alias("d"))


def _sizes_fit(na, nb, percent: int):
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb))


def _may_reach(rest_a, rest_b, na, nb, percent: int):
    """A first common shingle leaves at most as many more as either set has behind it."""
    return (100 + percent) * F.least(rest_a, rest_b) >= percent * (na + nb)


def _roots(tree: DataFrame) -> DataFrame:
    """``node, root`` of a forest of edges ``a`` (leader) to ``b``; leaders rank before their members, so there is no cycle."""
    up = save(tree.select(F.col("b").alias("node"), F.col("a").alias("root")), "roots")
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("root2"))
        after = save(up.join(above, "root", "left").select(
            "node", F.coalesce("root2", "root").alias("root"), F.col("root2").isNotNull().alias("moved")), "roots")
        moved = after.filter("moved").limit(1).count()
        discard(up)
        up = after.drop("moved")
        if not moved:
            return up


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between node ids whose components are those of all linked pairs.

    ``sets``: one row per distinct set (node, n, items, posts). Every pair of
    sets that links is verified, joined through verified edges, or proved to
    have its components joined; pairs proved apart by the triangle inequality
    aren't verified.
    """
    apart = 1 - percent / 100
    p = sets.select("node", "n", F.explode("posts").alias("x")).select(
        "node", "n", F.col("x.h").alias("h"), (F.col("n") - F.col("x.pos")).alias("rest"))
    shared = p.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    p = save(p.join(shared, "h"), "postings")

    # Each hub (at first each set) against the leader of most of its lists; linked ones join its tree.
    # The fullest prefix leads: an original's shingles all recur, its edited copies begin with ones of their own.
    members = save(p.groupBy("node").agg(F.count(F.lit(1)).alias("c"))
                   .select("node", F.struct((-F.col("c")).alias("w"), "node").alias("hub")), "members")
    tried = trees = None
    for _ in range(LEADER_ROUNDS):
        lists = p.join(members, "node").select("h", "hub").distinct()
        heads = lists.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("hub").alias("a")).filter("c > 1")
        tries = (lists.join(heads.drop("c"), "h").filter("hub <> a")
                 .groupBy("a", F.col("hub").alias("b")).agg(F.count(F.lit(1)).alias("c")))
        if tried is not None:
            tries = tries.join(tried, ["a", "b"], "left_anti")
        best = tries.groupBy("b").agg(F.max(F.struct("c", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
        best = save(best, "tries")
        near = _verified(best.select("a.node", "b.node").toDF("a", "b"), sets).filter(f"100 * inter >= {percent} * uni")
        new = save(best.join(near.select(F.col("b").alias("linked")), F.col("b.node") == F.col("linked")).select("a", "b"), "trees")
        tried = best if tried is None else tried.unionByName(best)
        trees = new if trees is None else trees.unionByName(new)
        if not new.limit(1).count():
            break
        root = _roots(new)
        moved = save(members.join(root.withColumnRenamed("node", "hub"), "hub", "left")
                     .select("node", F.coalesce("root", "hub").alias("hub")), "members")
        discard(members)
        members = moved
    tree = trees.select("a.node", "b.node").toDF("a", "b")
    # Exact distance of every member to its hub.
    far = _verified(members.filter("node <> hub.node").select(F.col("hub.node").alias("a"), F.col("node").alias("b")), sets)
    members = save(far.select(F.col("b").alias("node"), F.col("a").alias("hub"), F.col("d").alias("far")), "radii")
    hubs = members.groupBy("hub").agg(F.max("far").alias("radius"))

    # Blocks of the index lists: one per hub.
    q = save(p.join(members, "node", "left").select(
        "h", "node", "n", "rest", F.coalesce("hub", "node").alias("hub"), F.coalesce("far", F.lit(0.0)).alias("far")), "blocks")
    blocks = q.groupBy("h", "hub").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("rest").alias("rest"))
    left, right = (blocks.select("h", *(F.col(c).alias(f"{c}_{s}") for c in ("hub", "n0", "n1", "rest"))) for s in "ab")
    near = (left.join(right, "h").filter(
        (F.col("hub_a") < F.col("hub_b"))
        & (100 * F.col("n1_a") >= percent * F.col("n0_b")) & (100 * F.col("n1_b") >= percent * F.col("n0_a"))
        & _may_reach(F.col("rest_a"), F.col("rest_b"), F.col("n0_a"), F.col("n0_b"), percent))
        .select(F.col("hub_a").alias("a"), F.col("hub_b").alias("b")).distinct())
    second = save(_verified(near, sets), "hubs")
    joined = tree.unionByName(second.filter(f"100 * inter >= {percent} * uni").select("a", "b"))

    # Members of the block pairs that the hubs' distance leaves open and that no hub link has joined.
    ra = hubs.select(F.col("hub").alias("a"), F.col("radius").alias("ra"))
    rb = hubs.select(F.col("hub").alias("b"), F.col("radius").alias("rb"))
    open_ = (second.filter(f"100 * inter < {percent} * uni").join(ra, "a", "left").join(rb, "b", "left")
             .filter((F.coalesce("ra", F.lit(0.0)) + F.coalesce("rb", F.lit(0.0)) > 0)
                     & (F.col("d") - F.coalesce("ra", F.lit(0.0)) - F.coalesce("rb", F.lit(0.0)) <= apart + EPS)))
    comp = connected_components(joined)
    ca = comp.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    cb = comp.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    open_ = save(open_.join(ca, "a", "left").join(cb, "b", "left")
                 .filter(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b", "d"), "open")
    # The hub with fewer postings unfolds first, so a large group is only met where a list is shared.
    weight = q.groupBy("hub").agg(F.count(F.lit(1)).alias("w"))
    wa, wb = (weight.select(F.col("hub").alias(s), F.col("w").alias(f"w{s}")) for s in "ab")
    fewer = F.col("wa") <= F.col("wb")
    open_ = open_.join(wa, "a").join(wb, "b").select(
        F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("few"),
        F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("many"), "d")
    lf, lm = (q.select("h", F.col("hub").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "rest", "far")))
              for s in ("few", "many"))
    single = (open_.join(lf, "few").join(lm, ["h", "many"]).filter(
        (F.col("d") - F.col("far_few") - F.col("far_many") <= apart + EPS)
        & (F.col("far_few") + F.col("far_many") > 0)
        & _sizes_fit(F.col("n_few"), F.col("n_many"), percent)
        & _may_reach(F.col("rest_few"), F.col("rest_many"), F.col("n_few"), F.col("n_many"), percent))
        .select(F.col("node_few").alias("a"), F.col("node_many").alias("b")).distinct())
    third = _verified(single, sets).filter(f"100 * inter >= {percent} * uni").select("a", "b")
    return save(joined.unionByName(third).distinct(), "links")


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              width: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    A document's set is its distinct ``width``-word shingles (A-Z lower-cased,
    words between white space); with fewer words the whole sequence is one
    shingle; null, empty or blank texts have the empty set and link with
    nothing. Sets link when 100 * intersection >= ``percent`` * union.
    ``component_id`` is the smallest id reachable (a row without links: its own
    id). Rows with a null id take part; their id never names a component that
    has another. Other columns are ignored; an empty table gives an empty result.
    """
    # Ids travel as text: pandas would turn longs with nulls into floats.
    base = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    named, part = _components(base, width, percent)
    part = part.withColumn("m", F.col("m").cast("long"))
    named = named.withColumn("doc_id", F.col("doc_id").cast("long"))
    best = part.groupBy("c").agg(F.min("m").alias("component_id"))
    which = part.join(best, "c").select("node", "component_id")
    full = named.filter("n_shingles > 0").join(which, "node", "left").select("doc_id", "n_shingles", "component_id")
    empty = named.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def _components(base: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, node, n_shingles) of (doc_id, text), and each node's component ``c`` and smallest id ``m``.

    ``doc_id`` is an id as text, which a colon and more may follow: the id as a number counts first.
    """
    rows = save(index_sets(base, width, percent), "sets")
    # Equal sets count once from here on.
    sets = save(rows.filter("posts is not null").dropDuplicates(["node"]).select("node", "n", "items", "posts"), "nodes")
    comp = connected_components(links(sets, percent))
    named = rows.select("doc_id", "node", F.col("n").cast("long").alias("n_shingles"))
    smallest = named.filter("n_shingles > 0").groupBy("node").agg(_smallest("doc_id").alias("m"))
    return named, smallest.join(comp, "node", "left").select("node", F.coalesce("component", "node").alias("c"), "m")


def _smallest(doc_id: str):
    """The text of the smallest id; null only if there is no other."""
    number = F.substring_index(doc_id, ":", 1).cast("long")
    return F.min(F.when(number.isNotNull(), F.struct(number.alias("i"), F.col(doc_id).alias("t"))))["t"]


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = 5, percent: int = 75) -> DataFrame:
    """Of each component the row with the smallest id, with all columns; rows with null ids stay.

    Rows that share an id are told apart by their text: of a component's rows with the smallest id
    one stays. Rows without words link with nothing and stay.
    """
    key = tx.fresh(docs, "row_key")
    base = docs.select(tx.row_key(id_col, text_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    named, part = _components(base, width, percent)
    best = part.groupBy("c").agg(_smallest("m").alias("kept"))
    which = part.join(best, "c").select("node", "kept")
    drop = (named.filter("n_shingles > 0").join(which, "node").filter("doc_id <> kept")
            .select(F.col("doc_id").alias(key)).distinct())
    # Rows without id or words have a key of their own, as they aren't copies of each other.
    own = F.concat(F.lit("-:"), F.monotonically_increasing_id().cast("string"))
    marked = docs.withColumn(key, F.when(F.col(text_col).rlike(tx.NON_SPACE_SQL), tx.row_key(id_col, text_col)))
    marked = marked.withColumn(key, F.coalesce(key, own))
    return marked.join(drop, key, "left_anti").dropDuplicates([key]).select(*docs.columns)
