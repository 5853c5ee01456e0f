"""Near-duplicate embeddings by a robust-pruned flat graph (operator 5).

Equal vectors are one node. Centroids fitted on a bounded sample deal each node to the
shards of its ``overlap`` nearest centroids; every shard builds a graph of its nodes by
robust pruning (nearest first, dropping whatever a kept neighbour is closer to by the
factor ``ALPHA``), keeps some random long edges and all reverse ones, and a node's lists
of all its shards are united. Each node is then a query in the shard of its nearest
centroid: a greedy search from the shard's medoid (and from the node itself, being one of
the graph), then expansion of all that lies in range, a margin below the threshold, until
nothing new is in range. What was found is verified by cosine in double precision.

A shard of more than ``BLOCK_NODES`` nodes is cut into blocks, each with a graph of its
own, and the queries of each block go to all of them. A shard hands on counts and a spanning forest of its links, never the links themselves.
A link of two nodes is asked for in one place, whose finding counts for both of them and for
the component alike. The recall is audited: a bounded number of queries is compared with all
vectors by brute force, and while the mean share of a query's linked nodes that was found is
less than ``LEAST_RECALL``, twice the overlap is taken and shards are searched exhaustively,
in the end each of them for every node.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different lengths don't link, so every length has centroids
and shards of its own (a length of few vectors one shard); copies link with each other;
repeated ids are vectors of their own; a null id is never the smallest of a component with
ids; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.common import materialise
from fairgauge.llm.components import components

#: Nodes of a shard on average, before overlap, and centroids at most (2 MB at 64 doubles).
SHARD_NODES = 1000
MOST_SHARDS = 4096
#: Nodes of a block: a larger shard is searched block by block, so that no task holds
#: more than two blocks however large a tight group is.
BLOCK_NODES = 8192
#: Vectors that the centroids are fitted on at most, and rounds of fitting.
SAMPLE_ROWS = 16_384
FIT_ROUNDS = 8
#: Near candidates of a node, edges that pruning keeps, long edges, pruning factor.
CANDIDATES, DEGREE, LONG_EDGES, ALPHA = 64, 32, 4, 1.2
#: Nodes kept by the greedy search; what the expansion tolerates below the threshold.
BEAM, MARGIN = 24, 0.05
#: Queries of the audit, and the mean recall that it asks for.
AUDIT_ROWS, LEAST_RECALL = 256, 0.98
SEED = 5


def _matrix(column: pd.Series | list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that neither huge nor tiny components leave the doubles' range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [_unit(np.array(v.as_py())[None, :]).tobytes() for v in batch.column("vector")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(vectors, pa.binary())], names=batch.schema.names)


def fit_centroids(sample: np.ndarray, k: int, apart: float) -> np.ndarray:
    """Spherical k-means; of centroids whose cosine is ``apart`` or more one stays."""
    rng = np.random.default_rng(SEED)
    centroids = sample[rng.permutation(len(sample))[:k]]
    for _ in range(FIT_ROUNDS):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 0, sums / np.maximum(size, 1e-300), centroids)
    alone = np.ones(k, bool)  # a tight group isn't cut by several centroids inside of it
    for i in range(k):
        if alone[i]:
            alone[i + 1 :] &= centroids[i + 1 :] @ centroids[i] < apart
    return centroids[alone]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.array([len(v) // 8 for v in batch.column("vector").to_pylist()], np.int64)
    for d in np.unique(lengths).tolist():
        yield d, batch.take(pa.array(np.flatnonzero(lengths == d)))


#: Of a vector's length: its centroids and the number of its first shard.
Parts = dict[int, tuple[np.ndarray, int]]


def _deal(batches: Iterator[pa.RecordBatch], parts: Parts, overlap: int) -> Iterator[pa.RecordBatch]:
    """A row for each shard of a node; the first of ``shards`` is its home. Vectors of a
    length without centroids share the shard that minus their length numbers."""
    for mixed in batches:
        for d, batch in _by_length(mixed):
            if d in parts:
                centroids, first = parts[d]
                near = _matrix(batch.column("vector").to_pylist()) @ centroids.T
                best = first + np.argsort(-near, axis=1, kind="stable")[:, :overlap].astype(np.int32)
            else:
                best = np.full((batch.num_rows, 1), -d, np.int32)
            times = best.shape[1]
            rows = np.repeat(np.arange(batch.num_rows), times)
            dealt = batch.take(pa.array(rows))
            shards = pa.array(best.tolist(), pa.list_(pa.int32())).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*dealt.columns, pa.array(best.ravel()), pa.array(np.tile(np.arange(times) == 0, batch.num_rows)), shards],
                names=[*dealt.schema.names, "shard", "home", "shards"],
            )


def fit_parts(nodes: DataFrame, apart: float) -> Parts:
    """Centroids of every length that more than ``SHARD_NODES`` nodes have, each fitted on
    its share of the sample."""
    d = F.octet_length("vector") / 8
    sizes = nodes.groupBy(d.cast("int").alias("d")).agg(F.count("*").alias("n")).where(F.col("n") > SHARD_NODES).orderBy("d").collect()
    rows, parts, first = sum(r.n for r in sizes), {}, 0
    for r in sizes:
        share = max(math.ceil(r.n / SHARD_NODES), SAMPLE_ROWS * r.n // rows)
        some = nodes.where(d == r.d).orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(min(share, SAMPLE_ROWS)).select("vector").collect()
        k = min(MOST_SHARDS, math.ceil(r.n / SHARD_NODES), len(some))
        parts[r.d] = fit_centroids(_matrix([bytes(x.vector) for x in some]), k, apart), first
        first += len(parts[r.d][0])
    return parts


def robust_prune(x: np.ndarray, i: int, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours of ``i`` among ``candidates``, nearest first."""
    away = 1 - x[candidates] @ x[i]
    order = np.argsort(away, kind="stable")
    candidates, away = candidates[order], away[order]
    between = 1 - x[candidates] @ x[candidates].T
    alive, kept = candidates != i, []
    while len(kept) < degree and alive.any():
        p = int(alive.argmax())
        kept.append(candidates[p])
        alive &= ALPHA * between[p] > away
        alive[p] = False
    return np.array(kept, np.int64)


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of the unit vectors ``x``."""
    n, rng = len(x), np.random.default_rng(SEED)
    lists: list[set[int]] = [set() for _ in range(n)]
    for begin in range(0, n, 512):
        near = x[begin : begin + 512] @ x.T
        k = min(n, CANDIDATES + 1)
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        for i, candidates in enumerate(top, begin):
            far = rng.integers(0, n, LONG_EDGES)
            for j in (*robust_prune(x, i, candidates, DEGREE).tolist(), *far.tolist()):
                if j != i:
                    lists[i].add(j)
                    lists[j].add(i)
    # Reverse edges aren't pruned again: a node is reached from whatever it points to.
    return [np.fromiter(edges, np.int64, len(edges)) for edges in lists]


def _adjacency(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("node", kind="stable")
    node, lists = group["node"].to_numpy(), build_graph(_matrix(group["vector"]))
    return pd.DataFrame({"node": node, "neighbours": [node[e] for e in lists]})


def range_search(x: np.ndarray, lists: list[np.ndarray], q: np.ndarray, start: np.ndarray, threshold: float) -> np.ndarray:
    """Nodes whose cosine with ``q`` is at least ``threshold``, searched from ``start``."""
    cosine = dict(zip(start.tolist(), (x[start] @ q).tolist(), strict=True))
    opened: set[int] = set()

    def look(at: list[int]) -> None:
        opened.update(at)
        new = np.array([j for j in set(np.concatenate([lists[i] for i in at]).tolist()) if j not in cosine], np.int64)
        if len(new):
            cosine.update(zip(new.tolist(), (x[new] @ q).tolist(), strict=True))

    while True:  # the beam's best nodes that aren't opened yet
        beam = sorted(cosine, key=cosine.get, reverse=True)[:BEAM]
        closed = [i for i in beam if i not in opened]
        if not closed:
            break
        look(closed[:4])
    while reach := [i for i, c in cosine.items() if c >= threshold - MARGIN and i not in opened]:
        look(reach)  # all in range, ever further
    found = np.array([i for i, c in cosine.items() if c >= threshold - MARGIN], np.int64)
    return found[x[found] @ q >= threshold] if len(found) else found


def _search(group: pd.DataFrame, threshold: float, exhaustive: bool) -> pd.DataFrame:
    """The queries of one block among the nodes of another (or the same). For each node the
    links that were asked for here, with (``links``) and without copies of the others
    (``peers``); for each linked node the smallest node that it hangs together with here."""
    group = group.sort_values(["data", "node"], ascending=[False, True], kind="stable")
    n = int(group["data"].sum())
    node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    shards, same_block = group["shards"].tolist(), group["at"].iloc[0] == group["of"].iloc[0]
    here, homes = group["shard"].iloc[0], np.array([x[0] for x in shards])
    every = _matrix(group["vector"])
    x = every[:n]
    places = {v: i for i, v in enumerate(node[:n].tolist())}
    lists = [np.array([places[v] for v in e if v in places], np.int64) for e in group["neighbours"].iloc[:n]]
    medoid = int((x @ x.mean(axis=0)).argmax()) if n else 0
    root, links, peers = np.arange(len(node)), np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
    # Two nodes at home in this block ask each other here: what either finds is a link.
    inside = np.flatnonzero(homes[:n] == here) if same_block else np.zeros(0, np.int64)
    among = np.full(len(node), -1)
    among[inside] = np.arange(len(inside))
    mutual = np.zeros((len(inside), len(inside)), bool)
    for i in np.flatnonzero(group["query"].to_numpy()) if n else ():
        if exhaustive:
            found = np.flatnonzero(x @ every[i] >= threshold)
        else:
            start = np.unique([medoid, i]) if i < n else np.array([medoid])  # a node is in its own graph
            found = range_search(x, lists, every[i], start, threshold)
        found = found[found != i]
        both = among[found] >= 0 if among[i] >= 0 else np.zeros(len(found), bool)
        if both.any():
            mutual[among[i], among[found[both]]] = True
        # The other one asks elsewhere if this one is in its home; then the smaller one's finding counts.
        alone = ~both & (~np.isin(homes[found], shards[i]) | (node[i] < node[found]))
        once = found[alone]
        links[i] += copies[once].sum()
        peers[i] += len(once)
        links[once] += copies[i]
        peers[once] += 1
        found = found[both | alone]
        if len(found):
            roots = np.unique(root[np.append(found, i)])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[np.argmin(node[roots])]
    mutual |= mutual.T
    for begin in range(0, len(inside), 512):
        some = inside[begin : begin + 512]
        links[some] += mutual[begin : begin + 512] @ copies[inside]
        peers[some] += mutual[begin : begin + 512].sum(axis=1)
    linked = np.flatnonzero(peers)
    hung = np.flatnonzero(root != np.arange(len(node)))
    return pd.concat(
        [
            pd.DataFrame({"node": node[linked], "links": links[linked], "peers": peers[linked], "root": None}),
            pd.DataFrame({"node": node[hung], "links": None, "peers": None, "root": node[root[hung]]}),
        ]
    ).astype({"links": "Int64", "peers": "Int64", "root": "Int64", "node": "int64"})


def _units(dealt: DataFrame, united: DataFrame | None) -> DataFrame:
    """What each pair of blocks of a shard needs: the nodes of ``at`` with their lists,
    and the nodes at home of ``of`` as queries."""
    listed = dealt.join(united, "node") if united else dealt.withColumn("neighbours", F.array().cast("array<bigint>"))
    every, other = F.sequence(F.lit(0), F.col("blocks") - 1), F.col("other")
    rows = listed.withColumn("other", F.explode(every))
    data = rows.select(
        "shard", F.col("block").alias("at"), other.alias("of"), "node", "copies", "vector", "shards", "neighbours",
        F.lit(True).alias("data"), (F.col("home") & (other == F.col("block"))).alias("query"),
    )
    queries = rows.where(F.col("home") & (other != F.col("block"))).select(
        "shard", other.alias("at"), F.col("block").alias("of"), "node", "copies", "vector", "shards",
        F.lit(None).cast("array<bigint>").alias("neighbours"), F.lit(False).alias("data"), F.lit(True).alias("query"),
    )
    return data.unionByName(queries)


def _brute_force(batches: Iterator[pa.RecordBatch], queries: dict[int, bytes], threshold: float) -> Iterator[pa.RecordBatch]:
    of_length: dict[int, list[int]] = {}
    for node, vector in queries.items():
        of_length.setdefault(len(vector) // 8, []).append(node)
    for mixed in batches:
        for d, batch in _by_length(mixed):
            if d in of_length:
                ids, x = np.array(of_length[d], np.int64), _matrix(batch.column("vector").to_pylist())
                q = _matrix([queries[i] for i in of_length[d]])
                linked = (q @ x.T >= threshold) & (ids[:, None] != batch.column("node").to_numpy()[None, :])
                yield pa.RecordBatch.from_pydict({"node": ids, "exist": linked.sum(axis=1)})


def audit(nodes: DataFrame, counts: DataFrame, threshold: float, queries: int = AUDIT_ROWS) -> float:
    """Mean recall of the linked ones among the ``queries`` nodes of least hash, whatever
    the number of their links and copies."""
    some = nodes.orderBy(F.xxhash64("node"), "node").limit(queries).select("node", "vector").collect()
    if not some:
        return 1.0
    sent = {r.node: bytes(r.vector) for r in some}
    true = nodes.mapInArrow(lambda b: _brute_force(b, sent, threshold), "node long, exist long")
    both = true.groupBy("node").agg(F.sum("exist").alias("exist")).where("exist > 0").join(counts, "node", "left")
    recall = both.agg(F.avg(F.least(F.coalesce("peers", F.lit(0)) / F.col("exist"), F.lit(1.0)))).first()[0]
    return 1.0 if recall is None else recall


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", overlap: int = 3
) -> DataFrame:
    """``id_col``, n_links, component_id, kept of each vector."""
    raw = F.col(vector_col).cast("array<double>")
    finite = F.forall(raw, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = raw.isNotNull() & (F.size(raw) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(raw, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable, raw).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64(F.size("vector"), "vector")))
    classes = (
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.count("*").alias("copies"), F.min("id").alias("id"), F.first("vector").alias("vector"))
    )
    nodes = materialise(classes.mapInArrow(_nodes, "node long, copies long, id " + dict(rows.dtypes)["id"] + ", vector binary"), "graph-nodes")
    n = nodes.count()
    found = None
    parts = fit_parts(nodes, threshold)
    most = max((len(centroids) for centroids, _ in parts.values()), default=1)
    exhaustive = False
    while n:
        spread, exact = overlap, exhaustive
        dealt = materialise(
            nodes.drop("id").mapInArrow(
                lambda b: _deal(b, parts, spread),  # noqa: B023
                "node long, copies long, vector binary, shard int, home boolean, shards array<int>",
            ),
            "graph-shards",
        )
        sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("blocks"))
        dealt = dealt.join(F.broadcast(sizes), "shard").withColumn("block", F.pmod(F.xxhash64("node", "shard"), "blocks").cast("int"))
        united = None
        if not exact:
            lists = dealt.groupBy("shard", "block").applyInPandas(_adjacency, "node long, neighbours array<bigint>")
            united = materialise(
                lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")), "graph-lists"
            )
        searched = _units(dealt, united).groupBy("shard", "at", "of").applyInPandas(
            lambda g: _search(g, threshold, exact), "node long, links long, peers long, root long"  # noqa: B023
        )
        found = materialise(searched, "graph-links")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("peers").alias("peers"))
        if audit(nodes, counts, threshold) >= LEAST_RECALL or (exact and overlap >= most):
            break  # with every shard searched exhaustively for every node nothing is left to find
        overlap, exhaustive = 2 * overlap, True
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    stars = components(found.where(F.col("root").isNotNull()), "node", "root")
    known = nodes.drop("vector").join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = known.join(smallest, "component").join(counts, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.drop("vector").join(by_node, "node", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
