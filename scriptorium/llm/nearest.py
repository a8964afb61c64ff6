"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard, searched by beams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows of a shard while there are at most FEW_SHARDS of them; then the shards grow to MOST_ROWS, which a task holds in about 200 MB at
#: 128 components, and only then their number grows.
SHARD_ROWS, FEW_SHARDS, MOST_ROWS = 8192, 16, 131_072
#: Queries searched in one call; a shard is read once for each such block.
BLOCK_QUERIES = 65_536
#: Most edges of a node, beam of the build, relaxation of pruning, passes, nodes inserted together.
DEGREE, BUILD_BEAM, RELAX, PASSES, TOGETHER = 28, 48, 1.2, 1, 256
#: Distances between candidates that one pruning call holds.
PRUNED_CELLS = 4_000_000
#: Beam of a search, and nodes of the beam that are expanded at once.
SEARCH_BEAM, WIDTH = 160, 6


def usable(vector: Column) -> Column:
    """Neither null nor zero, and each component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes that a greedy beam from node 0 finds: ids and squared distances, nearest first, for all queries at once.

    graph: neighbours of each node, -1 where there are fewer. Places that aren't filled have id -1.
    """
    n, m = len(x), len(queries)
    rows = np.arange(m)[:, None]
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # stands for "no neighbour"
    ids = np.full((m, beam), n)
    dist = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    ids[:, 0], dist[:, 0], done[:, 0], seen[:, 0] = 0, ((queries - x[0]) ** 2).sum(1), False, True
    norms = (x * x).sum(1)
    own = (queries * queries).sum(1)
    active = np.arange(m)
    while len(active):
        open_ = np.where(done[active], np.inf, dist[active])
        pick = np.argsort(open_, axis=1, kind="stable")[:, :width]
        valid = np.isfinite(np.take_along_axis(open_, pick, 1))
        on = valid.any(1)
        active, pick, valid = active[on], pick[on], valid[on]
        if not len(active):
            break
        at = active[:, None]
        done[at, pick] = True
        near = np.where(valid[:, :, None], graph[np.where(valid, ids[at, pick], 0)], -1).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        near.sort(axis=1)
        fresh = ~seen[at, near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[at, near] = True
        node = np.where(fresh, near, 0)
        d = own[active][:, None] + norms[node] - 2 * np.matmul(x[node], queries[active][:, :, None])[:, :, 0]
        d = np.where(fresh, d, np.inf).astype(np.float32)
        every, far = np.concatenate([ids[active], np.where(fresh, near, n)], 1), np.concatenate([dist[active], d], 1)
        old = np.concatenate([done[active], ~fresh], 1)
        best = np.argsort(far, axis=1, kind="stable")[:, :beam]
        ids[active], dist[active], done[active] = (np.take_along_axis(a, best, 1) for a in (every, far, old))
    return np.where(np.isfinite(dist), ids, -1), dist


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Edges of each node: the nearest candidate stays and drops those that are relax times nearer to it than to the node, and so on."""
    far = np.full(candidates.shape, np.inf, np.float32)
    ok = (candidates >= 0) & (candidates != nodes[:, None])
    vectors = x[np.where(ok, candidates, 0)]
    base = ((vectors - x[nodes][:, None, :]) ** 2).sum(2)
    far[ok] = base[ok]
    rows = np.arange(len(nodes))
    out = np.full((len(nodes), degree), -1, np.int32)
    norms = (vectors * vectors).sum(2)
    apart = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    for k in range(degree):
        best = far.argmin(1)
        some = np.isfinite(far[rows, best])
        if not some.any():
            break
        out[some, k] = candidates[rows, best][some]
        far[relax * relax * apart[rows, best] <= far] = np.inf
        far[candidates == candidates[rows, best][:, None]] = np.inf
    return out


def build_graph(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """Neighbours of each node (-1 for none). Node 0 is where searches begin; it should lie in the middle."""
    n = len(x)
    rng = np.random.default_rng(seed)
    degree = min(DEGREE, max(n - 1, 1))
    graph = np.full((n, DEGREE), -1, np.int32)
    if n == 1:
        return graph
    start = rng.integers(0, n - 1, (n, degree), dtype=np.int32)
    graph[:, :degree] = start + (start >= np.arange(n)[:, None])
    for turn in range(PASSES):
        relax = 1.0 if turn == 0 and PASSES > 1 else RELAX
        order = rng.permutation(n)
        for at in range(0, n, TOGETHER):
            nodes = order[at : at + TOGETHER]
            found, _ = beam_search(x, graph, x[nodes], BUILD_BEAM, WIDTH)
            edges = robust_prune(x, nodes, np.concatenate([found, graph[nodes]], 1), DEGREE, relax)
            graph[nodes] = edges
            # the way back
            to, back = edges.ravel(), np.repeat(nodes, DEGREE)
            back, to = back[to >= 0], to[to >= 0]
            order_to = np.argsort(to, kind="stable")
            back, to = back[order_to], to[order_to]
            head, first, many = np.unique(to, return_index=True, return_counts=True)
            most = many.max()
            new = np.full((len(head), most), -1, np.int32)
            new[np.repeat(np.arange(len(head)), many), np.arange(len(to)) - np.repeat(first, many)] = back
            pool = np.concatenate([graph[head], new], 1)
            full = (pool >= 0).sum(1) > DEGREE
            graph[head[~full]] = -np.sort(-pool[~full], axis=1)[:, :DEGREE]
            head, pool = head[full], pool[full]
            step = max(1, PRUNED_CELLS // pool.shape[1] ** 2)
            for part in range(0, len(head), step):
                graph[head[part : part + step]] = robust_prune(x, head[part : part + step], pool[part : part + step], DEGREE, relax)
    return connect(x, graph)


def reached(graph: np.ndarray, seen: np.ndarray, front: np.ndarray) -> np.ndarray:
    """Marks in seen what edges lead to from the nodes front."""
    seen[front] = True
    while len(front):
        near = graph[front].ravel()
        near = np.unique(near[near >= 0])
        front = near[~seen[near]]
        seen[front] = True
    return seen


def connect(x: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """The graph with an edge to each part of it that no search from node 0 could enter, from the nearest node that one reaches.

    The edge takes a free place or widens the graph, so none is lost.
    """
    seen = reached(graph, np.zeros(len(x), bool), np.array([0]))
    while not seen.all():
        node = np.flatnonzero(~seen)[:1]
        near, _ = beam_search(x, graph, x[node], BUILD_BEAM, WIDTH)
        near = near[0][near[0] >= 0]
        free = near[(graph[near] < 0).any(1)]
        head = free[0] if len(free) else near[0]
        if not len(free):
            graph = np.concatenate([graph, np.full((len(graph), 1), -1, np.int32)], 1)
        graph[head, np.flatnonzero(graph[head] < 0)[0]] = node[0]
        seen = reached(graph, seen, node)
    return graph


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """One more component, so that the nearest point to (query, 0) is the one of the largest inner product."""
    squares = (vectors.astype(np.float64) ** 2).sum(1)
    top = squares.max()
    return np.concatenate([vectors, np.sqrt(np.maximum(top - squares, 0))[:, None]], 1).astype(np.float32)


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Index rows (dim, shard, node, ids, vector, edges) of every usable vector, and the number of shards.

    Rows are dealt to shards by hash of the vector. Equal vectors are one node, with the k + 1 smallest ids: ties go to
    the smaller id, so no other can be among the k nearest; the cut is made before the shuffle, so a vector
    that a third of the rows share is no hot task. Each shard's graph is built in one task from at most about
    MOST_ROWS nodes.
    """
    import pandas as pd

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    many = rows.count()
    shards = max(1, min(FEW_SHARDS, -(-many // SHARD_ROWS)), -(-many // MOST_ROWS))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    rows = rows.distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
    rows = rows.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "vector")

    def build(pdf):
        pdf = pdf.sort_values("vec_id")
        flat = np.stack(pdf["vector"].to_numpy()).astype(np.float64) + 0.0
        keys = pd.Series([v.tobytes() for v in flat])
        groups = pd.Series(pdf["vec_id"].to_numpy()).groupby(keys.to_numpy()).apply(list)
        x = np.frombuffer(b"".join(groups.index), np.float64).reshape(len(groups), -1)
        lifted = _lifted(x)
        middle = int(((lifted - lifted.mean(0)) ** 2).sum(1).argmin())
        order = np.concatenate([[middle], np.delete(np.arange(len(x)), middle)])
        graph = build_graph(np.ascontiguousarray(lifted[order]))
        return pd.DataFrame({"dim": x.shape[1], "shard": pdf["shard"].iloc[0], "node": np.arange(len(x)), "ids": [groups.iloc[i] for i in order], "vector": list(x[order]), "edges": list(graph)})

    index = rows.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, node int, ids array<long>, vector array<double>, edges array<int>")
    return staged(index, "ann-index"), shards


def search(index: DataFrame, shards: int, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best by inner product, itself left out, ties to the smaller id.

    Queries go in blocks to every shard; a shard's beam search proposes nodes, which are scored in double precision, and its
    best k go on to the merge. Vectors of other lengths than the query's are no candidates.
    """
    import pandas as pd

    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("query")).filter(F.col("query_id").isNotNull() & usable(F.col("query"))).distinct()
    asked = staged(asked.withColumn("dim", F.size("query")), "ann-queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    nodes = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def beams(key, of_shard, of_block):
        if not len(of_shard) or not len(of_block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        of_shard = of_shard.sort_values("node")
        wide = np.stack(of_shard["vector"].to_numpy()).astype(np.float64)
        lifted, graph, ids = _lifted(wide), np.stack(of_shard["edges"].to_numpy()), of_shard["ids"].to_numpy()
        out = []
        for at in range(0, len(of_block), TOGETHER):
            part = of_block.iloc[at : at + TOGETHER]
            q = np.stack(part["query"].to_numpy()).astype(np.float64)
            beam = max(SEARCH_BEAM, 2 * k + 2)
            if len(wide) <= beam:  # all nodes are scored
                found = np.tile(np.arange(len(wide)), (len(q), 1))
            else:
                found, _ = beam_search(lifted, graph, np.concatenate([q, np.zeros((len(q), 1))], 1).astype(np.float32), beam, WIDTH)
            for query_id, vector, near in zip(part["query_id"].to_numpy(), q, found):
                near = near[near >= 0]
                score = (wide[near] * vector).sum(1)
                # nodes that tie with the last one needed all stay, so that ids decide; the query itself may be one of them
                worst = -np.sort(-score)[min(k, len(score) - 1)]
                near, score = near[score >= worst], score[score >= worst]
                own = [ids[i] for i in near]
                vec, value = np.concatenate(own), np.repeat(score, [len(i) for i in own])
                keep = vec != query_id
                vec, value = vec[keep], value[keep]
                top = np.lexsort((vec, -value))[:k]
                out.append((np.full(len(top), query_id), vec[top], value[top]))
        return pd.DataFrame({name: np.concatenate(c) for name, c in zip(("query_id", "vec_id", "score"), zip(*out))})

    keys = ("dim", "shard", "block")
    found = nodes.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(beams, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Indexes all usable vectors and searches all usable queries; see build_index and search.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id. Repeated rows
    count once; an id with several vectors is a candidate with each. Ties go to the smaller id. Fewer than k candidates are all returned. Empty tables give no rows; other columns are ignored.
    """
    index, shards = build_index(vectors, k, id_col, vector_col)
    return search(index, shards, queries, k, id_col, vector_col)
