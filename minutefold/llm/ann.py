"""Approximate nearest neighbours: an HNSW graph per shard, as flat neighbour arrays."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minutefold.llm.work import Scratch

#: Vectors that one graph holds, and queries that one task takes to one graph.
SHARD, QUERY_BLOCK = 16_384, 8_192
#: Vectors of one graph are at most so many times as long as one another: lifted to one length,
#: much shorter ones would differ by less than single precision tells.
BAND = 32.0
#: Queries walked side by side; bounds the memory for marks of visited nodes.
SIDE = 256
#: Neighbours per node above the ground level, twice as many on it; beams of building and search.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 64, 128


@dataclass
class Graph:
    """``levels[l]`` is an array (nodes of level l) x (links), padded with -1; ``nodes[l]`` its
    node numbers in order. Level 0 has every node, each higher one a thinner random part."""

    vectors: np.ndarray
    nodes: list[np.ndarray]
    levels: list[np.ndarray]


def _walk(
    vectors: np.ndarray, links: np.ndarray, place: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Best ``beam`` nodes per query by inner product, best first, -1 where there are fewer.

    All queries take a step together: each opens its best unopened node and looks at that
    node's neighbours; a query is done when every node of its beam is open. ``place`` is the
    row of a node in ``links``; ``entry`` has a row of starting nodes per query.
    """
    count, width = len(queries), links.shape[1]
    ids = np.full((count, beam + width), -1, np.int64)
    score = np.full((count, beam + width), -np.inf, np.float32)
    opened = np.ones((count, beam + width), bool)
    seen = np.zeros((count, len(place) + 1), bool)
    seen[:, -1] = True  # where -1 points
    ids[:, : entry.shape[1]] = entry
    score[:, : entry.shape[1]] = np.matmul(vectors[entry], queries[:, :, None])[:, :, 0]
    opened[:, : entry.shape[1]] = False
    np.put_along_axis(seen, entry, True, axis=1)
    active = np.arange(count)
    while len(active):
        open_score = np.where(opened[active, :beam], -np.inf, score[active, :beam])
        best = open_score.argmax(axis=1)
        more = open_score[np.arange(len(active)), best] > -np.inf
        active, best = active[more], best[more]
        if not len(active):
            break
        opened[active, best] = True
        near = links[place[ids[active, best]]]
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        seen[:, -1] = True
        near = np.where(fresh, near, -1)
        gains = np.matmul(vectors[near], queries[active][:, :, None])[:, :, 0]
        ids[active, beam:] = near
        score[active, beam:] = np.where(fresh, gains, -np.inf)
        opened[active, beam:] = ~fresh
        order = np.argsort(-score[active], axis=1, kind="stable")
        ids[active] = np.take_along_axis(ids[active], order, axis=1)
        score[active] = np.take_along_axis(score[active], order, axis=1)
        opened[active] = np.take_along_axis(opened[active], order, axis=1)
        opened[active, beam:] = True
    ids = np.where(score == -np.inf, -1, ids)
    return ids[:, :beam], score[:, :beam]


def _spread(vectors: np.ndarray, node: np.ndarray, found: np.ndarray, keep: int) -> np.ndarray:
    """Per node, of its candidates, nearest first, those nearer to it than to any one kept before."""
    if len(node) > 4 * SIDE:
        parts = [slice(i, i + 4 * SIDE) for i in range(0, len(node), 4 * SIDE)]
        return np.concatenate([_spread(vectors, node[p], found[p], keep) for p in parts])
    count, wide = found.shape
    at = vectors[found]
    own = np.matmul(at, vectors[node][:, :, None])[:, :, 0]
    own[found < 0] = -np.inf
    own[found == node[:, None]] = -np.inf
    order = np.argsort(-own, axis=1, kind="stable")
    found, own = np.take_along_axis(found, order, axis=1), np.take_along_axis(own, order, axis=1)
    at = vectors[found]
    between = np.matmul(at, at.transpose(0, 2, 1))
    kept = np.zeros((count, wide), bool)
    chosen = np.zeros(count, int)
    for k in range(wide):
        blocked = (kept[:, :k] & (between[:, k, :k] > own[:, k : k + 1])).any(axis=1)
        take = (own[:, k] > -np.inf) & ~blocked & (chosen < keep)
        kept[:, k] = take
        chosen += take
    # Places that are left go to the nearest of the others.
    fill = np.argsort(np.where(kept, 0, np.where(own > -np.inf, 1, 2)), axis=1, kind="stable")[:, :keep]
    out = np.full((count, keep), -1, np.int64)
    real = np.take_along_axis(own, fill, axis=1) > -np.inf
    out[:, : fill.shape[1]] = np.where(real, np.take_along_axis(found, fill, axis=1), -1)
    return out


def _distinct(rows: np.ndarray) -> np.ndarray:
    """Repeated numbers of a row replaced by -1."""
    order = np.argsort(rows, axis=1, kind="stable")
    ranked = np.take_along_axis(rows, order, axis=1)
    ranked[:, 1:][ranked[:, 1:] == ranked[:, :-1]] = -1
    return ranked


def _level(vectors: np.ndarray, nodes: np.ndarray, links: int, rng: np.random.Generator) -> np.ndarray:
    """Neighbours of the nodes of one level, which enter in growing batches.

    A batch is searched in the graph of the nodes before it and compared with itself, then
    linked both ways; nodes with too many neighbours keep those that point different ways.
    """
    place = np.full(len(vectors), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    table = np.full((len(nodes), links), -1, np.int64)
    at = 0
    while at < len(nodes):
        batch = nodes[at : at + max(SIDE // 4, min(SIDE, at))]
        near = [np.full((len(batch), 1), -1, np.int64)]
        if at:
            start = nodes[rng.integers(0, at, (len(batch), min(at, 4)))]
            start = np.sort(start, axis=1)
            near.append(_walk(vectors, table, place, vectors[batch], start, BUILD_BEAM)[0])
        inner = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(inner, -np.inf)
        wide = min(len(batch) - 1, links)
        if wide:
            near.append(batch[np.argpartition(-inner, wide - 1, axis=1)[:, :wide]])
        table[at : at + len(batch)] = _spread(vectors, batch, _distinct(np.concatenate(near, axis=1)), links)
        # Links back: the neighbours of each touched node, old and new, are chosen again.
        source = np.repeat(batch, links)
        target = table[at : at + len(batch)].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        touched, first, count = np.unique(target, return_index=True, return_counts=True)
        if len(touched):
            column = np.arange(len(target)) - np.repeat(first, count)
            for low in range(0, int(count.max()), links):  # a hub's newcomers, some at a time
                now = (column >= low) & (column < low + links)
                fresh = np.full((len(touched), links), -1, np.int64)
                fresh[np.repeat(np.arange(len(touched)), count)[now], column[now] - low] = source[now]
                has = (fresh >= 0).any(axis=1)
                both = _distinct(np.concatenate([table[place[touched[has]]], fresh[has]], axis=1))
                table[place[touched[has]]] = _spread(vectors, touched[has], both, links)
        at += len(batch)
    return table


def build(vectors: np.ndarray, seed: int = 7) -> Graph:
    """Levels thin out by the number of links, up to one of at most that many nodes."""
    rng = np.random.default_rng(seed)
    padded = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), np.float32)])  # where -1 points
    nodes = [rng.permutation(len(vectors))]
    while len(nodes[-1]) > LINKS:
        nodes.append(nodes[-1][: max(1, len(nodes[-1]) // LINKS)])
    levels = [_level(padded, n, 2 * LINKS if i == 0 else LINKS, rng) for i, n in enumerate(nodes)]
    return Graph(padded, nodes, levels)


def search(graph: Graph, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """Node numbers per query, nearest first, -1 where there are fewer: down the levels."""
    out = np.full((len(queries), beam), -1, np.int64)
    for low in range(0, len(queries), SIDE):
        part = queries[low : low + SIDE]
        entry = np.tile(graph.nodes[-1], (len(part), 1))
        for level in range(len(graph.nodes) - 1, -1, -1):
            place = np.full(len(graph.vectors), -1, np.int64)
            place[graph.nodes[level]] = np.arange(len(graph.nodes[level]))
            wide = beam if level == 0 else LINKS
            entry = entry[:, :wide]
            found, _ = _walk(graph.vectors, graph.levels[level], place, part, entry, wide)
            keep = max(1, int((found >= 0).sum(axis=1).min()))
            entry = found[:, : min(keep, 4)]
        out[low : low + len(part)] = found
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths as a column, of vectors whose squares may be out of range, too."""
    most = np.abs(x).max(axis=1, keepdims=True)
    return most * np.sqrt(((x / most) ** 2).sum(axis=1, keepdims=True))


def _lifted(x: np.ndarray) -> np.ndarray:
    """Vectors of length one, with one more component, so that the largest inner product is nearest."""
    scaled = x / _norms(x).max()
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    return np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])




def nearest(
    df: DataFrame,
    scratch: Scratch,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    top: int = 20,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``top`` found nearest of each query.

    Queries are the rows whose key is divisible by ``every``; every other row is a candidate.
    Nearness is the inner product of the original vectors, in double precision; ties go to
    the smaller key. Each shard of at most about ``SHARD`` vectors, of lengths within a factor
    of ``BAND``, has its own graph, every vector is in one, and each block of queries is walked through each graph; the shards'
    findings are merged. Vectors that are null, zero, or hold null or non-finite components
    take no part, nor do null keys, or vectors of another size than the most frequent one, the
    smallest of several. Of rows equal in key each is a query of its own, with its own neighbours,
    and none is a neighbour of another. Only the named columns are read.
    """
    item = F.col(f"`{vector}`").cast("array<double>")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = scratch.land(
        df.select(F.col(f"`{key}`").cast("long").alias("id"), item.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(usable & F.exists("v", lambda x: x != 0))
        .withColumn("most", F.array_max(F.transform("v", F.abs)))
        .withColumn(
            "norm",
            F.col("most") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("most")) * (x / F.col("most")))),
        )
        .drop("most")
        .withColumn("row", F.monotonically_increasing_id()),
        "ann-rows",
    )
    usual = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.col("count").desc(), "dims").first()
    dims = usual[0] if usual else 0
    rows = rows.filter(F.size("v") == dims)
    longest = rows.agg(F.max("norm")).first()[0] or 1.0
    # Bands hang on the longest vector, so that lengths that are nearly equal share one.
    band = F.floor((F.lit(math.log(longest)) - F.log("norm")) / math.log(BAND) + 1e-9).cast("int")
    rows = rows.withColumn("band", F.greatest(band, F.lit(0))).drop("norm")
    bands = sorted(tuple(r) for r in rows.groupBy("band").count().collect())
    count = sum(n for _, n in bands)
    # Equal vectors are one node with its smallest keys; a query can need one more than the
    # top, itself. Counted in parts first, so that a common vector is no group in one task.
    mine = Window.partitionBy("h", "v", "salt").orderBy("id")
    few = (
        rows.withColumn("h", F.xxhash64("v"))
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
        .withColumn("n", F.row_number().over(mine))
        .filter(F.col("n") <= top + 1)
        .groupBy("h", "v", "band")
        .agg(F.slice(F.array_sort(F.collect_list("id")), 1, top + 1).alias("ids"))
    )
    # Number of the first shard of each band, and how many it has.
    shards, first_shard, own_shards = 0, F.lit(0), F.lit(1)
    for b, n in bands:
        here, own = F.col("band") == b, -(-n // SHARD)
        first_shard, own_shards = F.when(here, shards).otherwise(first_shard), F.when(here, own).otherwise(own_shards)
        shards += own
    shards = max(1, shards)
    blocks = max(1, -(-count // (every * QUERY_BLOCK)))

    def build_index(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(least=[i[0] for i in group["ids"]]).sort_values("least", kind="stable")
        width = max(map(len, group["ids"]))
        ids = np.full((len(group), width), -1, np.int64)
        for i, own in enumerate(group["ids"]):
            ids[i, : len(own)] = own
        graph = build(_lifted(_matrix(group["v"])))
        return pd.DataFrame(
            {
                "shard": [int(group["shard"].iloc[0])],
                "ids": [ids.tobytes()],
                "vectors": [_matrix(group["v"]).tobytes()],
                "nodes": [[n.astype(np.int32).tobytes() for n in graph.nodes]],
                "links": [[t.astype(np.int32).tobytes() for t in graph.levels]],
            }
        )

    index = scratch.land(
        few.withColumn("shard", (first_shard + F.pmod("h", own_shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(
            build_index, "shard int, ids binary, vectors binary, nodes array<binary>, links array<binary>"
        ),
        "ann-index",
    )

    def walk(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            row = left.iloc[0]
            exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, dims)
            ids = np.frombuffer(row["ids"], np.int64).reshape(len(exact), -1)
            lifted = _lifted(exact)
            padded = np.concatenate([lifted, np.zeros((1, dims + 1), np.float32)])
            nodes = [np.frombuffer(n, np.int32).astype(np.int64) for n in row["nodes"]]
            links = [np.frombuffer(t, np.int32).astype(np.int64) for t in row["links"]]
            graph = Graph(padded, nodes, [t.reshape(len(n), -1) for t, n in zip(links, nodes, strict=True)])
            for low in range(0, len(right), SIDE):
                part = right.iloc[low : low + SIDE]
                asked, query = part["id"].to_numpy(np.int64), _matrix(part["v"])
                flat = np.concatenate([query / _norms(query), np.zeros((len(query), 1))], axis=1).astype(np.float32)
                found = search(graph, flat, max(SEARCH_BEAM, 4 * top))
                score = np.einsum("qd,qkd->qk", query, exact[found])
                score[found < 0] = -np.inf
                hits = ids[found].reshape(len(query), -1)
                score = np.repeat(score, ids.shape[1], axis=1)
                score[(hits < 0) | (hits == asked[:, None])] = -np.inf
                order = np.lexsort((hits, -score), axis=1)[:, :top]
                score = np.take_along_axis(score, order, axis=1)
                hits = np.take_along_axis(hits, order, axis=1)
                real = score > -np.inf
                columns["query_row"].append(np.repeat(part["row"].to_numpy(np.int64), real.sum(axis=1)))
                columns["query_id"].append(np.repeat(asked, real.sum(axis=1)))
                columns["vec_id"].append(hits[real])
                columns["score"].append(score[real])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in columns.items()})

    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = (
        rows.filter(F.col("id") % every == 0)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .withColumn("shard", every_shard)
    )
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    found = (
        index.withColumn("block", every_block)
        .groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(walk, "query_row long, query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
