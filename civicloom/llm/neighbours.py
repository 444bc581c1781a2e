"""Approximate nearest neighbours with a robust-pruned directed graph per shard.

Vectors are dealt into shards of bounded size. In a shard every vector gets a few out-edges: a
greedy search over the graph so far proposes neighbours, and of these one is kept only if no kept
neighbour is closer to it, by a factor, than the vector itself, so that edges point in different
directions. Each search walks from the entry with a beam. Queries visit every shard; the best of
all shards are the answer, scored exactly on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicloom.llm.groups import whole_units
from civicloom.llm.neardup_vectors import usable
from civicloom.session import pin

SHARD_ROWS = 8192
QUERY_BLOCK = 8192
DEGREE = 24
# Out-edges a vector may collect from later ones before they are pruned again.
SLACK = 40
BUILD_BEAM = 64
SEARCH_BEAM = 192
RELAX = 1.2
INSERTED_AT_ONCE = 512
EXPANDED_AT_ONCE = 4


class Graph:
    """Unit vectors and their out-edges; -1 fills up a vector's row of edges."""

    def __init__(self, unit: np.ndarray, edges: np.ndarray, entry: int):
        self.unit, self.edges, self.entry = unit, edges, entry

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the ids of up to ``beam`` nearest found, nearest first (-1: none), and
        their distances."""
        rows = len(queries)
        ids = np.full((rows, beam), -1, dtype=np.int64)
        far = np.full((rows, beam), np.inf, dtype=np.float32)
        done = np.ones((rows, beam), dtype=bool)
        ids[:, 0] = self.entry
        far[:, 0] = 1 - queries @ self.unit[self.entry]
        done[:, 0] = False
        active = np.arange(rows)
        while len(active):
            # The nearest vectors of the beam that were not expanded yet.
            waiting = np.where(done[active], np.inf, far[active])
            pick = np.argpartition(waiting, EXPANDED_AT_ONCE - 1, axis=1)[:, :EXPANDED_AT_ONCE]
            usable_pick = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
            some = usable_pick.any(axis=1)
            active, pick, usable_pick = active[some], pick[some], usable_pick[some]
            if not len(active):
                break
            picked = np.where(usable_pick, ids[active[:, None], pick], -1)
            own_done = done[active]
            np.put_along_axis(own_done, pick, True, axis=1)
            done[active] = own_done
            new = np.where((picked >= 0)[:, :, None], self.edges[picked], -1).reshape(len(active), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            seen = (new[:, :, None] == ids[active][:, None, :]).any(axis=2)
            new[seen] = -1
            distance = 1 - np.einsum("bkd,bd->bk", self.unit[new], queries[active])
            distance[new < 0] = np.inf
            all_ids = np.concatenate((ids[active], new), axis=1)
            all_far = np.concatenate((far[active], distance.astype(np.float32)), axis=1)
            all_done = np.concatenate((done[active], np.zeros_like(new, dtype=bool)), axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, axis=1)
            far[active] = np.take_along_axis(all_far, best, axis=1)
            done[active] = np.take_along_axis(all_done, best, axis=1) | ~np.isfinite(far[active])
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, axis=1)
        return np.where(np.isfinite(far), np.take_along_axis(ids, order, axis=1), -1), far


def _pruned(unit: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Robust pruning: for each node, up to ``DEGREE`` of its candidates (-1: none). From the
    nearest on, one is kept unless a kept one is nearer to it, times ``RELAX``, than the node."""
    answer = np.full((len(nodes), DEGREE), -1, dtype=np.int64)
    for begin in range(0, len(nodes), 256):
        own, near = nodes[begin:begin + 256], np.sort(candidates[begin:begin + 256], axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[near == own[:, None]] = -1
        points = unit[near]
        away = np.sqrt(np.maximum(2 - 2 * np.einsum("bkd,bd->bk", points, unit[own]), 0))
        away[near < 0] = np.inf
        order = np.argsort(away, axis=1, kind="stable")
        near, away = np.take_along_axis(near, order, axis=1), np.take_along_axis(away, order, axis=1)
        points = np.take_along_axis(points, order[:, :, None], axis=1)
        between = np.sqrt(np.maximum(2 - 2 * (points @ points.transpose(0, 2, 1)), 0))
        alive = np.isfinite(away)
        kept = np.zeros(len(own), dtype=np.int64)
        rows = np.arange(len(own))
        for k in range(near.shape[1]):
            take = alive[:, k] & (kept < DEGREE)
            if not take.any():
                continue
            chosen = rows[take]
            answer[begin + chosen, kept[chosen]] = near[chosen, k]
            kept[chosen] += 1
            alive[chosen] &= RELAX * between[chosen, k] > away[chosen]
    return answer


def build(vectors: np.ndarray, seed: int = 7) -> Graph:
    """The graph of one shard; the vectors differ from each other and are not zero."""
    n = len(vectors)
    unit = (vectors / np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True))).astype(np.float32)
    entry = int(np.argmax(unit @ unit.mean(axis=0)))
    edges = np.full((n, SLACK), -1, dtype=np.int64)
    graph = Graph(unit, edges, entry)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    begin = 1
    while begin < n:
        # Few at a time first, so that those inserted together are a small part of the graph.
        batch = order[begin:begin + min(max(begin, 1), INSERTED_AT_ONCE)]
        begin += len(batch)
        found, _ = graph.search(unit[batch], min(BUILD_BEAM, max(EXPANDED_AT_ONCE, begin)))
        # Those inserted together may be each other's nearest.
        together = unit[batch] @ unit[batch].T
        np.fill_diagonal(together, -np.inf)
        mates = np.argsort(-together, axis=1)[:, :8]
        out = _pruned(unit, batch, np.concatenate((found, batch[mates] if len(batch) > 1 else found), axis=1))
        edges[batch, :DEGREE] = out
        edges[batch, DEGREE:] = -1
        _link_back(unit, edges, batch, out)
    _reach_all(graph)
    return graph


def _link_back(unit: np.ndarray, edges: np.ndarray, batch: np.ndarray, out: np.ndarray) -> None:
    source, target = np.repeat(batch, out.shape[1]), out.ravel()
    source, target = source[target >= 0], target[target >= 0]
    known = (edges[target] == source[:, None]).any(axis=1)
    source, target = source[~known], target[~known]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    room = (edges[nodes] >= 0).sum(axis=1)
    place = np.arange(len(target)) - np.repeat(first, counts) + np.repeat(room, counts)
    fits = np.repeat(room + counts <= edges.shape[1], counts)
    edges[target[fits], place[fits]] = source[fits]
    crowded = np.flatnonzero(room + counts > edges.shape[1])
    # Pruned together with those of about as many candidates, so that little is filled up.
    for some in np.array_split(crowded[np.argsort(counts[crowded])], max(1, len(crowded) // 256)):
        if not len(some):
            continue
        more = np.full((len(some), int(counts[some].max())), -1, dtype=np.int64)
        for k, node in enumerate(some):
            more[k, :counts[node]] = source[first[node]:first[node] + counts[node]]
        own = nodes[some]
        edges[own, :DEGREE] = _pruned(unit, own, np.concatenate((edges[own], more), axis=1))
        edges[own, DEGREE:] = -1


def _reach_all(graph: Graph) -> None:
    """Give every vector that no path from the entry reaches an edge from one that is reached."""
    n = len(graph.unit)
    reached = np.zeros(n, dtype=bool)
    frontier = np.array([graph.entry])
    while True:
        reached[frontier] = True
        while len(frontier):
            out = np.unique(graph.edges[frontier])
            frontier = out[(out >= 0) & ~reached[np.maximum(out, 0)]]
            reached[frontier] = True
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return
        found, _ = graph.search(graph.unit[lost], BUILD_BEAM)
        anchors, one = np.unique(found[:, 0], return_index=True)
        free = (graph.edges[anchors] < 0).any(axis=1)
        if not free.all():  # another column of edges
            graph.edges = np.concatenate((graph.edges, np.full((n, 1), -1, dtype=np.int64)), axis=1)
        place = (graph.edges[anchors] >= 0).sum(axis=1)
        graph.edges[anchors, place] = lost[one]
        frontier = lost[one]


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(row, dtype=np.float64) for row in column])


def build_index(vectors: DataFrame, *, shard_rows: int = SHARD_ROWS, ids_per_vector: int,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The graphs of all shards, one row per distinct vector: ``dim``, ``shard``, ``node``,
    ``entry`` (its shard's), ``vector``, ``ids`` (the ``ids_per_vector`` smallest that carry it)
    and ``edges``.

    Every vector with a direction and an id is in the index. Equal vectors are one node, whatever
    their number; a shard holds vectors of one dimension, about ``shard_rows`` of them.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(vector_col).alias("vector"))
    smallest = Window.partitionBy("vector").orderBy("vec")
    nodes = (
        rows.where(usable("vector") & F.col("vec").isNotNull())
        .withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= ids_per_vector)
        .groupBy("vector").agg(F.array_sort(F.collect_list("vec")).alias("ids"))
        .withColumn("dim", F.size("vector"))
    )
    nodes = pin(nodes, "distinct-vectors")
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = (
        nodes.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), "shards").cast("int"))
        .drop("shards")
    )
    dealt = dealt.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("ids")[0])

    def run(batches):
        for table, starts in whole_units(batches, ["dim", "shard"], shard_rows // 4):
            for begin, end in zip(starts[:-1], starts[1:]):
                part = table.slice(begin, end - begin)
                width = part["dim"][0].as_py()
                flat = part["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                graph = build(flat.astype(np.float64).reshape(-1, width))
                edges = [row[row >= 0].astype(np.int32) for row in graph.edges]
                n = int(end - begin)
                yield pa.RecordBatch.from_arrays(
                    [part["dim"].combine_chunks(), part["shard"].combine_chunks(),
                     pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, graph.entry), pa.int32()),
                     part["vector"].combine_chunks(), part["ids"].combine_chunks(),
                     pa.array(edges, pa.list_(pa.int32()))],
                    names=["dim", "shard", "node", "entry", "vector", "ids", "edges"])

    kind = vectors.schema[vector_col].dataType.simpleString()
    return dealt.select("dim", "shard", "vector", "ids").mapInArrow(
        run, f"dim int, shard int, node int, entry int, vector {kind}, ids array<long>, edges array<int>")


def search(index: DataFrame, queries: DataFrame, k: int, *, beam: int = SEARCH_BEAM,
           query_block: int = QUERY_BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` largest cosines found for
    each query among rows of another id, ties to the smaller id.

    ``index`` must carry ``k`` + 1 ids per vector. Queries without a direction, or without an id,
    get no rows; a query compares with vectors of its dimension only. Fewer candidates than ``k``
    are all returned. Each pair of a shard and a block of queries is a unit of work.
    """
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).alias("query"))
    asked = asked.where(usable("query") & F.col("query_id").isNotNull()).withColumn("dim", F.size("query"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / query_block).alias("blocks"))
    places = index.select(F.col("dim").alias("query_dim"), F.col("shard").alias("query_shard")).distinct()
    asked = asked.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks")).drop("blocks")
    asked = asked.join(places, F.col("dim") == F.col("query_dim")).select(
        "query_dim", "query_shard", F.col("block").alias("query_block"), "query_id", "query")
    shards = index.join(blocks, "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")

    def run(questions: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                              "score": pd.Series(dtype="float64")})
        if shard.empty or questions.empty:
            return empty
        shard = shard.sort_values("node")
        original = _matrix(shard["vector"])
        lengths = np.sqrt((original * original).sum(axis=1))
        width = max(len(row) for row in shard["edges"])
        edges = np.full((len(shard), max(1, width)), -1, dtype=np.int64)
        for node, row in enumerate(shard["edges"]):
            edges[node, :len(row)] = row
        graph = Graph((original / lengths[:, None]).astype(np.float32), edges, int(shard["entry"].iloc[0]))
        ids = [np.asarray(row) for row in shard["ids"]]
        rows = []
        for begin in range(0, len(questions), 256):
            part = questions.iloc[begin:begin + 256]
            raw = _matrix(part["query"])
            own = np.sqrt((raw * raw).sum(axis=1))
            found, _ = graph.search((raw / own[:, None]).astype(np.float32), max(beam, k + 1))
            for query, vector, size, nodes in zip(part["query_id"], raw, own, found):
                nodes = nodes[nodes >= 0]
                scores = np.einsum("ij,j->i", original[nodes], vector) / (lengths[nodes] * size)
                best = [(-score, int(vec)) for score, node in zip(scores, nodes) for vec in ids[node] if vec != query]
                rows.extend((query, vec, -score) for score, vec in sorted(best)[:k])
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]) if rows else empty

    found = (
        asked.groupBy("query_dim", "query_shard", "query_block")
        .cogroup(shards.groupBy("dim", "shard", "block"))
        .applyInPandas(run, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
