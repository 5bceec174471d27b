"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard of the
vectors, kept as flat neighbour arrays; the shards' results are merged.

1. Vectors that take part are staged; equal vectors form a class, for which its smallest id is indexed,
   and the few smallest ids of each class (as many as a result can hold) are kept as its members.
2. Classes are dealt by id hash to shards of about ``SHARD_VECTORS``; one task builds one shard's graph.
   Each vector is put into the layers up to its random level.  In each it is linked, both ways, to
   diverse ones of the nearest vectors put in before it; crowded lists are thinned by the same rule.
   A shard is one row: vectors, and per layer its nodes and their neighbour lists, as flat arrays.
3. Queries are searched in every shard of their dimension, in blocks of about ``QUERY_BLOCK``: greedy
   descent, then a beam of ``BEAM``.  Distances of what is returned are computed again in doubles.
4. The shards' nearest classes are merged for each query, and members put in their places.

Defined results: Euclidean distance, ties to the smaller id; a query's own id is not its neighbour;
queries with fewer candidates return all of them.  Null, empty or all-zero vectors, vectors with null or
non-finite components, and null ids take no part.  Where an id repeats, its smallest vector counts.
Vectors are compared within their dimension.  Extra columns are ignored, whatever their names.  An
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import staged

SHARD_VECTORS = 2048
QUERY_BLOCK = 512
LINKS = 16         # lists hold twice as many on the lowest layer
CANDIDATES = 64    # nearest earlier vectors that links are chosen from
BEAM = 96


def _chosen(near: np.ndarray, to: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Of candidates in rising distance ``to``, those nearer than to any one chosen before; then the
    nearest others, up to ``most``."""
    kept: list[int] = []
    for k in range(len(near)):
        if len(kept) == most:
            break
        if not kept or to[k] < between[near[k], near[kept]].min():
            kept.append(k)
    if len(kept) < most:
        taken = set(kept)
        kept += [k for k in range(len(near)) if k not in taken][:most - len(kept)]
    return [int(near[k]) for k in kept]


def build_layer(x: np.ndarray, links: int) -> np.ndarray:
    """Neighbour lists (rows padded with -1) of vectors put in one after the other.

    A shard is small, so the nearest earlier vectors are taken from its distance matrix."""
    n = len(x)
    squares = (x * x).sum(1)
    d = np.maximum(squares[:, None] + squares[None, :] - 2 * (x @ x.T), 0)
    lists: list[list[int]] = [[] for _ in range(n)]
    half = max(1, links // 2)
    for i in range(1, n):
        row = d[i, :i]
        near = np.argpartition(row, CANDIDATES)[:CANDIDATES] if i > CANDIDATES else np.arange(i)
        near = near[np.argsort(row[near], kind="stable")]
        lists[i] = _chosen(near, row[near], d, half)
        for j in lists[i]:
            lists[j].append(i)
            if len(lists[j]) > links:
                all_j = np.array(lists[j])
                all_j = all_j[np.argsort(d[j, all_j], kind="stable")]
                lists[j] = _chosen(all_j, d[j, all_j], d, links)
    flat = np.full((n, links), -1, np.int32)
    for i, own in enumerate(lists):
        flat[i, :len(own)] = own
    return flat


def build_graph(ids: np.ndarray, x: np.ndarray) -> dict[str, list]:
    """Vectors and, from the lowest layer up, each layer's nodes and neighbour lists (places among them)."""
    rng = np.random.default_rng(zlib.crc32(ids.tobytes()))
    order = rng.permutation(len(ids))
    ids, x = ids[order], x[order]
    level = np.floor(-np.log(1 - rng.random(len(ids))) / np.log(LINKS)).astype(int)
    layers = []
    for top in range(int(level.max()) + 1):
        nodes = np.flatnonzero(level >= top).astype(np.int32)
        layers.append((nodes, build_layer(x[nodes].astype(np.float32), LINKS if top else 2 * LINKS)))
    return {"ids": ids.astype("<i8").tobytes(), "vectors": x.tobytes(), "nodes": [n.tobytes() for n, _ in layers],
            "neighbours": [f.tobytes() for _, f in layers]}


class Graph:
    def __init__(self, row: dict, dim: int, kind: str):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.x = np.frombuffer(row["vectors"], kind).reshape(-1, dim)
        self.near = self.x.astype(np.float32)
        self.layers = []
        for top, (n, f) in enumerate(zip(row["nodes"], row["neighbours"])):
            nodes = np.frombuffer(n, np.int32)
            flat = np.frombuffer(f, np.int32).reshape(len(nodes), -1)
            self.layers.append((nodes, [r[r >= 0] for r in flat], self.near[nodes]))

    def search(self, query: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of about the k nearest, nearest first, ties to the smaller id."""
        q, place = query.astype(np.float32), 0
        for top in range(len(self.layers) - 1, 0, -1):
            nodes, lists, x = self.layers[top]
            best = ((x[place] - q) ** 2).sum()
            while len(lists[place]):
                d = ((x[lists[place]] - q) ** 2).sum(1)
                j = int(d.argmin())
                if d[j] >= best:
                    break
                best, place = d[j], int(lists[place][j])
            place = int(np.searchsorted(self.layers[top - 1][0], nodes[place]))
        found = self._beam(q, place, max(beam, k))
        exact = np.sqrt(((self.x[found].astype(np.float64) - query.astype(np.float64)) ** 2).sum(1))
        ids = self.ids[self.layers[0][0][found]]
        order = np.lexsort((ids, exact))[:k]
        return ids[order], exact[order]

    def _beam(self, q: np.ndarray, start: int, beam: int) -> np.ndarray:
        _, lists, x = self.layers[0]
        seen = np.zeros(len(x), bool)
        seen[start] = True
        first = float(((x[start] - q) ** 2).sum())
        todo, best = [(first, start)], [(-first, start)]
        while todo:
            d, at = heapq.heappop(todo)
            if len(best) == beam and d > -best[0][0]:
                break
            new = lists[at][~seen[lists[at]]]
            if not len(new):
                continue
            seen[new] = True
            for dn, n in zip(((x[new] - q) ** 2).sum(1).tolist(), new.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (-dn, n))
                    heapq.heappush(todo, (dn, n))
                elif dn < -best[0][0]:
                    heapq.heapreplace(best, (-dn, n))
                    heapq.heappush(todo, (dn, n))
        return np.array([n for _, n in best])


def taking_part(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, an id once."""
    v = F.col("vector")
    good = (v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(v, lambda c: c != 0))
    one = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    return one.where(F.col("vec_id").isNotNull() & good).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _shards_of(n: Column) -> Column:
    return F.ceil(n / SHARD_VECTORS).cast("int")


def build_index(reps: DataFrame, kind: str) -> DataFrame:
    """One row a shard: (dim, shard, ids, vectors, nodes, neighbours), written.  ``reps``: (vec_id,
    vector, dim, shards)."""
    def build(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        x = table.column("vector").combine_chunks().flatten().to_numpy().astype(kind).reshape(-1, dim)
        row = {"dim": dim, "shard": table.column("shard")[0].as_py()} | build_graph(table.column("vec_id").to_numpy().astype(np.int64), x)
        return pa.Table.from_pydict({k: [v] for k, v in row.items()}, schema=pa.schema([
            ("dim", pa.int32()), ("shard", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()),
            ("nodes", pa.list_(pa.binary())), ("neighbours", pa.list_(pa.binary()))]))

    dealt = reps.select("dim", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"), "vec_id", "vector")
    return staged(dealt.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, ids binary, vectors binary, nodes array<binary>, neighbours array<binary>"), "graphs")


def search_index(queries: DataFrame, index: DataFrame, kind: str, k: int) -> DataFrame:
    """(query_id, class_id, score): about the k nearest classes of each shard.  ``queries``: (query_id,
    vector, dim, shards, blocks)."""
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "class_id": [], "score": []}
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            graph = Graph(row, row["dim"], kind)
            x = right.column("vector").combine_chunks().flatten().to_numpy().astype(kind).reshape(right.num_rows, -1)
            for q, v in zip(right.column("query_id").to_pylist(), x):
                ids, scores = graph.search(v, k)
                out["query_id"] += [q] * len(ids)
                out["class_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.Table.from_pydict(out, schema=pa.schema([("query_id", pa.int64()), ("class_id", pa.int64()), ("score", pa.float64())]))

    blocks = queries.select("dim", "blocks").distinct()  # a row a dimension
    left = index.join(F.broadcast(blocks), "dim").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks")
    right = queries.select("dim", "query_id", "vector", F.pmod(F.xxhash64(F.lit(3), "query_id"), F.col("blocks")).cast("int").alias("block"),
                           F.explode(F.expr("sequence(0, shards - 1)")).alias("shard"))
    return left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(
        search, "query_id long, class_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the ids that ``is_query`` (over ``vec_id``) holds for; the
    index is built at once."""
    field = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "<f4" if field == "float" else "<f8"
    if field not in ("float", "double"):
        vectors = vectors.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    base = staged(taking_part(vectors, id_col, vector_col).withColumn("dim", F.size("vector")), "vectors")
    same = W.partitionBy("vector").orderBy("vec_id")
    members = base.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1)
    members = staged(members.withColumn("class_id", F.min("vec_id").over(W.partitionBy("vector"))), "classes")
    sizes = members.where("place = 1").groupBy("dim").agg(_shards_of(F.count(F.lit(1))).alias("shards"))
    index = build_index(members.where("place = 1").select("vec_id", "vector", "dim").join(F.broadcast(sizes), "dim"), kind)
    queries = base.where(is_query).select(F.col("vec_id").alias("query_id"), "vector", "dim")
    asked = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    queries = queries.join(F.broadcast(sizes), "dim").join(F.broadcast(asked), "dim")
    merge = W.partitionBy("query_id").orderBy("score", "class_id")
    found = (search_index(queries, index, kind, k + 1).withColumn("place", F.row_number().over(merge))
             .where(F.col("place") <= k + 1).drop("place"))
    rows = found.join(members.select("class_id", "vec_id"), "class_id").where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
