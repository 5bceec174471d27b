"""Centroid clustering of integer vectors, each assignment a tournament of bisector sign tests.

For centroids i < j the bisector's integer normal is 2 (cj - ci) and its threshold |cj|^2 - |ci|^2: a vector x
is strictly nearer to j if x . normal - threshold > 0, and zero favours i, the smaller number.  Normals and
thresholds of all pairs are made once a round.  A vector starts with centroid 0 and meets 1, 2, ... in turn;
the loser of each of the k - 1 sign tests is out, and the survivor is the nearest centroid, with ties to the
smaller number.  Only the survivor's distance is computed, exactly.

Vectors are turned into integers and written once.  A round assigns them task by task, each task adds up
its vectors by cluster, and the sums meet in one grouped aggregate; only k x dimension sums reach the driver.

Defined results: vectors that are null, of another length, or hold null or non-finite components are left
out; so are those with a component of ``LIMIT`` or more in size, whose distances a long could not hold.  Rows
that repeat an id are vectors of their own; where ids tie for a starting centroid, the smaller vector goes
first.  A null id starts no centroid but is clustered.  With fewer vectors than centroids there are as many
centroids as vectors with an id.  Without any, the result is empty.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import staged
from tillroll.llm.rows import map_slices

DIMENSION = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
LIMIT = float(1 << 20)  # components stay below 2^26, distances below 2^60
SLICE = 4096


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dimension: int) -> DataFrame:
    """(vec_id, x array<int>): floor(64 * component) of the vectors that take part."""
    v = F.col(vec_col)
    usable = (F.size(v) == dimension) & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))
    return vectors.where(usable).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("int")).alias("x"))


def starting_centroids(rows: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in hash order: ``clusters`` rows come to the driver."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").select(hashed.alias("h"), "x").orderBy("h", "x").limit(clusters).collect()
    return np.array([r["x"] for r in first], np.int64)


class Bisectors:
    """Normals and thresholds between each pair of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])  # [i, j]: from i towards j
        squares = (centroids * centroids).sum(1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The winner of each row's tournament."""
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", x, self.normals[best, j]) - self.thresholds[best, j]
            best[side > 0] = j
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[best]
        return (gap * gap).sum(1)


def _matrix(column, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dimension)


def cluster_sums(rows: DataFrame, bisectors: Bisectors) -> dict[int, tuple[int, list[int]]]:
    """Cluster -> (vectors, componentwise sums): added up in each task, then by one grouped aggregate."""
    k, dimension = bisectors.centroids.shape

    def run(batches):
        import pyarrow as pa
        sums, counts = np.zeros((k, dimension), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                x = _matrix(batch.column(0).slice(at, SLICE), dimension)
                best = bisectors.nearest(x)
                np.add.at(sums, best, x)
                counts += np.bincount(best, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64()),
                                          "sums": pa.array(sums[used].tolist(), pa.list_(pa.int64()))})

    parts = rows.select("x").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = (parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in total.orderBy("cluster", "i").collect():  # clusters x dimension rows
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["s"]))
    return out


def refined(rows: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Each round's non-empty clusters move to the floor of their mean."""
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, sums) in cluster_sums(rows, Bisectors(centroids)).items():
            moved[c] = [s // n for s in sums]
        centroids = moved
    return centroids


def clustered(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dimension: int = DIMENSION,
              clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1") -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, cluster, distance), a written table, and the final centroids; runs at once."""
    rows = staged(integer_vectors(vectors, id_col, vec_col, dimension), "integers")
    centroids = starting_centroids(rows, clusters, seed)
    if not len(centroids):
        return rows.where("false").select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    centroids = refined(rows, centroids, rounds)
    bisectors = Bisectors(centroids)

    def step(r):
        x = _matrix(r["x"], dimension)
        best = bisectors.nearest(x)
        return {"vec_id": r["vec_id"], "cluster": best, "distance": bisectors.distances(x, best)}

    return staged(map_slices(rows, lambda: step, "vec_id long, cluster int, distance long", SLICE), "clustered"), centroids


def clusters_with_inertia(vectors: DataFrame, **options) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).  An inertia beyond a long is null."""
    assigned, centroids = clustered(vectors, **options)
    spark = assigned.sparkSession
    digests = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")  # a row a centroid
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    whole = sums.agg(F.sum("s").alias("all"))
    per_cluster = (sums.join(named, "cluster").crossJoin(F.broadcast(whole))
                   .select("cluster", F.col("s").try_cast("long").alias("cluster_inertia"), F.col("all").try_cast("long").alias("inertia"), "centroid_sha256"))
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
