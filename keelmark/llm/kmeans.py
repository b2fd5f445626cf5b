"""Centroid clustering (k-means) over integer vectors with an incremental distance matrix.

Contract. Vectors with exactly ``DIM`` components, none null or non-finite, are kept; each
component x becomes ``floor(256 * x)`` (x as double). Centroids 0..k-1 start as the k kept
vectors with the smallest sha256 of ``<seed>:<vec_id>`` (ties by the components); every round
assigns each vector to its nearest centroid (squared Euclidean distance, ties to the smaller
number) and replaces each non-empty centroid by the componentwise floor of its members' mean;
empty centroids stay. After the rounds vectors are assigned once more.

Method. Each vector keeps its exact integer dot products with all k centroids in a persisted
table (written to the shared folder every round, so lineage stays one round long and a lost
executor costs a reread). A round sums members per cluster with one hash aggregate (partial
sums combine map-side, so a cluster holding a third of all vectors is no hot task), moves
the k centroids on the driver (k x DIM integers, a fixed bound), and sends only the changed
components of each centroid to the tasks: a vector's dot products grow by its values at those
components times the changes; distances follow as ``|v|^2 - 2 v.c + |c|^2`` and the argmin.

Edge cases: vectors of another length, with a null or NaN/infinite component, or a null
embedding are not kept and not returned; a null vec_id hashes as the empty text and is kept;
repeated rows are separate vectors; fewer than k kept vectors give that many centroids; no
kept vector gives an empty result. Extra columns are dropped first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import stored

__all__ = ["DIM", "kept_vectors", "initial_centroids", "clusters", "brute_force"]

# Fixed values of the contract.
DIM, K, ROUNDS, SEED = 64, 40, 5, 2
#: Above this magnitude products might leave 64 bits; such batches are computed with Python integers.
_SMALL = 1 << 24


def kept_vectors(embeddings: DataFrame, dim: int = DIM) -> DataFrame:
    """rid (row key), vec_id and the integer components of every kept vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    ok = (F.size("embedding") == dim) & finite
    chosen = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return (chosen.where(F.coalesce(ok, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("rid"), "vec_id",
                    F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x).cast("bigint")).alias("v")))


def initial_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The k vectors of smallest sha256 of ``<seed>:<vec_id>``, in that order (a top-k, k rows)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return [list(r["v"]) for r in rows]


def _matrix(values, exact: bool) -> np.ndarray:
    return np.array(values, dtype=object) if exact else np.array(values, dtype=np.int64)


def _step(model, first: bool):
    """Task function: update dot products by the sparse centroid changes, then assign."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, changes = model.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            dim = len(centroids[0])
            exact = bool(flat.size) and int(np.abs(flat).max()) > _SMALL
            vecs = _matrix(flat.reshape(-1, dim).tolist() if exact else flat.reshape(-1, dim), exact)
            if first:
                dots = vecs @ _matrix(centroids, exact).T
            else:
                dots = _matrix(batch.column("dots").to_pylist(), exact)
                columns = sorted({j for _, j, _ in changes})
                if columns:
                    delta = _matrix([[0] * len(columns) for _ in centroids], exact)
                    where = {j: n for n, j in enumerate(columns)}
                    for c, j, d in changes:
                        delta[c, where[j]] = d
                    dots = dots + vecs[:, columns] @ delta.T
            norms = (vecs * vecs).sum(axis=1)
            sizes = _matrix([sum(y * y for y in c) for c in centroids], exact)
            dist = norms[:, None] - 2 * dots + sizes[None, :]
            nearest = np.argmin(dist, axis=1) if dist.size else np.zeros(0, dtype=np.int64)  # first minimum: smaller number
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("vec_id"), batch.column("v"),
                 pa.array([[int(x) for x in row] for row in dots], pa.list_(pa.int64())),
                 pa.array(nearest.astype(np.int32), pa.int32()),
                 pa.array([int(dist[i, c]) for i, c in enumerate(nearest)], pa.int64())],
                ["rid", "vec_id", "v", "dots", "cluster", "distance"])

    return run


_STATE = "rid bigint, vec_id bigint, v array<bigint>, dots array<bigint>, cluster int, distance bigint"


def _moved(state: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: floor of the member mean for non-empty clusters (k rows collected)."""
    dim = len(centroids[0])
    sums = [F.sum(F.col("v")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(dim)]
    rows = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    moved = [list(c) for c in centroids]
    for r in rows:
        n = int(r["n"])
        moved[r["cluster"]] = [int(r[f"s{j}"]) // n for j in range(dim)]
    return moved


def clusters(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = embeddings.sparkSession
    vectors = stored(kept_vectors(embeddings, dim), "kmeans-vectors")
    centroids = initial_centroids(vectors, k, seed)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    model = spark.sparkContext.broadcast((centroids, []))
    state = stored(vectors.mapInArrow(_step(model, True), _STATE), "kmeans-state")
    for _ in range(rounds):
        moved = _moved(state, centroids)
        changes = [(c, j, b - a) for c, (old, new) in enumerate(zip(centroids, moved)) for j, (a, b) in enumerate(zip(old, new)) if a != b]
        centroids = moved
        model = spark.sparkContext.broadcast((centroids, changes))
        state = stored(state.mapInArrow(_step(model, False), _STATE), "kmeans-state")
    digests = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    per_cluster = state.groupBy("cluster").agg(F.sum("distance").cast("bigint").alias("cluster_inertia"))
    total = state.agg(F.sum("distance").cast("bigint")).first()[0]  # one scalar
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # both small sides hold at most k rows: broadcast by that bound
    return (state.join(F.broadcast(per_cluster), "cluster").join(F.broadcast(named), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("bigint").alias("inertia"), "centroid_sha256"))


def brute_force(rows: list[tuple], k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM) -> list[tuple]:
    """Plain Python of the contract over (vec_id, embedding) rows, for tests."""
    import math

    kept = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return []
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append(min(range(len(cents)), key=lambda c: (d[c], c)))
        return out

    for _ in range(rounds):
        a = assign()
        for c in range(len(cents)):
            members = [v for (_, v), x in zip(kept, a) if x == c]
            if members:
                cents[c] = [sum(col) // len(members) for col in zip(*members)]
    a = assign()
    dist = [sum((x - y) ** 2 for x, y in zip(v, cents[c])) for (_, v), c in zip(kept, a)]
    per = {c: sum(d for d, x in zip(dist, a) if x == c) for c in set(a)}
    sha = {c: hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest() for c in range(len(cents))}
    return [(i, c, d, per[c], sum(dist), sha[c]) for (i, _), c, d in zip(kept, a, dist)]
