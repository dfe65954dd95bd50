"""Centroid clustering of integer vectors by scalar lookup tables.

Components are whole numbers, so in each round only few squared differences occur: for each dimension, each number that
occurs there and each centroid one. A task tabulates them for its batch of vectors, and distances are gathers from these
tables and sums, in 64-bit integers without rounding. A round ships one row for each centroid and dimension of a task,
summed by Spark; new centroids are exact floors, worked out on the driver from k rows a dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.vectors import finite, matrix
from bazaarlens.session import write_out

LARGEST = 2.0**27  # components below it keep a distance of 64 of them within 62 bits
VECTORS = 8192  # vectors whose distances a task holds at once


def coded(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur in a column, in order, and the place of each entry's number among them."""
    low, high = int(column.min()), int(column.max())
    if high - low > 4 * len(column):
        return np.unique(column, return_inverse=True)
    there = np.bincount(column - low, minlength=high - low + 1) > 0
    return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[column - low]


def distances(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of vectors and centroids, a row for each vector."""
    out = np.zeros((len(q), len(centroids)), np.int64)
    for d in range(q.shape[1]):
        numbers, code = coded(q[:, d])
        table = (numbers[:, None] - centroids[:, d]) ** 2
        out += table[code]
    return out


def _nearest(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch with their vectors, each vector's nearest centroid and its distance; of equals the first."""
    for at in range(0, len(batch), VECTORS):
        part = batch.slice(at, VECTORS)
        q = matrix(pa.chunked_array([part["q"]]), centroids.shape[1])
        distance = distances(q, centroids)
        cluster = distance.argmin(1)
        yield part, q, cluster, distance[np.arange(len(q)), cluster]


def _sums(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for _, q, cluster, _ in _nearest(batch, centroids):
                n += np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                held, first = np.unique(cluster[order], return_index=True)
                total[held] += np.add.reduceat(q[order], first, axis=0)
        cluster, d = np.divmod(np.arange(k * dim), dim)
        table = pa.RecordBatch.from_pydict({"cluster": cluster, "d": d, "n": np.repeat(n, dim), "total": total.ravel()})
        yield table.filter(pa.array(np.repeat(n, dim) > 0))

    return task


def _assigned(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, cluster, distance in _nearest(batch, centroids):
                columns = {"vec_id": part["vec_id"], "cluster": pa.array(cluster, pa.int32()), "distance": distance}
                yield pa.RecordBatch.from_pydict(columns)

    return task


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each vector with exactly ``dim`` components.

    Vectors that are NULL, have another number of components or hold a NULL or non-finite one are left out. Components x
    become floor(scale * x). Centroids start as the k vectors with the smallest lower-case hex SHA-256 of "seed:vec_id"
    (fewer vectors: as many centroids; rows that repeat a vec_id: smaller vectors first; rows with a NULL vec_id start
    none, but are clustered). After ``rounds`` rounds of assigning to the nearest centroid (ties: smaller number) and
    replacing non-empty centroids by exact floors of means, vectors are assigned once more. A component of 2**27 or more
    in size ends the query with an error, as its distances need not fit into 64 bits; so does a sum that does not. Other
    columns are ignored; an empty table, and one whose vec_ids are all NULL, gives no rows.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(finite()).where(F.size("x") == dim)
    scaled = known.withColumn("x", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("double")))
    fault = F.raise_error(F.concat(F.lit("component too large in vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("NULL"))))
    small = F.forall("x", lambda v: F.abs(v) < LARGEST)
    whole = F.when(small, F.transform("x", lambda v: v.cast("long"))).otherwise(fault.cast("array<long>"))
    rows = write_out(scaled.select("vec_id", whole.alias("q")), "cluster-vectors")

    lot = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").select(lot.alias("lot"), "vec_id", "q").orderBy("lot", "vec_id", "q").limit(k).collect()
    centroids = np.array([r["q"] for r in first], np.int64).reshape(len(first), dim)
    if not len(first):
        kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], kind)
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(centroids), "cluster long, d long, n long, total long")
        for r in sums.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            centroids[r["cluster"], r["d"]] = r["total"] // r["n"]

    told = write_out(rows.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), "clustered")
    held = {r["cluster"]: r["s"] for r in told.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)  # noqa: E731  k values
    return told.select(
        "vec_id",
        "cluster",
        "distance",
        of([held.get(c, 0) for c in range(len(first))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(held.values())).cast("long").alias("inertia"),
        of(digests).alias("centroid_sha256"),
    )


def _oracle(rounds: int = 3) -> str:
    """DuckDB SQL; a round is three common table expressions."""
    steps = [
        """rows AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), lots AS (
    SELECT q, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), vec_id, q) - 1 AS c FROM rows WHERE vec_id IS NOT NULL
), centroids0 AS (SELECT c, q FROM lots WHERE c < 16)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""distances{i} AS MATERIALIZED (
    SELECT r, c, list_sum(list_transform(list_zip(rows.q, m.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM rows, centroids{i} m
), near{i} AS MATERIALIZED (
    SELECT r, c, distance FROM distances{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1
)""")
        if i < rounds:
            steps.append(f"""moved{i} AS (
    SELECT c, d, sum(q[d])::BIGINT AS total, count(*) AS n
    FROM near{i} JOIN rows USING (r), range(1, 65) dims(d) GROUP BY c, d
), means{i} AS (
    SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY d) AS q FROM moved{i} GROUP BY c
), centroids{i + 1} AS (
    SELECT c, coalesce(a.q, m.q) AS q FROM centroids{i} m LEFT JOIN means{i} a USING (c)
)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.q, ',')) AS centroid_sha256
FROM near{rounds} JOIN rows USING (r) JOIN centroids{rounds} m USING (c)
"""


ORACLE = _oracle()
