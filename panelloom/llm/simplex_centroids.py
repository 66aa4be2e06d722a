"""Centroid clustering in whole numbers with bounds from an n-simplex projection.

Vectors become whole numbers, floor(256 * x). A bounded sample gives up to ``PIVOTS`` vectors
that span a simplex (each the one farthest from the span of those before). The distances of a
vector to the pivots fix an apex over that simplex; its coordinates are computed once, written
beside the vector and read in every round. Between two apexes, the plain Euclidean distance is
a lower bound of the vectors' distance and the one with an apex mirrored an upper bound. A
centroid whose lower bound exceeds the least upper bound can't be nearest; those left are
compared by exact integer distances, ties to the smaller number.

A round is one job: tasks add up whole-number sums per centroid, Spark adds the tasks' rows, and
the driver, which holds the centroids (their number is a parameter), divides exactly. What goes
to tasks is the centroids and the pivots, bounded by parameters.

Defined results: vectors that are null, have another length than ``dim`` or null or non-finite
components, or a norm that 64 bits can't square take no part and have no row. Repeated rows
count as often as they occur and have a row each. Rows with a null id take part, but start a
centroid only after all others. If there are fewer vectors than centroids, each starts one.
Centroids that start equal keep their numbers; the larger ones stay empty and where they were.
An empty table gives an empty table. Columns not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import keep
from panelloom.llm.vectors import finite, fits, matrix, whole

SCALE = 256.0
PIVOTS = 16
SAMPLE_ROWS = 1_024
FLAT = 1e-3  # altitudes below this share of the widest distance add no pivot
ROOM = 1e-4  # rounding allowed for in bounds, as a share of the squared distances
CHUNK = 4_096
RESULT = (
    "vec_id BIGINT, cluster INT, distance BIGINT, cluster_inertia BIGINT, inertia BIGINT, "
    "centroid_sha256 STRING"
)


def squares(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to one vector."""
    gap = rows - other
    return np.einsum("ij,ij->i", gap, gap)


class Simplex:
    """Pivots and the coordinates of their simplex."""

    def __init__(self, sample: np.ndarray, most: int = PIVOTS) -> None:
        away = squares(sample, sample[0])
        chosen = [int(np.argmax(away))]
        first = squares(sample, sample[chosen[0]]).astype(np.float64)
        rest = first.copy()  # squared distance to the span of the chosen pivots
        floor = FLAT**2 * float(first.max())
        coordinates = np.zeros((len(sample), 0))
        corners: list[np.ndarray] = []
        while len(chosen) < most and rest.max() > floor > 0:
            at = int(np.argmax(rest))
            corner = np.append(coordinates[at], rest[at] ** 0.5)
            own = squares(sample, sample[at]).astype(np.float64)
            axis = self._axis(corner, first, own, coordinates)
            corners.append(corner)
            coordinates = np.column_stack([coordinates, axis])
            rest = np.maximum(rest - axis**2, 0)
            chosen.append(at)
        self.pivots = sample[chosen]
        self.corners = corners

    @staticmethod
    def _axis(
        corner: np.ndarray, first: np.ndarray, own: np.ndarray, known: np.ndarray
    ) -> np.ndarray:
        """The next coordinate from the distances to the first pivot and to this one."""
        along = (corner**2).sum() + first - own - 2 * (known @ corner[:-1])
        return along / (2 * corner[-1])

    def apexes(self, rows: np.ndarray) -> np.ndarray:
        """Coordinates of the rows: along the simplex, and the altitude over it."""
        first = squares(rows, self.pivots[0]).astype(np.float64)
        out = np.zeros((len(rows), 0))
        for corner, pivot in zip(self.corners, self.pivots[1:], strict=True):
            own = squares(rows, pivot).astype(np.float64)
            out = np.column_stack([out, self._axis(corner, first, own, out)])
        altitude = np.sqrt(np.maximum(first - (out**2).sum(axis=1), 0))
        return np.column_stack([out, altitude])


class Centroids:
    """Centroids and their apexes over one simplex."""

    def __init__(self, vectors: np.ndarray, simplex: Simplex) -> None:
        self.vectors = vectors
        self.apexes = simplex.apexes(vectors)

    def nearest(self, rows: np.ndarray, apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid of each row, the squared distance, and how many were compared."""
        sizes = (apexes**2).sum(axis=1)[:, None] + (self.apexes**2).sum(axis=1)[None, :]
        room = ROOM * sizes + 1.0
        below = sizes - 2 * (apexes @ self.apexes.T)
        above = below + 4 * apexes[:, -1:] * self.apexes[None, :, -1]
        left = below - room <= (above + room).min(axis=1)[:, None]
        number = np.full(len(rows), -1, np.int64)
        distance = np.full(len(rows), np.iinfo(np.int64).max, np.int64)
        for k in np.flatnonzero(left.any(axis=0)):
            at = np.flatnonzero(left[:, k])
            away = squares(rows[at], self.vectors[k])
            closer = away < distance[at]  # numbers ascend, so ties keep the smaller
            number[at[closer]], distance[at[closer]] = k, away[closer]
        return number, distance, int(left.sum())

    def moved(self, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
        """Componentwise floor(sum / count); centroids without vectors stay."""
        out = self.vectors.copy()
        for k, (count, total) in sums.items():
            out[k] = [value // count for value in total]
        return out

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components as decimal integers joined by commas."""
        return [
            hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()
            for row in self.vectors.tolist()
        ]


def cluster(
    spark: SparkSession,
    rows: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dim: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: str = "2",
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, inertia of the cluster and of all, and the digest
    of the final centroid. The starters are the vectors with the least SHA-256 of
    ``<seed>:<id>``."""
    plain = (
        rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("_raw"))
        .where(finite(F.col("_raw")) & (F.size("_raw") == dim))
        .select("vec_id", whole(F.col("_raw"), SCALE).alias("_vec"))
        .where(fits(F.col("_vec")))
    )
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    # A bounded sample: its first rows start the centroids, all of it may give pivots.
    drawn = (
        plain.withColumn("_h", order).orderBy(F.asc_nulls_last("_h"), "_vec")
        .limit(max(SAMPLE_ROWS, k)).select("_vec").toArrow()
    )
    if not drawn.num_rows:
        return spark.createDataFrame([], RESULT)
    sample = matrix(drawn.column("_vec"), dim)
    simplex = Simplex(sample[:SAMPLE_ROWS])
    centroids = Centroids(sample[:k], simplex)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                part = batch.slice(low, CHUNK)
                apexes = simplex.apexes(matrix(part.column("_vec"), dim))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("_vec"),
                     pa.array(apexes.tolist(), pa.list_(pa.float64()))],
                    ["vec_id", "_vec", "_apex"],
                )

    shape = "vec_id BIGINT, _vec ARRAY<BIGINT>, _apex ARRAY<DOUBLE>"
    cached = keep(spark, plain.mapInArrow(project, shape), "apexes")

    def assigned(
        batches: Iterator[pa.RecordBatch], own: Centroids
    ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                part = batch.slice(low, CHUNK)
                vectors = matrix(part.column("_vec"), dim)
                flat = part.column("_apex").flatten().to_numpy(zero_copy_only=False)
                number, distance, _ = own.nearest(vectors, flat.reshape(len(vectors), -1))
                yield part, vectors, number, distance

    def summed(own: Centroids):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(own.vectors), dim), np.int64)
            counts = np.zeros(len(own.vectors), np.int64)
            for _, vectors, number, _ in assigned(batches, own):
                np.add.at(sums, number, vectors)
                counts += np.bincount(number, minlength=len(counts))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()),
                 pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
                ["cluster", "n", "sums"],
            )

        return run

    for _ in range(rounds):
        partial = cached.select("_vec", "_apex").mapInArrow(
            summed(centroids), "cluster INT, n BIGINT, sums ARRAY<BIGINT>"
        )
        totals = partial.groupBy("cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)]).alias("sums")
        )
        sums = {row["cluster"]: (row["n"], row["sums"]) for row in totals.collect()}
        centroids = Centroids(centroids.moved(sums), simplex)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, distance in assigned(batches, final):
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    final = centroids
    found = keep(
        spark, cached.mapInArrow(placed, "vec_id BIGINT, cluster INT, distance BIGINT"), "clusters"
    )
    inertia = {
        row["cluster"]: row["inertia"]
        for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    }
    digests = final.digests()
    # One row per centroid, so at most k.
    about = spark.createDataFrame(
        [(n, value, sum(inertia.values()), digests[n]) for n, value in inertia.items()],
        "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING",
    )
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
