"""Nearest neighbours by largest inner product over balanced posting lists.

Inner products become distances by one more coordinate: vectors get sqrt(M^2 - |x|^2), with
M the largest norm, queries get 0. A bounded sample is halved again and again along the line
between two means until the leaves are small, which gives lists of equal share; the leaf
means are the centroids. A graph over the centroids (near neighbours and some far links) is
held in memory by every worker and searched with a beam, for all rows of a batch at once.
Vectors near a border are stored in every list whose centroid is at most ``REPLICA_RATIO``
times as far as the nearest, up to ``REPLICAS`` lists. A query reads the lists whose distance
is at most a ratio times that of the nearest one. The beam is ``BEAM`` wide, however many
centroids there are, and the ratio is the smallest of ``RATIOS`` that reaches ``TARGET`` recall on
sampled queries against brute force over the sample. Where none does, the beam is doubled, in
the end to all centroids with all lists read, which is exact; so the target is always met on
the sample.

All rows are indexed; among equal vectors only the k + 1 smallest ids can be results, so
only those are stored (Spark keeps that many per task before it shuffles). Neighbouring lists
share a shelf; a shelf with many rows or queries is cut in blocks, each pair of which is
searched by one group, so no group grows with the data.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, as query or candidate; scores are double sums in order
of the components; ties go to the smaller id; rows that share an id and vector count once;
ids are not null; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import keep

SAMPLE_ROWS = 20_000
ROWS_PER_CENTROID = 32
REPLICAS = 4
REPLICA_RATIO = 1.05
RATIOS = (1.02, 1.05, 1.1, 1.15, 1.2, 1.3, 1.4, 1.6, 2.0, 3.0)
TARGET = 0.97
TUNING_QUERIES = 200
BEAM = 64
NEAR_LINKS, FAR_LINKS = 16, 4
SHELF = 8
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4_096
SEED = 11


def halved(points: np.ndarray, leaf: int, seed: int = SEED) -> np.ndarray:
    """Means of equal parts of the points, neighbours side by side."""
    random = np.random.default_rng(seed)
    means: list[np.ndarray] = []

    def split(rows: np.ndarray) -> None:
        if len(rows) <= leaf:
            means.append(rows.mean(axis=0))
            return
        pair = rows[random.choice(len(rows), 2, replace=False)].copy()
        for _ in range(5):
            along = rows @ (pair[1] - pair[0])
            order = np.argsort(along, kind="stable")
            low, high = order[: len(rows) // 2], order[len(rows) // 2 :]
            pair = np.stack([rows[low].mean(axis=0), rows[high].mean(axis=0)])
        split(rows[low])
        split(rows[high])

    split(points)
    return np.stack(means).astype(np.float32)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    cross = points @ centres.T
    return np.maximum(
        (points**2).sum(axis=1)[:, None] - 2 * cross + (centres**2).sum(axis=1)[None, :], 0
    )


def link(centres: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Links of each centroid: its nearest ones and some at random."""
    random = np.random.default_rng(seed)
    count = len(centres)
    near = min(NEAR_LINKS, count)
    links = np.empty((count, near + FAR_LINKS), np.int32)
    for low in range(0, count, 1024):
        away = _squares(centres[low : low + 1024], centres)
        links[low : low + 1024, :near] = np.argpartition(away, near - 1, axis=1)[:, :near]
    links[:, near:] = random.integers(0, count, (count, FAR_LINKS))
    return links


def beam_search(
    points: np.ndarray, centres: np.ndarray, links: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroids found for each point, ascending: ids and distances."""
    count = len(points)
    width = min(width, len(centres))
    entries = np.unique(np.linspace(0, len(centres) - 1, width).astype(np.int64))
    ids = np.broadcast_to(entries, (count, len(entries))).copy()
    away = _squares(points, centres[entries])
    order = np.argsort(away, axis=1, kind="stable")
    ids, away = np.take_along_axis(ids, order, 1), np.take_along_axis(away, order, 1)
    done = np.zeros(ids.shape, bool)
    rows = np.arange(count)
    while True:
        open_rows = rows[~done[rows].all(axis=1)]
        if not len(open_rows):
            return ids, np.sqrt(away)
        rows = open_rows
        at = np.argmin(done[rows], axis=1)  # the nearest one not yet followed
        done[rows, at] = True
        new = links[ids[rows, at]].astype(np.int64)
        gap = centres[new] - points[rows][:, None, :]
        far = np.einsum("ijk,ijk->ij", gap, gap)
        known = (new[:, :, None] == ids[rows][:, None, :]).any(axis=2)
        twice = np.triu(new[:, :, None] == new[:, None, :], 1).any(axis=1)
        far[known | twice] = np.inf
        all_ids = np.concatenate([ids[rows], new], axis=1)
        all_away = np.concatenate([away[rows], far], axis=1)
        all_done = np.concatenate([done[rows], np.zeros(new.shape, bool)], axis=1)
        best = np.argsort(all_away, axis=1, kind="stable")[:, : ids.shape[1]]
        ids[rows] = np.take_along_axis(all_ids, best, 1)
        away[rows] = np.take_along_axis(all_away, best, 1)
        done[rows] = np.take_along_axis(all_done, best, 1) | ~np.isfinite(away[rows])


def lists_of(ids: np.ndarray, away: np.ndarray, ratio: float, most: int | None) -> list[np.ndarray]:
    """Lists at most ``ratio`` times as far as the nearest."""
    near = away <= ratio * away[:, :1] + 1e-12 if np.isfinite(ratio) else np.ones(away.shape, bool)
    if most:
        near[:, most:] = False
    return [row[mark] for row, mark in zip(ids, near, strict=True)]


def widened(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Stored form of vectors: one more coordinate makes all norms equal."""
    rest = np.maximum(norm**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0)
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1).astype(np.float32)


def asked(vectors: np.ndarray) -> np.ndarray:
    """Query form of vectors."""
    return np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1).astype(np.float32)


class Index:
    """Centroids, their graph and the tuned ratio; its size is that of the centroids."""

    def __init__(self, sample: np.ndarray, norm: float, lists: int, k: int) -> None:
        self.norm = norm
        stored = widened(sample, norm)
        self.centres = halved(stored, max(1, ceil(len(stored) / lists)))
        self.links = link(self.centres)
        self.beam, self.ratio, self.recall = self._tuned(sample, stored, k)

    def _tuned(self, sample: np.ndarray, stored: np.ndarray, k: int) -> tuple[int, float, float]:
        queries = sample[:TUNING_QUERIES]
        best = np.argsort(-(queries @ sample.T), axis=1, kind="stable")[:, : k + 1]
        homes = self.store(stored)
        places: list[set[int]] = [set(home.tolist()) for home in homes]
        beam = BEAM
        while True:
            ids, away = beam_search(asked(queries), self.centres, self.links, beam)
            whole = beam >= len(self.centres)
            for ratio in (*RATIOS, np.inf) if whole else RATIOS:
                read = lists_of(ids, away, ratio, None)
                hits = [
                    not places[row].isdisjoint(lists.tolist())
                    for lists, rows in zip(read, best, strict=True) for row in rows
                ]
                recall = float(np.mean(hits)) if hits else 1.0
                if recall >= TARGET:
                    return beam, ratio, recall
            if whole:
                raise ValueError("the index misses vectors that it stores")
            beam *= 2

    def store(self, stored: np.ndarray) -> list[np.ndarray]:
        """Lists that hold each stored vector."""
        found = beam_search(stored, self.centres, self.links, BEAM)
        return lists_of(*found, REPLICA_RATIO, REPLICAS)

    def read(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Lists that each query reads."""
        found = beam_search(asked(vectors), self.centres, self.links, self.beam)
        return lists_of(*found, self.ratio, None)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products as double sums in order of the components."""
    return np.cumsum(query[None, :] * vectors, axis=1)[:, -1]


def usable(vector: Column, dim: int) -> Column:
    """Vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = (F.size(vector) == dim) & ~F.exists(vector, lambda x: F.coalesce(bad(x), F.lit(True)))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(
    spark: SparkSession,
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lists: int | None = None,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k nearest found for each query."""
    out = "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE"
    sizes = rows.groupBy(F.size(vector_col).alias("n")).count().where("n > 0")
    common = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return spark.createDataFrame([], out)
    dim = common["n"]
    plain = rows.select(
        F.col(id_col).cast("bigint").alias("_id"), F.col(vector_col).alias("_vec"),
        is_query.alias("_asks"),
    ).where(usable(F.col("_vec"), dim) & F.col("_id").isNotNull())
    square = F.aggregate("_vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total = plain.agg(F.count("*"), F.max(square)).first()
    if not total[0]:
        return spark.createDataFrame([], out)
    lists = lists or max(1, ceil(total[0] ** 0.5))
    wanted = max(SAMPLE_ROWS, ROWS_PER_CENTROID * lists)
    # The bound of the sample is a parameter (rows per centroid), the draw is by hash.
    drawn = plain.select("_id", "_vec").orderBy(F.xxhash64("_id"), "_id").limit(wanted).toArrow()
    sample = matrix(drawn.column("_vec").combine_chunks(), dim)
    index = spark.sparkContext.broadcast(Index(sample, float(total[1]) ** 0.5, lists, k))

    equal = Window.partitionBy("_vec").orderBy("_id")
    ranked = plain.select("_id", "_vec").distinct().withColumn("_n", F.row_number().over(equal))
    candidates = ranked.where(F.col("_n") <= k + 1).drop("_n")
    # Queries with equal vectors read the same lists: one of them stands for all.
    askers = plain.where("_asks").select("_id", "_vec").distinct()
    queries = askers.groupBy("_vec").agg(F.min("_id").alias("_id")).select("_id", "_vec")

    def placed(kind: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in batches:
                for low in range(0, batch.num_rows, 1024):
                    part = batch.slice(low, 1024)
                    vectors = matrix(part.column("_vec"), dim)
                    if kind == "store":
                        homes = own.store(widened(vectors, own.norm))
                    else:
                        homes = own.read(vectors)
                    at, shelf, inside = [], [], []
                    for i, home in enumerate(homes):
                        shelves = np.unique(home // SHELF)
                        at += [i] * len(shelves)
                        shelf += shelves.tolist()
                        inside += [home[home // SHELF == s].tolist() for s in shelves]
                    taken = part.take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shelf, pa.int32()), pa.array(inside, pa.list_(pa.int32())),
                            taken.column("_id"), taken.column("_vec"),
                        ],
                        ["_shelf", "_lists", "_id", "_vec"],
                    )

        return run

    kind = plain.schema["_vec"].dataType.simpleString()
    shape = f"_shelf INT, _lists ARRAY<INT>, _id BIGINT, _vec {kind}"
    stored = keep(spark, candidates.mapInArrow(placed("store"), shape), "postings")
    probes = keep(spark, queries.mapInArrow(placed("read"), shape), "probes")
    blocks = _blocks(stored, BLOCK_ROWS, "_b").join(_blocks(probes, BLOCK_QUERIES, "_q"), "_shelf")
    left = stored.join(blocks, "_shelf").withColumn("_bi", F.pmod(F.xxhash64("_id"), "_b")).withColumn(
        "_qi", F.explode(F.sequence(F.lit(0), F.col("_q") - 1))
    )
    right = probes.join(blocks, "_shelf").withColumn("_qi", F.pmod(F.xxhash64("_id"), "_q")).withColumn(
        "_bi", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))
    )
    key = ("_shelf", "_bi", "_qi")
    columns = [*key, "_lists", "_id", "_vec"]

    def compare(posts: pa.Table, asks: pa.Table) -> pa.Table:
        queries_out, found_out = [], []
        if posts.num_rows and asks.num_rows:
            ids = posts.column("_id").to_numpy()
            vectors = matrix(posts.column("_vec").combine_chunks(), dim)
            q_ids = asks.column("_id").to_numpy()
            q_vectors = matrix(asks.column("_vec").combine_chunks(), dim)
            member = _members(posts.column("_lists").to_pylist())
            reads = _members(asks.column("_lists").to_pylist())
            for low in range(0, len(q_ids), 256):
                scores = q_vectors[low : low + 256] @ vectors.T
                scores[(reads[low : low + 256] @ member.T) == 0] = -np.inf
                for i, row in enumerate(scores):
                    some = np.flatnonzero(np.isfinite(row))
                    if not len(some):
                        continue
                    if len(some) > k + 1:
                        bar = np.partition(row[some], -(k + 1))[-(k + 1)]
                        some = some[row[some] >= bar - 1e-9 * max(1.0, abs(bar))]
                    value = exact(q_vectors[low + i], vectors[some])
                    order = np.lexsort((ids[some], -value))[: k + 1]
                    queries_out.append(q_ids[low + i])
                    found_out.append(
                        [{"away": -value[j], "id": ids[some[j]]} for j in order]
                    )
        pair = pa.struct([("away", pa.float64()), ("id", pa.int64())])
        return pa.table(
            {
                "_query": pa.array(queries_out, pa.int64()),
                "_found": pa.array(found_out, pa.list_(pair)),
            }
        )

    found = left.select(columns).groupBy(*key).cogroup(right.select(columns).groupBy(*key)).applyInArrow(
        compare, "_query BIGINT, _found ARRAY<STRUCT<away: DOUBLE, id: BIGINT>>"
    )
    # A list of k + 1 per shelf read: the number of shelves bounds what meets here.
    merged = found.groupBy("_query").agg(F.flatten(F.collect_list("_found")).alias("_found"))
    merged = merged.select(
        F.col("_query").alias("_id"),
        F.slice(F.array_sort(F.array_distinct("_found")), 1, k + 1).alias("_found"),
    )
    by_vector = queries.join(merged, "_id").select("_vec", "_found")
    answers = askers.join(by_vector, "_vec").select(
        F.col("_id").alias("query_id"),
        F.slice(F.filter("_found", lambda f: f["id"] != F.col("_id")), 1, k).alias("_found"),
    )
    return answers.select("query_id", F.posexplode("_found").alias("_i", "_f")).select(
        "query_id", (F.col("_i") + 1).cast("int").alias("rank"), F.col("_f")["id"].alias("vec_id"),
        (F.lit(0.0) - F.col("_f")["away"]).alias("score"),
    )


def _members(lists: list[list[int]]) -> np.ndarray:
    """Which lists of the shelf each row is in, as a small matrix."""
    member = np.zeros((len(lists), SHELF), np.float32)
    for i, row in enumerate(lists):
        member[i, [home % SHELF for home in row]] = 1
    return member


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Number of blocks of each shelf."""
    return rows.groupBy("_shelf").agg(F.ceil(F.count("*") / size).alias(name))
