"""Hard-negative mining with bounds along a spanning tree of anchors.

Vectors become whole numbers, floor(256 * x); a score is their integer inner product. Anchors
are dealt into blocks by a hash of the row; each block gets the minimum spanning tree of its
anchors. In a block a candidate c is scored at the root. Going down an edge of length d, its
score moves by at most d * |c|, so the parent's score (or interval) plus or minus that bounds
the child's. Only candidates whose interval overlaps what the child still wants are scored
again; the others hand their interval on.

Two passes do this. The first wants rows of the anchor's label that may be among the best. The
second wants rows of other labels inside a window below a positive's score, from
``low`` to ``high`` percent; once a window has enough negatives, or intervals inside it, their
least score is its new lower end. Both are exact: an interval that misses the window cannot
hold a result.

All candidates meet all anchors in pairs of blocks, one group each: at most about
``ANCHOR_BLOCK`` anchors and ``CANDIDATE_BLOCK`` candidates, dealt by hash, so neither a frequent
label nor a repeated vector makes a group large. A group returns at most ``positives`` rows, or
``negatives`` per positive, for each anchor; a window function takes the best of all groups.
Nothing but counts goes to the driver; nothing is broadcast.

Defined results: rows with a null id, label or vector, with null or non-finite components, with
another length than most, or of a norm that 64 bits can't score take no part. Rows equal in id,
label and whole-number vector count once. Rows that share an id but differ otherwise are rows of
their own, and each may be an anchor. Ties go to the smaller id. An anchor without positives, or
a positive whose window holds nothing (as below zero), has no rows. Zero vectors score 0. An empty
table gives an empty table. Columns not named are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import keep
from panelloom.llm.vectors import finite, fits, matrix, whole

ANCHOR_BLOCK = 2_048
CANDIDATE_BLOCK = 131_072
CHUNK = 4_096
SCALE = 256.0
RESULT = (
    "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, "
    "positive_score BIGINT, negative_score BIGINT"
)
FOUND = "_q INT, _node INT, _slot INT, _id BIGINT, _score BIGINT"


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree: rows parents first, each one's parent (a place in that order,
    -1 for the root) and the length of the edge to it."""
    exact = points.astype(np.float64)
    count = len(exact)
    near = np.full(count, np.inf)
    link = np.full(count, -1)
    open_ = np.ones(count, bool)
    children: list[list[int]] = [[] for _ in range(count)]
    at = 0
    for _ in range(count - 1):
        open_[at] = False
        away = ((exact - exact[at]) ** 2).sum(axis=1)
        closer = open_ & (away < near)
        near[closer], link[closer] = away[closer], at
        at = int(np.argmin(np.where(open_, near, np.inf)))
        children[link[at]].append(at)
    order, stack = [], [0]
    while stack:
        row = stack.pop()
        order.append(row)
        stack += children[row][::-1]
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    parent = np.array([place[link[row]] if row else -1 for row in order], np.int64)
    edge = np.array([near[row] ** 0.5 if row else 0.0 for row in order])
    return np.array(order), parent, edge


class Best:
    """The best rows of one slot so far: higher scores, then smaller ids."""

    __slots__ = ("ids", "most", "scores")

    def __init__(self, most: int) -> None:
        self.most = most
        self.ids = np.empty(0, np.int64)
        self.scores = np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))[: self.most]
        self.scores, self.ids = scores[best], ids[best]

    def bar(self, low: float) -> float:
        """Scores below this can't enter any more."""
        return max(low, float(self.scores[-1])) if len(self.scores) == self.most else low


class Windows:
    """What an anchor wants: scores of wanted rows inside closed windows, the best of each."""

    def __init__(self, bounds: list[tuple[float, float]], most: int) -> None:
        self.bounds = bounds
        self.best = [Best(most) for _ in bounds]

    def overlaps(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which intervals may hold a score that a window still wants. Intervals that lie inside
        a window hold scores of it, so the least end of the last one wanted is a bar, too."""
        found = np.zeros(len(low), bool)
        for (bottom, top), best in zip(self.bounds, self.best, strict=True):
            bar = best.bar(bottom)
            sure = low[(low >= bar) & (high <= top)]
            if len(sure) > best.most:
                bar = max(bar, float(np.partition(sure, -best.most)[-best.most]))
            found |= (high >= bar) & (low <= top)
        return found

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -scores))
        scores, ids = scores[order], ids[order]
        falling = -scores
        for (bottom, top), best in zip(self.bounds, self.best, strict=True):
            begin = 0 if top == np.inf else np.searchsorted(falling, -int(top), "left")
            end = len(scores) if bottom == -np.inf else np.searchsorted(
                falling, -int(bottom), "right"
            )
            end = min(end, begin + best.most)
            if begin < end:
                best.add(scores[begin:end], ids[begin:end])


class Anchors:
    """One block of anchors in tree order."""

    def __init__(self, table: pa.Table, dim: int) -> None:
        table = table.sort_by("_node")
        self.nodes = table.column("_node").to_pylist()
        self.parents = table.column("_parent").to_pylist()
        self.edges = table.column("_edge").to_pylist()
        self.ids = table.column("_id").to_pylist()
        self.labels = table.column("_label").to_pylist()
        self.vectors = matrix(table.column("_vec"), dim)
        self.wanted = [[] for _ in self.nodes]
        if "_positives" in table.column_names:
            self.wanted = [row or [] for row in table.column("_positives").to_pylist()]


def walk(
    candidates: pa.Table, anchors: Anchors, goals: list[Windows], dim: int, same_label: bool
) -> int:
    """Meet every goal over the candidates; returns how many scores were computed."""
    if not candidates.num_rows or not any(goal.bounds for goal in goals):
        return 0
    scored = 0
    waiting = np.bincount([p for p in anchors.parents if p >= 0], minlength=len(goals))
    largest = float((anchors.vectors.astype(np.float64) ** 2).sum(axis=1).max()) ** 0.5
    for begin in range(0, candidates.num_rows, CHUNK):
        part = candidates.slice(begin, CHUNK)
        vectors = matrix(part.column("_vec"), dim)
        ids = part.column("_id").to_numpy()
        labels = part.column("_label").to_numpy()
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        # Doubles add whole numbers exactly below 2^53, and much faster.
        plain = largest * float(norms.max()) < 2.0**52
        rows = vectors.astype(np.float64) if plain else vectors
        asks = anchors.vectors.astype(rows.dtype)
        room = 1.0 + norms * (largest * 1e-12)  # what rounding may add to an interval
        spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        left = waiting.copy()
        for node, (parent, edge, goal) in enumerate(
            zip(anchors.parents, anchors.edges, goals, strict=True)
        ):
            if parent < 0:
                low = (rows @ asks[node]).astype(np.float64)
                high = low.copy()
            else:
                reach = norms * (edge * (1 + 1e-9)) + room
                low, high = spans[parent][0] - reach, spans[parent][1] + reach
                left[parent] -= 1
                if not left[parent]:
                    del spans[parent]
            if goal.bounds:
                at = np.flatnonzero((labels == anchors.labels[node]) == same_label)
                if same_label:
                    own = at[ids[at] == anchors.ids[node]]
                    itself = own[(vectors[own] == anchors.vectors[node]).all(axis=1)]
                    at = np.setdiff1d(at, itself, assume_unique=True)
                at = at[goal.overlaps(low[at], high[at])]
                if len(at):
                    scored += len(at)
                    scores = rows[at] @ asks[node]
                    low[at] = high[at] = scores
                    goal.add(scores.astype(np.int64), ids[at])
            if left[node]:
                spans[node] = (low, high)
    return scored


def _rows_of(block: int, anchors: Anchors, goals: list[Windows]) -> pa.Table:
    nodes, slots, ids, scores = [], [], [], []
    for node, goal in zip(anchors.nodes, goals, strict=True):
        for slot, best in enumerate(goal.best):
            nodes += [node] * len(best.ids)
            slots += [slot] * len(best.ids)
            ids.append(best.ids)
            scores.append(best.scores)
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.table(
        {
            "_q": pa.array([block] * len(nodes), pa.int32()),
            "_node": pa.array(nodes, pa.int32()),
            "_slot": pa.array(slots, pa.int32()),
            "_id": pa.array(join(ids), pa.int64()),
            "_score": pa.array(join(scores), pa.int64()),
        }
    )


def _windows(positives: list[dict], low: int, high: int) -> list[tuple[float, float]]:
    """Least and largest whole score of each positive's window."""
    return [(-((-low * p["score"]) // 100), high * p["score"] // 100) for p in positives]


def _planted(rows: DataFrame, dim: int) -> DataFrame:
    """Anchors with their block's spanning tree."""

    def span(table: pa.Table) -> pa.Table:
        order, parent, edge = spanning_tree(matrix(table.column("_vec"), dim))
        table = table.take(pa.array(order))
        table = table.append_column("_node", pa.array(range(len(order)), pa.int32()))
        table = table.append_column("_parent", pa.array(parent, pa.int32()))
        return table.append_column("_edge", pa.array(edge, pa.float64()))

    return rows.groupBy("_q").applyInArrow(
        span,
        "_id BIGINT, _label BIGINT, _vec ARRAY<BIGINT>, _q INT, _node INT, _parent INT, _edge DOUBLE",
    )


def mine(
    spark: SparkSession,
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str | Column = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores: the first
    ``negatives`` rows of other labels in the window of each of an anchor's ``positives``."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    plain = rows.select(
        F.col(id_col).cast("bigint").alias("_id"),
        label.cast("bigint").alias("_label"),
        F.col(vector_col).alias("_raw"),
        F.coalesce(is_anchor, F.lit(False)).alias("_asks"),
    ).where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & finite(F.col("_raw")))
    sizes = plain.groupBy(F.size("_raw").alias("n")).count().where("n > 0")
    common = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    dim = common["n"]
    # Repeats meet here after a partial aggregation, so a row repeated often stays cheap.
    vectors = (
        plain.where(F.size("_raw") == dim)
        .select("_id", "_label", whole(F.col("_raw"), SCALE).alias("_vec"), "_asks")
        .where(fits(F.col("_vec")))
        .groupBy("_id", "_label", "_vec")
        .agg(F.max("_asks").alias("_asks"))
    )
    vectors = keep(spark, vectors, "vectors")
    total, asking = vectors.agg(F.count("*"), F.count_if("_asks")).first()
    if not asking:
        return spark.createDataFrame([], RESULT)
    cores = spark.sparkContext.defaultParallelism
    n_blocks = max(2 * cores, ceil(total / CANDIDATE_BLOCK))
    n_trees = ceil(asking / ANCHOR_BLOCK)
    deal = lambda count, seed: F.pmod(
        F.xxhash64("_id", "_label", "_vec", F.lit(seed)), F.lit(count)
    ).cast("int")
    anchors = vectors.where("_asks").drop("_asks").withColumn("_q", deal(n_trees, 1))
    tree = keep(spark, _planted(anchors, dim), "anchor-tree")
    blocks = (
        vectors.drop("_asks").withColumn("_c", deal(n_blocks, 2))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    )

    def met(anchor_rows: DataFrame, run: Callable) -> DataFrame:
        every = anchor_rows.withColumn(
            "_c", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
        )
        return blocks.groupBy("_c", "_q").cogroup(every.groupBy("_c", "_q")).applyInArrow(run, FOUND)

    def best_of(most: int, goals_of: Callable, same_label: bool) -> Callable:
        def run(key: tuple, candidates: pa.Table, block: pa.Table) -> pa.Table:
            own = Anchors(block, dim)
            goals = [Windows(goals_of(row), most) for row in own.wanted]
            if own.nodes:
                walk(candidates, own, goals, dim, same_label)
            return _rows_of(key[1].as_py(), own, goals)

        return run

    first = met(tree, best_of(positives, lambda _: [(-np.inf, np.inf)], True))
    by_score = Window.partitionBy("_q", "_node", "_slot").orderBy(F.desc("_score"), "_id")
    chosen = (
        first.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= positives)
        .groupBy("_q", "_node")
        .agg(F.array_sort(F.collect_list(
            F.struct("_n", F.col("_id").alias("id"), F.col("_score").alias("score"))
        )).alias("_positives"))
    )
    # Anchors without positives stay: the bounds of their children come through them.
    aimed = keep(spark, tree.join(chosen, ["_q", "_node"], "left"), "anchor-windows")
    second = met(aimed, best_of(negatives, lambda row: _windows(row, low, high), False))
    ranked = second.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= negatives)
    names = aimed.select("_q", "_node", F.col("_id").alias("anchor_id"), "_positives")
    paired = ranked.join(names, ["_q", "_node"]).withColumn(
        "_p", F.element_at("_positives", F.col("_slot") + 1)
    )
    return paired.select(
        "anchor_id", F.col("_p")["id"].alias("positive_id"), F.col("_n").alias("rank"),
        F.col("_id").alias("negative_id"), F.col("_p")["score"].alias("positive_score"),
        F.col("_score").alias("negative_score"),
    )
