"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut in blocks: hash ranges of its documents, so block order is already a
random order of documents. A block has about 1 / (``SHARDS`` x ``SHARD_BLOCKS``) of all words, and
``BLOCK_WORDS`` at most, so there are ``SHARDS`` shards or more at every size, and of large inputs
as many as keep a shard at ``MOST_BLOCKS`` blocks. A source's target is met by
whole passes over its blocks and one partial pass that ends inside one block, at a word.
Each pass visits the blocks in a permuted order of its own. The numbers of blocks drawn
per source are the quotas. A binary tree over the output shards splits the quota vector: a
node draws its left child's share without replacement (multivariate hypergeometric), so
every shard has a fixed number of blocks and all quotas are met exactly. A node's draw
depends on the seed and its place only, so tasks walk the tree themselves and nothing but
one row per source is ever held by the driver. The j-th drawn block of a source goes to the
shard whose range holds j, so draws are disjoint. Inside a shard rows are ordered by a hash.

Targets: sources in code point order, null last, take the weights in turn and share all
words by weight; a target stops at ``cap`` times its source's words and the excess goes to
the others by weight until none is above.

Defined results: null and empty texts have size 0 and take 0 words; a source without words
has target 0; rows that repeat are drawn alike and each counts; null ids are rows like
others; an empty table gives an empty table; other columns pass through in a struct.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from math import ceil, gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm.common import keep

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK_WORDS = 1 << 16
SHARDS = 64
SHARD_BLOCKS = 64  # wanted in each of SHARDS shards
MOST_BLOCKS = 1 << 12  # of a shard
CELL = 1 << 12
MAX_SOURCES = 1_000_000
SEED = 20
SOURCES = T.StructType(
    [
        T.StructField("_source", T.StringType()),
        T.StructField("_sid", T.IntegerType()),
        T.StructField("_source_size", T.LongType()),
        T.StructField("_target", T.DoubleType()),
        T.StructField("_full", T.IntegerType()),
        T.StructField("_rest", T.LongType()),
        T.StructField("_blocks", T.LongType()),
        T.StructField("_steps", T.ArrayType(T.LongType())),
        T.StructField("_shifts", T.ArrayType(T.LongType())),
    ]
)


def word_count(text: Column) -> Column:
    """Number of words of a text, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, cap: float = CAP
) -> dict[str | None, float]:
    """Words to take from each source."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    left, free, targets = float(sum(sizes.values())), list(names), {}
    while free:
        total = sum(weight[name] for name in free)
        over = [name for name in free if left * weight[name] / total > cap * sizes[name]]
        if not over:
            targets |= {name: left * weight[name] / total for name in free}
            break
        targets |= {name: float(cap * sizes[name]) for name in over}
        left -= sum(targets[name] for name in over)
        free = [name for name in free if name not in targets]
    return targets


def _plan(
    sizes: dict[str | None, int], weights: Sequence[float], cap: float, block_words: int, seed: int
) -> list[tuple]:
    """One row per source: passes, rest and the block permutation of each pass."""
    rows = []
    targets = source_targets(sizes, weights, cap)
    for sid, (name, target) in enumerate(
        sorted(targets.items(), key=lambda kv: (kv[0] is None, kv[0] or ""))
    ):
        size = sizes[name]
        goal = round(target)
        full, rest = divmod(goal, size) if size else (0, 0)
        blocks = max(1, ceil(size / block_words))
        draw = np.random.default_rng([seed, sid])
        steps, shifts = [], []
        for _ in range(full + 1):
            step = int(draw.integers(1, blocks + 1))
            while gcd(step, blocks) != 1:
                step += 1
            steps.append(step % blocks)
            shifts.append(int(draw.integers(0, blocks)))
        rows.append((name, sid, size, float(target), full, rest, blocks, steps, shifts))
    return rows


def _block_words(total: int) -> int:
    """Words of a block: a fixed share of all, within bounds."""
    return max(1, min(BLOCK_WORDS, total // (SHARDS * SHARD_BLOCKS)))


def _place(number: Column | int) -> Column:
    """Place of a row's block in the order of a pass."""
    step, shift = F.get("_steps", number), F.get("_shifts", number)
    return F.pmod(F.col("_block") * step + shift, F.col("_blocks"))


class SplittingTree:
    """Which shard takes the j-th block drawn from a source."""

    def __init__(self, quotas: Sequence[int], shards: int, seed: int) -> None:
        self.quotas, self.shards, self.seed = np.array(quotas, np.int64), shards, seed
        self.left = functools.lru_cache(maxsize=65536)(self._left)

    def held(self, low: int, high: int) -> int:
        """Blocks of shards [low, high): sizes differ by one at most."""
        base, more = divmod(int(self.quotas.sum()), self.shards)
        return base * (high - low) + min(more, high) - min(more, low)

    def _left(self, low: int, high: int, counts: bytes) -> np.ndarray:
        draw = np.random.default_rng([self.seed, low, high])
        middle = (low + high) // 2
        return draw.multivariate_hypergeometric(
            np.frombuffer(counts, np.int64), self.held(low, middle), method="marginals"
        )

    def shard(self, sid: int, number: int) -> int:
        """Walk from the root to the leaf that holds the drawn block."""
        low, high, counts = 0, self.shards, self.quotas
        while high - low > 1:
            middle = (low + high) // 2
            left = self.left(low, high, counts.tobytes())
            if number < left[sid]:
                high, counts = middle, left
            else:
                number -= int(left[sid])
                low, counts = middle, counts - left
        return low


def draw_words(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    cap: float = CAP,
    block_words: int | None = None,
    shards: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One slim row per document: ``_id``, ``_text`` (hash), ``_source``, ``_size``,
    ``_source_size``, ``_target`` and ``_draws``, an array of (pass, shard, words, order, block).
    ``block_words`` and ``shards`` follow from the number of words unless given."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        F.xxhash64(text).alias("_text"),
        word_count(F.col(text_col)).alias("_size"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("_hash"),
    )
    slim = keep(spark, slim, "mix-sizes")
    totals = slim.groupBy("_source").agg(F.sum("_size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError("too many sources for one row each on the driver")
    sizes = {r[0]: r[1] for r in totals}
    block_words = block_words or _block_words(sum(sizes.values()))
    plan = _plan(sizes, weights, cap, block_words, seed)
    sources = spark.createDataFrame(plan, SOURCES)
    same = slim["_source"].eqNullSafe(sources["_source"])
    unit = F.shiftrightunsigned("_hash", 11).cast("double") / float(1 << 53)
    rows = (
        slim.join(sources, same)
        .drop(sources["_source"])
        .withColumn("_block", F.floor(unit * F.col("_blocks")))
        .withColumn("_place", _place(F.col("_full")))
    )
    cuts = {r["_sid"]: (r["_place"], r["_need"]) for r in _cuts(rows).collect()}
    quotas = [
        row[4] * row[6] + (cuts[row[1]][0] + 1 if row[1] in cuts else 0) for row in plan
    ]
    shards = shards or max(SHARDS, ceil(sum(quotas) / MOST_BLOCKS))
    cut_rows = spark.createDataFrame(
        [(sid, *cuts.get(sid, (-1, 0))) for sid in range(len(plan))],
        "_sid INT, _cut BIGINT, _need BIGINT",
    )
    rows = rows.join(cut_rows, "_sid")
    # Inside the block where the partial pass ends, documents are taken in order of their
    # hash up to the cut: one block per source, so the windows are small. Documents without
    # words, of which a block may hold any number, stay out of them.
    order = Window.partitionBy("_sid").orderBy("_hash", "_id", "_text")
    before = F.coalesce(
        F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    cut = (F.col("_place") == F.col("_cut")) & (F.col("_size") > 0)
    ends = rows.where(cut).withColumn(
        "_part", F.least("_size", F.greatest(F.col("_need") - before, F.lit(0)))
    )
    inside = rows.where(~cut).withColumn(
        "_part", F.when(F.col("_place") < F.col("_cut"), F.col("_size")).otherwise(0)
    )

    @F.pandas_udf("ARRAY<INT>")
    def shards_of(sids: pd.Series, numbers: pd.Series) -> pd.Series:
        tree = _tree(tuple(quotas), shards, seed)
        drawn = [
            [(sid, int(j)) if j is not None and j >= 0 else None for j in each]
            for sid, each in zip(sids.tolist(), numbers.tolist(), strict=True)
        ]
        memo = {pair: tree.shard(*pair) for pair in {p for each in drawn for p in each if p}}
        return pd.Series([[memo.get(pair) for pair in each] for each in drawn])

    def words(number: Column) -> Column:
        return F.when(number < F.col("_full"), F.col("_size")).otherwise(F.col("_part"))

    passes = F.sequence(F.lit(0), F.col("_full"))
    numbers = F.transform(
        passes, lambda p: F.when(words(p) > 0, p * F.col("_blocks") + _place(p)).otherwise(-1)
    )
    draws = F.transform(
        passes,
        lambda p: F.struct(
            p.alias("pass"),
            F.get("_shards", p).alias("shard"),
            words(p).alias("words"),
            F.xxhash64(F.lit(seed), p, "_hash").alias("order"),
            F.when(words(p) > 0, p * F.col("_blocks") + _place(p)).alias("block"),
        ),
    )
    return (
        inside.unionByName(ends)
        .withColumn("_shards", shards_of("_sid", numbers))
        .select(
            "_id", "_text", "_source", "_size", "_source_size", "_target",
            F.filter(draws, lambda d: d["words"] > 0).alias("_draws"),
        )
    )


def mix(spark: SparkSession, docs: DataFrame, whole: bool = False, **options) -> DataFrame:
    """The mixed rows: ``_doc`` (all columns), ``_pass``, ``_shard``, ``_words`` (to take from
    the start of the text) and ``_order`` inside the shard. With ``whole`` the document in
    which a source's last pass ends counts as taken in full."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    drawn = draw_words(spark, docs, **options)
    # Rows that repeat are drawn alike, or with the cut between them; each row of the table
    # takes one row of the draws, counted off among its equals.
    drawn = keep(spark, drawn.where(F.size("_draws") > 0), "mix-draws")
    equals = Window.partitionBy("_id", "_text", "_source").orderBy(F.size("_draws").desc())
    drawn = drawn.withColumn("_nth", F.row_number().over(equals))
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole_row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    # Rows without words are never drawn. Equals are counted off by all their columns.
    rows = docs.where(word_count(F.col(text_col)) > 0).select(
        whole_row.alias("_doc"),
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"),
        F.col(options.get("source_col", "source")).cast("string").alias("_source"),
    ).withColumn("_nth", F.row_number().over(
        Window.partitionBy("_id", "_text", "_source").orderBy(F.xxhash64("_doc"))
    ))
    same = [rows[k].eqNullSafe(drawn[k]) for k in ("_id", "_text", "_source", "_nth")]
    taken = rows.join(drawn, same).select(
        rows["_doc"], drawn["_size"].alias("_size"), F.explode("_draws").alias("_d")
    )
    share = F.col("_size") if whole else F.col("_d")["words"]
    return taken.select(
        "_doc", F.col("_d")["pass"].alias("_pass"), F.col("_d")["shard"].alias("_shard"),
        share.alias("_words"), F.col("_d")["order"].alias("_order"),
    )


def in_shards(mixed: DataFrame) -> DataFrame:
    """Rows of a shard side by side in one task, shuffled inside it. Shards have equal numbers
    of blocks, so no task is much larger than the others."""
    return mixed.repartition("_shard").sortWithinPartitions("_shard", "_order")


def write_shards(mixed: DataFrame, path: str) -> None:
    """One folder per shard, rows shuffled inside it."""
    in_shards(mixed).write.partitionBy("_shard").parquet(path)


@functools.lru_cache(maxsize=4)
def _tree(quotas: tuple[int, ...], shards: int, seed: int) -> SplittingTree:
    return SplittingTree(quotas, shards, seed)


def _cuts(rows: DataFrame) -> DataFrame:
    """Per source the place of the block in which the partial pass ends and the words it
    still needs there: sums over cells of places first, then inside one cell."""
    blocks = rows.groupBy("_sid", "_rest", "_place").agg(F.sum("_size").alias("_words"))
    blocks = blocks.withColumn("_cell", F.floor(F.col("_place") / CELL))
    cells = blocks.groupBy("_sid", "_rest", "_cell").agg(F.sum("_words").alias("_cell_words"))
    order = Window.partitionBy("_sid").orderBy("_cell")
    upto = F.sum("_cell_words").over(order)
    cells = cells.withColumn("_base", upto - F.col("_cell_words")).where(
        (F.col("_base") < F.col("_rest")) & (F.col("_rest") <= F.col("_base") + F.col("_cell_words"))
    )
    inner = Window.partitionBy("_sid").orderBy("_place")
    found = blocks.join(cells.select("_sid", "_cell", "_base"), ["_sid", "_cell"])
    found = found.withColumn("_before", F.col("_base") + F.sum("_words").over(inner) - F.col("_words"))
    return found.where(
        (F.col("_before") < F.col("_rest")) & (F.col("_rest") <= F.col("_before") + F.col("_words"))
    ).select("_sid", "_place", (F.col("_rest") - F.col("_before")).alias("_need"))
