"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import keep


def components(spark: SparkSession, edges: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``label`` (one node of its component) of all nodes that have an edge.

    In each round every node joins the least of its neighbours and itself, and edges are
    drawn between what they joined. Orders alternate between plain and scrambled ones: stars
    end in one plain round, long paths lose a share of their nodes in each scrambled round.
    All tables are written between rounds; the driver sees only whether edges are left."""
    rows = edges.select(F.col(first).alias("a"), F.col(second).alias("b"))
    left = _plain(rows)
    left = keep(spark, left, "edges")
    labels: DataFrame | None = None
    turn = 0
    while not left.isEmpty():
        mask = 0 if turn % 2 == 0 else (0x9E3779B97F4A7C15 * turn) % (1 << 63)
        scrambled = lambda c, m=mask: c.bitwiseXOR(F.lit(m).cast("bigint"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(scrambled(F.col("b"))).alias("m"))
        joined = keep(
            spark,
            least.select("a", scrambled(F.least("m", scrambled(F.col("a")))).alias("to")),
            "joined",
        )
        if labels is None:
            labels = joined.select(F.col("a").alias("node"), F.col("to").alias("label"))
        else:
            step = joined.select(F.col("a").alias("label"), "to")
            labels = keep(
                spark,
                labels.join(step, "label", "left").select(
                    "node", F.coalesce("to", "label").alias("label")
                ),
                "labels",
            )
        one = joined.select("a", F.col("to").alias("x"))
        two = joined.select(F.col("a").alias("b"), F.col("to").alias("y"))
        moved = left.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        left = keep(spark, _plain(moved), "edges")
        turn += 1
    return spark.createDataFrame([], "node BIGINT, label BIGINT") if labels is None else labels


def _plain(rows: DataFrame) -> DataFrame:
    """Undirected edges, each once, without loops."""
    low: Column = F.least("a", "b")
    return rows.where("a <> b").select(low.alias("a"), F.greatest("a", "b").alias("b")).distinct()
