"""Firm-year features kept up to date batch by batch.

A landed batch of documents is counted once and stored as sums per firm-year under its batch
number. A batch whose sums are complete is left out when it is replayed. The feature table
is the sum of all parts, whose size is that of firm-years, not of documents. From time to time the
parts are folded into a base that names the last batch in it; a batch at or below that number is
already in and is left out when replayed. A base counts only once it is complete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelloom import schemas
from panelloom.functions import text as tx
from panelloom.operators import features
from panelloom.sources.scans import read_stage_if_exists
from panelloom.sources.sinks import committed_folders, remove_folder

FOLD_AFTER = 32  # parts that are read side by side
SUMS = ("document_count", "mentioning", "ai_mention_count", "total_tokens", "ai_token_count")
_PARTIAL = T.StructType(
    [T.StructField("firm_id", T.StringType()), T.StructField("year", T.IntegerType()),
     *[T.StructField(name, T.LongType()) for name in SUMS]]
)


def partial_sums(measured: DataFrame) -> DataFrame:
    """Document features to sums that can be added up: firm-years, null ones included."""
    return measured.groupBy("firm_id", "year").agg(
        F.count("document_id").alias("document_count"),
        F.count_if("has_ai_mention").alias("mentioning"),
        F.sum("ai_mention_count").alias("ai_mention_count"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("ai_token_count").alias("ai_token_count"),
    )


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("firm_id", "year").agg(*[F.sum(name).alias(name) for name in SUMS])


class FirmYearStore:
    """Sums of landed batches under ``path``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, fold_after: int = FOLD_AFTER) -> None:
        self.spark, self.fold_after = spark, fold_after
        self.parts, self.bases = f"{path.rstrip('/')}/parts", f"{path.rstrip('/')}/bases"

    def _folded(self) -> int:
        """Number of the last batch in the newest complete base; -1 without one."""
        names = committed_folders(self.spark, self.bases)
        return max((int(name) for name in names), default=-1)

    def _open_parts(self, folded: int) -> list[int]:
        names = committed_folders(self.spark, self.parts)
        return sorted(int(name) for name in names if int(name) > folded)

    def add(self, measured: DataFrame, batch: int) -> None:
        """Store the sums of one batch of document features."""
        folded = self._folded()
        if batch <= folded or batch in self._open_parts(folded):
            return
        partial_sums(measured).write.mode("overwrite").parquet(f"{self.parts}/{batch}")
        numbers = self._open_parts(folded)
        if len(numbers) > self.fold_after:
            self._sums().write.mode("overwrite").parquet(f"{self.bases}/{numbers[-1]}")
            for number in numbers:
                remove_folder(self.spark, f"{self.parts}/{number}")
            if folded >= 0:
                remove_folder(self.spark, f"{self.bases}/{folded}")

    def _sums(self) -> DataFrame:
        folded = self._folded()
        paths = [f"{self.parts}/{number}" for number in self._open_parts(folded)]
        stored = read_stage_if_exists(self.spark, f"{self.bases}/{folded}", _PARTIAL)
        if paths:
            stored = stored.unionByName(self.spark.read.schema(_PARTIAL).parquet(*paths))
        return _added(stored)

    def read(self, source: str = features.FEATURE_SOURCE) -> DataFrame:
        """The feature table over all batches so far."""
        documents = F.col("document_count")
        share = F.col("mentioning") / F.greatest(documents, F.lit(1))
        rolled = self._sums().withColumn("ai_mention_share", share)
        return rolled.withColumn("source", F.lit(source)).select(
            *schemas.ATTENTION_FIRM_YEAR.names
        )


def roll_up_stream(
    documents: DataFrame,
    store: FirmYearStore,
    checkpoint: str,
    keywords: Sequence[str] = tx.DEFAULT_KEYWORDS,
) -> StreamingQuery:
    """Count each micro-batch of documents into the store, then stop when caught up."""

    def add(batch: DataFrame, epoch: int) -> None:
        store.add(features.document_features(batch, keywords), epoch)

    return (
        documents.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
