"""A mapping whose upserts rewrite only the buckets they touch.

Rows lie in buckets by a hash of ``firm_id``. An upsert reads the buckets of the firms in the
batch, takes the last registered row of each firm there and writes these buckets into a folder
of their own, a generation. An index, one row per bucket, names the generation of each; a new
index counts once it is complete, so a reader sees the state before or after, and an
upsert that dies leaves the state before. Files of untouched buckets stay as they are. What
an index replaced is deleted with the index after the next, so readers have time to finish. A
batch that is registered again changes no row. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom import schemas
from panelloom.operators import mapping as maps
from panelloom.session import scratch_path
from panelloom.sources.scans import read_stage_if_exists
from panelloom.sources.sinks import committed_folders, remove_folder

BUCKETS = 256
_LAYOUT = T.StructType([T.StructField("buckets", T.IntegerType())])
_INDEX = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("generation", T.StringType())]
)


class MappingStore:
    """A mapping table under ``path``; ``buckets`` is fixed when it is made."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, base = spark, path.rstrip("/")
        self.rows_root, self.index_root = f"{base}/rows", f"{base}/index"
        layout = read_stage_if_exists(spark, f"{base}/layout", _LAYOUT).first()
        self.buckets = layout["buckets"] if layout else buckets
        if layout is None:
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{base}/layout")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("firm_id"), F.lit(self.buckets)).cast("int")

    def _numbers(self) -> list[int]:
        """Complete indexes, the newest last."""
        return sorted(int(name) for name in committed_folders(self.spark, self.index_root))

    def _index(self, number: int | None) -> dict[int, str]:
        """Generation of each bucket that has rows: as many entries as buckets at most."""
        if number is None:
            return {}
        rows = self.spark.read.schema(_INDEX).parquet(f"{self.index_root}/{number}").collect()
        return {row["bucket"]: row["generation"] for row in rows}

    def _rows(self, generations: dict[int, str]) -> DataFrame:
        if not generations:
            return schemas.empty(self.spark, schemas.MAPPING)
        paths = [f"{self.rows_root}/{g}/bucket={b}" for b, g in sorted(generations.items())]
        return self.spark.read.schema(schemas.MAPPING).parquet(*paths)

    def read(self) -> DataFrame:
        """The whole mapping."""
        numbers = self._numbers()
        return self._rows(self._index(numbers[-1] if numbers else None))

    def upsert(self, records: DataFrame, on_missing: str = "raise") -> list[int]:
        """Register records; the highest sequence of a firm wins. Returns the buckets touched."""
        fresh = maps.latest_per_firm(maps.prepare_records(records, on_missing))
        path = scratch_path(self.spark, "registered")
        fresh.withColumn("bucket", self._bucket()).write.parquet(path)
        batch = self.spark.read.parquet(path)
        # At most as many numbers as there are buckets.
        touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())
        if not touched:
            return []
        numbers = self._numbers()
        before = self._index(numbers[-1] if numbers else None)
        held = self._rows({b: g for b, g in before.items() if b in touched})
        merged = maps.latest_per_firm(held.unionByName(batch.select(*schemas.MAPPING.names)))
        generation = uuid.uuid4().hex
        merged.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy(
            "bucket"
        ).parquet(f"{self.rows_root}/{generation}")
        self._publish(before | dict.fromkeys(touched, generation), numbers, before)
        return touched

    def _publish(self, index: dict[int, str], numbers: list[int], before: dict[int, str]) -> None:
        number = numbers[-1] + 1 if numbers else 0
        rows = self.spark.createDataFrame(sorted(index.items()), _INDEX).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.index_root}/{number}")
        for older in numbers[:-1]:
            for bucket, generation in self._index(older).items():
                if generation not in (index.get(bucket), before.get(bucket)):
                    remove_folder(self.spark, f"{self.rows_root}/{generation}/bucket={bucket}")
            remove_folder(self.spark, f"{self.index_root}/{older}")
