"""A manifest that takes batches without reading itself whole.

Rows lie in ``buckets`` folders by a hash of their key. Beside them is a table of Bloom
filters: keys are hashed to ``segments`` (several to a bucket), and each segment has one bitmap
of 32,768 bits, in which every key sets ``PROBES`` bits. An append looks its keys up in the
bitmaps of their segments. Keys that a bitmap rules out are new. Only the buckets of the other
keys are opened, key columns alone, and a comparison there decides exactly. So a batch of new keys
reads the filters (two bytes a key, as laid out) and next to none of the rows. Whole rows of a
batch are shuffled once, by bucket, together with the keys of the opened buckets; of a batch that
is known but for a few keys, only the rows of these.

Filters only ever say "maybe" too often: a store that outgrows its layout opens more buckets
and stays right. Filters are written before rows. If an append dies between the two, its keys
are looked up in their buckets when it runs again, and are found missing; if it dies later,
they are found. An append that runs twice therefore adds nothing the second time. Merged
filters are a generation of their own, read only once it is complete. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom import schemas
from panelloom.operators.filings import MANIFEST_KEYS, first_per_key
from panelloom.session import kept, settings
from panelloom.sources.scans import read_stage_if_exists
from panelloom.sources.sinks import committed_folders, remove_folder

BITS = 32_768  # of one bitmap; Spark's bitmap functions fix this number
PROBES = 6
BITS_PER_KEY = 16
COMPACT_AFTER = 16  # appends whose filters are read side by side
SLICE_SEGMENTS = 64  # of a bucket, dealt as one: about 130,000 keys
TASK_ROWS = 1_500_000  # of a task that sorts rows it has read from files
KNOWN_SHARE = 0.9  # above it keys are compared before whole rows are moved
HOT_ROWS = 500_000  # in one segment, which is laid out for 2,048 keys
HOT_SEGMENTS = 1000  # at most so many are named to all tasks
EARLY, EARLY_ROWS = 64, 1_000_000  # one key of so many is asked first, in a batch of more rows

_LAYOUT = T.StructType(
    [T.StructField("buckets", T.IntegerType()), T.StructField("segments", T.IntegerType())]
)
_FILTERS = T.StructType(
    [T.StructField("segment", T.IntegerType()), T.StructField("bits", T.BinaryType()),
     T.StructField("part", T.StringType())]
)


@dataclass(frozen=True)
class Appended:
    """What an append did: its new rows, and the buckets it had to open."""

    fresh: DataFrame
    opened: tuple[int, ...]


class ManifestStore:
    """Rows and filters under one path; ``expected_keys`` sizes the filters."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType = schemas.MANIFEST,
        keys: Sequence[str] = MANIFEST_KEYS,
        buckets: int = 256,
        expected_keys: int = 10_000_000,
    ) -> None:
        self.spark, self.schema, self.keys = spark, schema, list(keys)
        base = path.rstrip("/")
        self.rows_path, self.filters_root = f"{base}/rows", f"{base}/filters"
        wanted = max(buckets, ceil(expected_keys * BITS_PER_KEY / BITS))
        layout = read_stage_if_exists(spark, f"{base}/layout", _LAYOUT).first()
        # The layout is fixed when the store is made; later calls take it from there.
        self.buckets = layout["buckets"] if layout else buckets
        self.segments = layout["segments"] if layout else ceil(wanted / buckets) * buckets
        if layout is None:
            one = spark.range(1).select(
                F.lit(self.buckets).alias("buckets"), F.lit(self.segments).alias("segments")
            )
            one.write.parquet(f"{base}/layout")

    def read(self) -> DataFrame:
        """All rows."""
        return self._rows().select(*self.schema.names)

    def _rows(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        return read_stage_if_exists(self.spark, self.rows_path, stored)

    def _segment(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.segments)).cast("int")

    def _probes(self) -> Column:
        return F.array(
            *[F.pmod(F.xxhash64(*self.keys, F.lit(i)), F.lit(BITS)) for i in range(PROBES)]
        )

    def _generation(self) -> int:
        """The newest complete generation of filters."""
        found = committed_folders(self.spark, self.filters_root)
        return max((int(name) for name in found), default=0)

    def _parts(self) -> DataFrame:
        """Bitmaps of the newest generation, several to a segment."""
        newest = f"{self.filters_root}/{self._generation()}"
        return read_stage_if_exists(self.spark, newest, _FILTERS)

    def _filters(self) -> DataFrame:
        """One bitmap per segment."""
        return self._parts().groupBy("segment").agg(F.bitmap_or_agg("bits").alias("bits"))

    def append(
        self, batch: DataFrame, order: Sequence[str] = ("filing_date", "primary_document")
    ) -> Appended:
        """Add the rows whose key the store lacks, one per key: the first by ``order``.

        The batch is computed several times (rows are counted, filters asked, rows dealt), so it
        must give the same keys each time; keep one that is costly to compute.
        """
        rows = batch.select(*self.schema.names).withColumn("_new", F.lit(True))
        number, hot = self._counted(rows)
        opened, known_share = self._opened(rows, number)
        if hot:  # rows of a key that comes very often shrink before they meet in one task
            ranked = ("_new", *order)
            often = first_per_key(rows.where(self._segment().isin(hot)), ranked, self.keys)
            rows = rows.where(~self._segment().isin(hot)).unionByName(often)
        with self._settings(batch.sparkSession, number):
            if opened:
                # Known keys rank first in their key. A key with a null in it is never known.
                known = self._stored_keys(opened).dropna().withColumn("_new", F.lit(False))
                if known_share > KNOWN_SHARE:
                    rows = self._missing(rows, known, opened)
                else:
                    rows = rows.unionByName(known, allowMissingColumns=True)
            first = self._firsts(rows, order).select(*self.schema.names, "segment", "bucket")
            fresh = self._kept(first, "fresh")
        with self._settings(self.spark, fresh.count()):
            self._write_filters(fresh)
            stored = fresh.select(*self.schema.names, "bucket")
            packed = stored.write.mode("append").option("compression", "zstd")
            packed.partitionBy("bucket").parquet(self.rows_path)
        return Appended(stored.drop("bucket"), opened)

    def _firsts(self, rows: DataFrame, order: Sequence[str]) -> DataFrame:
        """The new row of each key that has no known one.

        Rows are dealt once: those of a key and its known key meet, and lie by bucket as stored.
        Places are worked out again behind the shuffle, so they are not shuffled.
        """
        place = self._place()
        dealt = rows.repartition(place["bucket"], place["slice"]).withColumns(place)
        return first_per_key(dealt, ("_new", *order), [*place, *self.keys]).where("_new")

    def _missing(self, rows: DataFrame, known: DataFrame, opened: tuple[int, ...]) -> DataFrame:
        """Rows whose keys are not known. Keys alone are compared, and of whole rows only those of
        missing keys are gathered, which are few where this is asked."""
        inside = self._place()["bucket"].isin(list(opened))
        outside = F.lit(False) if len(opened) == self.buckets else ~inside
        keys = rows.where(inside).select(*self.keys, "_new").unionByName(known)
        names = [F.col(k).alias(f"_{k}") for k in self.keys]
        missing = self._kept(self._firsts(keys, ()).select(*names), "missing")
        unopened = rows.where(outside)
        if missing.isEmpty():
            return unopened
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        return unopened.unionByName(rows.where(inside).join(missing, same, "left_semi"))

    def _place(self) -> dict[str, Column]:
        """Bucket of a row, the slice of the bucket that one task takes, and segment."""
        slices = ceil(self.segments / self.buckets / SLICE_SEGMENTS)
        group = F.floor(self._segment() / F.lit(self.buckets)) % F.lit(slices)
        bucket = self._segment() % F.lit(self.buckets)
        return {"bucket": bucket, "slice": group.cast("int"), "segment": self._segment()}

    def _counted(self, rows: DataFrame) -> tuple[int, list[int]]:
        """Number of rows, and the segments with too many of them for one task."""
        counts = rows.groupBy(self._segment().alias("segment")).count()
        large = F.when(F.col("count") > HOT_ROWS, F.struct("count", "segment"))
        largest = F.slice(F.sort_array(F.collect_list(large), asc=False), 1, HOT_SEGMENTS)
        found = counts.agg(F.sum("count").alias("rows"), largest["segment"].alias("hot")).first()
        return found["rows"] or 0, found["hot"]

    def _opened(self, rows: DataFrame, number: int) -> tuple[tuple[int, ...], float]:
        """Buckets in which a bitmap says "maybe" to some key of the rows, and the share of the
        rows asked first that hear it.

        Of many rows those of some keys are asked first. The other keys of buckets that these open
        need not be asked.
        """
        if self._parts().isEmpty():
            return (), 0.0
        filters, opened, share = self._filters(), set(), None
        bucket = self._place()["bucket"]
        early = F.pmod(F.xxhash64(*self.keys, F.lit(PROBES)), F.lit(EARLY)) == 0
        for asked in (early, ~early) if number > EARLY_ROWS else (F.lit(True),):
            if len(opened) == self.buckets:
                break
            keys = rows.where(asked & ~bucket.isin(list(opened))).select(*self.keys)
            maybe = (
                # Positions are worked out behind the join, so they are not shuffled.
                keys.withColumn("segment", self._segment())
                .join(filters, "segment", "left")
                .withColumn("_probes", self._probes())
                .withColumn("_maybe", F.coalesce(_all_set("bits", "_probes"), F.lit(False)))
            )
            # At most as many rows as there are buckets.
            counts = maybe.groupBy(bucket.alias("bucket")).agg(
                F.count("*").alias("asked"), F.count_if("_maybe").alias("maybe")
            )
            found = counts.collect()
            opened |= {r["bucket"] for r in found if r["maybe"]}
            if share is None:
                share = sum(r["maybe"] for r in found) / max(1, sum(r["asked"] for r in found))
        return tuple(sorted(opened)), share

    def _settings(self, spark: SparkSession, rows: int) -> AbstractContextManager[None]:
        """Files are read by so many tasks that each sorts its rows in memory, and shuffle files go
        when a write ends, not when the driver next collects garbage."""
        key = "spark.sql.files.minPartitionNum"
        least = int(spark.conf.get(key, None) or spark.sparkContext.defaultParallelism)
        return settings(
            spark,
            {key: str(max(least, ceil(rows / TASK_ROWS))),
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"},
        )

    def known_keys(self, buckets: Sequence[int]) -> DataFrame:
        """Keys in some buckets; the other buckets' folders are not read."""
        return self._stored_keys(buckets).distinct()

    def _stored_keys(self, buckets: Sequence[int]) -> DataFrame:
        return self._rows().where(F.col("bucket").isin(list(buckets))).select(*self.keys)

    def _write_filters(self, fresh: DataFrame) -> None:
        # One row per key is sorted, not one per position.
        probes = fresh.select("segment", self._probes().alias("_probes")).select(
            "segment", *[F.col("_probes")[i].alias(f"_probe{i}") for i in range(PROBES)]
        )
        each = probes.groupBy("segment").agg(
            F.array(*[F.bitmap_construct_agg(f"_probe{i}") for i in range(PROBES)]).alias("_each")
        )
        bits = each.select("segment", F.explode("_each").alias("bits")).groupBy("segment").agg(
            F.bitmap_or_agg("bits").alias("bits")
        )
        generation = self._generation()
        newest = f"{self.filters_root}/{generation}"
        parts = read_stage_if_exists(self.spark, newest, _FILTERS)
        number = parts.select("part").distinct().count()
        if number >= COMPACT_AFTER:
            merged = self._filters().withColumn("part", F.lit("merged"))
            newer = f"{self.filters_root}/{generation + 1}"
            merged.write.parquet(newer)
            remove_folder(self.spark, newest)
            newest, number = newer, 1
        bits.withColumn("part", F.lit(f"append-{number}")).write.mode("append").parquet(newest)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return kept(self.spark, df, name)


def _all_set(bits: str, probes: str) -> Column:
    """Whether a bitmap has all of the positions."""

    def one(i: int) -> Column:
        at = F.col(probes)[i]
        byte = F.substr(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (at % 8).cast("int")) == 1

    return reduce(lambda a, b: a & b, [one(i) for i in range(PROBES)])
