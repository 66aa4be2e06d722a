"""Available-now streams that append newly landed rows to a manifest."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelloom import schemas
from panelloom.operators import filings
from panelloom.session import kept
from panelloom.sources.manifest_store import ManifestStore
from panelloom.sources.scans import raw_file_rows, read_stage_if_exists


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Stream of raw files under a folder; each file is seen once per checkpoint."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .load(root)
    )
    return raw_file_rows(files)


def append_stream(
    batches: DataFrame,
    manifest_path: str,
    checkpoint: str,
    to_manifest: Callable[[DataFrame], DataFrame] | None = None,
    order: Sequence[str] = ("filing_date", "primary_document"),
) -> StreamingQuery:
    """Append the new rows of each micro-batch to the manifest, then stop when caught up.

    A micro-batch that is run again after a failure adds nothing, because its rows
    are compared with the manifest as it stands. That makes the sink exactly-once
    without any state beside the manifest itself. ``to_manifest`` turns landed rows
    into manifest rows.
    """

    def append(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        rows = to_manifest(batch) if to_manifest else batch
        manifest = read_stage_if_exists(spark, manifest_path, schemas.MANIFEST)
        fresh = filings.new_rows(rows.select(*schemas.MANIFEST.names), manifest, order)
        fresh.write.mode("append").parquet(manifest_path)

    return _started(batches, append, checkpoint)


def append_stream_to_store(
    batches: DataFrame,
    store: ManifestStore,
    checkpoint: str,
    to_manifest: Callable[[DataFrame], DataFrame] | None = None,
    order: Sequence[str] = ("filing_date", "primary_document"),
) -> StreamingQuery:
    """As ``append_stream``, into a store that opens only buckets which may hold a batch's keys."""

    def append(batch: DataFrame, _epoch: int) -> None:
        # An append computes its rows several times; what has landed is read once.
        rows = to_manifest(batch) if to_manifest else batch
        store.append(kept(store.spark, rows.select(*store.schema.names), "landed"), order)

    return _started(batches, append, checkpoint)


def _started(batches: DataFrame, append: Callable, checkpoint: str) -> StreamingQuery:
    return (
        batches.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
