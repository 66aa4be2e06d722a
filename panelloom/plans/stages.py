"""Stage compositions: landed files to documents, features, panel and validation.

Each function joins operators and one write; the tables between them are Parquet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.functions import text as tx
from panelloom.operators import features, filings, mapping, metrics, panel, sampling
from panelloom.session import kept, scratch_path
from panelloom.sources import listing, scans, sinks
from panelloom.sources.manifest_store import ManifestStore
from panelloom.sources.mapping_store import MappingStore


def bootstrap(
    spark: SparkSession, universe_path: str, directory_path: str, mapping_path: str
) -> str:
    """Universe and ticker directory to a saved mapping."""
    firms = mapping.bootstrap_mapping(
        scans.read_universe(spark, universe_path), scans.read_directory(spark, directory_path)
    )
    return sinks.save_mapping(firms, mapping_path)


def ingest(
    spark: SparkSession,
    history: DataFrame,
    universe_path: str,
    mapping_path: str,
    manifest_path: str,
    root: str,
    forms: Sequence[str] = filings.FORM_TYPES,
    start_year: int | None = None,
    end_year: int | None = None,
) -> str:
    """Append the wanted new filings of a landed history to the manifest."""
    manifest = scans.read_stage_if_exists(spark, manifest_path, schemas.MANIFEST)
    mapped = sinks.load_mapping(spark, mapping_path)
    universe = scans.read_universe(spark, universe_path)
    rows = _wanted_rows(history, universe, mapped, root, forms, start_year, end_year)
    filings.new_rows(rows, manifest).write.mode("append").parquet(manifest_path)
    return manifest_path


def _wanted_rows(
    history: DataFrame,
    universe: DataFrame,
    mapped: DataFrame,
    root: str,
    forms: Sequence[str],
    start_year: int | None,
    end_year: int | None,
) -> DataFrame:
    wanted = filings.select_filings(
        scans.filings_as_columns(history), forms, start_year, end_year
    )
    return filings.manifest_rows(filings.attach_firms(wanted, universe, mapped), root)


def ingest_into(
    store: ManifestStore,
    mapping_store: MappingStore,
    history: DataFrame,
    universe_path: str,
    root: str,
    forms: Sequence[str] = filings.FORM_TYPES,
    start_year: int | None = None,
    end_year: int | None = None,
) -> DataFrame:
    """As ``ingest``, between stores that batches do not read whole; returns the new rows."""
    universe = scans.read_universe(store.spark, universe_path)
    rows = _wanted_rows(
        history, universe, mapping_store.read(), root, forms, start_year, end_year
    )
    return store.append(kept(store.spark, rows, "wanted")).fresh


def bundle_files(spark: SparkSession, root: str, table: str, buckets: int) -> int:
    """Add the landed files that a bundle table lacks; returns how many. Files are listed and
    read by the executors; a file that is in the table already is not opened. A file that is
    named twice in the table, as after a death while appending, never comes about: Spark commits
    an append as a whole."""
    files = listing.list_files(spark, root)
    path = F.regexp_replace("path", "^file:/+", "/")
    if spark.catalog.tableExists(table):
        held = spark.table(table).select(F.col("path").alias("_held"))
        files = files.join(held, path == F.col("_held"), "left_anti")
    fresh = files.where(~F.col("path").endswith(".parquet"))
    known = scratch_path(spark, "listed")
    fresh.write.parquet(known)  # the list is read twice: for its bytes and for its files
    fresh = spark.read.parquet(known)
    count = fresh.count()
    if count:
        sinks.write_bundles(listing.read_listed(fresh), table, buckets)
    return count


def standardize_bundles(
    spark: SparkSession,
    manifest: DataFrame,
    table: str,
    root: str,
    documents_path: str,
    metadata_path: str,
) -> str:
    """Manifest rows and a bundle table to the documents table; contents stay where they are."""
    base = listing.plain(listing.qualified(spark, root))  # as the table's paths begin
    documents = filings.standardize(manifest, spark.table(table), base)
    return sinks.write_stage(
        documents, documents_path, "intermediate", features.FEATURE_SOURCE, "attention",
        metadata_path,
    )


def standardize(
    spark: SparkSession, manifest_path: str, root: str, documents_path: str, metadata_path: str
) -> str:
    """Manifest and raw files to the documents table; no manifest gives an empty one."""
    manifest = scans.read_stage_if_exists(spark, manifest_path, schemas.MANIFEST)
    if manifest.isEmpty():
        documents = schemas.empty(spark, schemas.DOCUMENTS)
    else:
        documents = filings.standardize(manifest, scans.read_raw_files(spark, root), root)
    return sinks.write_stage(
        documents, documents_path, "intermediate", features.FEATURE_SOURCE, "attention",
        metadata_path,
    )


def extract_features(
    spark: SparkSession,
    documents_path: str,
    features_path: str,
    metadata_path: str,
    keywords: Sequence[str] = tx.DEFAULT_KEYWORDS,
    source: str = features.FEATURE_SOURCE,
) -> str:
    """Documents to firm-year features; no documents give an empty typed table."""
    documents = scans.read_stage_if_exists(spark, documents_path, schemas.DOCUMENTS)
    return sinks.write_stage(
        features.attention_firm_year(documents, keywords, source),
        features_path, "features", source, "attention", metadata_path,
    )


def extract_features_from_files(
    spark: SparkSession,
    manifest_path: str,
    root: str,
    features_path: str,
    metadata_path: str,
    keywords: Sequence[str] = tx.DEFAULT_KEYWORDS,
    source: str = features.FEATURE_SOURCE,
) -> str:
    """Manifest and raw files to firm-year features, without a documents table."""
    manifest = scans.read_stage_if_exists(spark, manifest_path, schemas.MANIFEST)
    measured = filings.features_from_files(
        manifest, scans.read_raw_files(spark, root), root, keywords
    )
    return sinks.write_stage(
        features.firm_year_features(measured, source), features_path, "features", source,
        "attention", metadata_path,
    )


def build_panel(
    spark: SparkSession,
    feature_paths: Mapping[str, str],
    output_path: str,
    formats: Sequence[str] = ("parquet",),
    min_year: int | None = None,
    max_year: int | None = None,
) -> str:
    """Feature tables to the saved panel; missing and empty ones are left out."""
    tables = {
        name: scans.read_stage_if_filled(spark, path) for name, path in feature_paths.items()
    }
    assembled = panel.assemble_panel(spark, tables, min_year=min_year, max_year=max_year)
    return sinks.save_panel(assembled, output_path, formats)


def draw_sample(
    spark: SparkSession,
    documents_path: str,
    labeling_path: str,
    scores_path: str,
    sample_size: int = sampling.SAMPLE_SIZE,
    keywords: Sequence[str] | None = None,
) -> None:
    """Documents to the two files of a blind labelling sample."""
    documents = scans.read_stage(spark, documents_path)
    sample = sampling.generate_sample(documents, keywords, sample_size)
    sinks.write_blind_sample(sample, labeling_path, scores_path)


def validate(
    spark: SparkSession, labeling_path: str, scores_path: str | None = None
) -> DataFrame:
    """Labelled sample to classifier metrics."""
    labels = scans.read_text_csv(spark, labeling_path)
    scores = scans.read_text_csv(spark, scores_path) if scores_path else None
    return metrics.validation_metrics(labels, scores)
