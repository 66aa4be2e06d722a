"""Writers: stage tables, metadata, panel exports and the blind sample files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.operators import sampling

EXPORT_FORMATS = ("parquet", "csv", "table")
# Fixed value: name of the exported panel table.
PANEL_TABLE = "firm_year_panel"


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Rename through the file system Spark itself uses for the path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path(source)) and fs.rename(path(source), path(target))


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders right under ``root`` that a Spark job has written to its end."""
    base, fs = _folder(spark, root)
    if not fs.exists(base):
        return []
    paths = [status.getPath() for status in fs.listStatus(base)]
    marker = lambda path: _folder(spark, f"{path.toString()}/_SUCCESS")[0]
    return [path.getName() for path in paths if fs.exists(marker(path))]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    target, fs = _folder(spark, path)
    fs.delete(target, True)


def publish_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Publish a table as Parquet; see ``_swapped``."""
    return _swapped(
        df.sparkSession, path, lambda fresh: df.write.partitionBy(*partition_by).parquet(fresh)
    )


def publish_csv(df: DataFrame, path: str, **options) -> str:
    """Publish a table as CSV with a header; see ``_swapped``."""
    return _swapped(
        df.sparkSession, path, lambda fresh: df.write.options(header=True, **options).csv(fresh)
    )


def _swapped(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Write a complete new copy beside ``path``, then swap it in by renames.

    The target may be an input of what is written: it is not touched before the new copy is
    committed. The old copy is kept as ``<path>__old-<id>`` until the swap is done. Between
    the two renames the path is absent for a moment, and on object stores a rename is a
    copy: use it on file systems with a quick rename (HDFS, local, shared POSIX folders).
    """
    tag = uuid.uuid4().hex
    base = path.rstrip("/")
    fresh, old = f"{base}__new-{tag}", f"{base}__old-{tag}"
    write(fresh)
    replaced = _rename(spark, base, old)
    if not _rename(spark, fresh, base):
        if replaced:
            _rename(spark, old, base)
        raise OSError(f"could not publish {base}; the new copy is in {fresh}")
    if replaced:
        remove_folder(spark, old)
    return path


def write_stage(
    df: DataFrame,
    path: str,
    stage: str,
    source: str,
    signal_layer: str,
    metadata_path: str,
    partition_by: Sequence[str] = (),
) -> str:
    """Publish a stage table and append one row about it to the metadata table.

    Rows are counted while they are written, not in a pass of their own.
    """
    spark = df.sparkSession
    seen = Observation(f"stage-{uuid.uuid4().hex}")
    publish_parquet(df.observe(seen, F.count(F.lit(1)).alias("row_count")), path, partition_by)
    row = (
        spark.range(1)
        .select(
            F.lit(stage).alias("stage"),
            F.lit(source).alias("source"),
            F.lit(signal_layer).alias("signal_layer"),
            F.lit(path).alias("path"),
            F.current_timestamp().alias("created_at"),
            F.lit(seen.get["row_count"]).cast("bigint").alias("row_count"),
            F.lit(None).cast("string").alias("config_hash"),
        )
        .select(*schemas.STAGE_METADATA.names)
    )
    row.coalesce(1).write.mode("append").parquet(metadata_path)
    return path


def save_panel(panel: DataFrame, path: str, formats: Sequence[str] = ("parquet",)) -> str:
    """Publish the panel as Parquet and, by request, also as CSV and as a table."""
    unknown = sorted(set(formats) - set(EXPORT_FORMATS))
    if unknown:
        raise ValueError(f"unknown export formats: {unknown}")
    publish_parquet(panel, path)
    written = panel.sparkSession.read.parquet(path)
    if "csv" in formats:
        publish_csv(written, f"{path.rstrip('/')}.csv")
    if "table" in formats:
        publish_table(written, PANEL_TABLE, f"{path.rstrip('/')}__table")
    return path


def _location(spark: SparkSession, table: str) -> str:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return about.first()["data_type"]


def publish_table(df: DataFrame, name: str, root: str) -> str:
    """Publish a catalogue table: write a fresh folder under ``root``, then point the name at it.

    The pointer moves by one catalogue operation after the folder is complete, so a reader sees
    the old rows or the new ones, and the table is never absent. No file is renamed, which
    suits object stores. ``df`` may read the table itself. The folder of the state before stays
    for its readers until the next publication. Only where the columns change, the table
    is made anew, and is absent for a moment.
    """
    spark = df.sparkSession
    fresh = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    target, fs = _folder(spark, fresh)
    location = fs.makeQualified(target).toString()
    before = _location(spark, name) if spark.catalog.tableExists(name) else None
    columns = spark.read.parquet(fresh).schema
    if before and spark.table(name).schema.simpleString() == columns.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=location, source="parquet", schema=columns)
    in_use = {str(place).rstrip("/").rsplit("/", 1)[-1] for place in (location, before)}
    for folder in committed_folders(spark, root):
        if folder not in in_use:
            remove_folder(spark, f"{root.rstrip('/')}/{folder}")
    return location


def write_bundles(files: DataFrame, table: str, buckets: int) -> str:
    """Raw files as a catalogue table of (path, content), bucketed and sorted by path.

    Many files share a Parquet file, so no listing grows with their number, and a join on
    the path leaves the contents where they are. Existing rows stay; new ones are appended.
    """
    files.select("path", "content").write.bucketBy(buckets, "path").sortBy("path").mode(
        "append"
    ).saveAsTable(table)
    return table


def save_mapping(mapping: DataFrame, path: str) -> str:
    """Publish a mapping table; the mapping may have been read from the same path."""
    return publish_parquet(mapping.select(*schemas.MAPPING.names), path)


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A saved mapping, or an empty one when there is none."""
    from panelloom.sources.scans import read_stage_if_exists

    return read_stage_if_exists(spark, path, schemas.MAPPING)


def write_blind_sample(sample: DataFrame, labeling_path: str, scores_path: str) -> None:
    """Two CSVs from one sample: what labellers see and what stays hidden.

    The sample is at most a few hundred rows; it is kept so that both files hold the
    same documents and the corpus is read once.
    """
    kept = sample.persist()
    for frame, path in (
        (sampling.blind_labeling(kept), labeling_path),
        (sampling.blind_scores(kept), scores_path),
    ):
        publish_csv(frame, path, escape='"', emptyValue="")
    kept.unpersist()
