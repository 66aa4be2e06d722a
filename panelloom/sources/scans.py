"""Readers: files in, typed DataFrames out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom import schemas
from panelloom.functions import identifiers as ids
from panelloom.sources import listing

# Fixed values -------------------------------------------------------------
CONTROL_REQUIRED = ("gvkey", "cik", "fyear", "at", "roa", "sic", "emp")
CONTROL_TYPES = {"fyear": "int", "at": "double", "roa": "double", "sic": "int", "emp": "double"}
# --------------------------------------------------------------------------


def _is_missing_path(error: AnalysisException) -> bool:
    return (error.getCondition() or "") == "PATH_NOT_FOUND"


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stage table in Parquet, with its declared schema when given."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_stage_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A stage table; for a missing path the typed empty table, or None without schema."""
    try:
        return read_stage(spark, path, schema)
    except AnalysisException as error:
        if not _is_missing_path(error):
            raise
        return schemas.empty(spark, schema) if schema else None


def read_stage_if_filled(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A stage table, or None when it is missing or has no rows (one row is looked for)."""
    table = read_stage_if_exists(spark, path, schema)
    return None if table is None or table.isEmpty() else table


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Firm universe CSV; lines starting with ``#`` and blank lines are skipped.

    Columns follow the header, all as text, so a ticker like ``NA`` stays a ticker.
    Adds ``registered_seq``: files in order of their paths, blocks of a file in order, rows
    in order. It does not depend on how Spark packs files into tasks.
    """
    frame = spark.read.option("comment", "#").option("header", True).csv(path)
    block = ["_file", "_start"]
    rows = frame.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    first = F.min("_at").over(Window.partitionBy(*block))
    rows = rows.withColumn("_at", F.col("_at") - first)
    # One row per block of a file; each holds up to 2^40 rows.
    order = Window.orderBy(*block)
    blocks = rows.select(*block).distinct().withColumn("_block", F.row_number().over(order))
    sequence = F.shiftleft(F.col("_block").cast("bigint"), 40) + F.col("_at")
    return rows.join(blocks, block).select(*frame.columns, sequence.alias("registered_seq"))


def parse_directory(documents: DataFrame, json: str = "value", order: str = "seq") -> DataFrame:
    """Ticker directory from JSON objects of entries; one row per upper-cased ticker.

    When a ticker repeats, the last entry wins: by ``order`` of the documents, then
    by position inside one. A damaged document raises.
    """
    kind = T.MapType(T.StringType(), schemas.TICKER_ENTRY)
    entries = F.map_entries(F.from_json(json, kind, {"mode": "FAILFAST"}))
    rows = documents.select(F.col(order).alias("_doc"), F.posexplode(entries).alias("_pos", "_e"))
    fields = rows.select(
        F.struct("_doc", "_pos").alias("_order"),
        F.upper("_e.value.ticker").alias("ticker"),
        ids.normalize_cik(F.col("_e.value.cik_str")).alias("cik"),
        F.col("_e.value.title").alias("title"),
    )
    last = F.max_by(F.struct("cik", "title"), "_order").alias("_row")
    return fields.groupBy("ticker").agg(last).select("ticker", "_row.cik", "_row.title")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """Ticker directory from landed JSON files."""
    files = spark.read.text(path, wholetext=True)
    return parse_directory(files.withColumn("seq", F.col("_metadata.file_path")))


def transpose_filings(batches: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Struct-of-arrays filing history to one row per filing.

    There are as many filings as accession numbers. ``keep`` names batch columns to
    repeat on each row.
    """
    names = batches.schema[column].dataType.names
    zipped = F.arrays_zip(*[F.col(f"{column}.{name}").alias(name) for name in names])
    count = F.coalesce(F.size(F.col(f"{column}.accessionNumber")), F.lit(0))
    rows = F.slice(zipped, F.lit(1), F.greatest(count, F.lit(0)))
    return batches.select(*keep, F.inline(rows))


def _whole_files(spark: SparkSession, root: str) -> DataFrame:
    """``name`` and text (``value``) of all files under a folder, found and read by the executors;
    a single file, a pattern or a store that Arrow does not open is listed by the driver."""
    if listing.opens(spark, root):
        files = listing.read_listed(listing.list_files(spark, root))
        name = F.element_at(F.split("path", "/"), -1)
        return files.select(name.alias("name"), F.col("content").cast("string").alias("value"))
    return spark.read.text(root, wholetext=True).select(
        F.col("_metadata.file_name").alias("name"), "value"
    )


def read_filing_history(
    spark: SparkSession, submissions: str, shards: str | None = None
) -> DataFrame:
    """All filings of the landed submission files and, if given, of older shards.

    A damaged file raises."""
    strict = {"mode": "FAILFAST"}
    kind = T.ArrayType(schemas.SUBMISSIONS)  # a file holds one object or an array of them
    files = spark.read.text(submissions, wholetext=True).select(
        F.inline(F.from_json("value", kind, strict))
    )
    recent = transpose_filings(
        files.select("cik", F.col("filings.recent").alias("batch")), "batch", ("cik",)
    )
    if shards is None:
        return recent
    # A shard carries no id of its own; its file name starts with CIK and ten digits.
    cik = F.regexp_extract(F.col("name"), "CIK([0-9]{10})", 1)
    shard = _whole_files(spark, shards).select(
        cik.alias("cik"), F.from_json("value", schemas.SUBMISSION_SHARD, strict).alias("batch")
    )
    return recent.unionByName(
        transpose_filings(shard, "batch", ("cik",)), allowMissingColumns=True
    )


def filings_as_columns(history: DataFrame) -> DataFrame:
    """Filing history with the column names used by the filing operators."""
    return history.select(
        "cik",
        F.col("accessionNumber").alias("accession_number"),
        F.col("form").alias("form_type"),
        F.col("filingDate").alias("filing_date"),
        F.col("primaryDocument").alias("primary_document"),
    )


def raw_file_rows(files: DataFrame) -> DataFrame:
    """Path and content of a binary file scan or stream, Parquet files left out."""
    path = F.regexp_replace("path", "^file:/+", "/")
    return files.select(path.alias("path"), "content").where(~F.col("path").endswith(".parquet"))


def read_raw_files(spark: SparkSession, root: str) -> DataFrame:
    """Landed raw files: path and content. Selecting only the path reads no content.

    The driver lists the files, so this suits fresh landings. Large collections belong in a
    bundle table (``sinks.write_bundles``), which has the same two columns.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return raw_file_rows(files)


def read_controls(spark: SparkSession, path: str) -> DataFrame:
    """Financial controls CSV with the required columns; ids stay text, extras are kept."""
    try:
        raw = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if _is_missing_path(error):
            raise FileNotFoundError(f"no controls file at {path}") from error
        raise
    missing = sorted(set(CONTROL_REQUIRED) - set(raw.columns))
    if missing:
        raise ValueError(f"controls lack the columns {missing}")
    typed = raw.withColumns({name: F.col(name).cast(to) for name, to in CONTROL_TYPES.items()})
    return typed.withColumn("cik", ids.normalize_file_cik(F.col("cik"))).withColumnRenamed(
        "fyear", "year"
    )


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Labels or scores CSV, every column as text so that blanks never change types."""
    return spark.read.option("header", True).option("multiLine", True).option(
        "escape", '"'
    ).csv(path)
