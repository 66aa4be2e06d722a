"""Filings: selection, idempotent append, manifest and standardised documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.functions import identifiers as ids
from panelloom.functions import text as tx
from panelloom.operators import features
from panelloom.operators.joins import lookup_join

# Fixed values -------------------------------------------------------------
FORM_TYPES = ("10-K", "10-Q")
FALLBACK_YEAR = 2015
CENTURY_PIVOT = 70
MANIFEST_KEYS = ("cik", "accession_number")
# --------------------------------------------------------------------------


def _number(digits: Column) -> Column:
    return F.when(digits.rlike("^[0-9]+$"), digits.try_cast("int"))


def select_filings(
    filings: DataFrame,
    forms: Sequence[str] = FORM_TYPES,
    start_year: int | None = None,
    end_year: int | None = None,
) -> DataFrame:
    """Filings of the wanted forms and years with date, accession and document present.

    Forms match exactly, so amendments are out. The year is that of the filing date; a
    date without one raises. Without bounds no year is left out. Adds ``fiscal_year``.
    """
    year = ids.whole_number(F.substring("filing_date", 1, 4)).cast("int")
    present = [
        F.col(name) != "" for name in ("filing_date", "accession_number", "primary_document")
    ]
    complete = present[0] & present[1] & present[2]
    wanted = filings.where(F.col("form_type").isin(*forms) & complete).withColumn(
        "fiscal_year", year
    )
    if start_year:
        wanted = wanted.where(F.col("fiscal_year") >= start_year)
    return wanted.where(F.col("fiscal_year") <= end_year) if end_year else wanted


def attach_firms(filings: DataFrame, universe: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add firm_id and ticker to filings keyed by cik, for universe firms only.

    A universe ticker resolves to the first mapping row with that ticker; firms
    without one are dropped.
    """
    by_ticker = (
        mapping.where(F.col("ticker").isNotNull())
        .groupBy(F.col("ticker").alias("_ticker"))
        .agg(F.min_by(F.struct("firm_id", "cik"), "registered_seq").alias("_row"))
    )
    wanted = universe.select(F.upper("ticker").alias("_ticker")).distinct()
    firms = wanted.join(by_ticker, "_ticker").select(
        F.col("_row.firm_id").alias("firm_id"),
        F.col("_ticker").alias("ticker"),
        ids.normalize_file_cik(F.col("_row.cik")).alias("cik"),
    )
    keyed = filings.drop("firm_id", "ticker").withColumn(
        "cik", ids.normalize_file_cik(F.col("cik"))
    )
    return keyed.join(firms, "cik")


def accession_folder(accession: Column) -> Column:
    """Accession number without dashes."""
    return F.replace(accession, F.lit("-"), F.lit(""))


def filing_path(root: str, cik: Column, accession: Column, document: Column) -> Column:
    """``root/<cik without zeros>/<accession without dashes>/<document>``."""
    return F.concat_ws(
        "/", F.lit(root.rstrip("/")), ids.unpadded_cik(cik), accession_folder(accession), document
    )


def manifest_rows(filings: DataFrame, root: str) -> DataFrame:
    """Manifest rows of selected filings: padded cik and the path of the landed file."""
    path = filing_path(root, F.col("cik"), F.col("accession_number"), F.col("primary_document"))
    padded = filings.withColumns(
        {"cik": ids.normalize_file_cik(F.col("cik")), "raw_path": path}
    )
    return padded.select(*schemas.MANIFEST.names)


def first_per_key(
    batch: DataFrame,
    order: Sequence[str] = ("filing_date", "primary_document"),
    keys: Sequence[str] = MANIFEST_KEYS,
) -> DataFrame:
    """One row per key, the first by ``order``. A key repeated any number of times shrinks
    to one row per task ahead of the shuffle."""
    ranked = [*order, *[name for name in batch.columns if name not in {*keys, *order}]]
    first = batch.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return first.select(*keys, "_row.*").select(*batch.columns)


def new_rows(
    batch: DataFrame,
    manifest: DataFrame,
    order: Sequence[str] = ("filing_date", "primary_document"),
    keys: Sequence[str] = MANIFEST_KEYS,
) -> DataFrame:
    """Batch rows whose key the manifest lacks, one per key: the first by ``order``.

    The batch is reduced to one row per key before the join, which reads that shuffle. The
    join is a left join with a filter for that reason: Spark would move an anti join below
    the aggregate, where the repeats are. The manifest is read whole; one that is kept in a
    ``ManifestStore`` is not.
    """
    first = first_per_key(batch, order, keys)
    known = manifest.select(*keys).distinct().withColumn("_known", F.lit(True))
    return (
        first.join(known, list(keys), "left").where(F.col("_known").isNull()).select(*batch.columns)
    )


def append_to_manifest(manifest: DataFrame, batch: DataFrame) -> DataFrame:
    """Manifest plus the new rows of the batch; a second run with it adds nothing."""
    return manifest.unionByName(new_rows(batch, manifest))


_LANDED = r"/([0-9]+)/([^/]+)/([^/]+)$"


def rebuild_manifest(paths: DataFrame, mapping: DataFrame) -> DataFrame:
    """Manifest from the paths of landed files (column ``path``).

    A path ends in ``<cik>/<accession folder>/<file>``; Parquet files and files of
    unknown firms are left out. Form and date are unknown, so blank, and the year 0.
    """
    folder = F.regexp_extract("path", _LANDED, 2)
    first = F.min_by(F.struct("firm_id", "ticker"), "registered_seq").alias("_firm")
    firms = mapping.where(F.col("cik").isNotNull()).groupBy("cik").agg(first)
    landed = paths.where(
        F.col("path").rlike(_LANDED) & ~F.col("path").endswith(".parquet")
    ).select(
        ids.normalize_cik(F.regexp_extract("path", _LANDED, 1)).alias("cik"),
        F.regexp_replace(folder, "^(.{0,10})(.{0,2})(.*)$", "$1-$2-$3").alias("accession_number"),
        F.regexp_extract("path", _LANDED, 3).alias("primary_document"),
        F.col("path").alias("raw_path"),
    )
    return lookup_join(landed, firms, "cik", "inner").select(
        F.col("_firm.firm_id").alias("firm_id"),
        F.col("_firm.ticker").alias("ticker"),
        "cik",
        "accession_number",
        F.lit("").alias("form_type"),
        F.lit("").alias("filing_date"),
        F.lit(0).alias("fiscal_year"),
        "primary_document",
        "raw_path",
    )


def year_from_accession(accession: Column) -> Column:
    """Year from the two digits after the first dash; a fixed year when there are none."""
    yy = _number(F.get(F.split(accession, "-"), F.lit(1)))
    century = F.when(yy < CENTURY_PIVOT, F.lit(2000)).otherwise(F.lit(1900))
    return F.coalesce(century + yy, F.lit(FALLBACK_YEAR))


def fiscal_year(stored: Column, filing_date: Column, accession: Column) -> Column:
    """Stored year unless null or 0, else that of the date, else that of the accession."""
    return F.coalesce(
        F.when(stored != 0, stored.cast("int")),
        _number(F.substring(filing_date, 1, 4)),
        year_from_accession(accession),
    )


def locate_files(manifest: DataFrame, paths: DataFrame, root: str) -> DataFrame:
    """Manifest with ``raw_path`` set to an existing file; rows without one are dropped.

    The computed path is tried first, then the stored one: both meet the list of paths in
    one join, and each manifest row keeps its first hit. Only path strings take part, and
    rows without a stored path have no second try, so no null is ever a join key.
    """
    known = paths.select(F.col("path").alias("_found"))
    computed = filing_path(
        root, F.col("cik"), F.col("accession_number"), F.col("primary_document")
    )
    stored = F.when(~F.col("raw_path").eqNullSafe(computed), F.col("raw_path"))
    tries = manifest.select("*", F.posexplode(F.array(computed, stored)).alias("_try", "_found"))
    hits = tries.where(F.col("_found").isNotNull()).join(known, "_found")
    # Equal manifest rows stay as many as they were.
    first = F.count_if(F.col("_try") == 0)
    second = F.count_if(F.col("_try") == 1)
    located = hits.groupBy(*manifest.columns).agg(
        F.min(F.when(F.col("_try") == 0, F.col("_found"))).alias("_at_computed"),
        F.min(F.when(F.col("_try") == 1, F.col("_found"))).alias("_at_stored"),
        F.when(first > 0, first).otherwise(second).cast("int").alias("_times"),
    )
    return (
        located.withColumn("raw_path", F.coalesce("_at_computed", "_at_stored"))
        .withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*manifest.columns)
    )


def document_records(manifest: DataFrame, paths: DataFrame, root: str) -> DataFrame:
    """Document records without their text, of all manifest rows whose file is there."""
    keyed = manifest.withColumn("cik", ids.normalize_file_cik(F.col("cik")))
    cik, accession = F.col("cik"), F.col("accession_number")
    return locate_files(keyed, paths, root).select(
        ids.document_id(cik, accession, F.col("primary_document")).alias("document_id"),
        "firm_id",
        "cik",
        "ticker",
        "form_type",
        "filing_date",
        fiscal_year(F.col("fiscal_year"), F.col("filing_date"), accession).alias("fiscal_year"),
        "raw_path",
    )


def _parsed(files: DataFrame, content: str) -> DataFrame:
    parsed = tx.with_filing_text(files.select("path", content), content)
    return parsed.select(F.col("path").alias("raw_path"), "text")


def standardize(
    manifest: DataFrame, files: DataFrame, root: str, content: str = "content"
) -> DataFrame:
    """Document records with text.

    ``files`` has ``path`` and the raw bytes. Bytes become text in the scan; the join that
    finds each file sees path strings only. The last join, on the path, moves texts unless
    the files are a table bucketed by path (``sinks.write_bundles``): then only the records
    are shuffled, to the buckets.
    """
    records = document_records(manifest, files.select("path"), root)
    return _parsed(files, content).join(records, "raw_path").select(*schemas.DOCUMENTS.names)


def features_from_files(
    manifest: DataFrame,
    files: DataFrame,
    root: str,
    keywords: Sequence[str] = tx.DEFAULT_KEYWORDS,
    content: str = "content",
) -> DataFrame:
    """Document features straight from raw files, when no documents table is wanted.

    Texts are measured where they are read. Only the counts meet the manifest, so no
    text is ever shuffled.
    """
    measured = features.with_measures(_parsed(files, content), keywords).drop("text")
    records = document_records(manifest, files.select("path"), root)
    return measured.join(records, "raw_path").select(
        "document_id", "firm_id", F.col("fiscal_year").alias("year"), *features.MEASURES
    )
