"""Identifier mapping: upsert, lookups and bootstrap.

A mapping has one row per ``firm_id``. ``registered_seq`` is its row order: a later
registration of the same firm replaces the earlier one and moves to the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.functions import identifiers as ids
from panelloom.operators.joins import lookup_join

# Fixed value: the source label of bootstrapped rows.
BOOTSTRAP_SOURCE = "sec_company_tickers"

_TYPES = {field.name: field.dataType for field in schemas.MAPPING.fields}
_COLUMNS = schemas.MAPPING.names


def _optional(df: DataFrame, name: str) -> Column:
    value = F.col(name) if name in df.columns else F.lit(None)
    return value.cast(_TYPES[name])


def prepare_records(records: DataFrame, on_missing: str = "raise") -> DataFrame:
    """Identifier records in mapping layout: normalised, with a ``firm_id``.

    A given non-empty ``firm_id`` is kept. Missing columns are null. The input needs
    a ``registered_seq`` that tells the order of registration.
    """
    raw = records.select(*[_optional(records, name).alias(name) for name in _COLUMNS])
    cik = F.when(F.col("cik") != "", F.col("cik"))
    generated = ids.firm_id(
        gvkey=F.col("gvkey"),
        cik=cik,
        cusip=F.col("cusip"),
        permno=F.col("permno"),
        ticker=F.col("ticker"),
        company_name=F.col("company_name"),
        on_missing=on_missing,
    )
    given = F.when(F.col("firm_id") != "", F.col("firm_id"))
    return raw.withColumns(
        {
            "firm_id": F.coalesce(given, generated),
            "cik": ids.normalize_cik(cik),
            "ticker": ids.normalize_ticker(F.col("ticker")),
        }
    )


def latest_per_firm(rows: DataFrame) -> DataFrame:
    """The last registered row of every firm.

    An aggregate, not a window: each task keeps one row per firm before the shuffle,
    so a firm registered very often costs no more than any other.
    """
    rest = [name for name in _COLUMNS if name != "firm_id"]
    latest = F.max_by(F.struct(*rest), F.col("registered_seq")).alias("_row")
    return rows.groupBy("firm_id").agg(latest).select("firm_id", "_row.*")


def upsert_mapping(mapping: DataFrame, records: DataFrame, on_missing: str = "raise") -> DataFrame:
    """Register records into a mapping; the record with the highest sequence wins."""
    fresh = prepare_records(records, on_missing)
    return latest_per_firm(mapping.select(*_COLUMNS).unionByName(fresh))


def lookup_table(mapping: DataFrame, kind: str, output: str = "firm_id") -> DataFrame:
    """One row per identifier of the given kind (column ``_key``): the first in row order."""
    if kind not in ids.IDENTIFIER_TYPES:
        raise ValueError(f"unknown identifier type: {kind}")
    return (
        mapping.where(F.col(kind).isNotNull())
        .groupBy(F.col(kind).alias("_key"))
        .agg(F.min_by("firm_id", "registered_seq").alias(output))
    )


def resolve(mapping: DataFrame, kind: str, value: str | int) -> DataFrame:
    """One row, one column ``firm_id``: the firm of one identifier, null when unknown."""
    key = ids.normalize_identifier(kind, F.lit(value))
    return mapping.where(F.col(kind) == key).agg(
        F.min_by("firm_id", "registered_seq").alias("firm_id")
    )


def resolve_column(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    kind: str,
    output: str = "firm_id",
) -> DataFrame:
    """Add the firm of each row's identifier; unmatched and null identifiers give null.

    The lookup has one row per key, so every input row stays one row. Spark broadcasts
    it when it is small; otherwise a hot identifier on the left is split at run time.
    """
    lookup = lookup_table(mapping, kind, output)
    keyed = df.withColumn("_key", ids.normalize_identifier(kind, F.col(column))).drop(output)
    return lookup_join(keyed, lookup, "_key").drop("_key")


def resolution_rate(resolved: DataFrame, output: str = "firm_id") -> DataFrame:
    """How many rows were resolved, of how many."""
    return resolved.agg(
        F.count(output).alias("resolved"),
        F.count("*").alias("total"),
        F.coalesce(F.try_divide(F.count(output), F.count("*")), F.lit(0.0)).alias("rate"),
    )


def bootstrap_mapping(universe: DataFrame, directory: DataFrame) -> DataFrame:
    """Mapping of all universe firms whose ticker is in the directory.

    ``universe`` has ticker, optionally company_name, and ``registered_seq``;
    ``directory`` has one row per ticker. The directory title names a firm only when
    the universe has no name column.
    """
    by_ticker = directory.select(F.col("ticker").alias("_key"), F.col("cik"), F.col("title"))
    keyed = universe.drop("cik", "title").withColumn("_key", F.upper("ticker"))
    name = "company_name" if "company_name" in universe.columns else "title"
    records = lookup_join(keyed, by_ticker, "_key", "inner").select(
        "registered_seq",
        "cik",
        F.col("_key").alias("ticker"),
        F.col(name).alias("company_name"),
        F.lit(BOOTSTRAP_SOURCE).alias("source"),
    )
    return latest_per_firm(prepare_records(records))


def bootstrap_unmatched(universe: DataFrame, directory: DataFrame) -> DataFrame:
    """Universe rows whose ticker the directory lacks."""
    known = directory.select(F.col("ticker").alias("_key"))
    keyed = universe.withColumn("_key", F.upper("ticker"))
    return lookup_join(keyed, known, "_key", "left_anti").drop("_key")
