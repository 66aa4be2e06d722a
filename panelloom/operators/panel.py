"""Firm-year panel assembly."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.operators.features import prefix_columns
from panelloom.operators.joins import HOT_ROWS, left_join, null_salt, outer_join

# Fixed values -------------------------------------------------------------
JOIN_KEYS = ("firm_id", "year")
CONTROL_COLUMNS = ("at", "roa", "sic", "emp", "gvkey")
CONTROL_PREFIX = "compustat"
CLASH_SUFFIX = "_dup"
# --------------------------------------------------------------------------


def table_prefix(table: str) -> str:
    """Column prefix and view name of a feature table."""
    return table.replace("/", "_").replace("-", "_")


def within_years(df: DataFrame, min_year: int | None, max_year: int | None) -> DataFrame:
    """Keep the inclusive year range; an absent or zero bound does not filter."""
    if min_year:
        df = df.where(F.col("year") >= min_year)
    if max_year:
        df = df.where(F.col("year") <= max_year)
    return df


def assemble_panel(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    join_keys: Sequence[str] = JOIN_KEYS,
    min_year: int | None = None,
    max_year: int | None = None,
    null_safe: bool = True,
    unique_keys: bool = False,
    hot_rows: int = HOT_ROWS,
    keep_inputs: bool = False,
) -> DataFrame:
    """Full outer join of feature tables on the keys, years filtered before the join.

    Absent tables (None) are left out; whether a stored table is empty is decided where it
    is read, so building the panel of tables with one row per key runs no job. Every table
    after the first gets its own name as column prefix; its ``source`` becomes
    ``source_<table>``. Without bounds no year is left out. The filter sits on each input
    so that it reaches the Parquet scan.
    """
    parts: list[DataFrame] = []
    for name, df in tables.items():
        if df is None:
            continue
        if parts:
            df = prefix_columns(df, name.replace("/", "_"), exclude=[*join_keys, "source"])
            df = df.withColumnRenamed("source", f"source_{table_prefix(name)}")
        parts.append(within_years(df, min_year, max_year))
    if not parts:
        return schemas.empty(spark, schemas.PANEL_KEYS)
    return outer_join(parts, join_keys, null_safe, unique_keys, hot_rows, keep_inputs)


def panel_sql(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    min_year: int | None = None,
    max_year: int | None = None,
    unique_keys: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """SQL form: ``FULL OUTER JOIN ... USING (firm_id, year)`` over named views.

    Null keys match nothing. Inside the views such rows get a salt as one more key, which
    spreads them over all tasks, so one join serves all rows and each table is read once.
    Columns keep their names, except that every later ``source`` is called
    ``source_<table>``. A year filter on the joined year equals one on each input, and
    only the latter is pushed down. Views get names of their own for each call. Tables
    that may repeat a key (``unique_keys`` false) take the same join in its DataFrame
    form, which splits hot keys.
    """
    if not tables:
        return schemas.empty(spark, schemas.PANEL_KEYS)
    parts = []
    for i, (name, df) in enumerate(tables.items()):
        if i:
            df = df.withColumnRenamed("source", f"source_{table_prefix(name)}")
        parts.append(within_years(df, min_year, max_year))
    if not unique_keys:
        return outer_join(parts, JOIN_KEYS, False, False, hot_rows)
    call = uuid.uuid4().hex
    salt = f"_salt_{call}"
    views = []
    for name, part in zip(tables, parts, strict=True):
        view = f"`{table_prefix(name).replace('`', '_')}_{call}`"
        null_salt(part, JOIN_KEYS, salt).createOrReplaceTempView(view)
        views.append(view)
    using = f"USING (firm_id, year, {salt})"
    joins = "".join(f" FULL OUTER JOIN {view} {using}" for view in views[1:])
    return spark.sql(f"SELECT * EXCEPT ({salt}) FROM {views[0]}{joins}")


def add_controls(
    panel: DataFrame,
    controls: DataFrame,
    mapping: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join financial controls onto the panel through the firm's regulator id.

    Repeated controls of one firm-year repeat the panel row. Control columns that
    would clash with panel columns get a suffix.
    """
    if "cik" in panel.columns:
        raise ValueError("panel already has a cik column")
    # A mapping has one row per firm; controls may repeat a firm-year.
    ciks = mapping.select("firm_id", "cik")
    keyed = left_join(panel, ciks, ["firm_id"], null_safe=True, unique_keys=True)
    renamed = controls.withColumnsRenamed({c: f"{CONTROL_PREFIX}_{c}" for c in CONTROL_COLUMNS})
    clashes = set(renamed.columns) & set(keyed.columns) - {"cik", "year"}
    renamed = renamed.withColumnsRenamed({c: c + CLASH_SUFFIX for c in clashes})
    return left_join(keyed, renamed, ["cik", "year"], null_safe=True, hot_rows=hot_rows)
