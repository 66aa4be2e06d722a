"""Panel quality checks; each report comes from one pass over the panel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
REQUIRED_COLUMNS = ("firm_id", "year")
ALL_PRESENT = "All required columns present"
MISSING_COLUMNS = "Missing: [%s]"
DUPLICATE_ROWS = "Found %d duplicate firm_id-year rows"
EMPTY_NO_DUPLICATES = "Empty panel; no duplicates"
YEAR_RANGE = "Year range: %d-%d"
NO_YEARS = "No year data to validate"
NULL_FIRMS = "Found %d null firm_id values"
EMPTY_PANEL = "Empty panel"
FIRM_ID_PATTERN = "^OAA-"
FIRST_YEAR = 1990
COUNT_COLUMNS = ("document_count", "ai_mention_count", "total_tokens", "ai_token_count")
SHARE_COLUMN = "ai_mention_share"
REQUIRED_FIELDS = ("firm_id", "year", "source")
# --------------------------------------------------------------------------


def _check(name: str, passed: Column, message: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        passed.alias("passed"),
        message.alias("message"),
        details.alias("details"),
    )


def _details(**values: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in values.items()]))


def quality_report(panel: DataFrame) -> DataFrame:
    """Four checks as rows: name, passed, message, details (JSON).

    Rows are first counted per (firm_id, year), which is combined map-side; all
    checks then derive from those counts. A panel lacking a key column fails the
    checks that need it and does not raise.
    """
    missing = [name for name in REQUIRED_COLUMNS if name not in panel.columns]
    present = [name for name in REQUIRED_COLUMNS if name not in missing]
    per_key = panel.groupBy(*present).agg(F.count("*").alias("_n"))
    zero = F.lit(0).cast("bigint")
    measures = {"rows": F.sum("_n")}
    if not missing:
        measures["duplicates"] = F.sum(F.when(F.col("_n") > 1, F.col("_n")))
    if "year" in present:
        measures["min_year"], measures["max_year"] = F.min("year"), F.max("year")
    if "firm_id" in present:
        measures["nulls"] = F.sum(F.when(F.col("firm_id").isNull(), F.col("_n")))
    totals = per_key.agg(*[value.alias(name) for name, value in measures.items()])
    for name in ("rows", "duplicates", "nulls"):
        if name in measures:
            totals = totals.withColumn(name, F.coalesce(F.col(name), zero))

    empty = F.col("rows") == 0
    no_details = F.lit("{}")
    lacking = ", ".join(f"'{name}'" for name in missing)
    cannot = F.lit(MISSING_COLUMNS % lacking)
    checks = [
        _check(
            "required_columns",
            F.lit(not missing),
            cannot if missing else F.lit(ALL_PRESENT),
            _details(missing_columns=F.array(*map(F.lit, missing)).cast("array<string>")),
        )
    ]

    if missing:
        checks.append(_check("duplicate_keys", empty, cannot, no_details))
    else:
        n = F.col("duplicates")
        checks.append(
            _check(
                "duplicate_keys",
                n == 0,
                F.when(empty, EMPTY_NO_DUPLICATES).otherwise(F.format_string(DUPLICATE_ROWS, n)),
                F.when(empty, no_details).otherwise(_details(duplicate_count=n)),
            )
        )
    no_years = F.lit(NO_YEARS)
    if "year" in missing:
        checks.append(_check("year_range", F.lit(True), no_years, no_details))
    else:
        low, high = F.col("min_year"), F.col("max_year")
        checks.append(
            _check(
                "year_range",
                F.lit(True),
                F.when(low.isNull(), no_years).otherwise(F.format_string(YEAR_RANGE, low, high)),
                F.when(low.isNull(), no_details).otherwise(_details(min_year=low, max_year=high)),
            )
        )
    if "firm_id" in missing:
        checks.append(_check("null_firm_ids", empty, cannot, no_details))
    else:
        n = F.col("nulls")
        checks.append(
            _check(
                "null_firm_ids",
                n == 0,
                F.when(empty, EMPTY_PANEL).otherwise(F.format_string(NULL_FIRMS, n)),
                F.when(empty, no_details).otherwise(_details(null_count=n)),
            )
        )
    return totals.select(F.inline(F.array(*checks)))


def report_passed(report: DataFrame) -> DataFrame:
    """One row: do all checks pass."""
    return report.agg(F.bool_and("passed").alias("passed"))


def feature_rules() -> dict[str, Column]:
    """Declared constraints of the attention feature table; each rule must not be false."""
    rules = {f"{name}_required": F.col(name).isNotNull() for name in REQUIRED_FIELDS}
    rules["firm_id_format"] = F.col("firm_id").rlike(FIRM_ID_PATTERN)
    rules["year_minimum"] = F.col("year") >= FIRST_YEAR
    for name in COUNT_COLUMNS:
        rules[f"{name}_minimum"] = F.col(name) >= 0
    rules[f"{SHARE_COLUMN}_range"] = F.col(SHARE_COLUMN).between(0, 1)
    return rules


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows (rule, violations): how many rows break each rule, counted in one pass.

    A rule that is null for a row, as for a null optional value, is not broken.
    """
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules
    ]
    return counted.select(F.inline(F.array(*rows)))
