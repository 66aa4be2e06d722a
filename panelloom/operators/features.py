"""Document features and their roll-up to firm-years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.functions import text as tx

# Fixed value: default source label of the feature table.
FEATURE_SOURCE = "sec_filings"


def with_measures(
    df: DataFrame, keywords: Sequence[str] = tx.DEFAULT_KEYWORDS, text: str = "text"
) -> DataFrame:
    """Add keyword and token counts of a text column.

    The keyword search runs once per text; every count derives from its result.
    """
    hits = F.col("__hits")
    mentions = F.size(hits).cast("bigint")
    return (
        df.withColumn("__hits", tx.keyword_hits(F.col(text), keywords))
        .withColumns(
            {
                "ai_mention_count": mentions,
                "total_tokens": tx.total_tokens(F.col(text), keywords),
                "ai_token_count": mentions,
                "has_ai_mention": mentions > 0,
                "matched_keywords": F.array_sort(
                    F.array_distinct(F.transform(hits, F.lower))
                ),
            }
        )
        .drop("__hits")
    )


MEASURES = (
    "ai_mention_count",
    "total_tokens",
    "ai_token_count",
    "has_ai_mention",
    "matched_keywords",
)


def document_features(
    documents: DataFrame, keywords: Sequence[str] = tx.DEFAULT_KEYWORDS
) -> DataFrame:
    """Keyword and token counts per document. One projection over the text column."""
    return with_measures(documents, keywords).select(
        "document_id", "firm_id", F.col("fiscal_year").alias("year"), *MEASURES
    )


def firm_year_features(features: DataFrame, source: str = FEATURE_SOURCE) -> DataFrame:
    """Roll document features up to firm-years; null firms and years stay groups.

    All aggregates are counts and sums, so each task sends one row per firm-year.
    """
    documents = F.count("document_id")
    with_mention = F.count_if("has_ai_mention")
    rolled = features.groupBy("firm_id", "year").agg(
        documents.alias("document_count"),
        F.sum("ai_mention_count").alias("ai_mention_count"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("ai_token_count").alias("ai_token_count"),
        (with_mention / F.greatest(documents, F.lit(1))).alias("ai_mention_share"),
    )
    return rolled.withColumn("source", F.lit(source)).select(*schemas.ATTENTION_FIRM_YEAR.names)


def attention_firm_year(
    documents: DataFrame,
    keywords: Sequence[str] = tx.DEFAULT_KEYWORDS,
    source: str = FEATURE_SOURCE,
) -> DataFrame:
    """Documents to firm-year attention features in one plan."""
    return firm_year_features(document_features(documents, keywords), source)


def with_year(df: DataFrame, date_column: str, year_column: str = "year") -> DataFrame:
    """Add the calendar year of a date, timestamp or ISO date string column."""
    return df.withColumn(year_column, F.year(F.to_timestamp(date_column)))


def prefix_columns(
    df: DataFrame, prefix: str, exclude: Sequence[str] = ("firm_id", "year")
) -> DataFrame:
    """Put ``prefix_`` before every column name but the excluded ones."""
    return df.withColumnsRenamed(
        {name: f"{prefix}_{name}" for name in df.columns if name not in exclude}
    )


def placebo_trend(firm_years: DataFrame) -> DataFrame:
    """Per year: mentions in all, mean per firm-year, share of firm-years with any."""
    mentions = F.col("ai_mention_count")
    return firm_years.groupBy("year").agg(
        F.sum(mentions).alias("total_mentions"),
        F.avg(mentions).alias("mean_mentions"),
        F.avg((mentions > 0).cast("double")).alias("share_with_mention"),
    )
