"""Explicit table schemas; every stage reads and writes one of these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, TIMESTAMP = T.DoubleType(), T.TimestampType()


def _table(**columns: T.DataType) -> T.StructType:
    """A table's columns and types, all nullable."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


MAPPING = _table(
    firm_id=STRING, gvkey=STRING, cik=STRING, ticker=STRING, cusip=STRING, permno=INT,
    company_name=STRING, source=STRING, registered_seq=LONG,
)

MANIFEST = _table(
    firm_id=STRING, ticker=STRING, cik=STRING, accession_number=STRING, form_type=STRING,
    filing_date=STRING, fiscal_year=INT, primary_document=STRING, raw_path=STRING,
)

DOCUMENTS = _table(
    document_id=STRING, firm_id=STRING, cik=STRING, ticker=STRING, form_type=STRING,
    filing_date=STRING, fiscal_year=INT, text=STRING, raw_path=STRING,
)

ATTENTION_FIRM_YEAR = _table(
    firm_id=STRING, year=INT, document_count=LONG, ai_mention_count=LONG, total_tokens=LONG,
    ai_token_count=LONG, ai_mention_share=DOUBLE, source=STRING,
)

PANEL_KEYS = _table(firm_id=STRING, year=INT)

STAGE_METADATA = _table(
    stage=STRING, source=STRING, signal_layer=STRING, path=STRING, created_at=TIMESTAMP,
    row_count=LONG, config_hash=STRING,
)

_FILING_LISTS = T.StructType(
    [
        T.StructField(name, T.ArrayType(T.StringType()))
        for name in ("accessionNumber", "form", "filingDate", "primaryDocument")
    ]
)

SUBMISSIONS = T.StructType(
    [
        T.StructField("cik", T.StringType()),
        T.StructField(
            "filings",
            T.StructType(
                [
                    T.StructField("recent", _FILING_LISTS),
                    T.StructField(
                        "files",
                        T.ArrayType(T.StructType([T.StructField("name", T.StringType())])),
                    ),
                ]
            ),
        ),
    ]
)

SUBMISSION_SHARD = _FILING_LISTS

TICKER_ENTRY = T.StructType(
    [
        T.StructField("cik_str", T.LongType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("title", T.StringType()),
    ]
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed frame with no rows; the optimizer sees that it is empty."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)
