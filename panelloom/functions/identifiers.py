"""Identifier normalisers and the canonical hashed id, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelloom.functions.text import strip

# Fixed values -------------------------------------------------------------
FIRM_ID_PREFIX = "OAA-"
FIRM_ID_HEX = 12
SAMPLE_ID_HEX = 12
HASH_HEX = 16
CIK_DIGITS = 10
IDENTIFIER_TYPES = ("gvkey", "cik", "ticker", "cusip", "permno", "company_name")
# --------------------------------------------------------------------------

_NO_IDENTIFIER = "a firm id needs at least one identifier"


def stable_hash(value: Column, length: int = HASH_HEX) -> Column:
    """Leading hex digits of the SHA-256 of a string."""
    return F.substring(F.sha2(value.cast("string"), 256), 1, length)


def _padded(number: Column) -> Column:
    # lpad cuts to the given width, so the width follows longer numbers.
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(CIK_DIGITS)), F.lit("0"))


def _number(text: Column) -> Column:
    """A number in text, else null. The cast ignores white space of ASCII; only text that it
    can't read is stripped, which is dear, and read again."""
    return F.coalesce(text.try_cast("bigint"), strip(text).try_cast("bigint"))


def whole_number(text: Column) -> Column:
    """Text as a number; bad text raises whatever the session's ANSI setting. Null stays null.

    What is behind the first cast runs only where that gave null, so a good id is read once.
    """
    bad = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("bigint")
    return F.coalesce(_number(text), F.when(text.isNotNull(), bad))


def normalize_cik(cik: Column, strict: bool = True) -> Column:
    """Zero-padded regulator id. Bad text raises, or is null when not strict. Null stays null."""
    text = cik.cast("string")
    return _padded(whole_number(text) if strict else _number(text))


def normalize_file_cik(cik: Column) -> Column:
    """Variant for files: cut at the first dot; missing, blank and ``nan`` give ``""``."""
    text = F.substring_index(cik.cast("string"), ".", 1)
    absent = text.isNull() | F.lower(strip(text)).isin("", "nan")
    # Text that is no number is looked at again, to tell absent from bad.
    rest = F.when(absent, F.lit("")).otherwise(_padded(whole_number(text)))
    return F.coalesce(_padded(_number(text)), rest)


def unpadded_cik(cik: Column) -> Column:
    """Regulator id without leading zeros, as used in file paths."""
    return cik.cast("bigint").cast("string")


def normalize_ticker(ticker: Column) -> Column:
    """Upper-cased and stripped ticker."""
    return strip(F.upper(ticker.cast("string")))


def normalize_identifier(kind: str, value: Column) -> Column:
    """The lookup form of an identifier of the given kind."""
    if kind not in IDENTIFIER_TYPES:
        raise ValueError(f"unknown identifier type: {kind}")
    if kind == "cik":
        return normalize_cik(value)
    if kind == "ticker":
        return normalize_ticker(value)
    if kind == "permno":
        return value.cast("int")
    return value.cast("string")


def _non_blank(value: Column) -> Column:
    return F.nullif(strip(value.cast("string")), F.lit(""))


def firm_id(
    gvkey: Column | None = None,
    cik: Column | None = None,
    cusip: Column | None = None,
    permno: Column | None = None,
    ticker: Column | None = None,
    company_name: Column | None = None,
    on_missing: str = "raise",
) -> Column:
    """Canonical id hashed from the strongest identifier present.

    Order: gvkey, cik, cusip, permno, ticker, company name. A blank cik counts as
    missing. With no identifier at all the row raises, or is null for
    ``on_missing="null"``.
    """
    seeds = []
    if gvkey is not None:
        seeds.append(F.concat(F.lit("gvkey:"), _non_blank(gvkey)))
    if cik is not None:
        text = cik.cast("string")
        given = _padded(_number(text))
        # Only text that is no number is looked at again: blank means missing, the rest raises.
        seeds.append(F.concat(F.lit("cik:"), F.coalesce(given, normalize_cik(_non_blank(text)))))
    if cusip is not None:
        seeds.append(F.concat(F.lit("cusip:"), _non_blank(cusip)))
    if permno is not None:
        seeds.append(F.concat(F.lit("permno:"), permno.cast("bigint").cast("string")))
    if ticker is not None:
        seeds.append(F.concat(F.lit("ticker:"), normalize_ticker(ticker)))
    if company_name is not None:
        seeds.append(F.concat(F.lit("name:"), F.upper(_non_blank(company_name))))
    if not seeds:
        raise ValueError(_NO_IDENTIFIER)
    if on_missing == "raise":
        seeds.append(F.raise_error(_NO_IDENTIFIER).cast("string"))
    digest = stable_hash(F.coalesce(*seeds), FIRM_ID_HEX)
    return F.concat(F.lit(FIRM_ID_PREFIX), digest)


def sample_id(document_id: Column) -> Column:
    """Blind id of a sampled document."""
    return stable_hash(document_id, SAMPLE_ID_HEX)


def document_id(cik: Column, accession: Column, document: Column) -> Column:
    """``cik_accession_document``."""
    return F.concat_ws("_", cik, accession, document)
