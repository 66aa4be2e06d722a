"""Normalisers, hashes and canonical ids."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from panelloom.functions import identifiers as ids

FIELDS = ("gvkey", "cik", "cusip", "permno", "ticker", "company_name")
RECORD = "gvkey string, cik string, cusip string, permno int, ticker string, company_name string"


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def digest(seed, length=12):
    return hashlib.sha256(seed.encode()).hexdigest()[:length]


def firm_ids(spark, records, **options):
    df = spark.createDataFrame(records, RECORD)
    expression = ids.firm_id(**{name: F.col(name) for name in FIELDS}, **options)
    return [row.o for row in df.select(expression.alias("o")).collect()]


def test_cik(spark):
    values = ["5", "0000000005", "0", "12345678901", None, " 77 "]
    expected = ["0000000005", "0000000005", "0000000000", "12345678901", None, "0000000077"]
    assert column(spark, values, ids.normalize_cik) == expected
    assert column(spark, [9], ids.normalize_cik, "int") == ["0000000009"]
    assert column(spark, ["x"], lambda c: ids.normalize_cik(c, strict=False)) == [None]
    with pytest.raises(Exception, match="not a whole number"):
        column(spark, ["x"], ids.normalize_cik)


def test_file_cik(spark):
    values = ["5.0", "0012", None, "", "nan", "NaN", "99999999999.5"]
    expected = ["0000000005", "0000000012", "", "", "", "", "99999999999"]
    assert column(spark, values, ids.normalize_file_cik) == expected


def test_ticker(spark):
    assert column(spark, [" brk.b\t", None, ""], ids.normalize_ticker) == ["BRK.B", None, ""]


def test_hash_matches_sha256(spark):
    values = ["", "x", "é😀"]
    assert column(spark, values, ids.stable_hash) == [digest(v, 16) for v in values]
    assert column(spark, values, ids.sample_id) == [digest(v) for v in values]


def test_known_ids(spark):
    # Published triples of document id, its sample id, and the firm id of its cik.
    known = [
        ("0000796343_0000796343-15-000022_adbe10kfy14.htm", "c66ba4efb743", "OAA-9e0f5193b1b5"),
        ("0000001800_0001047469-15-001377_a2222655z10-k.htm", "5915bc2b9de0", "OAA-b9d26f5ed5a7"),
    ]
    df = spark.createDataFrame([(doc,) for doc, _, _ in known], "doc string")
    out = df.select(
        "doc",
        ids.sample_id(F.col("doc")).alias("sample"),
        ids.firm_id(cik=F.substring_index("doc", "_", 1)).alias("firm"),
    ).collect()
    assert [tuple(row) for row in out] == known


def test_priority(spark):
    full = [" 12 ", "7", "CU", 3, " tk ", " Name "]
    seeds = ["gvkey:12", "cik:0000000007", "cusip:CU", "permno:3", "ticker:TK", "name:NAME"]
    records = [tuple([None] * i + full[i:]) for i in range(6)]
    assert firm_ids(spark, records) == ["OAA-" + digest(seed) for seed in seeds]
    assert all(len(firm) == 16 for firm in firm_ids(spark, records))


def test_blank_identifiers_are_skipped(spark):
    record = (" ", "", " ", None, None, "Acme")
    assert firm_ids(spark, [record]) == ["OAA-" + digest("name:ACME")]


def test_no_identifier(spark):
    nothing = [(None,) * 6]
    assert firm_ids(spark, nothing, on_missing="null") == [None]
    with pytest.raises(Exception, match="at least one identifier"):
        firm_ids(spark, nothing)
    with pytest.raises(ValueError, match="at least one identifier"):
        ids.firm_id()


def test_unknown_kind():
    with pytest.raises(ValueError, match="unknown identifier type"):
        ids.normalize_identifier("isin", None)
