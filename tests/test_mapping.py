"""Upsert, lookups and bootstrap."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SKEW_SETTINGS
from panelloom import schemas
from panelloom.operators import mapping as maps

FIELDS = "firm_id string, gvkey string, cik string, ticker string, source string, registered_seq long"


def records(spark, rows):
    return spark.createDataFrame(rows, FIELDS)


def base(spark):
    rows = records(
        spark,
        [
            ("", "0100", "11", " aa ", "s", 1),
            ("", None, "22", "bb", "s", 2),
            ("", None, "33", "bb", "s", 3),
            ("given", None, None, "cc", "s", 4),
        ],
    )
    return maps.upsert_mapping(schemas.empty(spark, schemas.MAPPING), rows)


def test_register_normalises_and_keeps_given_ids(spark):
    rows = {r.registered_seq: r for r in base(spark).collect()}
    assert (rows[1].cik, rows[1].ticker, rows[1].gvkey) == ("0000000011", "AA", "0100")
    assert rows[4].firm_id == "given" and rows[4].cik is None
    assert all(rows[i].firm_id.startswith("OAA-") for i in (1, 2, 3))


def test_upsert_keeps_one_row_per_firm_the_last(spark):
    mapping = base(spark)
    again = records(spark, [("", "0100", "44", "zz", "t", 9), ("", None, "22", "yy", "t", 8),
                            ("", None, "22", "xx", "t", 10)])
    merged = maps.upsert_mapping(mapping, again)
    assert merged.count() == mapping.count()
    tickers = {r.ticker for r in merged.collect()}
    assert tickers == {"ZZ", "XX", "BB", "CC"}
    assert merged.where("ticker = 'ZZ'").first().cik == "0000000044"
    assert merged.schema.names == schemas.MAPPING.names


def test_resolve(spark):
    mapping = base(spark)

    def one(kind, value):
        return maps.resolve(mapping, kind, value).first().firm_id

    assert one("cik", 11) == one("ticker", "aa ") == one("gvkey", "0100") is not None
    assert one("ticker", "bb") == one("cik", "22"), "the first row in order wins"
    assert one("gvkey", "100") is None and one("permno", 5) is None
    with pytest.raises(ValueError):
        one("isin", "x")


def test_bulk_resolve_keeps_rows(spark):
    mapping = base(spark)
    rows = [(1, "bb"), (2, "BB "), (3, None), (4, "nope"), (5, "aa"), (5, "aa")]
    df = spark.createDataFrame(rows, "n int, id string")
    out = maps.resolve_column(df, mapping, "id", "ticker", "firm")
    assert out.columns == ["n", "id", "firm"] and out.count() == len(rows)
    found = {r.n: r.firm for r in out.collect()}
    assert found[1] == found[2] == maps.resolve(mapping, "cik", "22").first().firm_id
    assert found[3] is None and found[4] is None and found[5] is not None
    rate = maps.resolution_rate(out, "firm").first()
    assert (rate.resolved, rate.total) == (4, 6)
    assert maps.resolution_rate(out.where("n > 9"), "firm").first().rate == 0.0


def test_hot_identifier_is_split_at_run_time(spark, settings):
    """Nine of ten rows share one identifier: the join reads that partition in pieces."""
    settings(SKEW_SETTINGS)
    ids = F.when(F.col("id") % 10 > 0, "aa").otherwise(F.concat(F.lit("t"), "id"))
    facts = spark.range(0, 200_000, 1, 16).withColumn("ticker", ids)
    out = maps.resolve_column(facts, base(spark), "ticker", "ticker")
    assert out.where("firm_id is not null").count() == 180_000
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_bootstrap(spark):
    universe = spark.createDataFrame(
        [("xx", "X Corp", 1), ("Yy", "Y Corp", 2), ("zz", None, 3), ("ww", "W", 4)],
        "ticker string, company_name string, registered_seq long",
    )
    directory = spark.createDataFrame(
        [("XX", "0000000001", "x title"), ("YY", "0000000001", "y"), ("ZZ", "0000000003", "z")],
        "ticker string, cik string, title string",
    )
    mapping = maps.bootstrap_mapping(universe, directory)
    rows = {r.cik: r for r in mapping.collect()}
    # Two tickers of one cik are one firm; the later one stays.
    assert set(rows) == {"0000000001", "0000000003"}
    assert (rows["0000000001"].ticker, rows["0000000001"].company_name) == ("YY", "Y Corp")
    assert rows["0000000003"].company_name is None
    assert {r.source for r in rows.values()} == {maps.BOOTSTRAP_SOURCE}
    assert [r.ticker for r in maps.bootstrap_unmatched(universe, directory).collect()] == ["ww"]
    unnamed = maps.bootstrap_mapping(universe.drop("company_name"), directory)
    assert unnamed.where("ticker = 'ZZ'").first().company_name == "z"
