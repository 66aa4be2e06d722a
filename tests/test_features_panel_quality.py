"""Document features, roll-up, panel assembly, controls and checks."""

from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.operators import features, panel, quality

DOC = "document_id string, firm_id string, fiscal_year int, text string"


def documents(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_roll_up(spark):
    docs = documents(
        spark,
        [
            ("1", "f", 2020, "Machine learning and deep learning."),
            ("2", "f", 2020, "Nothing here"),
            ("3", None, 2020, "computer vision"),
            ("4", None, 2020, None),
            ("5", "g", None, ""),
            (None, "g", None, "generative AI"),
        ],
    )
    out = features.attention_firm_year(docs, source="s")
    assert out.schema.names == schemas.ATTENTION_FIRM_YEAR.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.ATTENTION_FIRM_YEAR]
    rows = {(r.firm_id, r.year): tuple(r)[2:] for r in out.collect()}
    assert rows == {
        ("f", 2020): (2, 2, 7, 2, 0.5, "s"),
        (None, 2020): (2, 1, 2, 1, 0.5, "s"),
        # The document without an id is not counted, its mention is.
        ("g", None): (1, 1, 2, 1, 1.0, "s"),
    }


def test_no_documents_give_an_empty_typed_table(spark):
    out = features.attention_firm_year(schemas.empty(spark, schemas.DOCUMENTS))
    assert out.count() == 0 and out.schema.names == schemas.ATTENTION_FIRM_YEAR.names


def test_one_keyword_search_per_text(spark):
    docs = documents(spark, [("1", "f", 2020, "x")]).repartition(2)
    plan = features.attention_firm_year(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_year_prefix_and_trend(spark):
    dates = spark.createDataFrame([("2021-03-04",), ("1999-12-31 23:59:59",), (None,)], "d string")
    years = [r.y for r in features.with_year(dates, "d", "y").collect()]
    assert years == [2021, 1999, None]
    df = spark.createDataFrame([("f", 2020, 0, 1), ("g", 2020, 4, 1)],
                               "firm_id string, year int, ai_mention_count int, n int")
    assert features.prefix_columns(df, "p").columns == ["firm_id", "year", "p_ai_mention_count", "p_n"]
    trend = features.placebo_trend(df).first()
    assert tuple(trend) == (2020, 4, 2.0, 0.5)


@pytest.fixture(scope="module")
def tables(spark):
    first = spark.createDataFrame(
        [("f", 2014, "s", 1), ("f", 2015, "s", 2), ("g", 2016, "s", 3), (None, 2016, "s", 4)],
        "firm_id string, year int, source string, n int",
    )
    second = spark.createDataFrame(
        [("f", 2015, "t", 10), ("h", 2020, "t", 20), (None, 2016, "t", 30), ("f", None, "t", 40)],
        "firm_id string, year int, source string, n int",
    )
    return {"a/first": first, "b/second": second}


def test_panel(spark, tables):
    out = panel.assemble_panel(spark, {"none": None, **tables}, min_year=2015, max_year=2019)
    assert out.columns == ["firm_id", "year", "source", "n", "source_b_second", "b_second_n"]
    rows = {tuple(r) for r in out.collect()}
    assert rows == {
        ("f", 2015, "s", 2, "t", 10),
        ("g", 2016, "s", 3, None, None),
        (None, 2016, "s", 4, "t", 30),
    }


def test_panel_without_bounds_keeps_null_years(spark, tables):
    out = panel.assemble_panel(spark, tables, min_year=None, max_year=0)
    assert out.count() == 6
    assert out.where("year is null").first().b_second_n == 40


def test_table_emptied_by_the_filter_still_counts_as_first(spark, tables):
    out = panel.assemble_panel(spark, tables, min_year=2018, max_year=None)
    assert "b_second_n" in out.columns and out.count() == 1


def test_panel_without_inputs(spark):
    for out in (panel.assemble_panel(spark, {}), panel.panel_sql(spark, {})):
        assert out.columns == ["firm_id", "year"] and out.count() == 0


def test_panel_sql_does_not_match_nulls(spark, tables):
    second = tables["b/second"].withColumnRenamed("n", "m")
    out = panel.panel_sql(spark, {"a/first": tables["a/first"], "b-second": second})
    assert out.columns == ["firm_id", "year", "source", "n", "source_b_second", "m"]
    rows = Counter_rows(out)
    assert rows[(None, 2016, "s", 4, None, None)] == rows[(None, 2016, None, None, "t", 30)] == 1
    assert sum(rows.values()) == 7


def Counter_rows(df):
    from collections import Counter

    return Counter(tuple(r) for r in df.collect())


def test_year_filter_reaches_the_scan(spark, tables, tmp_path):
    stored = {}
    for name, df in tables.items():
        path = str(tmp_path / name.replace("/", "_"))
        df.write.parquet(path)
        stored[name] = spark.read.parquet(path)
    out = panel.assemble_panel(spark, stored, min_year=2015, max_year=2019, unique_keys=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(year,2015)") == 2


def test_controls(spark):
    base = spark.createDataFrame(
        [("f", 2020, 1), ("g", 2020, 2), ("f", 2021, 3), ("x", 2020, 4)],
        "firm_id string, year int, conm int",
    )
    mapping = spark.createDataFrame([("f", "0000000001"), ("g", None)], "firm_id string, cik string")
    controls = spark.createDataFrame(
        [("1", "0000000001", 2020, 9.0, 0.5, 12, 3.0, "F"),
         ("2", "0000000001", 2020, 8.0, 0.25, 13, 4.0, "F2"),
         ("3", "", 2020, 7.0, 0.1, 14, 5.0, "blank")],
        "gvkey string, cik string, year int, at double, roa double, sic int, emp double, conm string",
    )
    for hot_rows in (1, 1_000_000):
        out = panel.add_controls(base, controls, mapping, hot_rows)
        assert out.columns == ["firm_id", "year", "conm", "cik", "compustat_gvkey", "compustat_at",
                               "compustat_roa", "compustat_sic", "compustat_emp", "conm_dup"]
        roa = sorted((r.firm_id, r.year, r.compustat_roa or 0) for r in out.collect())
        assert roa == [("f", 2020, 0.25), ("f", 2020, 0.5), ("f", 2021, 0), ("g", 2020, 0),
                       ("x", 2020, 0)]
    with pytest.raises(ValueError):
        panel.add_controls(out, controls, mapping)


def report(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    out = quality.quality_report(df)
    passed = quality.report_passed(out).first().passed
    return {r.name: (r.passed, r.message, json.loads(r.details)) for r in out.collect()}, passed


def test_quality_report(spark):
    rows = [("a", 2020), ("a", 2020), (None, 2021), (None, 2021), (None, 2021), ("b", None)]
    checks, passed = report(spark, rows, "firm_id string, year int")
    frame = pd.DataFrame(rows, columns=["firm_id", "year"])
    duplicates = int(frame.duplicated(keep=False).sum())
    assert checks == {
        "required_columns": (True, "All required columns present", {"missing_columns": []}),
        "duplicate_keys": (False, f"Found {duplicates} duplicate firm_id-year rows",
                           {"duplicate_count": duplicates}),
        "year_range": (True, "Year range: 2020-2021", {"min_year": 2020, "max_year": 2021}),
        "null_firm_ids": (False, "Found 3 null firm_id values", {"null_count": 3}),
    }
    assert passed is False
    _, passed = report(spark, [("a", 2020), ("b", 2021)], "firm_id string, year int")
    assert passed is True


def test_quality_report_of_an_empty_panel(spark):
    checks, passed = report(spark, [], "firm_id string, year int")
    assert passed is True
    assert checks["duplicate_keys"][1] == "Empty panel; no duplicates"
    assert checks["year_range"][1] == "No year data to validate"
    assert checks["null_firm_ids"][1] == "Empty panel"


def test_quality_report_with_missing_columns(spark):
    checks, passed = report(spark, [("a",), (None,)], "firm_id string")
    assert passed is False
    assert checks["required_columns"] == (False, "Missing: ['year']", {"missing_columns": ["year"]})
    assert checks["duplicate_keys"][0] is False and checks["null_firm_ids"][2] == {"null_count": 1}
    checks, _ = report(spark, [(1,)], "other int")
    assert checks["required_columns"][1] == "Missing: ['firm_id', 'year']"


def test_rule_violations(spark):
    good = ("OAA-1", 2020, 1, 0, 0, 0, 0.5, "s")
    bad = [("X", 1980, -1, -1, -1, -1, 1.5, None), (None, None, 1, 1, None, None, None, "s")]
    df = spark.createDataFrame([good, *bad], schemas.ATTENTION_FIRM_YEAR)
    out = quality.rule_violations(df, quality.feature_rules())
    found = {r.rule: r.violations for r in out.collect()}
    assert found.pop("firm_id_required") == found.pop("year_required") == 1
    assert set(found.values()) == {1}
    clean = quality.rule_violations(df.limit(1), quality.feature_rules())
    assert clean.agg(F.sum("violations")).first()[0] == 0
