"""Stratified sample against brute force; metrics against hand counts."""

from __future__ import annotations

import hashlib

import pytest

from panelloom.operators import metrics, sampling
from panelloom.sources import scans, sinks

WORDS = {"zero": 0, "low": 3, "medium": 9, "high": 30}


@pytest.fixture(scope="module")
def documents(spark):
    rows = []
    for i in range(900):
        # One stratum holds most of the documents.
        year = 2020 if i % 10 else 2015 + i % 6
        name = "zero" if i % 7 else list(WORDS)[i // 7 % 4]
        rows.append((f"d{i}", "f", "T", year, "10-K", "deep learning " * WORDS[name] + f"end {i}"))
    schema = "document_id string, firm_id string, ticker string, fiscal_year int, form_type string, text string"
    return spark.createDataFrame(rows, schema).repartition(7)


def draw(salt, document):
    return hashlib.sha256(f"42|{salt}{document}".encode()).hexdigest(), document


def brute_force(pool, size):
    quota = max(1, size // len({r.density_bin for r in pool}))
    strata: dict = {}
    for r in pool:
        strata.setdefault((r.fiscal_year, r.density_bin), []).append(r)
    chosen = [
        r
        for rows in strata.values()
        for r in sorted(rows, key=lambda r: draw("", r.document_id))[:quota]
    ]
    return {r.document_id for r in sorted(chosen, key=lambda r: draw("second|", r.document_id))[:size]}


@pytest.mark.parametrize("size", [1, 3, 40, 250, 2000])
def test_sample_equals_brute_force(documents, size):
    pool = sampling.score_pool(documents)
    sample = sampling.stratified_sample(pool, size).collect()
    assert {r.document_id for r in sample} == brute_force(pool.collect(), size)
    assert len(sample) <= size


def test_sample_is_stable_under_partitioning(documents):
    first = sampling.generate_sample(documents, sample_size=50).collect()
    second = sampling.generate_sample(documents.repartition(3), sample_size=50).collect()
    assert sorted(first) == sorted(second)
    assert {r.sample_id for r in first} == {
        hashlib.sha256(r.document_id.encode()).hexdigest()[:12] for r in first
    }


def test_rows_are_dropped_before_the_shuffle(documents):
    plan = sampling.stratified_sample(sampling.score_pool(documents))
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_no_documents(spark, documents):
    with pytest.raises(ValueError, match="no documents"):
        sampling.generate_sample(documents.limit(0))


def test_missing_columns_are_blank(documents):
    row = sampling.score_pool(documents.drop("ticker", "form_type")).first()
    assert (row.ticker, row.form_type) == ("", "")


def test_blind_files(spark, documents, tmp_path):
    sample = sampling.generate_sample(documents, ["end"], sample_size=30)
    labeling, scores = str(tmp_path / "labeling"), str(tmp_path / "scores")
    sinks.write_blind_sample(sample, labeling, scores)
    blind, hidden = scans.read_text_csv(spark, labeling), scans.read_text_csv(spark, scores)
    assert blind.columns == list(sampling.LABELING_COLUMNS)
    assert hidden.columns == list(sampling.SCORE_COLUMNS)
    assert blind.count() == hidden.count() == 30
    assert blind.join(hidden, "sample_id").count() == 30
    with pytest.raises(Exception, match="no row with"):
        metrics.validation_metrics(blind, hidden).collect()


def test_excerpts_with_quotes_and_newlines_survive_the_file(spark, tmp_path):
    text = 'a "quoted", line\nand \\ more'
    df = spark.createDataFrame(
        [("d", "f", "T", 2020, "10-K", text)],
        "document_id string, firm_id string, ticker string, fiscal_year int, form_type string, text string",
    )
    sinks.write_blind_sample(
        sampling.generate_sample(df), str(tmp_path / "l"), str(tmp_path / "s")
    )
    assert scans.read_text_csv(spark, str(tmp_path / "l")).first().excerpt == text


def measured(spark, pairs):
    labels = spark.createDataFrame(
        [(str(i), label) for i, (label, _) in enumerate(pairs)], "sample_id string, human_ai_mention string")
    scores = spark.createDataFrame(
        [(str(i), p) for i, (_, p) in enumerate(pairs)], "sample_id string, keyword_predicted string")
    return metrics.validation_metrics(labels, scores).first().asDict()


def test_metrics(spark):
    pairs = [("1", "1")] * 5 + [("0", "1")] + [(" 1\t", "0")] * 2 + [("0", "0")] * 2
    pairs += [("", "1"), (None, "1"), ("yes", "0"), ("1.0", "0")]
    out = measured(spark, pairs)
    assert (out["n_labeled"], out["tp"], out["fp"], out["fn"], out["tn"]) == (10, 5, 1, 2, 2)
    assert out["precision"] == 5 / 6 and out["recall"] == 5 / 7
    assert out["f1"] == pytest.approx(10 / 13)
    assert out["false_positive_rate"] == 1 / 3 and out["false_negative_rate"] == 2 / 7


def test_undefined_rates_are_zero(spark):
    out = measured(spark, [("0", "0")])
    assert [out[k] for k in ("precision", "recall", "f1", "false_negative_rate")] == [0.0] * 4


def test_errors(spark):
    labels = spark.createDataFrame([("a", "1")], "sample_id string, human_ai_mention string")
    other = spark.createDataFrame([("b", "1")], "sample_id string, keyword_predicted string")
    with pytest.raises(ValueError, match="human_ai_mention"):
        metrics.validation_metrics(other)
    with pytest.raises(ValueError, match="keyword_predicted"):
        metrics.validation_metrics(labels)
    with pytest.raises(ValueError, match="sample_id"):
        metrics.validation_metrics(labels, other.drop("sample_id"))
    with pytest.raises(Exception, match=metrics.NO_MATCH):
        metrics.validation_metrics(labels, other).collect()
    blank = spark.createDataFrame([("b", "")], "sample_id string, human_ai_mention string")
    with pytest.raises(Exception, match=metrics.NO_LABEL):
        metrics.validation_metrics(blank, other).collect()


def test_combined_file(spark):
    both = spark.createDataFrame([("1", "1"), ("0", "1")], "human_ai_mention string, keyword_predicted string")
    assert metrics.validation_metrics(both).first().precision == 0.5
