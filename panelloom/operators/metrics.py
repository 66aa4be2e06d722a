"""Classifier metrics against human labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.text import strip


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


NO_MATCH = "no label row has a prediction"
NO_LABEL = "no row with a prediction has a label of 0 or 1"


def labelled_predictions(
    labels: DataFrame, scores: DataFrame | None = None, keep_unlabelled: bool = False
) -> DataFrame:
    """Label and prediction side by side, for rows whose label is 0 or 1; on request also
    for the others, with a null label.

    ``scores`` is joined on ``sample_id``; without it the labels must carry
    ``keyword_predicted`` themselves.
    """
    if "human_ai_mention" not in labels.columns:
        raise ValueError("labels have no human_ai_mention column")
    if scores is None:
        if "keyword_predicted" not in labels.columns:
            raise ValueError("give scores, or labels with a keyword_predicted column")
        pairs = labels
    else:
        if "sample_id" not in labels.columns or "sample_id" not in scores.columns:
            raise ValueError("labels and scores need a sample_id column")
        pairs = labels.select("sample_id", "human_ai_mention").join(
            scores.select("sample_id", "keyword_predicted"), "sample_id"
        )
    label = strip(F.col("human_ai_mention").cast("string"))
    both = pairs.select(
        F.when(label.isin("0", "1"), label.try_cast("int")).alias("actual"),
        F.col("keyword_predicted").cast("int").alias("predicted"),
    )
    return both if keep_unlabelled else both.where(F.col("actual").isNotNull())


def confusion_metrics(pairs: DataFrame) -> DataFrame:
    """One row: counts, precision, recall, F1 and error rates; 0.0 where undefined."""

    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col("actual") == actual) & (F.col("predicted") == predicted))

    counts = pairs.agg(
        F.count("*").alias("n_labeled"),
        cell(1, 1).alias("tp"),
        cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"),
        cell(0, 0).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    precision, recall = F.col("precision"), F.col("recall")
    return counts.withColumns(
        {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)}
    ).withColumns(
        {
            "f1": _ratio(2 * precision * recall, precision + recall),
            "false_positive_rate": _ratio(fp, fp + tn),
            "false_negative_rate": _ratio(fn, fn + tp),
        }
    )


def validation_metrics(labels: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Metrics of labels against predictions. That no row matches is one error, that no
    matching row has a label of 0 or 1 another."""
    pairs = labelled_predictions(labels, scores, keep_unlabelled=True)
    used = F.col("actual").isNotNull()
    metrics = confusion_metrics(pairs.where(used))
    matched = pairs.agg(F.count("*").alias("_matched"), F.count_if(used).alias("_used"))
    found = matched.select(
        F.when(F.col("_matched") == 0, F.raise_error(NO_MATCH))
        .when(F.col("_used") == 0, F.raise_error(NO_LABEL))
        .otherwise(F.col("_used"))
        .cast("bigint")
        .alias("n_labeled")
    )
    return metrics.join(found, "n_labeled").select(metrics.columns)
