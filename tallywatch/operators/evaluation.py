"""Quality of a prediction column against a label column, and score statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(part: Column, whole: Column) -> Column:
    """0 when the denominator is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The four cells as one row; rows with a null label or prediction are left out."""
    truth, guess = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(truth & guess).alias("tp"),
    )


def confusion_matrix(
    df: DataFrame, label: str = "is_fraud", prediction: str = "is_ml_anomaly"
) -> DataFrame:
    """Counts for all four pairs of label and prediction."""
    return _cells(df, label, prediction).select(F.inline(F.array(*[
        F.struct(
            F.lit(truth).alias("actual"),
            F.lit(guess).alias("predicted"),
            F.col(cell).alias("row_count"),
        )
        for truth, guess, cell in [
            (False, False, "tn"), (False, True, "fp"), (True, False, "fn"), (True, True, "tp")
        ]
    ])))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def classification_report(
    df: DataFrame, label: str = "is_fraud", prediction: str = "is_ml_anomaly"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def scores(hit: Column, wrongly_in: Column, missed: Column) -> Column:
        precision = _ratio(hit, hit + wrongly_in)
        recall = _ratio(hit, hit + missed)
        return F.struct(
            precision.alias("precision"),
            recall.alias("recall"),
            _f1(precision, recall).alias("f1_score"),
            (hit + missed).alias("support"),
        )

    both = _cells(df, label, prediction).select(
        scores(tn, fn, fp).alias("neg"),
        scores(tp, fp, fn).alias("pos"),
        (tn + tp).alias("right"),
        (tn + fp + fn + tp).alias("total"),
    )
    total, right = F.col("total"), F.col("right")

    def line(name: str, measure, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[measure(m).alias(m) for m in ("precision", "recall", "f1_score")],
            support.alias("support"),
        )

    def macro(m: str) -> Column:
        return (F.col(f"neg.{m}") + F.col(f"pos.{m}")) / 2

    def weighted(m: str) -> Column:
        return _ratio(
            F.col(f"neg.{m}") * F.col("neg.support") + F.col(f"pos.{m}") * F.col("pos.support"),
            total,
        )

    return both.select(F.inline(F.array(
        line("False", lambda m: F.col(f"neg.{m}"), F.col("neg.support")),
        line("True", lambda m: F.col(f"pos.{m}"), F.col("pos.support")),
        line("accuracy", lambda m: _ratio(right, total), total),
        line("macro avg", macro, total),
        line("weighted avg", weighted, total),
    )))


def binary_quality(
    df: DataFrame, label: str = "is_fraud", prediction: str = "is_ml_anomaly"
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, with the row count."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return _cells(df, label, prediction).select(
        _ratio(tn + tp, total).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1_score"),
        total.alias("n_samples"),
    )


def false_positive_by_segment(
    df: DataFrame, segment: str, label: str = "is_fraud", prediction: str = "is_flagged"
) -> DataFrame:
    """Share of unlabelled rows that are flagged, per segment."""
    negatives = F.count_if(~F.col(label))
    false_positives = F.count_if(~F.col(label) & F.col(prediction))
    return df.groupBy(segment).agg(
        false_positives.alias("false_positives"),
        negatives.alias("negatives"),
        _ratio(false_positives, negatives).alias("false_positive_rate"),
    )


def score_stats(
    df: DataFrame, score: str = "ml_anomaly_score", prediction: str = "is_ml_anomaly"
) -> DataFrame:
    """Mean, sample deviation and range of the scores, and the share of anomalies."""
    return df.agg(
        F.avg(score).alias("mean_score"),
        F.stddev_samp(score).alias("std_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.avg(F.col(prediction).cast("int")).alias("anomaly_rate"),
    )


# When a model is stale, when it is too weak, and the least training rows.
MAX_MODEL_AGE_HOURS = 24
MIN_ACCURACY = 0.85
MIN_TRAINING_ROWS = 1000


def retrain_decision(
    df: DataFrame,
    last_update: datetime,
    as_of: datetime,
    label: str = "is_fraud",
    prediction: str = "is_ml_anomaly",
) -> DataFrame:
    """One row: retrain when the model is stale, too weak, and there is enough data."""
    age = (as_of - last_update).total_seconds() / 3600
    return binary_quality(df, label, prediction).select(
        F.lit(age).alias("age_hours"),
        "accuracy",
        "n_samples",
        (
            (F.lit(age) > MAX_MODEL_AGE_HOURS)
            & (F.col("accuracy") < MIN_ACCURACY)
            & (F.col("n_samples") >= MIN_TRAINING_ROWS)
        ).alias("should_retrain"),
    )
