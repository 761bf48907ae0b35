"""Rules and model together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.hashing import in_training_split
from tallywatch.functions.rules import either
from tallywatch.operators.features import prepare_features
from tallywatch.operators.history import ROW_ID
from tallywatch.operators.model import AnomalyModel
from tallywatch.operators.rules import apply_rules
from tallywatch.operators.skew import (
    DEFAULT_POLICY,
    KEY_ROWS,
    KeyTable,
    SkewPolicy,
    attach,
    join_on,
)
from tallywatch.schema import DEFAULT_CONFIG, RiskConfig


def join_scores(
    scored_by_rules: DataFrame,
    scores: DataFrame,
    on: str = ROW_ID,
    row_id: str = ROW_ID,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Left join of separately computed scores, by default on the row id.

    ``on`` may be another column, such as the timestamp. Scores that share its value are
    reduced to the lowest one, so ties never multiply rows.
    """
    if on == row_id:
        columns = [row_id, "ml_anomaly_score", "is_ml_anomaly"]
        return join_on(scored_by_rules, scores.select(*columns), [row_id])
    lowest = KeyTable(
        scores.filter(F.col(on).isNotNull()),
        [on],
        {
            "ml_anomaly_score": F.min("ml_anomaly_score"),
            "is_ml_anomaly": F.min_by("is_ml_anomaly", "ml_anomaly_score"),
        },
        policy,
    )
    sizes = KeyTable(scored_by_rules, [on], policy=policy)
    return attach(
        scored_by_rules, lowest.table.drop(KEY_ROWS), lowest.n_keys, sizes, row_id
    )


def with_enhanced_flag(df: DataFrame) -> DataFrame:
    """Rule flag or model flag; null when the rules are silent and there is no score."""
    return df.withColumn("is_enhanced_fraud", either(F.col("is_flagged"), F.col("is_ml_anomaly")))


def hybrid_scoring(
    transactions: DataFrame,
    model: AnomalyModel | None = None,
    config: RiskConfig = DEFAULT_CONFIG,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rules, features and model score in one pass over the rows; rules only without a model."""
    ruled = apply_rules(transactions, config)
    if model is None or model.forest is None:
        return ruled
    return with_enhanced_flag(model.score(prepare_features(ruled, model.row_id, policy)))


def train_test_split(
    df: DataFrame, row_id: str = ROW_ID, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Split by row-id hash, the same on every run and partitioning."""
    inside = in_training_split(F.col(row_id), percent)
    return df.filter(inside), df.filter(~inside)


def train_model(
    transactions: DataFrame,
    model: AnomalyModel,
    config: RiskConfig = DEFAULT_CONFIG,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> tuple[AnomalyModel, DataFrame]:
    """Fit on the training split; returns the model and the features of the test split.

    Features come from the whole history before the split, so both sides and later scoring
    see the same distributions.
    """
    features = prepare_features(apply_rules(transactions, config), model.row_id, policy)
    training, test = train_test_split(features, model.row_id)
    return model.train(training), test
