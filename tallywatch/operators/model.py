"""Anomaly model: train, save, load, score, explain, evaluate, importance."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.hashing import hash52, hash_text
from tallywatch.functions.rules import reasons
from tallywatch.operators import forest as iforest
from tallywatch.operators.evaluation import (
    classification_report,
    confusion_matrix,
    score_stats,
)
from tallywatch.operators.features import add_missing_features, fill_features
from tallywatch.operators.forest import Forest, fit_nodes, score_matrix
from tallywatch.operators.history import ROW_ID
from tallywatch.operators.quantile import exact_quantile
from tallywatch.operators.versions import (
    current_version,
    new_version,
    publish,
    version_path,
)
from tallywatch.schema import DEFAULT_CONFIG, FEATURES, RiskConfig
from tallywatch.session import materialize, spread

logger = logging.getLogger(__name__)

# Rows per hash bucket when columns are shuffled for the importance measure.
SHUFFLE_BUCKET_ROWS = 250


class AnomalyModel:
    """Isolation Forest over feature tables (see ``prepare_features``)."""

    def __init__(
        self,
        path: str | None = None,
        contamination: float = 0.1,
        seed: int = 42,
        n_trees: int = iforest.N_TREES,
        sample_size: int = iforest.SAMPLE_SIZE,
        features: list[str] = FEATURES,
        row_id: str = ROW_ID,
    ):
        self.path = path
        self.contamination = contamination
        self.seed = seed
        self.n_trees = n_trees
        self.sample_size = sample_size
        self.features = list(features)
        self.row_id = row_id
        self.forest: Forest | None = None
        self.version: str | None = None

    # -- training -------------------------------------------------------------------

    def train(self, feature_table: DataFrame) -> AnomalyModel:
        """Fit on ``feature_table`` and set the cut at its ``contamination`` quantile.

        Its model columns are stored first, because samples and scores both read them, and
        so are the scores, which the quantile reads several times.
        """
        inputs = self._inputs(feature_table)
        rows = materialize(inputs.select(
            self.row_id, *iforest.model_inputs(inputs, self.features)))
        n_rows = rows.count()
        if n_rows == 0:
            raise ValueError("no training rows")
        nodes = fit_nodes(
            rows, n_rows, self.row_id, self.features,
            self.n_trees, self.sample_size, self.seed,
        ).toPandas()  # at most n_trees * 2 * sample_size rows
        self.forest = Forest(nodes, min(self.sample_size, n_rows), self.features)
        scores = materialize(rows.select(self.forest.raw_score_column(rows).alias("score")))
        self.forest.offset = exact_quantile(scores, "score", self.contamination)
        if self.path:
            self.save(feature_table.sparkSession)
        return self

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self._fitted().nodes, iforest.NODE_SCHEMA)

    # -- persistence ----------------------------------------------------------------

    def save(self, spark: SparkSession) -> None:
        """Node table and settings as a new version below ``path``, which readers see at once
        and whole."""
        fitted = self._fitted()
        version = new_version()
        root = version_path(self.path, version)
        self.nodes(spark).coalesce(1).write.parquet(f"{root}/nodes")
        spark.createDataFrame(
            [(fitted.sample_size, fitted.offset, fitted.columns, self.contamination, self.seed)],
            "sample_size int, offset double, columns array<string>, "
            "contamination double, seed long",
        ).coalesce(1).write.parquet(f"{root}/settings")
        publish(spark, self.path, version)
        self.version = version

    def load(self, spark: SparkSession) -> bool:
        """Read the current version from ``path``; False if there is none or it is unreadable."""
        try:
            version = current_version(spark, self.path)
            root = version_path(self.path, version) if version else self.path
            nodes = spark.read.schema(iforest.NODE_SCHEMA).parquet(f"{root}/nodes")
            settings = spark.read.parquet(f"{root}/settings").first()
            self.forest = Forest(
                nodes.orderBy("tree_id", "node_id").toPandas(),
                settings["sample_size"],
                list(settings["columns"]),
                settings["offset"],
            )
        except (PySparkException, KeyError, TypeError, ValueError) as problem:
            logger.warning("no usable model at %s: %s", self.path, problem)
            return False
        self.version = version
        self.features = self.forest.columns
        self.contamination = settings["contamination"]
        self.seed = settings["seed"]
        return True

    def refresh(self, spark: SparkSession) -> bool:
        """Load the current version if it is not the one in use; whether it was loaded. An
        unreadable one leaves the model as it is."""
        version = current_version(spark, self.path)
        return version is not None and version != self.version and self.load(spark)

    # -- use ------------------------------------------------------------------------

    def score(
        self, feature_table: DataFrame, compiled: bool = False, paths: str | None = None
    ) -> DataFrame:
        """Adds score and anomaly flag in place; no join, one row out per row in. ``compiled``
        scores without Python workers, with the same result to the last bit; ``paths`` names a
        column for the sum of path lengths."""
        return self._fitted().score(self._inputs(feature_table), compiled, paths)

    def explain(self, feature_table: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
        """Flag, score, reasons and feature values for every row.

        The features must come from the user's full history. Where ``gap_seconds`` is
        present, a first transaction is not called rapid.
        """
        has_previous = (
            F.col("gap_seconds").isNotNull() if "gap_seconds" in feature_table.columns else None
        )
        return self.score(feature_table).select(
            self.row_id,
            F.col("is_ml_anomaly").alias("is_anomaly"),
            F.col("ml_anomaly_score").alias("anomaly_score"),
            reasons(has_previous, config).alias("explanations"),
            F.struct(
                *[F.col(c).cast("double").alias(c) for c in self.features]
            ).alias("feature_values"),
        )

    def evaluate(self, feature_table: DataFrame, label: str = "is_fraud") -> dict[str, DataFrame]:
        """Score statistics, and with a label column also matrix and report."""
        scored = self.score(feature_table)
        results = {"score_stats": score_stats(scored)}
        if label in scored.columns:
            results["confusion_matrix"] = confusion_matrix(scored, label)
            results["classification_report"] = classification_report(scored, label)
        return results

    def importance(self, feature_table: DataFrame) -> DataFrame:
        """Permutation importance: mean absolute score change per shuffled column.

        Rows are put into hash buckets of about 250 rows; inside a bucket every row takes
        the column of the next row in a second hash order, the last row that of the first.
        One shuffle serves all columns.
        """
        fitted = self._fitted()
        inputs = self._inputs(feature_table)
        rows = materialize(inputs.select(
            self.row_id, F.array(*iforest.model_inputs(inputs, self.features)).alias("own"),
        ))
        n_buckets = rows.count() // SHUFFLE_BUCKET_ROWS + 1
        bucket = hash52(self.seed, F.col(self.row_id)) % F.lit(n_buckets)
        order = Window.partitionBy("bucket").orderBy(
            hash_text(self.seed + 1, F.col(self.row_id)), self.row_id
        )
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # Few bytes but much arithmetic per row, so AQE must not merge the tasks.
        paired = spread(rows.withColumn("bucket", bucket), "bucket").select(
            "own",
            F.coalesce(F.lead("own", 1).over(order), F.first("own").over(whole)).alias("other"),
        )
        shared = feature_table.sparkSession.sparkContext.broadcast(
            (fitted.arrays(), fitted.sample_size)
        )

        @F.pandas_udf("array<double>")
        def score_changes(own: pd.Series, other: pd.Series) -> pd.Series:
            arrays, size = shared.value
            base = np.stack(own.to_numpy())
            swapped = np.stack(other.to_numpy())
            unchanged = score_matrix(base, arrays, size)
            changes = np.empty_like(base)
            for i in range(base.shape[1]):
                trial = base.copy()
                trial[:, i] = swapped[:, i]
                changes[:, i] = np.abs(score_matrix(trial, arrays, size) - unchanged)
            return pd.Series(list(changes))

        changes = paired.select(score_changes.asNondeterministic()("own", "other").alias("c"))
        means = changes.agg(
            *[F.avg(F.col("c")[i]).alias(name) for i, name in enumerate(self.features)]
        )
        return means.unpivot([], self.features, "feature", "importance").orderBy(
            F.desc("importance"), "feature"
        )

    def _inputs(self, df: DataFrame) -> DataFrame:
        return fill_features(add_missing_features(df, self.features), self.features)

    def _fitted(self) -> Forest:
        if self.forest is None:
            raise ValueError("no trained model available")
        return self.forest
