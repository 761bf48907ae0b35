"""Forest, quantile, model life cycle."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywatch.operators import quantile
from tallywatch.operators.evaluation import (
    binary_quality,
    classification_report,
    confusion_matrix,
    retrain_decision,
    score_stats,
)
from tallywatch.operators.features import prepare_features, scale_features
from tallywatch.operators.forest import (
    Forest,
    average_path,
    draw_samples,
    grow_tree,
    max_depth,
    score_matrix,
    split_draws,
)
from tallywatch.operators.model import AnomalyModel
from tallywatch.operators.rules import apply_rules
from tallywatch.operators.skew import SkewPolicy
from tallywatch.plans.scoring import (
    hybrid_scoring,
    join_scores,
    train_model,
    with_enhanced_flag,
)
from tallywatch.plans.tables import transactions
from tallywatch.schema import FEATURES


@pytest.fixture(scope="module")
def rows(spark, data):
    return transactions(spark, data)


@pytest.fixture(scope="module")
def features(rows):
    return prepare_features(apply_rules(rows)).cache()


@pytest.fixture(scope="module")
def model(features):
    return AnomalyModel().train(features)


def walk(nodes, point):
    """Path length of one point by following one tree's node rows."""
    table = {n.node_id: n for n in nodes}
    node = table[0]
    while node.feature >= 0:
        node = table[node.left if point[node.feature] <= node.threshold else node.right]
    return node.depth + float(average_path(node.n_samples))


def test_average_path_values():
    assert float(average_path(1)) == 0.0
    assert float(average_path(2)) == 1.0
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-4)


def test_trees_are_bounded_and_partition_their_sample(model):
    nodes = model.forest.nodes
    assert nodes["tree_id"].nunique() == 100
    assert nodes["depth"].max() <= max_depth(256) == 8
    assert nodes.groupby("tree_id").size().max() <= 511
    leaves = nodes[nodes["feature"] < 0]
    assert set(leaves.groupby("tree_id")["n_samples"].sum()) == {256}


def test_scores_match_a_walk_through_the_nodes(model, features):
    points = np.array(
        [[float(r[c]) for c in FEATURES] for r in features.select(*FEATURES).limit(40).collect()]
    )
    trees = [list(g.itertuples(index=False)) for _, g in model.forest.nodes.groupby("tree_id")]
    expected = [
        -(2 ** (-np.mean([walk(t, p) for t in trees]) / float(average_path(256)))) for p in points
    ]
    assert model.forest.raw_score(points) == pytest.approx(expected)


def test_spark_scores_equal_the_matrix_scores(model, features):
    scored = model.score(features).limit(200).collect()
    points = np.round([[float(r[c]) for c in FEATURES] for r in scored], 6)
    direct = model.forest.raw_score(points) - model.forest.offset
    assert [r.ml_anomaly_score for r in scored] == pytest.approx(list(direct), abs=1e-12)
    assert all(r.is_ml_anomaly == bool(s < 0) for r, s in zip(scored, direct) if abs(s) > 1e-12)


def test_compiled_scores_equal_the_batches_to_the_last_bit(model, features):
    compiled = model.score(features, compiled=True, paths="path_sum")
    assert set(compiled.columns) == {
        *features.columns, "path_sum", "ml_anomaly_score", "is_ml_anomaly"}
    plan = compiled._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    columns = ["event_id", "path_sum", "ml_anomaly_score", "is_ml_anomaly"]
    both = model.score(features, paths="path_sum").select(columns)
    assert compiled.select(columns).exceptAll(both).count() == 0
    assert both.exceptAll(compiled.select(columns)).count() == 0


def test_compiled_scores_of_a_small_forest(spark):
    rows = spark.createDataFrame(
        [(i, float(i % 4), i % 2) for i in range(6)], "event_id long, a double, b int")
    small = AnomalyModel(features=["a", "b"], n_trees=3).train(rows)
    left = small.score(rows, compiled=True).orderBy("event_id").collect()
    assert left == small.score(rows).orderBy("event_id").collect()
    assert small.score(rows.limit(0), compiled=True).collect() == []


def test_training_share_of_anomalies_is_the_contamination(model, features):
    stats = score_stats(model.score(features)).first()
    assert stats.anomaly_rate == pytest.approx(0.1, abs=0.002)
    assert stats.min_score < 0 < stats.max_score


def test_planted_outlier_scores_below_the_median_row(model, features, spark):
    medians = features.agg(
        *[F.percentile_approx(F.col(c).cast("double"), 0.5).alias(c) for c in FEATURES]
    ).withColumn("event_id", F.lit(-1))
    strange = medians.withColumns({
        "event_id": F.lit(-2),
        "amount": F.lit(5e5),
        "distance_from_nairobi": F.lit(900.0),
        "amount_deviation": F.lit(80.0),
        "time_since_last_txn": F.lit(700.0),
    })
    scored = {
        r.event_id: r.ml_anomaly_score for r in model.score(medians.unionByName(strange)).collect()
    }
    assert scored[-2] < 0 < scored[-1]
    assert scored[-2] < scored[-1]


def test_fit_does_not_depend_on_partitioning(features, model):
    again = AnomalyModel().train(features.repartition(5))
    left = model.forest.nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
    right = again.forest.nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
    assert left.equals(right)
    assert again.forest.offset == pytest.approx(model.forest.offset)


@pytest.mark.parametrize("n_rows", [300, 900, 5_000, 200_000])
def test_one_sampling_scheme_at_every_size(spark, n_rows):
    """Trees draw independently: any two share about as many rows as chance gives them."""
    rows = spark.range(n_rows).toDF("event_id")
    sample = draw_samples(rows, n_rows, "event_id", 40, 64, 42)
    sizes = sample.groupBy("tree_id").count().collect()
    assert len(sizes) == 40 and {r["count"] for r in sizes} <= set(range(48, 65))
    by_tree = sample.groupBy("tree_id").agg(F.collect_set("event_id").alias("ids")).collect()
    sets = [set(r.ids) for r in by_tree]
    shared = [len(a & b) for i, a in enumerate(sets) for b in sets[:i]]
    expected = np.mean([len(s) for s in sets]) ** 2 / n_rows
    assert np.mean(shared) == pytest.approx(expected, rel=0.25, abs=0.15)


def test_constant_data_gives_single_leaf():
    nodes = grow_tree(np.ones((10, 3)), split_draws(1, 0), 4)
    assert nodes == [(0, -1, 0.0, -1, -1, 10, 0)]
    frame = pd.DataFrame(
        [(0, *nodes[0])],
        columns=["tree_id", "node_id", "feature", "threshold", "left", "right", "n_samples",
                 "depth"],
    )
    forest = Forest(frame, 10, ["a", "b", "c"])
    assert score_matrix(np.ones((2, 3)), forest.arrays(), 10) == pytest.approx([-0.5, -0.5])


def test_splits_put_every_row_on_one_side():
    """Also where the cut would round up to the largest value."""
    close = np.array([[1.0], [np.nextafter(1.0, 2.0)]] * 3)
    for seed in range(40):
        nodes = grow_tree(close, split_draws(seed, 0), 4)
        assert [n[1] for n in nodes].count(0) == 1 and sum(n[5] for n in nodes if n[1] < 0) == 6


def test_input_noise_does_not_move_a_row(model, features):
    noisy = features.withColumn("user_avg_amount", F.col("user_avg_amount") * (1 + 1e-15))
    left = model.score(features).select("event_id", "ml_anomaly_score")
    assert left.exceptAll(model.score(noisy).select("event_id", "ml_anomaly_score")).count() == 0


def test_model_round_trip(model, features, spark, tmp_path):
    model.path = str(tmp_path / "model")
    model.save(spark)
    other = AnomalyModel(model.path)
    assert other.load(spark)
    both = model.score(features).select("event_id", F.col("ml_anomaly_score").alias("a")).join(
        other.score(features).select("event_id", F.col("ml_anomaly_score").alias("b")), "event_id"
    )
    assert both.count() == features.count()
    assert both.filter("a <> b").count() == 0
    assert not AnomalyModel(str(tmp_path / "nothing")).load(spark)
    (tmp_path / "broken" / "nodes").mkdir(parents=True)
    (tmp_path / "broken" / "nodes" / "x.parquet").write_text("junk")
    assert not AnomalyModel(str(tmp_path / "broken")).load(spark)


def test_untrained_model_refuses(features):
    with pytest.raises(ValueError):
        AnomalyModel().score(features)


def test_missing_feature_columns_count_as_zero(model, features):
    partial = features.drop("is_weekend")
    zeroed = features.withColumn("is_weekend", F.lit(0))
    left = {r.event_id: r.ml_anomaly_score for r in model.score(partial).collect()}
    right = {r.event_id: r.ml_anomaly_score for r in model.score(zeroed).collect()}
    assert left == right


def test_explanations_carry_reasons_and_features(model, features):
    explained = model.explain(features)
    assert explained.count() == features.count()
    high = explained.filter(F.col("feature_values.amount") > 10000)
    assert high.filter(~F.array_contains("explanations", "High amount transaction")).count() == 0
    firsts = explained.join(features.filter("gap_seconds IS NULL").select("event_id"), "event_id")
    assert firsts.count() > 0
    assert firsts.filter(
        F.array_contains("explanations", "Rapid succession transactions")
    ).count() == 0


def test_importance_covers_every_feature_and_ignores_constants(model, features):
    constant = features.withColumn("is_weekend", F.lit(0))
    result = {r.feature: r.importance for r in model.importance(constant).collect()}
    assert set(result) == set(FEATURES)
    assert result["is_weekend"] == 0.0
    assert result["amount"] > 0
    assert list(result.values()) == sorted(result.values(), reverse=True)


def test_hybrid_scoring(rows, model, spark):
    scored = hybrid_scoring(rows, model)
    assert scored.count() == rows.count()
    wrong = (F.col("is_flagged") | F.col("is_ml_anomaly")) != F.col("is_enhanced_fraud")
    assert scored.filter(wrong).count() == 0
    only_rules = hybrid_scoring(rows, None)
    assert "ml_anomaly_score" not in only_rules.columns and "is_flagged" in only_rules.columns
    table = spark.createDataFrame(
        [(True, None), (False, None), (False, True)], "is_flagged boolean, is_ml_anomaly boolean"
    )
    assert [r.is_enhanced_fraud for r in with_enhanced_flag(table).collect()] == [True, None, True]


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(0, 10, 10**6)])
def test_score_join_on_a_timestamp_does_not_multiply_ties(spark, policy):
    day, other = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rules = spark.createDataFrame(
        [(i, day if i < 40 else other if i < 42 else None, False) for i in range(45)],
        "event_id long, transaction_timestamp timestamp_ntz, is_flagged boolean",
    )
    scores = rules.filter("event_id < 41 OR event_id = 44").select(
        "event_id",
        "transaction_timestamp",
        (F.col("event_id") / 100 - 0.2).alias("ml_anomaly_score"),
        (F.col("event_id") < 20).alias("is_ml_anomaly"),
    )
    joined = join_scores(rules, scores, on="transaction_timestamp", policy=policy)
    found = {r.event_id: (r.ml_anomaly_score, r.is_ml_anomaly) for r in joined.collect()}
    assert joined.count() == 45
    assert found[0] == found[39] == (-0.2, True)
    assert found[41] == (0.2, False) and found[44] == (None, None)
    by_row = {r.event_id: r.ml_anomaly_score for r in join_scores(rules, scores).collect()}
    assert by_row[1] == pytest.approx(-0.19) and by_row[43] is None and by_row[44] is not None


def test_train_model_evaluates_on_held_out_rows(rows):
    model, test = train_model(rows, AnomalyModel(n_trees=20))
    results = model.evaluate(test)
    assert set(results) == {"score_stats", "confusion_matrix", "classification_report"}
    matrix = results["confusion_matrix"].collect()
    assert len(matrix) == 4
    assert sum(r.row_count for r in matrix) == test.count() == 2029
    assert set(model.evaluate(test.drop("is_fraud"))) == {"score_stats"}


def test_quality_metrics_by_hand(spark):
    pairs = [(True, True)] * 3 + [(True, False)] + [(False, True)] * 2 + [(False, False)] * 4
    df = spark.createDataFrame(pairs, "is_fraud boolean, is_ml_anomaly boolean")
    cells = {(r.actual, r.predicted): r.row_count for r in confusion_matrix(df).collect()}
    assert cells == {
        (False, False): 4, (False, True): 2, (True, False): 1, (True, True): 3
    }
    row = binary_quality(df).first()
    assert (row.accuracy, row.precision, row.recall) == pytest.approx((0.7, 0.6, 0.75))
    report = {r["class"]: r for r in classification_report(df).collect()}
    assert report["True"].support == 4 and report["weighted avg"].support == 10
    empty = classification_report(df.limit(0)).collect()
    assert {r.precision for r in empty} == {0.0}
    decide = retrain_decision(df, datetime(2024, 1, 1), datetime(2024, 1, 3)).first()
    assert decide.age_hours == 48.0 and not decide.should_retrain


def test_scaling_gives_unit_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = scale_features(df, ["a", "b"]).collect()
    assert [r.b for r in rows] == [0.0, 0.0, 0.0]
    assert np.std([r.a for r in rows]) == pytest.approx(1.0)


@pytest.mark.parametrize("shape", ["uniform", "ties", "heavy", "two", "sorted_ties"])
@pytest.mark.parametrize("q", [0.0, 0.1, 0.1234567, 0.5, 0.999, 1.0])
def test_exact_quantile(spark, monkeypatch, shape, q):
    monkeypatch.setattr(quantile, "SMALL_COLUMN", 50)
    monkeypatch.setattr(quantile, "ACCURACY", 200)
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.uniform(-1, 1, 5000),
        "ties": rng.integers(0, 7, 5000).astype(float),
        "heavy": np.exp(rng.normal(0, 40, 5000)),
        "two": np.repeat([1.0, 2.0], [500, 4500]),
        "sorted_ties": np.concatenate([np.full(1700, 3.0), rng.uniform(2.9, 3.1, 3300)]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").cache()
    assert quantile.exact_quantile(df, "x", q) == pytest.approx(
        float(np.quantile(values, q)), rel=1e-12
    )
    df.unpersist()


@pytest.mark.parametrize("n, step", [(44, 1), (1000, 29)])
def test_every_rank_is_a_real_value(spark, n, step):
    """Wide gaps, so that a value beside the right one shows."""
    values = np.sort(np.exp(np.random.default_rng(n).normal(0, 30, n)))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").cache()
    for small in (10**6, 20):
        for rank in range(0, n, step):
            if small == 20 and rank % 3:
                continue
            assert quantile._value_at(df, n, rank, small) == values[rank]
    df.unpersist()


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.77, 1.0])
def test_quantile_from_merged_sketches(spark, q):
    rng = np.random.default_rng(8)
    values = np.concatenate([np.exp(rng.normal(0, 9, 4000)), np.full(1500, 2.5)])
    df = spark.createDataFrame(
        [(i % 7, float(v)) for i, v in enumerate(values)] + [(3, None), (9, None)],
        "day int, x double").cache()
    bracket = quantile.bracket_from(quantile.column_sketches(df, "x", "day"), q)
    assert bracket[0] == len(values) and bracket[1] <= np.quantile(values, q) <= bracket[2]
    expected = pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    assert quantile.exact_quantile(df, "x", q, small=40, bracket=bracket) == expected
    # a bracket that misses the rank costs time, not the result
    for low, high in ((-5.0, -4.0), (1e300, 1e301), (2.5, 2.5)):
        wrong = (len(values), low, high)
        assert quantile.exact_quantile(df, "x", q, small=40, bracket=wrong) == expected
    df.unpersist()


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(1, None)], "day int, x double")
    assert quantile.bracket_from(quantile.column_sketches(empty, "x", "day"), 0.5) is None


def test_quantile_of_nothing(spark):
    assert quantile.exact_quantile(spark.createDataFrame([], "x double"), "x", 0.1) is None
