"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the
timed runs per query (median counts; one untimed run comes first).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from tallywatch.operators.features import prepare_features  # noqa: E402
from tallywatch.operators.model import AnomalyModel  # noqa: E402
from tallywatch.operators.rules import apply_rules  # noqa: E402
from tallywatch.plans import catalog  # noqa: E402
from tallywatch.plans.tables import transactions  # noqa: E402
from tallywatch.session import build_session, materialize, remove_tables  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "hourly_metrics", "user_frequency", "date_histogram", "top_fraud_users", "rule_flags",
    "json_parse", "user_stats", "recipient_features", "feature_table", "scaled_features",
    "alert_reasons", "profile_lookup", "classification_report", "data_quality",
    "contamination_cut", "alert_stream", "hourly_stream", "frequency_stream",
    "causal_user_features", "hybrid_scoring",
]
# Queries that read another table than the events.
SOURCES = {"profile_lookup": "orders"}


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        begin = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in HEADLINE:
        query = catalog.QUERIES[name]
        results[name] = timed(lambda: drain(query(spark, FOLDER)))

    features = materialize(prepare_features(apply_rules(transactions(spark, FOLDER))))
    model = AnomalyModel()
    results["forest_fit"] = timed(lambda: model.train(features))
    results["forest_score"] = timed(lambda: drain(model.score(features)))
    results["feature_importance"] = timed(lambda: drain(model.importance(features)))
    n_rows = {"events": features.count()}
    for table in set(SOURCES.values()):
        n_rows[table] = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    remove_tables(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": Path(FOLDER).name.removeprefix("sf"),
        "transactions": n_rows["events"],
        "transactions_per_sec": {
            name: round(n_rows[SOURCES.get(name, "events")] / s) for name, s in results.items()
        },
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
