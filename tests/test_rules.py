"""Golden values of the rules, the calendar and the parser."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallywatch.functions import clock
from tallywatch.functions.geo import distance_km, masked_location
from tallywatch.functions.rules import newer_than, reasons
from tallywatch.operators.metrics import frequent_users, hourly_metrics
from tallywatch.operators.quality import quality_report, split_quarantine
from tallywatch.operators.rules import apply_rules, search
from tallywatch.schema import CORRUPT
from tallywatch.sources.files import (
    read_jsonl,
    read_jsonl_with_quarantine,
    read_lookup_table,
    records_to_table,
)
from tallywatch.sources.parse import flatten_location, parse_records, with_event_time

CENTER = (-1.286389, 36.817223)

# Sample transactions (user, amount, time, latitude, longitude).
SAMPLE = [
    ("user_1", 15000.0, "2026-01-15T09:30:15.123456", *CENTER),
    ("user_2", 500.5, "2026-01-15T09:31:22.234567", -1.292064, 36.821945),
    ("user_1", 12500.0, "2026-01-15T09:32:18.345678", *CENTER),
    ("user_1", 18000.0, "2026-01-15T09:33:45.456789", *CENTER),
    ("user_1", 22000.0, "2026-01-15T09:34:52.567890", *CENTER),
    ("user_1", 16000.0, "2026-01-15T09:35:30.678901", *CENTER),
    ("user_3", 750.25, "2026-01-15T09:36:12.789012", -1.301838, 36.807492),
    ("user_4", 3200.75, "2026-01-15T09:37:28.890123", -0.023559, 37.906193),
    ("user_5", 890.0, "2026-01-15T09:38:45.901234", -1.292064, 36.821945),
    ("user_2", 450.8, "2026-01-15T09:39:33.012345", -1.301838, 36.807492),
]


@pytest.fixture(scope="module")
def sample(spark):
    records = [
        {"user_id": u, "amount": a, "timestamp": t, "location": {"lat": la, "long": lo},
         "type": "transfer"}
        for u, a, t, la, lo in SAMPLE
    ]
    return flatten_location(with_event_time(records_to_table(spark, records)))


def test_sample_flags_and_hourly_totals(sample):
    ruled = apply_rules(sample)
    rows = ruled.collect()
    assert [r.is_high_amount for r in rows] == [
        True, False, True, True, True, True, False, False, False, False
    ]
    assert [i for i, r in enumerate(rows, 1) if r.is_location_outlier] == [8]
    (hour,) = hourly_metrics(ruled).collect()
    assert (hour.hour, hour.total_transactions, hour.flagged_count) == (9, 10, 6)
    assert hour.total_volume == pytest.approx(89292.30)
    assert hour.avg_amount == pytest.approx(8929.23)
    assert (hour.max_amount, hour.min_amount) == (22000.0, 450.8)
    assert frequent_users(sample).count() == 0


@pytest.mark.parametrize("lat, long, km", [
    (*CENTER, 0.0),
    (-1.286, 36.817, 0.0499),
    (-4.0435, 39.6682, 440.7386),
    (-2.0, 38.0, 153.5551),
    (-3.0, 38.0, 231.4715),
    (-0.023559, 37.906193, 185.4121),
    (-1.292064, 36.821945, 0.8208),
    (-1.301838, 36.807492, 2.0301),
    (-1.186389, 36.917223, 15.7235),
    (None, 36.8, 0.0),
    (-1.2, None, 0.0),
])
def test_distance(spark, lat, long, km):
    df = spark.createDataFrame([(lat, long)], "lat double, long double")
    assert df.select(distance_km(F.col("lat"), F.col("long"))).first()[0] == pytest.approx(
        km, abs=1e-4
    )


@pytest.mark.parametrize("amount, lat, long, high, far", [
    (5000.0, -1.286, 36.817, False, False),
    (15000.0, -1.286, 36.817, True, False),
    (1000.0, -3.0, 38.0, False, True),
    (800.0, -1.286, 36.817, False, False),
    (20000.0, -4.0435, 39.6682, True, True),
    (10000.0, -1.286, 36.817, False, False),
    (10000.01, -1.286, 36.817, True, False),
    (None, None, None, False, False),
])
def test_rule_boundaries(spark, amount, lat, long, high, far):
    df = spark.createDataFrame(
        [(amount, lat, long)], "amount double, latitude double, longitude double"
    )
    row = apply_rules(df).first()
    assert (row.is_high_amount, row.is_location_outlier, row.is_flagged) == (
        high, far, high or far
    )


def test_rules_stay_in_the_jvm(sample):
    plan = apply_rules(sample)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


@pytest.mark.parametrize("text, weekend, business, month_end, multiplier", [
    ("2024-01-15 10:00:00", 0, 1, 0, 1.5),
    ("2024-01-15 20:00:00", 0, 0, 0, 1.2),
    ("2024-01-15 03:00:00", 0, 0, 0, 0.3),
    ("2024-01-25 10:00:00", 0, 1, 1, 1.5),
    ("2024-01-30 10:00:00", 0, 1, 1, 3.375),
    ("2024-01-31 03:00:00", 0, 0, 1, 0.75),
    ("2024-01-13 07:59:59", 1, 0, 0, 0.3),
    ("2024-01-14 08:00:00", 1, 1, 0, 1.5),
    ("2024-01-24 18:59:59", 0, 1, 0, 1.5),
    ("2024-01-24 19:00:00", 0, 0, 0, 1.2),
])
def test_calendar(spark, text, weekend, business, month_end, multiplier):
    ts = F.lit(text).cast("timestamp_ntz")
    row = spark.range(1).select(
        clock.is_weekend(ts), clock.is_business_hours(ts), clock.is_end_of_month(ts),
        clock.volume_multiplier(ts),
    ).first()
    assert tuple(row)[:3] == (weekend, business, month_end)
    assert row[3] == pytest.approx(multiplier)


@pytest.mark.parametrize("hour, deviation, gap, previous, expected", [
    (5, 0.0, 1.0, True, ["Unusual time of day"]),
    (6, 2.0, 1.0, True, []),
    (22, 2.01, 2.0, True, ["Amount deviates from user's average"]),
    (23, 0.0, 0.0, True, ["Unusual time of day", "Rapid succession transactions"]),
    (12, 0.0, 0.0, False, []),
])
def test_reasons(spark, hour, deviation, gap, previous, expected):
    df = spark.createDataFrame(
        [(10.0, 1.0, hour, deviation, gap, previous)],
        "amount double, distance_from_nairobi double, hour_of_day int, "
        "amount_deviation double, time_since_last_txn double, previous boolean",
    )
    assert df.select(reasons(F.col("previous"))).first()[0] == expected


def test_recent_filter_is_strict(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 24),), (datetime(2024, 1, 24, 0, 0, 1),)], "ts timestamp_ntz"
    )
    assert df.filter(newer_than(F.col("ts"), datetime(2024, 1, 31))).count() == 1


def test_parse_keeps_bad_rows_as_nulls(spark):
    raw = [
        '{"user_id":"u1","amount":1.5,"timestamp":"2024-01-01T00:00:00.5",'
        '"location":{"lat":1.0,"long":2.0},"type":"transfer"}',
        "not json",
        '{"amount":"abc","user_id":"u2"}',
        '{"user_id":"u3","timestamp":"nope"}',
    ]
    records = spark.createDataFrame([(r.encode(),) for r in raw], "value binary").withColumn(
        "timestamp", F.current_timestamp()
    )
    rows = parse_records(records, keep_corrupt=True).collect()
    assert [r.user_id for r in rows] == ["u1", None, "u2", "u3"]
    assert [r.amount for r in rows] == [1.5, None, None, None]
    assert rows[0].transaction_timestamp == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert rows[3].transaction_timestamp is None
    assert (rows[0].latitude, rows[0].longitude) == (1.0, 2.0)
    assert [r[CORRUPT] for r in rows] == [None, raw[1], raw[2], None]


def test_jsonl_source(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text(
        '{"user_id":"a","amount":1.0}\nnot json\n\n{"user_id":"b","amount":"x"}\n{"user_id":\n'
    )
    rows = read_jsonl(spark, str(path))
    assert sorted((r.user_id, r.amount) for r in rows.collect()) == [("a", 1.0), ("b", None)]
    assert rows.count() == 2
    good, bad = read_jsonl_with_quarantine(spark, str(path))
    assert [r.user_id for r in good.collect()] == ["a"]
    assert sorted(r.raw_record for r in bad.collect()) == sorted(
        ["", "not json", '{"user_id":"b","amount":"x"}', '{"user_id":']
    )
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_jsonl(spark, str(tmp_path / "missing.jsonl")).count()


def test_lookup_table_and_search(spark, tmp_path):
    path = str(tmp_path / "profiles")
    spark.createDataFrame([("u1", 1), ("u2", 2)], "user_id string, tier int").write.parquet(path)
    table = read_lookup_table(spark, path)
    assert table.is_cached
    assert search(table, user_id="u2").first().tier == 2
    assert search(table, user_id="u2", tier=1).count() == 0
    table.unpersist()


def test_masked_locations_are_bounded_and_stable(spark):
    ids = spark.range(5000)
    points = ids.select("id", masked_location(F.col("id")).alias("p")).select("id", "p.*")
    low_lat, high_lat, low_long, high_long = points.agg(
        F.min("lat"), F.max("lat"), F.min("long"), F.max("long")
    ).first()
    assert CENTER[0] - 0.1 <= low_lat < CENTER[0] - 0.09
    assert CENTER[0] + 0.09 < high_lat <= CENTER[0] + 0.1
    assert CENTER[1] - 0.1 <= low_long < CENTER[1] - 0.09
    assert CENTER[1] + 0.09 < high_long <= CENTER[1] + 0.1
    again = ids.repartition(13).select("id", masked_location(F.col("id")).alias("p"))
    assert again.select("id", "p.*").exceptAll(points).count() == 0
    other = ids.select("id", masked_location(F.col("id"), seed=7).alias("p")).select("id", "p.*")
    assert other.join(points, ["id", "lat"]).count() == 0


def test_quality_rules_and_quarantine(spark):
    df = spark.createDataFrame(
        [
            ("u", 100.0, "2024-01-01T00:00:00", 1.0, 2.0, "transfer"),
            (None, 99.99, "nope", 91.0, -181.0, "other"),
            ("u", None, None, None, None, None),
        ],
        "user_id string, amount double, timestamp string, latitude double, longitude double, "
        "type string",
    )
    report = {r.rule: r.violations for r in quality_report(df).collect()}
    assert report == {
        "has_user_id": 1, "has_amount": 1, "has_timestamp": 1, "has_location": 1, "has_type": 1,
        "amount_in_range": 1, "known_type": 1, "latitude_in_range": 1, "longitude_in_range": 1,
        "timestamp_parses": 1,
    }
    good, bad = split_quarantine(df)
    assert good.count() == 1
    assert sorted(len(r.broken_rules) for r in bad.collect()) == [4, 6]
