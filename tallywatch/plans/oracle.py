"""The catalog's queries in SQL, for an engine that shares no code with this package."""

from __future__ import annotations

TX = """
tx AS (
  SELECT event_id,
         concat('user_', CAST(user_id AS varchar)) AS user_id,
         value * 100.0::double AS amount,
         ts AS transaction_timestamp,
         CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE -1.286389::double + ((event_id * 37) % 201 - 100) / 1000.0::double
                   + CASE WHEN event_id % 25 = 0 THEN 1.0::double ELSE 0.0::double END
         END AS latitude,
         CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE 36.817223::double + ((event_id * 53) % 201 - 100) / 1000.0::double
         END AS longitude,
         event_type AS type,
         json_extract_string(props, '$.k') AS recipient_id,
         event_id % 25 = 0 AS is_fraud
  FROM events)"""

RULED = TX + """,
dist AS (
  SELECT *, coalesce(2 * asin(sqrt(
           pow(sin((radians(latitude) - radians(-1.286389::double)) / 2), 2)
           + cos(radians(-1.286389::double)) * cos(radians(latitude))
             * pow(sin((radians(longitude) - radians(36.817223::double)) / 2), 2)
         )) * 6371.0::double, 0.0) AS distance_from_nairobi
  FROM tx),
flags AS (
  SELECT *, coalesce(amount > 10000, false) AS is_high_amount,
         coalesce(distance_from_nairobi > 50, false) AS is_location_outlier
  FROM dist),
ruled AS (SELECT *, is_high_amount OR is_location_outlier AS is_flagged FROM flags)"""

SCORES = RULED + """,
scores AS (
  SELECT event_id, round(0.1 - (event_id % 20) / 100.0::double, 4) AS ml_anomaly_score,
         round(0.1 - (event_id % 20) / 100.0::double, 4) < 0 AS is_ml_anomaly
  FROM tx),
joined AS (
  SELECT ruled.*, ml_anomaly_score, is_ml_anomaly
  FROM ruled LEFT JOIN (SELECT * FROM scores WHERE event_id % 3 <> 0) USING (event_id))"""

CALENDAR = """
         CAST(hour(transaction_timestamp) AS integer) AS hour_of_day,
         CAST(dayofweek(transaction_timestamp) + 1 AS integer) AS day_of_week,
         CAST(day(transaction_timestamp) AS integer) AS day_of_month,
         CASE WHEN dayofweek(transaction_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour(transaction_timestamp) BETWEEN 8 AND 18 THEN 1 ELSE 0 END
           AS is_business_hours,
         CASE WHEN day(transaction_timestamp) >= 25 THEN 1 ELSE 0 END AS is_end_of_month"""

SECONDS = "CAST(floor(epoch(transaction_timestamp)) AS bigint)"

HISTORY = RULED + f""",
past AS (
  SELECT *, {CALENDAR},
         {SECONDS} - lag({SECONDS}) OVER (
           PARTITION BY user_id ORDER BY transaction_timestamp, event_id) AS gap_seconds,
         count(*) OVER (PARTITION BY user_id) AS user_transaction_count,
         avg(amount) OVER (PARTITION BY user_id) AS user_avg_amount
  FROM ruled),
features AS (
  SELECT *, coalesce(gap_seconds / 3600.0::double, 0) AS time_since_last_txn,
         CASE WHEN user_avg_amount > 0 THEN (amount - user_avg_amount) / user_avg_amount
              ELSE 0 END AS amount_deviation
  FROM past)"""

WINDOWS = TX + """,
hops AS (
  SELECT user_id,
         time_bucket(INTERVAL '12 hours', transaction_timestamp) - k * INTERVAL '12 hours'
           AS window_start
  FROM tx, range(0, 2) t(k)),
windows AS (
  SELECT window_start, window_start + INTERVAL '1 day' AS window_end, user_id,
         count(*) AS transaction_count
  FROM hops GROUP BY ALL)"""

HOURLY = RULED + """,
hourly AS (
  SELECT CAST(hour(transaction_timestamp) AS integer) AS hour,
         count(*) AS total_transactions, sum(amount) AS total_volume,
         count(*) FILTER (is_flagged) AS flagged_count, avg(amount) AS avg_amount,
         max(amount) AS max_amount, min(amount) AS min_amount
  FROM ruled GROUP BY 1)"""

HOURLY_ROWS = """
SELECT hour, total_transactions, round(total_volume, 2) AS total_volume, flagged_count,
       round(avg_amount, 2) AS avg_amount, max_amount, min_amount FROM hourly"""

HISTOGRAM = TX + """,
filled AS (
  SELECT date_trunc('hour', transaction_timestamp) AS hour_start, count(*) AS doc_count,
         sum(amount) AS total_volume
  FROM tx GROUP BY 1),
histogram AS (
  SELECT h.hour_start, coalesce(doc_count, 0) AS doc_count,
         coalesce(total_volume, 0) AS total_volume
  FROM (SELECT unnest(generate_series(min(hour_start), max(hour_start), INTERVAL 1 HOUR))
          AS hour_start FROM filled) h
  LEFT JOIN filled USING (hour_start))"""

MULTIPLIER = """
  (CASE WHEN day({ts}) >= 25 THEN 1 + 1.5::double * (day({ts}) - 25) / 6.0::double ELSE 1 END)
  * (CASE WHEN hour({ts}) BETWEEN 8 AND 18 THEN 1.5::double
          WHEN hour({ts}) BETWEEN 19 AND 22 THEN 1.2::double ELSE 0.3::double END)"""

QUALITY = """
cells AS (
  SELECT count(*) FILTER (NOT is_fraud AND NOT {guess}) AS tn,
         count(*) FILTER (NOT is_fraud AND {guess}) AS fp,
         count(*) FILTER (is_fraud AND NOT {guess}) AS fn,
         count(*) FILTER (is_fraud AND {guess}) AS tp
  FROM {rows}),
classes AS (
  SELECT 'False' AS class, tn AS hit, fn AS wrong, fp AS missed FROM cells
  UNION ALL SELECT 'True', tp, fp, fn FROM cells),
ratios AS (
  SELECT class, hit + missed AS support, hit,
         CASE WHEN hit + wrong > 0 THEN hit::double / (hit + wrong) ELSE 0 END AS precision,
         CASE WHEN hit + missed > 0 THEN hit::double / (hit + missed) ELSE 0 END AS recall
  FROM classes),
lines AS (
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score
  FROM ratios),
quality AS (
  SELECT (tn + tp)::double / (tn + fp + fn + tp) AS accuracy, l.precision, l.recall, l.f1_score,
         tn + fp + fn + tp AS n_samples
  FROM cells, lines l WHERE l.class = 'True')"""
CELLS = RULED + "," + QUALITY.format(guess="is_flagged", rows="ruled")

REPORT = """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, support FROM lines
UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6),
       n_samples FROM quality
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
       round(avg(f1_score), 6), CAST(sum(support) AS bigint) FROM lines
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6),
       round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS bigint)
FROM lines"""

CAUSAL = f"""
SELECT user_id, event_id, count(*) OVER so_far AS user_count_so_far,
       round(avg(amount) OVER so_far, 6) AS user_avg_so_far,
       {SECONDS} - lag({SECONDS}) OVER (
         PARTITION BY user_id ORDER BY transaction_timestamp, event_id) AS seconds_since_last
FROM tx
WINDOW so_far AS (PARTITION BY user_id ORDER BY transaction_timestamp, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

FEATURE_ROWS = """
SELECT event_id, amount, hour_of_day, day_of_week, day_of_month,
       round(distance_from_nairobi, 6) AS distance_from_nairobi, user_transaction_count,
       round(user_avg_amount, 6) AS user_avg_amount,
       round(amount_deviation, 6) AS amount_deviation,
       round(time_since_last_txn, 6) AS time_since_last_txn,
       is_weekend, is_business_hours, is_end_of_month FROM features"""

PROFILES = """
SELECT o_orderkey AS event_id, o_custkey AS user_id, CAST(o_totalprice AS double) AS amount,
       c_mktsegment, c_nationkey
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""

IN_WEEK = "transaction_timestamp > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAYS"
MONTH_END = "day(transaction_timestamp) >= 25"
RECENT = f"""
SELECT event_id, user_id, amount, transaction_timestamp FROM tx WHERE {IN_WEEK}"""

REASONS = """
  concat_ws(';',
    CASE WHEN amount > 10000 THEN 'High amount transaction' END,
    CASE WHEN distance_from_nairobi > 50 THEN 'Unusual location' END,
    CASE WHEN hour_of_day < 6 OR hour_of_day > 22 THEN 'Unusual time of day' END,
    CASE WHEN amount_deviation > 2.0 THEN 'Amount deviates from user''s average' END,
    CASE WHEN {rapid} THEN 'Rapid succession transactions' END)"""

FEATURE_NAMES = [
    "amount", "hour_of_day", "day_of_week", "day_of_month", "distance_from_nairobi",
    "user_transaction_count", "user_avg_amount", "amount_deviation", "time_since_last_txn",
    "is_weekend", "is_business_hours", "is_end_of_month",
]

HASH = "('0x' || substr(md5({text}), 1, 8))::bigint"
# The forest, grown and walked again from the hashes that decide its samples and splits.

PATH = """CASE WHEN {n} > 2 THEN
  round((2 * (ln({n} - 1) + 0.5772156649015329::double) - 2 * ({n} - 1)::double / {n})
        * 1073741824) / 1073741824 WHEN {n} = 2 THEN 1.0::double ELSE 0.0::double END"""
MD5 = "('0x' || substr(md5({text}), 1, {digits}))::bigint"

MODEL_ROWS = HISTORY + f""",
model AS (
  SELECT *, {HASH.format(text='CAST(event_id AS varchar)')} % 100 < 80 AS in_training,
         [{', '.join(f'round(coalesce({name}, 0)::double, 6)' for name in FEATURE_NAMES)}] AS x
  FROM features)"""


def _splits(rows: str) -> str:
    """CTEs that end with ``splits``: feature and cut of every (tree, node) of ``rows`` that can
    be split."""
    pick = MD5.format(text="concat('42:', tree, ':', node, ':feature')", digits=8)
    share = MD5.format(text="concat('42:', tree, ':', node, ':cut')", digits=8)
    return f"""
  spread AS (SELECT tree, node, unnest(range(0, len(x))) AS f, unnest(x) AS v FROM {rows}),
  ranges AS (SELECT tree, node, f, min(v) AS low, max(v) AS high, count(*) AS n FROM spread
             GROUP BY ALL),
  choices AS (SELECT tree, node, max(n) AS n, list(f ORDER BY f) FILTER (high > low) AS fs
              FROM ranges GROUP BY ALL),
  picked AS (SELECT tree, node, fs[{pick} % len(fs) + 1] AS f FROM choices
             WHERE n > 1 AND len(fs) > 0),
  cuts AS (SELECT tree, node, f, low, high,
                  low + (high - low) * ({share} / 4294967296.0::double) AS c
           FROM picked JOIN ranges USING (tree, node, f)),
  splits AS (SELECT tree, node, f, CASE WHEN c >= high THEN low ELSE c END AS cut FROM cuts)"""


FIRST_HASH = MD5.format(text="concat('42:', event_id)", digits=13)
TREE_HASH = MD5.format(text="concat('42:', tree, ':', event_id)", digits=13)
FOREST = MODEL_ROWS + f""",
sized AS (
  SELECT count(*) AS n, least(256, count(*)) AS size,
         CAST(trunc(4503599627370496.0::double
              * least(1.0::double, 1.5::double * least(256, count(*)) / count(*))) AS bigint)
           AS bound
  FROM model WHERE in_training),
first AS (
  SELECT event_id, x, bound, size,
         CASE WHEN bound = 4503599627370496 THEN 0.0
              ELSE floor(ln(({FIRST_HASH} + 1) / 4503599627370496.0::double)
                         / ln(1 - bound / 4503599627370496.0::double)) END AS tree_1
  FROM model, sized WHERE in_training),
drawn AS (
  SELECT tree, event_id, x, size FROM first, range(0, 100) t(tree)
  WHERE tree = tree_1 OR (tree > tree_1 AND {TREE_HASH} < bound)),
samples AS (
  SELECT tree, event_id, x FROM drawn
  QUALIFY row_number() OVER (
    PARTITION BY tree ORDER BY md5(concat('44:', tree, ':', event_id)), event_id) <= size),
deepest AS (
  SELECT greatest(1, ceil(log2(greatest(size, 2))))::integer AS levels FROM sized),
placed AS (
  SELECT tree, event_id, x, 0::bigint AS node, 0 AS depth FROM samples
  UNION ALL
  (WITH here AS MATERIALIZED (SELECT placed.* FROM placed, deepest WHERE depth < levels),
  {_splits('here')}
   SELECT here.tree, here.event_id, here.x,
          2 * here.node + 1 + (here.x[f + 1] > cut)::integer, here.depth + 1
   FROM here JOIN splits USING (tree, node))),
inner_rows AS (SELECT tree, node, x FROM placed, deepest WHERE depth < levels),
{_splits('inner_rows')},
nodes AS MATERIALIZED (
  SELECT tree, node, depth, count(*) AS n, coalesce(any_value(f), -1) AS f,
         coalesce(any_value(cut), 0.0::double) AS cut
  FROM placed LEFT JOIN splits USING (tree, node) GROUP BY tree, node, depth),
expected AS (SELECT {PATH.format(n='size')} AS length FROM sized)"""

WALK = """,
{name} AS (
  SELECT {key}, tree, 0::bigint AS node FROM {rows}, range(0, 100) t(tree)
  UNION ALL
  SELECT {key}, w.tree, 2 * w.node + 1 + (x[f + 1] > cut)::integer
  FROM {name} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND f >= 0
  JOIN {rows} USING ({key})),
{name}_paths AS (
  SELECT {key}, sum(depth + {path}) AS total
  FROM {name} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND f < 0 GROUP BY {key}),
{name}_raw AS (
  SELECT {key}, total, -pow(2.0::double, -(total / 100.0::double) / length) AS raw
  FROM {name}_paths, expected)"""

SCORED = FOREST + WALK.format(
    name="walk", key="event_id", rows="model", path=PATH.format(n="n")) + """,
cut_at AS (
  SELECT quantile_cont(raw, 0.1) AS cut_off FROM walk_raw JOIN model USING (event_id)
  WHERE in_training),
scored AS (
  SELECT model.*, total, raw - cut_off AS score, raw - cut_off < 0 AS is_ml_anomaly
  FROM model JOIN walk_raw USING (event_id), cut_at)"""

# Every test row as it is (trial 0), and with one feature of the next row of its bucket.
TRIALS = FOREST + f""",
test AS (SELECT event_id, x FROM model WHERE NOT in_training),
bucketed AS (
  SELECT *, {FIRST_HASH} % (SELECT count(*) // 250 + 1 FROM test) AS bucket FROM test),
paired AS (
  SELECT event_id, x, coalesce(lead(x) OVER w, first_value(x) OVER w) AS other FROM bucketed
  WINDOW w AS (PARTITION BY bucket ORDER BY md5(concat('43:', event_id)), event_id)),
trials AS (
  SELECT event_id * 16 + k AS trial,
         list_transform(range(1, len(x) + 1), lambda i: CASE WHEN i = k THEN other[i] ELSE x[i] END)
           AS x
  FROM paired, range(0, 13) t(k))""" + WALK.format(
    name="walk", key="trial", rows="trials", path=PATH.format(n="n"))


def _recursive(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{select.strip()}"


RULE_COLUMNS = "distance_from_nairobi, is_high_amount, is_location_outlier, is_flagged"
WIRE_TIME = "strftime(transaction_timestamp, '%Y-%m-%dT%H:%M:%S.%f')"
ISO_TIME = (
    "CASE WHEN strftime(transaction_timestamp, '%f') = '000000' "
    "THEN strftime(transaction_timestamp, '%Y-%m-%dT%H:%M:%S') "
    f"ELSE {WIRE_TIME} END"
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _masked(axis: str, center: str) -> str:
    text = f"concat('42:{axis}', CAST(event_id AS varchar))"
    u = HASH.format(text=text) + " / 4294967296.0::double"
    return f"{center}::double + (2 * ({u}) - 1) * 0.1::double"


def _scaled(name: str) -> str:
    return (
        f"round(({name} - avg({name}) OVER ()) / CASE WHEN stddev_pop({name}) OVER () = 0 "
        f"THEN 1 ELSE stddev_pop({name}) OVER () END, 5) AS {name}"
    )


def oracle_sql() -> dict[str, str]:
    wire_value = (
        "CAST(to_json({'user_id': user_id, 'amount': amount, 'timestamp': " + WIRE_TIME
        + ", 'location': {'lat': latitude, 'long': longitude}, 'type': type}) AS varchar)"
    )
    histogram_mean = "(avg(doc_count) OVER ())"
    expected = f"{histogram_mean} * " + MULTIPLIER.format(ts="hour_start")
    found = {
        "json_parse": _with(TX, f"""
SELECT user_id, amount, {WIRE_TIME} AS timestamp, type, latitude, longitude,
       transaction_timestamp FROM tx"""),
        "jsonl_scan": _with(TX, f"""
SELECT user_id, amount, {WIRE_TIME} AS timestamp, type, latitude, longitude
FROM tx WHERE event_id % 50 <> 0"""),
        "keyed_json_records": _with(TX, f"SELECT user_id AS key, {wire_value} AS value FROM tx"),
        "slim_projection": _with(TX, """
SELECT event_id, user_id, CAST(amount AS float) AS amount, transaction_timestamp, type
FROM tx"""),
        "geo_mask": f"""
SELECT event_id, {_masked('lat', '-1.286389')} AS latitude,
       {_masked('long', '36.817223')} AS longitude FROM events""",
        "feature_backfill": _with(RULED, f"""
SELECT event_id, amount, distance_from_nairobi, 0.0::double AS user_transaction_count,
       0.0::double AS user_avg_amount, 0.0::double AS amount_deviation,
       0.0::double AS time_since_last_txn, {CALENDAR} FROM ruled"""),
        "flagged_documents": _with(RULED, f"""
SELECT CAST(event_id AS varchar) AS doc_id, user_id, amount,
       {ISO_TIME} AS transaction_timestamp, latitude AS location_lat,
       longitude AS location_lon, latitude, longitude, type, {RULE_COLUMNS},
       'flagged_transaction' AS document_type
FROM ruled WHERE is_flagged"""),
        "hourly_documents": _with(HOURLY, """
SELECT 'hour-' || lpad(CAST(hour AS varchar), 2, '0') AS doc_id,
       lpad(CAST(hour AS varchar), 2, '0') AS hour, round(total_volume, 2) AS total_volume,
       flagged_count, total_transactions, round(avg_amount, 2) AS avg_amount, max_amount,
       min_amount, 'hourly_aggregate' AS document_type FROM hourly"""),
        "haversine_distance": _with(RULED, "SELECT event_id, distance_from_nairobi FROM ruled"),
        "rule_flags": _with(RULED, f"SELECT event_id, {RULE_COLUMNS} FROM ruled"),
        "flagged_transactions": _with(RULED, f"""
SELECT event_id, user_id, amount, transaction_timestamp, {RULE_COLUMNS}
FROM ruled WHERE is_flagged"""),
        "calendar_features": _with(TX, f"SELECT event_id, {CALENDAR} FROM tx"),
        "volume_multiplier": f"""
SELECT event_id, round({MULTIPLIER.format(ts='ts')}, 6) AS multiplier FROM events""",
        "alert_reasons": _with(HISTORY, f"""
SELECT event_id, {REASONS.format(rapid='time_since_last_txn < 1')} AS reasons,
       {REASONS.format(rapid='gap_seconds < 3600')} AS history_reasons FROM features"""),
        "recent_transactions": _with(TX, RECENT),
        "recent_transactions_daily": _with(TX, RECENT),
        "hourly_metrics_month_end": _with(
            HOURLY.replace("FROM ruled GROUP", f"FROM ruled WHERE {MONTH_END} GROUP"),
            HOURLY_ROWS),
        "date_histogram_daily": _with(
            HISTOGRAM.replace("FROM tx GROUP", f"FROM tx WHERE {IN_WEEK} GROUP"), """
SELECT hour_start, doc_count, round(total_volume, 2) AS total_volume FROM histogram"""),
        "document_search": _with(RULED, """
SELECT CAST(event_id AS varchar) AS doc_id, user_id, amount, is_high_amount,
       'flagged_transaction' AS document_type
FROM ruled WHERE is_flagged AND is_location_outlier"""),
        "score_threshold": _with(SCORES, """
SELECT event_id, ml_anomaly_score FROM scores WHERE ml_anomaly_score < -0.05"""),
        "rules_scores_left_join": _with(SCORES, """
SELECT event_id, is_flagged, ml_anomaly_score, is_ml_anomaly FROM joined"""),
        "enhanced_flag": _with(SCORES, """
SELECT event_id, is_flagged, is_ml_anomaly, is_flagged OR is_ml_anomaly AS is_enhanced_fraud
FROM joined"""),
        "user_count_join": _with(TX, """
SELECT event_id, user_id, user_transaction_count
FROM tx JOIN (SELECT user_id, count(*) AS user_transaction_count FROM tx GROUP BY 1)
USING (user_id)"""),
        "broadcast_rules": _with(RULED, """
SELECT event_id, 'high_amount' AS rule_id, amount > 10000 AS fired FROM ruled
UNION ALL SELECT event_id, 'very_high_amount', amount > 30000 FROM ruled
UNION ALL SELECT event_id, 'location_outlier', distance_from_nairobi > 50 FROM ruled"""),
        "profile_lookup": PROFILES,
        "profile_lookup_bucketed": PROFILES,
        "user_window_counts": _with(WINDOWS, "SELECT * FROM windows"),
        "user_frequency": _with(WINDOWS, """
SELECT *, true AS is_high_frequency FROM windows WHERE transaction_count > 5"""),
        "hourly_metrics": _with(HOURLY, HOURLY_ROWS + " ORDER BY hour"),
        "hourly_chart": _with(HOURLY, HOURLY_ROWS + " ORDER BY hour LIMIT 24"),
        "fraud_type_breakdown": _with(RULED, """
SELECT 'high_amount' AS bucket, count(*) AS doc_count FROM ruled WHERE is_flagged AND is_high_amount
UNION ALL SELECT 'location_outlier', count(*) FROM ruled WHERE is_flagged AND is_location_outlier
UNION ALL SELECT 'total_flagged', count(user_id) FROM ruled WHERE is_flagged"""),
        "fraud_rate": _with(RULED, """
SELECT count(*) FILTER (is_flagged) AS flagged, count(*) AS total,
       round(avg(is_flagged::int), 6) AS fraud_rate FROM ruled"""),
        "date_histogram": _with(HISTOGRAM, """
SELECT hour_start, doc_count, round(total_volume, 2) AS total_volume FROM histogram"""),
        "top_fraud_users": _with(RULED, """
SELECT user_id, count(*) AS doc_count, round(sum(amount), 2) AS total_amount
FROM ruled WHERE is_flagged GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
        "volume_vs_expected": _with(HISTOGRAM, f"""
SELECT hour_start, doc_count, round({expected}, 6) AS expected_count,
       round(doc_count / ({expected}), 6) AS volume_ratio FROM histogram"""),
        "dataset_stats": _with(TX, """
SELECT count(*) AS total_transactions, count(*) FILTER (amount > 10000) AS high_amount,
       round(count(*) FILTER (amount > 10000) / count(*)::double * 100, 6) AS high_amount_pct
FROM tx"""),
        "score_stats": _with(SCORES, """
SELECT round(avg(ml_anomaly_score), 6) AS mean_score,
       round(stddev_samp(ml_anomaly_score), 6) AS std_score,
       min(ml_anomaly_score) AS min_score, max(ml_anomaly_score) AS max_score,
       round(avg(is_ml_anomaly::int), 6) AS anomaly_rate FROM scores"""),
        "confusion_matrix": _with(CELLS, """
SELECT false AS actual, false AS predicted, tn AS row_count FROM cells
UNION ALL SELECT false, true, fp FROM cells
UNION ALL SELECT true, false, fn FROM cells
UNION ALL SELECT true, true, tp FROM cells"""),
        "classification_report": _with(CELLS, REPORT),
        "binary_quality": _with(CELLS, """
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, n_samples FROM quality"""),
        "repeat_users": _with(TX, """
SELECT user_id, count(*) AS transaction_count FROM tx GROUP BY 1 HAVING count(*) > 1"""),
        "data_quality": _with(TX + f""",
wire AS (SELECT *, {WIRE_TIME} AS timestamp FROM tx),
broken AS (
  SELECT unnest([
    {{'rule': 'has_user_id', 'bad': user_id IS NULL}},
    {{'rule': 'has_amount', 'bad': amount IS NULL}},
    {{'rule': 'has_timestamp', 'bad': timestamp IS NULL}},
    {{'rule': 'has_location', 'bad': latitude IS NULL OR longitude IS NULL}},
    {{'rule': 'has_type', 'bad': type IS NULL}},
    {{'rule': 'amount_in_range', 'bad': coalesce(amount < 100, false)}},
    {{'rule': 'known_type', 'bad': type NOT IN ('purchase', 'view', 'click', 'signup')}},
    {{'rule': 'latitude_in_range', 'bad': coalesce(abs(latitude) > 90, false)}},
    {{'rule': 'longitude_in_range', 'bad': coalesce(abs(longitude) > 180, false)}},
    {{'rule': 'timestamp_parses', 'bad': try_cast(timestamp AS timestamp) IS NULL}}
  ], recursive := true) FROM wire)""", """
SELECT rule, count(*) FILTER (bad) AS violations, count(*) AS checked FROM broken GROUP BY 1"""),
        "false_positive_by_segment": _with(RULED, """
SELECT type, count(*) FILTER (NOT is_fraud AND is_flagged) AS false_positives,
       count(*) FILTER (NOT is_fraud) AS negatives,
       round(count(*) FILTER (NOT is_fraud AND is_flagged)::double
             / count(*) FILTER (NOT is_fraud), 6) AS false_positive_rate
FROM ruled GROUP BY 1"""),
        "time_since_last": _with(HISTORY, """
SELECT event_id, round(time_since_last_txn, 6) AS time_since_last_txn FROM features"""),
        "gap_seconds": _with(HISTORY, "SELECT event_id, gap_seconds FROM features"),
        "user_stats": _with(HISTORY, """
SELECT event_id, user_id, user_transaction_count, round(user_avg_amount, 6) AS user_avg_amount
FROM features"""),
        "amount_deviation": _with(HISTORY, """
SELECT event_id, round(amount_deviation, 6) AS amount_deviation FROM features"""),
        "recipient_features": _with(TX + """,
pairs AS (
  SELECT event_id, recipient_id,
         count(*) OVER (PARTITION BY user_id, recipient_id) AS recipient_frequency FROM tx)""", """
SELECT *, CASE WHEN recipient_frequency = 1 THEN 1 ELSE 0 END AS is_new_recipient FROM pairs"""),
        "feature_table": _with(HISTORY, FEATURE_ROWS),
        "feature_table_bucketed": _with(HISTORY, FEATURE_ROWS),
        "scaled_features": _with(
            HISTORY,
            "SELECT event_id, " + ", ".join(map(_scaled, FEATURE_NAMES)) + " FROM features",
        ),
        "fraud_hotspots": _with(RULED, """
SELECT event_id, user_id, amount, distance_from_nairobi FROM ruled
WHERE is_flagged AND is_location_outlier
ORDER BY distance_from_nairobi DESC, event_id LIMIT 100"""),
        "alert_list": _with(RULED, """
SELECT event_id, user_id, amount, is_high_amount, is_location_outlier FROM ruled
WHERE is_flagged ORDER BY event_id LIMIT 1000"""),
        "train_split": f"""
SELECT event_id, {HASH.format(text='CAST(event_id AS varchar)')} % 100 < 80 AS is_training
FROM events""",
        "retrain_decision": _with(CELLS, """
SELECT 48.0::double AS age_hours, round(accuracy, 6) AS accuracy, n_samples,
       accuracy < 0.85 AND n_samples >= 1000 AS should_retrain FROM quality"""),
        "contamination_cut": _with(TX + """,
cut AS (SELECT quantile_cont(amount, 0.1) AS q FROM tx)""", """
SELECT round(any_value(q), 6) AS amount_cut, count(*) FILTER (amount < q) AS below_cut
FROM tx, cut"""),
        "contamination_cut_narrowed": _with(TX + """,
cut AS (SELECT quantile_cont(amount, 0.1) AS q FROM tx)""", """
SELECT round(any_value(q), 6) AS amount_cut, count(*) FILTER (amount < q) AS below_cut
FROM tx, cut"""),
        "forest_leaf_sizes": f"""
SELECT CAST(tree AS integer) AS tree_id, least(256, n) AS n_samples
FROM range(0, 100) t(tree), (
  SELECT count(*) AS n FROM events
  WHERE {HASH.format(text='CAST(event_id AS varchar)')} % 100 < 80)""",
        "training_anomaly_share": f"""
SELECT 10.0::double AS anomaly_percent, count(*) AS n_rows FROM events
WHERE {HASH.format(text='CAST(event_id AS varchar)')} % 100 < 80""",
        "hybrid_rule_flags": _with(RULED, """
SELECT event_id, is_flagged, true AS is_consistent FROM ruled"""),
        "explanation_features": _with(HISTORY, f"""
SELECT event_id, {REASONS.format(rapid='gap_seconds < 3600')} AS reasons,
       amount::double AS amount, hour_of_day::double AS hour_of_day,
       day_of_week::double AS day_of_week, day_of_month::double AS day_of_month,
       round(distance_from_nairobi, 6) AS distance_from_nairobi,
       user_transaction_count::double AS user_transaction_count,
       round(user_avg_amount, 6) AS user_avg_amount,
       round(amount_deviation, 6) AS amount_deviation,
       round(time_since_last_txn, 6) AS time_since_last_txn,
       is_weekend::double AS is_weekend, is_business_hours::double AS is_business_hours,
       is_end_of_month::double AS is_end_of_month FROM features"""),
        "forest_nodes": _recursive(FOREST, """
SELECT tree::integer AS tree_id, node::integer AS node_id, f::integer AS feature,
       round(cut, 6) AS threshold, (CASE WHEN f < 0 THEN -1 ELSE 2 * node + 1 END)::integer AS left,
       (CASE WHEN f < 0 THEN -1 ELSE 2 * node + 2 END)::integer AS right, n AS n_samples,
       depth::integer AS depth FROM nodes"""),
        "forest_scores": _recursive(SCORED, """
SELECT event_id, round(score, 9) AS ml_anomaly_score, is_ml_anomaly FROM scored"""),
        "forest_scores_compiled": _recursive(SCORED, """
SELECT event_id, total AS path_sum, round(score, 9) AS ml_anomaly_score, is_ml_anomaly
FROM scored"""),
        "model_evaluation": _recursive(
            SCORED + ", judged AS (SELECT * FROM scored WHERE NOT in_training),"
            + QUALITY.format(guess="is_ml_anomaly", rows="judged"), REPORT),
        "feature_importance": _recursive(TRIALS, f"""
SELECT {FEATURE_NAMES}[(t.trial % 16)::integer] AS feature,
       round(avg(abs(t.raw - own.raw)), 6) AS importance
FROM walk_raw t JOIN walk_raw own ON own.trial = t.trial - t.trial % 16
WHERE t.trial % 16 > 0 GROUP BY t.trial % 16"""),
        "explain_anomalies": _recursive(SCORED, f"""
SELECT event_id, is_ml_anomaly AS is_anomaly, round(score, 9) AS anomaly_score,
       {REASONS.format(rapid='gap_seconds < 3600')} AS explanations,
       {', '.join(f'round({n}::double, 6) AS {n}' for n in FEATURE_NAMES)} FROM scored"""),
        "hybrid_scoring": _recursive(SCORED, """
SELECT event_id, is_flagged, round(score, 9) AS ml_anomaly_score, is_ml_anomaly,
       is_flagged OR is_ml_anomaly AS is_enhanced_fraud FROM scored"""),
        "alert_stream": _with(RULED, f"""
SELECT event_id, user_id, amount, {RULE_COLUMNS} FROM ruled WHERE is_flagged"""),
        "frequency_stream": _with(WINDOWS, """
SELECT *, true AS is_high_frequency FROM windows WHERE transaction_count > 5"""),
        "frequency_updates": _with(WINDOWS, """
SELECT *, true AS is_high_frequency FROM windows WHERE transaction_count > 5"""),
        "frequency_state": _with(WINDOWS, "SELECT * FROM windows"),
        "hourly_stream": _with(HOURLY, HOURLY_ROWS),
        "causal_user_features": _with(TX, CAUSAL),
        "causal_user_features_stateful": _with(TX, CAUSAL),
    }
    return found | {
        "data_quality_stream": found["data_quality"],
        "contamination_cut_sketched": found["contamination_cut"],
        "flagged_documents_committed": found["flagged_documents"],
    }
