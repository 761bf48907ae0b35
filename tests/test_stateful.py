"""Features from the stream's own state: order of files, restarts, late rows, expiry."""

from datetime import datetime, timedelta

import pandas as pd
import pytest

from tallywatch.streaming.queries import start
from tallywatch.streaming.stateful import END, causal_stream, with_heartbeats, write_heartbeat

SCHEMA = "event_id long, user_id string, amount double, transaction_timestamp timestamp"
DAY = datetime(2024, 1, 1)
FEATURES = ["user_count_so_far", "user_avg_so_far", "seconds_since_last"]


def at(second):
    return DAY + timedelta(seconds=second)


class Run:
    """A stream over files that are written on the way; ``go`` drains it and stops."""

    def __init__(self, spark, path, delay, **options):
        self.spark, self.path, self.delay, self.options = spark, str(path), delay, options
        write_heartbeat(spark, f"{self.path}/beats")
        self.n = 0

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.path}/rows")

    def go(self):
        rows = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(
            f"{self.path}/rows")
        stream = causal_stream(
            with_heartbeats(rows, f"{self.path}/beats"), self.delay, **self.options)
        query = start(
            stream.writeStream.outputMode("append").format("parquet").option(
                "path", f"{self.path}/data"), f"{self.path}/checkpoint", None, True)
        query.awaitTermination()
        return query

    def end(self):
        write_heartbeat(self.spark, f"{self.path}/beats", END)
        return self.go()

    def found(self):
        rows = self.spark.read.parquet(f"{self.path}/data").collect()
        assert len({r.event_id for r in rows}) == len(rows)
        return {r.event_id: tuple(r[c] for c in FEATURES) for r in rows}


def plain(rows):
    """Features by walking every user's rows in order."""
    out, state = {}, {}
    for event, user, amount, ts in sorted(rows, key=lambda r: (r[3], r[0])):
        count, amounts, total, last = state.get(user, (0, 0, 0.0, None))
        count += 1
        if amount is not None:
            amounts, total = amounts + 1, total + amount
        out[event] = (count, total / amounts if amounts else None,
                      None if last is None else int((ts - last).total_seconds()))
        state[user] = count, amounts, total, ts
    return out


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    from tallywatch.session import STATE_STORE

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    yield
    spark.conf.set(key, before)


@pytest.fixture
def rows():
    """Ties in time, null amounts, a user without name, a hot user, one row only."""
    out = [(i, f"u{i % 3}", None if i % 7 == 0 else i * 1.5, at(i * 37 % 900)) for i in range(90)]
    out += [(100 + i, "u0", 2.0, at(450)) for i in range(40)]
    return out + [(200, None, 5.0, at(3)), (201, None, 7.0, at(800)), (202, "once", 1.0, at(1))]


def test_files_out_of_order_give_ordered_features(spark, tmp_path, rows):
    run = Run(spark, tmp_path, "1 hour")
    for part in range(3):
        run.add(rows[part::3])
    run.go()
    run.end()
    assert run.found() == plain(rows)


def test_rows_come_out_when_the_watermark_passes_them(spark, tmp_path):
    run = Run(spark, tmp_path, "100 seconds")
    rows = [(1, "a", 1.0, at(0)), (2, "a", 2.0, at(50)), (3, "b", 4.0, at(200))]
    run.add(rows)
    run.go()
    assert set(run.found()) == {1, 2}
    write_heartbeat(spark, run.path + "/beats", at(301))
    run.go()
    assert run.found() == plain(rows)


def test_a_restart_goes_on_from_the_state_and_reads_no_row_again(spark, tmp_path, rows):
    run = Run(spark, tmp_path, "20 seconds")
    ordered = sorted(rows, key=lambda r: r[3])
    run.add(ordered[:60])
    first = run.go()
    assert first.lastProgress is not None
    done = set(run.found())
    run.add(ordered[60:])
    second = run.go()
    read = sum(p.numInputRows for p in second.recentProgress)
    assert read == len(ordered) - 60
    run.end()
    assert done < set(run.found()) and run.found() == plain(rows)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    run = Run(spark, tmp_path, "10 seconds")
    run.add([(1, "a", 1.0, at(0)), (2, "a", 1.0, at(1000))])
    run.go()
    run.add([(3, "a", 9.0, at(500)), (4, "a", 3.0, at(995))])
    query = run.go()
    dropped = sum(
        o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert dropped == 1
    run.end()
    assert run.found() == plain(
        [(1, "a", 1.0, at(0)), (2, "a", 1.0, at(1000)), (4, "a", 3.0, at(995))])


def test_idle_users_are_forgotten(spark, tmp_path):
    run = Run(spark, tmp_path, "1 second", idle_days=2)
    days = [0, 1, 8]
    rows = [(i, "a", 10.0 * (i + 1), at(d * 86_400)) for i, d in enumerate(days)]
    for row in rows:
        run.add([row])
        run.go()
        write_heartbeat(spark, run.path + "/beats", row[3] + timedelta(days=5 if row[0] else 0, hours=1))
        run.go()
    run.end()
    assert run.found() == {0: (1, 10.0, None), 1: (2, 15.0, 86_400), 2: (1, 30.0, None)}


def test_rows_without_time_are_kept(spark, tmp_path):
    run = Run(spark, tmp_path, "1 second")
    run.add([(1, "a", 1.0, at(0)), (2, "a", 100.0, None), (3, "a", 3.0, at(5))])
    run.go()
    run.end()
    assert run.found() == {1: (1, 1.0, None), 2: (None, None, None), 3: (2, 2.0, 5)}


def test_equal_to_the_gathered_features(spark, tmp_path, rows):
    from tallywatch.streaming.causal import causal_features

    run = Run(spark, tmp_path, "1 hour")
    run.add(rows)
    run.go()
    run.end()
    batch, _ = causal_features(spark.createDataFrame(rows, SCHEMA))
    expected = {r.event_id: tuple(r[c] for c in FEATURES) for r in batch.collect()}
    found = run.found()
    assert {k: (v[0], v[2]) for k, v in found.items()} == {
        k: (v[0], v[2]) for k, v in expected.items()}
    for key, value in found.items():
        assert value[1] == pytest.approx(expected[key][1])


def test_waiting_rows_are_packed(spark):
    from tallywatch.streaming.stateful import RunningTotals

    class Waiting:
        def __init__(self):
            self.entries = []

        def appendList(self, entries):
            self.entries += entries

        def registerTimer(self, at):
            self.at = at

    calls, processor = Waiting(), RunningTotals("event_id", "bigint")
    processor.handle = processor.waiting = calls
    part = pd.DataFrame({
        "event_id": range(500), "amount": [None, 1.0] * 250, "event_micros": range(5_000, 5_500)})
    assert not list(processor.handleInputRows(("a",), iter([part, part]), None))
    assert len(calls.entries) == 2 and calls.at == 5  # one entry a part, not one a row


def test_two_batches_wait_and_come_out_in_parts(spark, tmp_path, rows):
    """Parts of several batches wait together, and a timer takes some rows of each."""
    run = Run(spark, tmp_path, "1 hour")
    for part in range(3):
        run.add(rows[part::3])
    run.go()
    write_heartbeat(spark, run.path + "/beats", at(400 + 3600))
    run.go()
    assert 0 < len(run.found()) < len(rows)
    run.end()
    assert run.found() == plain(rows)
