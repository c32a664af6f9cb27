"""Run tables: merge on read, folding, crashes between steps, changes; and the ingest handler with its ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotcast import session as SS
from slotcast.sinks import deltas
from slotcast.sinks import exports as X
from slotcast.sinks.tables import dates_deltas, predictions_deltas, readings_deltas, write_readings
from slotcast.streaming import ingest as IG
from slotcast.streaming import late as LT
from slotcast.streaming import resample as RS
from tests.helpers import readings_df


def batch(spark, rows, sensor="s1"):
    """rows: (time, count)"""
    return readings_df(spark, rows, sensor).withColumn("free_spots", F.array().cast("array<int>"))


def contents(table):
    return {(r.sensor_id, str(r.ts)): float(r.car_count) for r in table.read().collect()}


def test_last_write_wins_before_and_after_folds(spark, tmp_path):
    table = readings_deltas(spark, str(tmp_path / "t"))
    assert table.read().count() == 0 and table.runs() == []
    want = {}
    for k in range(9):
        rows = [(f"2024-01-0{1 + (k + i) % 4} 10:0{i}:00", float(10 * k + i)) for i in range(3)] + [("2024-02-01 00:00:00", float(k))]
        assert table.write(batch(spark, rows)) == k
        want |= {("s1", t): v for t, v in rows}
        assert contents(table) == want
    assert table.fold() == 2  # nine small runs: two folds of four
    assert [(r.first, r.last) for r in table.runs()] == [(0, 0), (1, 4), (5, 8)] or len(table.runs()) <= 3
    assert contents(table) == want and table.read().count() == len(want)
    assert table.write(batch(spark, [("2024-01-01 10:00:00", -1.0)]), 6) is None  # folded already: a replay
    assert contents(table) == want


def test_order_within_a_batch_and_rows_without_time(spark, tmp_path):
    table = readings_deltas(spark, str(tmp_path / "t"))
    rows = batch(spark, [("2024-01-01 10:00:00", 1.0), ("2024-01-01 10:00:00", 2.0)])
    table.write(rows.unionByName(rows.withColumn("ts", F.lit(None).cast("timestamp_ntz"))))
    assert contents(table) == {("s1", "2024-01-01 10:00:00"): 2.0}
    table.write(rows.limit(0))
    assert contents(table) == {("s1", "2024-01-01 10:00:00"): 2.0}


def test_crashes_between_the_steps(spark, tmp_path, monkeypatch):
    table = readings_deltas(spark, str(tmp_path / "t"))
    for k in range(4):
        table.write(batch(spark, [(f"2024-01-01 1{k}:00:00", float(k))]), k)
    want = contents(table)
    # a run that was never committed doesn't count, and is replaced when the batch is replayed
    path = f"{table.path}/run-{4:012d}-{4:012d}"
    batch(spark, [("2024-01-01 10:00:00", 99.0)]).write.parquet(path + "/date=2024-01-01")
    SS.delete(spark, path + "/date=2024-01-01/_SUCCESS")
    assert contents(table) == want
    table.write(batch(spark, [("2024-01-02 10:00:00", 4.0)]), 4)
    want |= {("s1", "2024-01-02 10:00:00"): 4.0}
    assert contents(table) == want
    # a fold that is committed, while the old runs stay: they are superseded, and the next fold deletes them
    old = {r.path for r in table.runs()}
    plan = table.read()
    assert table.fold() == 1 and contents(table) == want
    assert plan.count() == len(want)  # planned before the fold; its files are still there
    assert {r.path for r in table.committed()} > {r.path for r in table.runs()}
    table.clean()
    assert {r.path for r in table.committed()} == {r.path for r in table.runs()} and len(old & {r.path for r in table.runs()}) == 1
    assert contents(table) == want


def test_bytes_follow_the_batch(spark, tmp_path):
    table = readings_deltas(spark, str(tmp_path / "t"))
    start = dt.datetime(2024, 1, 1)
    table.write(batch(spark, [((start + dt.timedelta(seconds=7 * i)).isoformat(" "), float(i * 37 % 101)) for i in range(12_000)]))
    table.write(batch(spark, [("2024-01-01 00:00:07", 5.0)]))
    large, small = (r.size for r in table.runs())
    assert small < large / 10 and table.read().count() == 12_000


def test_dates_follow_the_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_readings(spark, path, batch(spark, [("2024-01-01 10:00:00", 1.0), ("2024-01-01 11:02:00", 2.0)]), 0)
    write_readings(spark, path, batch(spark, [("2024-01-01 10:00:00", 3.0), ("2024-01-01 12:00:00", 2.0), ("2024-01-05 01:00:00", 1.0)]), 1)
    got = {str(r.date): (r.n, str(r.first_bucket), str(r.last_bucket)) for r in dates_deltas(spark, path).read().collect()}
    assert got == {"2024-01-01": (3, "2024-01-01 10:00:00", "2024-01-01 12:00:00"), "2024-01-05": (1, "2024-01-05 01:00:00", "2024-01-05 01:00:00")}


def test_changes_are_retractions_and_additions(spark, tmp_path):
    table = readings_deltas(spark, str(tmp_path / "t"))
    table.write(batch(spark, [("2024-01-01 10:00:00", 1.0), ("2024-01-01 10:01:00", 2.0)]), 0)
    table.write(batch(spark, [("2024-01-01 10:01:00", 7.0), ("2024-01-02 10:00:00", 3.0)]), 1)
    got = sorted((str(r.ts), float(r.car_count), r.sign) for r in deltas.changes(table, 1).collect())
    assert got == [("2024-01-01 10:01:00", 2.0, -1), ("2024-01-01 10:01:00", 7.0, 1), ("2024-01-02 10:00:00", 3.0, 1)]
    table.write(batch(spark, []), 2)
    assert deltas.changes(table, 2).count() == 0


def land(spark, path, rows):
    IG.write_landing(IG.envelopes(batch(spark, rows)), path)


def test_a_corrected_reading_counts_once(spark, tmp_path):
    landing, log, ckpt = (str(tmp_path / x) for x in ("landing", "log", "ckpt"))
    view = lambda: {(str(r.bucket), r.car_count, r.n) for r in RS.resampled_view(spark, log).collect()}
    land(spark, landing, [("2024-01-10 08:00:00", 4.0), ("2024-01-10 08:01:00", 6.0)])
    RS.run_resample(spark, landing, log, ckpt)
    land(spark, landing, [("2024-01-10 08:01:00", 10.0)])
    RS.run_resample(spark, landing, log, ckpt)
    assert view() == {("2024-01-10 08:00:00", 7.0, 2)}
    land(spark, landing, [("2024-01-10 08:01:00", 10.0)])  # sent again as it was
    RS.run_resample(spark, landing, log, ckpt)
    assert view() == {("2024-01-10 08:00:00", 7.0, 2)}


def test_one_handler_for_all_sinks_and_a_replay(spark, tmp_path):
    """Scoring, exports and master in one stream; a late row reaches all of them, a replayed batch none; a sink that
    failed catches up with the next batch."""
    landing, table, exports, log, master, preds, ckpt = (str(tmp_path / x) for x in ("landing", "readings", "exports", "log", "master", "preds", "ckpt"))
    handler = LT.LateAwareIngest(table, exports, log, master, preds)
    start = dt.datetime(2024, 1, 1)
    land(spark, landing, [((start + dt.timedelta(minutes=5 * i)).isoformat(" "), 40.0) for i in range(2 * 288)])
    IG.run_ingest(spark, landing, ckpt, handler)
    handler.export_all(spark)
    rows_of = lambda root: sorted((str(r.date), r.timestamp, float(r.car_count)) for r in X.read_csv_or_empty(spark, root, X.MASTER_SCHEMA).collect())
    forecasts = lambda: [(str(r.timestamp), r.prediction) for r in predictions_deltas(spark, preds).read().collect()]
    assert len(rows_of(master)) == len(rows_of(exports)) == 576 and forecasts() == [("2024-01-02 23:55:00", 40)]

    late = [("2024-01-01 07:02:00", 90.0)]
    land(spark, landing, late)
    failing = handler.sinks["master"]
    handler.sinks["master"] = lambda *_: (_ for _ in ()).throw(RuntimeError("the master is away"))
    with pytest.raises(Exception):
        IG.run_ingest(spark, landing, ckpt, handler)
    assert len(rows_of(exports)) == 577 and len(rows_of(master)) == 576
    handler.sinks["master"] = failing
    IG.run_ingest(spark, landing, ckpt, handler)  # the batch is replayed: exports have it, the master catches up
    assert ("2024-01-01", "01/01/2024 07:02:00", 90.0) in rows_of(master) and rows_of(master) == rows_of(exports)

    before = rows_of(master), rows_of(exports), forecasts(), contents(readings_deltas(spark, table))
    envelopes = IG.envelopes(batch(spark, late)).drop("date")
    handler(envelopes, 1)  # once more
    assert (rows_of(master), rows_of(exports), forecasts(), contents(readings_deltas(spark, table))) == before
    assert handler.ledger(spark).done("master") == handler.ledger(spark).done("exports") == 1


