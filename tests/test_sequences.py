"""Chunked sliding windows against a brute-force numpy build."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.operators import sequences as Q


def _frame(spark, values, sensor="a"):
    data = [(sensor, i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "sensor_id string, idx long, v double")


def _brute(values, n, lead):
    out = {}
    for e in range(n - 1, len(values) - lead):
        w = values[e - n + 1 : e + 1]
        out[e] = (float(sum(w)), float(w[0]), float(values[e + lead]))
    return out


@pytest.mark.parametrize("n,lead,chunk,length", [(5, 1, 7, 40), (5, 3, 5, 23), (4, 13, 13, 60), (6, 1, 6, 6), (6, 1, 6, 7)])
def test_digest_matches_brute_force(spark, n, lead, chunk, length):
    rng = np.random.default_rng(n * 100 + lead)
    values = rng.integers(0, 100, length).tolist()
    df = _frame(spark, values)
    d = Q.window_digest(df, n, lead, {"s": F.col("v")}, {"f": F.col("v")}, F.col("v"), chunk_rows=chunk).collect()
    got = {r["idx"]: (r["s"], r["f"], r["label"]) for r in d}
    assert got == _brute(values, n, lead)


def test_arrays_row_major(spark):
    values = list(range(20))
    df = _frame(spark, values).withColumn("h", F.col("v") * 10)
    a = Q.window_arrays(df, 3, 1, ["v", "h"], F.col("v"), chunk_rows=4).orderBy("idx").collect()
    assert len(a) == len(values) - 3
    first = a[0]
    assert first["idx"] == 2 and list(first["x"]) == [0.0, 0.0, 1.0, 10.0, 2.0, 20.0] and first["label"] == 3.0


def test_arrays_of_many_keys_match_brute_force(spark):
    """Carried columns, null values and null labels, null keys, over chunk borders and rows in any order."""
    rng = np.random.default_rng(7)
    values = {key: [None if rng.random() < 0.1 else float(v) for v in rng.integers(0, 100, n)] for key, n in (("a", 90), ("b", 61), (None, 33), ("short", 5))}
    rows = [(key, i, v, float(i), f"{key}{i}") for key, vs in values.items() for i, v in enumerate(vs)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    df = spark.createDataFrame(rows, "sensor_id string, idx long, v double, h double, note string")
    n, lead = 6, 3
    got = Q.window_arrays(df, n, lead, ["v", "h"], F.col("v"), carry=("note",), chunk_rows=8).collect()
    want = {}
    for key, vs in values.items():
        for e in range(n - 1, len(vs) - lead):
            if vs[e + lead] is not None:
                want[key, e] = (f"{key}{e}", [y for t in range(e - n + 1, e + 1) for y in (vs[t], float(t))], vs[e + lead])
    assert {(r["sensor_id"], r["idx"]): (r["note"], list(r["x"]), r["label"]) for r in got} == want and len(got) == len(want)
    unlabelled = Q.window_arrays(df, n, lead, ["v"], None, chunk_rows=8)
    assert unlabelled.columns == ["sensor_id", "idx", "x"] and unlabelled.count() == sum(max(0, len(vs) - n + 1) for vs in values.values())


def test_written_windows_are_spread_over_tasks(spark, tmp_path):
    """A window row is 288 times its reading, so the size of the readings must not decide how many tasks write windows."""
    from slotcast.plans import training
    from slotcast.sinks.tables import WINDOWS_TABLE, read_table

    n, length = 4, 12 * Q.DEFAULT_CHUNK
    rows = spark.range(2 * length).selectExpr(f"concat('s', id DIV {length}) AS sensor_id", f"id % {length} AS idx", "id AS n_rows", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "CAST(id % 50 AS DOUBLE) AS car_count")
    path = str(tmp_path / "windows")
    training.write_windows(training.window_tensors(rows, n), path)
    assert len({p.name.split("-")[1] for p in (tmp_path / "windows").glob("part-*.parquet")}) >= 4
    assert read_table(spark, path, WINDOWS_TABLE).count() == 2 * (length - n)


def test_training_window_counts_287_288_289(spark):
    """len - n windows; none at 288 or fewer rows (training needs > 288)."""
    for length, expected in [(287, 0), (288, 0), (289, 1), (300, 12)]:
        df = _frame(spark, list(range(length)))
        d = Q.window_digest(df, 288, 1, {"s": F.col("v")}, {}, F.col("v"))
        assert d.count() == expected


def test_eval_window_counts_300_301(spark):
    for length, expected in [(300, 0), (301, 1), (310, 10)]:
        df = _frame(spark, list(range(length)))
        d = Q.window_digest(df, 288, 13, {"s": F.col("v")}, {}, F.col("v"))
        assert d.count() == expected


def test_last_window(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    data = [("a", base + dt.timedelta(minutes=5 * i), float(i)) for i in range(300)]
    df = spark.createDataFrame(data, "sensor_id string, bucket timestamp_ntz, v double")
    lw = Q.last_window(df, 288, ["v"]).collect()[0]
    assert lw["n_rows"] == 288 and lw["x"][0] == 12.0 and lw["x"][-1] == 299.0


def test_last_buckets_of_every_sensor_equal_the_full_series(spark, tmp_path):
    """Chosen dates give the last 288 buckets of the full-history series, for a sensor with gaps,
    one that has been silent for a month, and one with a single reading."""
    import datetime as dt

    from pyspark.sql.window import Window as W

    from slotcast.operators.edges import dates_of_last_buckets, sensor_dates
    from slotcast.operators.recent import last_buckets
    from slotcast.operators.series import regular_series

    base = dt.datetime(2024, 1, 1)
    rows = [("dense", base + dt.timedelta(minutes=7 * i), float(i % 50), i) for i in range(8000)]
    rows += [("sparse", base + dt.timedelta(hours=9 * i), float(i), 10000 + i) for i in range(20)]
    rows += [("silent", base + dt.timedelta(minutes=11 * i), float(i), 20000 + i) for i in range(400)]
    rows += [("once", base, 3.0, 30000)]
    df = spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long")
    df = df.withColumn("car_count", F.col("car_count").cast(C.COUNT_TYPE)).withColumn("date", F.to_date("ts"))
    path = str(tmp_path / "readings")
    df.write.partitionBy("date").parquet(path)
    table = spark.read.parquet(path)
    dates = sensor_dates(table)
    got = {(r["sensor_id"], r["bucket"]): r["car_count"] for r in last_buckets(table, 288, dates).collect()}
    ranked = regular_series(table).withColumn("r", F.row_number().over(W.partitionBy("sensor_id").orderBy(F.col("bucket").desc())))
    assert got == {(r["sensor_id"], r["bucket"]): r["car_count"] for r in ranked.where("r <= 288").collect()}
    assert {k[0] for k in got} == {"dense", "sparse", "silent", "once"}
    assert dates_of_last_buckets(dates, 288).where("sensor_id = 'dense'").count() <= 2


def test_latest_rows_from_chosen_dates(spark):
    import datetime as dt

    from slotcast.operators.edges import dates_of_latest_rows, read_dates, sensor_dates
    from slotcast.operators.ordering import latest_n

    rows = [("a", dt.datetime(2024, 1, 1 + i // 10, i % 10), float(i), i) for i in range(60)] + [("b", dt.datetime(2023, 5, 1), 1.0, 99)]
    df = spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long").withColumn("date", F.to_date("ts"))
    needed = dates_of_latest_rows(sensor_dates(df), 15)
    assert needed.count() == 3
    key = lambda t: {(r["sensor_id"], r["ts"]) for r in latest_n(t, 15).collect()}
    assert key(read_dates(df, needed)) == key(df)


def test_digest_of_stored_windows(spark):
    """First, last and sums of a window, null where a value they take is null."""
    from slotcast.catalog.q_windows import _tensor_digest
    from slotcast.sinks.tables import WINDOWS_TABLE

    rng = np.random.default_rng(3)
    rows = []
    for i in range(2500):
        x = rng.random(10).round(4).tolist()
        if i % 5 == 0:
            x[i // 5 % 10] = None
        rows.append((i, 2500, x, float(i), f"s{i % 3}"))
    got = {r["window_idx"]: r for r in _tensor_digest(spark.createDataFrame(rows, WINDOWS_TABLE)).collect()}
    total = lambda v: None if None in v else pytest.approx(sum(v), abs=1e-4)
    assert len(got) == len(rows)
    for i, _, x, label, sensor in rows:
        r = got[i]
        assert (r["sensor_id"], r["n_steps"], r["first_car"], r["last_car"], r["label"]) == (sensor, 5, x[0], x[8], label)
        assert r["sum_car"] == total(x[::2]) and r["sum_hour"] == total(x[1::2])
    assert _tensor_digest(spark.createDataFrame([], WINDOWS_TABLE)).count() == 0
