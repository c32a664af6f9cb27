"""Position index, tail fraction, split ranges, keep-last, top-k."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from slotcast.operators import dedup as DD
from slotcast.operators import ordering as O


def _rows(spark, n, sensors=("a", "b"), seed=1):
    rnd = random.Random(seed)
    data = []
    seq = 0
    for s in sensors:
        t = dt.datetime(2024, 1, 1)
        for _ in range(n):
            t += dt.timedelta(seconds=rnd.randint(1, 7200))
            data.append((s, t, float(rnd.randint(0, 50)), seq))
            seq += 1
    return spark.createDataFrame(data, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long")


def test_sequence_index_equals_row_number(spark):
    df = _rows(spark, 500)
    got = O.sequence_index(df).select("sensor_id", "ingest_seq", "idx", "n_total").collect()
    by = {}
    for r in got:
        by.setdefault(r["sensor_id"], []).append((r["ingest_seq"], r["idx"], r["n_total"]))
    for rows in by.values():
        rows.sort()
        assert [i for _, i, _ in rows] == list(range(len(rows)))
        assert {n for _, _, n in rows} == {len(rows)}


@pytest.mark.parametrize("n", [10, 11, 99, 100, 288])
def test_tail_fraction_sizes(spark, n):
    df = _rows(spark, n, sensors=("a",))
    kept = O.tail_fraction(O.sequence_index(df), 0.7).count()
    assert kept == n - int(n * (1 - 0.7))


@pytest.mark.parametrize("n", [10, 11, 99, 100, 288])
def test_split_sizes(spark, n):
    df = spark.range(n).select(F.lit("a").alias("sensor_id"), F.col("id").alias("window_idx"), F.lit(n).cast("long").alias("n_windows"))
    out = O.split_label(df, 0.8, 0.9, idx="window_idx", total="n_windows")
    valid = out.where("split = 'valid'").count()
    assert valid == int(n * 0.9) - int(n * 0.8)
    assert out.where("part = 'head'").count() == int(n * 0.8)
    assert out.where("part = 'tail'").count() == n - int(n * 0.9)


def test_keep_last_prefers_order_tuple(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, 5, "old"), ("a", 1, 1, 3, "new-early"), ("a", 1, 1, 4, "new-late"), ("b", 2, 0, 1, "only")],
        "sensor_id string, k int, src int, seq int, v string",
    )
    out = {(r["sensor_id"], r["k"]): r["v"] for r in DD.keep_last(df, ["sensor_id", "k"], ["src", "seq"]).collect()}
    assert out == {("a", 1): "new-late", ("b", 2): "only"}


def test_latest_n(spark):
    df = _rows(spark, 50)
    top = O.latest_n(df, 7).collect()
    assert len(top) == 14
    assert {r["rank"] for r in top} == set(range(1, 8))
