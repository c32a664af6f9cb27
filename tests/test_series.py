"""Resample + spine + time interpolation: pandas parity and edge cases."""

import random

import pytest

from slotcast.operators import series as S
from tests.helpers import pandas_series, readings_df


def _spark_series(spark, rows):
    out = S.regular_series(readings_df(spark, rows)).orderBy("bucket").collect()
    return {r["bucket"]: r["car_count"] for r in out}


CASES = {
    "gap_over_midnight": [("2024-01-01 22:03:00", 10), ("2024-01-02 01:12:30", 40), ("2024-01-02 01:14:00", 20)],
    "duplicates_in_bucket": [("2024-01-01 00:00:01", 1), ("2024-01-01 00:04:59.999", 3), ("2024-01-01 00:20:00", 9)],
    "one_row": [("2024-01-05 12:34:56", 7)],
    "missing_whole_days": [("2024-01-01 10:00:00", 5), ("2024-01-04 10:00:00", 35)],
    "sub_second_same_second": [("2024-01-01 00:00:00.100", 2), ("2024-01-01 00:00:00.900", 4), ("2024-01-01 00:10:00", 6)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_matches_pandas(spark, name):
    rows = CASES[name]
    got = _spark_series(spark, rows)
    want = pandas_series(rows)
    assert len(got) == len(want)
    for t, v in want.items():
        assert got[t.to_pydatetime()] == pytest.approx(v, abs=1e-9)


def test_random_gappy_series_matches_pandas(spark):
    rnd = random.Random(7)
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(400):
        t += dt.timedelta(seconds=rnd.choice([20, 200, 600, 3600, 9000]))
        rows.append((t.isoformat(sep=" "), round(rnd.uniform(0, 100), 2)))
    got = _spark_series(spark, rows)
    want = pandas_series(rows)
    assert len(got) == len(want)
    for k, v in want.items():
        assert got[k.to_pydatetime()] == pytest.approx(v, abs=1e-9)


def test_spine_spans_first_to_last_bucket_only(spark):
    r = S.resample_mean(readings_df(spark, [("2024-01-01 00:10:00", 4), ("2024-01-01 00:20:00", 8)]))
    out = S.interpolate_time(r).orderBy("bucket").collect()
    assert [x["car_count"] for x in out] == [4.0, 6.0, 8.0]
    assert [x["observed"] for x in out] == [True, False, True]


def test_within_day_mode_has_no_carry(spark):
    rows = [("2024-01-01 23:50:00", 10), ("2024-01-02 00:10:00", 30)]
    r = S.resample_mean(readings_df(spark, rows))
    across = S.interpolate_time(r).count()
    within = S.interpolate_time(r, across_days=False).count()
    assert across == 5 and within == 2


def test_resample_is_exact_decimal_mean(spark):
    rows = [("2024-01-01 00:00:01", 0.1), ("2024-01-01 00:00:02", 0.2), ("2024-01-01 00:00:03", 0.3)]
    r = S.resample_mean(readings_df(spark, rows)).collect()[0]
    assert r["car_count"] == 0.6 / 3 or r["car_count"] == pytest.approx(0.2, abs=0)
    assert r["n"] == 3
