"""Property test: resample + interpolation equals pandas on random gappy
multi-sensor series (gaps up to several days, duplicates in a bucket)."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from slotcast import config as C
from slotcast.operators import series as S
from tests.helpers import pandas_series

gaps = st.lists(
    st.tuples(st.sampled_from([0, 7, 290, 301, 3599, 86400, 86400 * 3 + 17]), st.integers(0, 500)),
    min_size=1,
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=gaps, b=gaps)
def test_interpolation_matches_pandas(spark, a, b):
    def rows(spec, start):
        t, out = start, []
        for gap, v in spec:
            t += dt.timedelta(seconds=gap)
            out.append((t.isoformat(sep=" "), v / 4))
        return out

    ra = rows(a, dt.datetime(2024, 1, 1, 23, 0))
    rb = rows(b, dt.datetime(2024, 1, 3, 0, 0, 1))
    data = [("a", dt.datetime.fromisoformat(t), v, i) for i, (t, v) in enumerate(ra)]
    data += [("b", dt.datetime.fromisoformat(t), v, 1000 + i) for i, (t, v) in enumerate(rb)]
    df = spark.createDataFrame(data, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long")
    got = {}
    for r in S.regular_series(df.withColumn("car_count", df["car_count"].cast(C.COUNT_TYPE))).collect():
        got[(r["sensor_id"], r["bucket"])] = r["car_count"]
    for sensor, rr in (("a", ra), ("b", rb)):
        want = pandas_series(rr)
        assert sum(1 for k in got if k[0] == sensor) == len(want)
        for t, v in want.items():
            assert got[(sensor, t.to_pydatetime())] == pytest.approx(v, abs=1e-9)
