import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from slotcast import config as C


def ts(s):
    return dt.datetime.fromisoformat(s)


def readings_df(spark, rows, sensor="s1"):
    """rows: list of (iso time, count) -> readings DataFrame."""
    data = [(sensor, ts(t), float(v) if v is not None else None, i) for i, (t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long")
    return df.withColumn("car_count", F.col("car_count").cast(C.COUNT_TYPE))


def pandas_series(rows):
    """The pandas chain the source uses: resample 5 min mean -> time interpolation."""
    pdf = pd.DataFrame({"timestamp": [ts(t) for t, _ in rows], "car_count": [v for _, v in rows]})
    pdf = pdf.dropna().set_index("timestamp").sort_index()
    return pdf["car_count"].astype(float).resample("5min").mean().interpolate(method="time")
