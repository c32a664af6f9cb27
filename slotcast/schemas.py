"""Explicit schemas for every table (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

READING_BODY = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("car_count", T.StringType(), True),
        T.StructField("free_spots", T.ArrayType(T.StringType()), True),
    ]
)

PAYLOAD_RECORD = T.StructType(
    [
        T.StructField("car_count", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
    ]
)

EVAL_REPORT = T.StructType(
    [
        T.StructField(
            "regression_metrics",
            T.StructType(
                [
                    T.StructField(
                        "mae",
                        T.StructType(
                            [
                                T.StructField("value", T.DoubleType()),
                                T.StructField("standard_deviation", T.DoubleType()),
                            ]
                        ),
                    ),
                    T.StructField(
                        "mse",
                        T.StructType(
                            [
                                T.StructField("value", T.DoubleType()),
                                T.StructField("standard_deviation", T.DoubleType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "comparison",
            T.StructType(
                [
                    T.StructField("new_mae", T.DoubleType()),
                    T.StructField("old_mae", T.DoubleType()),
                    T.StructField("result", T.StringType()),
                ]
            ),
        ),
    ]
)

DRIFT_REPORT = T.StructType(
    [
        T.StructField("drift_detected", T.BooleanType()),
        T.StructField("drift_count", T.IntegerType()),
        T.StructField(
            "details",
            T.MapType(
                T.StringType(),
                T.StructType([T.StructField("mae", T.DoubleType()), T.StructField("status", T.StringType())]),
            ),
        ),
        T.StructField("check_timestamp", T.StringType()),
    ]
)


def require_columns(columns, required, what: str = "input") -> None:
    """Driver-side schema check with a clear error (no data is touched)."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"{what} must contain columns {list(required)}; missing {missing}")
