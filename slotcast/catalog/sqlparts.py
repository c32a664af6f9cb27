"""DuckDB SQL building blocks for the oracles.

The oracles are deliberately brute force: per-sensor windows over the whole
series, no day split, so they check the scalable Spark formulation."""

from __future__ import annotations


def q4(expr: str, places: int = 4) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,9)), {places}) AS DOUBLE)"


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def sec_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def date_text(expr: str) -> str:
    return f"strftime(CAST({expr} AS DATE), '%Y-%m-%d')"


READINGS = """
readings AS (
  SELECT event_type AS sensor_id, ts, CAST(value AS DECIMAL(28,10)) AS car_count,
         event_id AS ingest_seq, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

RESAMPLED = """
resampled AS (
  SELECT sensor_id, time_bucket(INTERVAL '5 minutes', ts) AS bucket,
         CAST(SUM(car_count) AS DOUBLE) / COUNT(car_count) AS car_count, COUNT(car_count) AS n
  FROM readings GROUP BY 1, 2
)"""


def interp(src: str, name: str, keys: str = "sensor_id", value: str = "car_count") -> str:
    """Spine between first and last bucket per key + time interpolation."""
    k = [x.strip() for x in keys.split(",")]
    on = " AND ".join(f"r.{x} = s.{x}" for x in k)
    ks = ", ".join(f"s.{x}" for x in k)
    part = ", ".join(k)
    w_prev = f"(PARTITION BY {part} ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    w_next = f"(PARTITION BY {part} ORDER BY bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""
{name}_bounds AS (SELECT {part}, MIN(bucket) AS lo, MAX(bucket) AS hi FROM {src} GROUP BY ALL),
{name}_spine AS (SELECT {part}, UNNEST(generate_series(lo, hi, INTERVAL '5 minutes')) AS bucket FROM {name}_bounds),
{name}_sp AS (SELECT {ks}, s.bucket, r.{value} AS v FROM {name}_spine s LEFT JOIN {src} r ON {on} AND r.bucket = s.bucket),
{name}_nbr AS (
  SELECT {part}, bucket, v,
    LAST_VALUE(CASE WHEN v IS NOT NULL THEN bucket END IGNORE NULLS) OVER {w_prev} AS pb,
    LAST_VALUE(v IGNORE NULLS) OVER {w_prev} AS pv,
    FIRST_VALUE(CASE WHEN v IS NOT NULL THEN bucket END IGNORE NULLS) OVER {w_next} AS nb,
    FIRST_VALUE(v IGNORE NULLS) OVER {w_next} AS nv
  FROM {name}_sp
),
{name} AS (
  SELECT {part}, bucket{'' if 'date' in k else ', CAST(bucket AS DATE) AS date'},
    CASE WHEN v IS NOT NULL THEN v WHEN pb IS NULL THEN NULL WHEN nb IS NULL THEN pv
         ELSE pv + (nv - pv) * (epoch(bucket) - epoch(pb)) / (epoch(nb) - epoch(pb)) END AS {value},
    v IS NOT NULL AS observed
  FROM {name}_nbr
)"""


SERIES = interp("resampled", "series")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PREDICTIONS = """
predictions AS (
  SELECT sensor_id, bucket AS timestamp, CAST(round_even(car_count, 0) AS INTEGER) AS prediction,
         bucket + INTERVAL 1 DAY AS prediction_for, bucket AS created_at
  FROM series WHERE car_count IS NOT NULL
)"""

INDEXED = """
indexed AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts, ingest_seq) - 1 AS idx,
         count(*) OVER (PARTITION BY sensor_id) AS n_total
  FROM readings
)"""

TAIL = """
tail AS (
  SELECT * FROM indexed
  WHERE idx >= floor(CAST(n_total AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.7 AS DOUBLE)))
)"""


def resample_sql(src: str, name: str, ts: str, value: str) -> str:
    """5-minute mean per (sensor, bucket) with the bucket's date."""
    return f"""
{name} AS (
  SELECT sensor_id, time_bucket(INTERVAL '5 minutes', {ts}) AS bucket,
         CAST(time_bucket(INTERVAL '5 minutes', {ts}) AS DATE) AS date,
         CAST(SUM({value}) AS DOUBLE) / COUNT({value}) AS {value}
  FROM {src} WHERE {ts} IS NOT NULL AND {value} IS NOT NULL GROUP BY 1, 2, 3
)"""


def day_profile_sql(src: str, name: str, ts: str, value: str, filled: bool = True) -> str:
    """Per (sensor, date): resample, interpolate inside the day, reindex 288
    slots, fill forward / backward / 0."""
    w = "PARTITION BY sensor_id, date ORDER BY slot"
    fill = (
        f"coalesce(v, LAST_VALUE(v IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
        f" FIRST_VALUE(v IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0)"
        if filled
        else "v"
    )
    return (
        resample_sql(src, f"{name}_r", ts, value)
        + ","
        + interp(f"{name}_r", f"{name}_i", keys="sensor_id, date", value=value)
        + f""",
{name}_keys AS (SELECT DISTINCT sensor_id, date FROM {name}_i),
{name}_cal AS (SELECT sensor_id, date, UNNEST(range(0, 288)) AS slot FROM {name}_keys),
{name}_j AS (
  SELECT c.sensor_id, c.date, c.slot, i.{value} AS v FROM {name}_cal c LEFT JOIN {name}_i i
  ON i.sensor_id = c.sensor_id AND i.date = c.date AND hour(i.bucket) * 12 + minute(i.bucket) // 5 = c.slot
),
{name} AS (SELECT sensor_id, date, slot, {fill} AS {value} FROM {name}_j)"""
    )
