"""Parsing of reading envelopes and scoring payloads (JSON or CSV text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast import schemas
from slotcast.functions.numeric import coerce_count
from slotcast.functions.timecols import parse_day_first, parse_lenient

ENVELOPE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("body", T.StringType()),
    ]
)


def parse_reading(envelopes: DataFrame, body: str = "body") -> DataFrame:
    """``body`` JSON -> sensor reading: strict day-first time, decimal count,
    ``free_spots`` as ints (default empty).  Unparseable rows get NULLs; the
    caller decides to drop or quarantine them (``valid``)."""
    b = F.from_json(F.col(body), schemas.READING_BODY)
    out = envelopes.withColumn("_b", b).select(
        *[c for c in envelopes.columns if c != body],
        parse_day_first("_b.timestamp").alias("ts"),
        coerce_count("_b.car_count").alias("car_count"),
        F.transform(F.coalesce(F.col("_b.free_spots"), F.array().cast("array<string>")), lambda x: x.try_cast("int")).alias(
            "free_spots"
        ),
    )
    return out.withColumn("valid", F.col("ts").isNotNull() & F.col("car_count").isNotNull())


_COLUMNS = "car_count array<string>, timestamp array<string>"
_FIELD = r',[ \t]*("(?:[^"]|"")*"|[^,]*)'


def _fields(line: Column) -> Column:
    """The fields of a CSV line, trimmed and unquoted."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.transform(raw, lambda x: F.replace(F.regexp_replace(F.trim(x), '^"|"$', ""), F.lit('""'), F.lit('"')))


def _json_records(body: Column) -> Column:
    """A JSON array of records, an object of columns, or one record -> array of records."""
    rows = F.when(F.ltrim(body).startswith("["), F.from_json(body, T.ArrayType(schemas.PAYLOAD_RECORD)))
    columns = F.from_json(body, _COLUMNS)
    zipped = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(columns["car_count"]), F.size(columns["timestamp"])) - 1),
        lambda i: F.struct(F.get(columns["car_count"], i).alias("car_count"), F.get(columns["timestamp"], i).alias("timestamp")),
    )
    both = F.size(columns["car_count"]).between(1, 1 << 30) & F.size(columns["timestamp"]).between(1, 1 << 30)
    one = F.from_json(body, schemas.PAYLOAD_RECORD)
    single = F.when(one["car_count"].isNotNull() & one["timestamp"].isNotNull(), F.array(one))
    return F.coalesce(rows, F.when(both, zipped), single)


def parse_payloads(payloads: DataFrame, body: str = "body", content_type: str = "content_type") -> DataFrame:
    """Scoring payloads: ``application/json`` (array of records, object of columns,
    or one record) or ``text/csv`` (header + rows, quoted or not) -> one row per
    record with the count coerced and the time parsed leniently (day-first or
    ISO); other content types and unparseable records are kept with ``error`` set
    (quarantine)."""
    ct = F.lower(F.trim(F.col(content_type)))
    as_json = _json_records(F.col(body))
    lines = F.filter(F.split(F.regexp_replace(F.col(body), "\r", ""), "\n"), lambda s: F.length(F.trim(s)) > 0)
    header = _fields(F.get(lines, 0))
    ci, ti = F.array_position(header, "car_count"), F.array_position(header, "timestamp")
    none = F.lit(None).cast("string")
    csv_lines = F.transform(
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
        lambda ln: F.struct(none.alias("car_count"), none.alias("timestamp"), ln.alias("line")),
    )
    json_rows = F.transform(as_json, lambda r: F.struct(r["car_count"].alias("car_count"), r["timestamp"].alias("timestamp"), none.alias("line")))
    keep = [c for c in payloads.columns if c != body]
    read = payloads.select(*keep, body, ct.alias("_ct"), ci.cast("int").alias("_ci"), ti.cast("int").alias("_ti"))
    records = F.when(F.col("_ct") == "application/json", json_rows).when((F.col("_ct") == "text/csv") & (F.col("_ci") > 0) & (F.col("_ti") > 0), csv_lines)
    exploded = read.select(*keep, "_ct", "_ci", "_ti", F.explode_outer(records).alias("_r"))
    exploded = exploded.withColumn("_f", _fields(F.col("_r.line")))
    out = exploded.select(
        *keep,
        coerce_count(F.coalesce("_r.car_count", F.get("_f", F.col("_ci") - 1))).cast("double").alias("car_count"),
        parse_lenient(F.coalesce("_r.timestamp", F.get("_f", F.col("_ti") - 1))).alias("ts"),
        F.when(~F.col("_ct").isin("application/json", "text/csv"), F.lit("unsupported content type"))
        .when(F.col("_r").isNull(), F.lit("no records"))
        .alias("error"),
    )
    return out.withColumn(
        "error",
        F.coalesce(
            F.col("error"),
            F.when(F.col("car_count").isNull() | F.col("ts").isNull(), F.lit("bad record")),
        ),
    )
