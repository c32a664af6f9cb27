"""Sliding windows of ``n`` consecutive rows with a label ``lead`` rows after
the window's last row.

Scale design: a window over a key's whole history would put a hot sensor in
one task.  Rows are grouped in chunks of ``chunk_rows`` consecutive positions;
each row is also copied into the next chunk when it lies in the last ``n-1``
positions of its own (history for the next chunk's first windows) and into
the previous chunk when it lies in the first ``lead`` positions (labels for
the previous chunk's last windows).  Windows are then computed per
(key, chunk) and kept only in the row's home chunk: at most
``chunk_rows + n - 1 + lead`` rows per task, about 7 % extra rows at the
default chunk size.

Positions (``idx``) come from ``ordering.sequence_index`` for raw rows, or
straight from the time (bucket number) for a regular series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

DEFAULT_CHUNK = 4096


def bucket_index(ts_col: str = "bucket", step_seconds: int = 300) -> Column:
    """Position of a bucket on the global step grid (regular series)."""
    return (F.unix_timestamp(F.col(ts_col)) / F.lit(step_seconds)).cast("long")


def chunked(df: DataFrame, n: int, lead: int, idx: str, chunk_rows: int) -> DataFrame:
    """Rows with their ``home`` chunk, copied into the ``chunk`` numbers that need them."""
    return _chunked(df, n, lead, idx, chunk_rows).withColumnsRenamed({"_home": "home", "_chunk": "chunk"})


def _chunked(df: DataFrame, n: int, lead: int, idx: str, chunk_rows: int) -> DataFrame:
    if chunk_rows < max(n - 1, lead, 1):
        raise ValueError("chunk_rows must be at least max(n - 1, lead)")
    c = F.lit(chunk_rows).cast("long")
    home = F.floor(F.col(idx) / c).cast("long")
    pos = F.col(idx) - home * c
    targets = F.array(
        home,
        F.when(pos >= c - (n - 1), home + 1),
        F.when(pos < lead, home - 1),
    )
    return (
        df.withColumn("_home", home)
        .withColumn("_chunk", F.explode(F.filter(targets, lambda x: x.isNotNull())))
    )


def _frame(keys, idx):
    return W.partitionBy(*keys, "_chunk").orderBy(idx)


def window_digest(
    df: DataFrame,
    n: int,
    lead: int,
    sums: dict[str, Column],
    firsts: dict[str, Column],
    label: Column | None,
    keys: tuple[str, ...] = ("sensor_id",),
    idx: str = "idx",
    carry: tuple[str, ...] = (),
    chunk_rows: int = DEFAULT_CHUNK,
) -> DataFrame:
    """One row per full window (``n`` rows, label present): the window's last
    ``idx``, ``carry`` columns of its last row, ``sums`` over the window,
    ``firsts`` (value at the window's first row) and ``label``.

    Window sums are differences of running sums (``cum(e) - cum(e - n)``):
    O(1) per row instead of re-adding ``n`` rows; exact for decimal inputs."""
    ch = _chunked(df, n, lead, idx, chunk_rows)
    w = _frame(keys, idx)
    running = w.rowsBetween(W.unboundedPreceding, 0)
    cols = [F.lag(F.col(idx), n - 1).over(w).alias("_start")]
    cols += [F.sum(expr).over(running).alias(f"_cum_{name}") for name, expr in sums.items()]
    cols += [F.lag(expr, n - 1).over(w).alias(name) for name, expr in firsts.items()]
    if label is not None:
        cols.append(F.lead(label, lead).over(w).alias("label"))
    out = ch.select(*keys, idx, "_home", "_chunk", *carry, *cols)
    w2 = _frame(keys, idx)
    out = out.select(
        "*",
        *[
            (F.col(f"_cum_{name}") - F.coalesce(F.lag(f"_cum_{name}", n).over(w2), F.lit(0).cast(out.schema[f"_cum_{name}"].dataType))).alias(name)
            for name in sums
        ],
    )
    keep = (F.col("_chunk") == F.col("_home")) & (F.col("_start") == F.col(idx) - (n - 1))
    if label is not None:
        keep = keep & F.col("label").isNotNull()
    return out.where(keep).drop("_home", "_chunk", "_start", *[f"_cum_{name}" for name in sums])


def window_arrays(
    df: DataFrame,
    n: int,
    lead: int,
    features: list[str],
    label: Column | None,
    keys: tuple[str, ...] = ("sensor_id",),
    idx: str = "idx",
    carry: tuple[str, ...] = (),
    chunk_rows: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Full windows as a flat array ``x`` of ``n * len(features)`` doubles in
    row-major order (row t, feature f at ``t * len(features) + f``), plus
    ``label``.  This is the tensor ``[n, len(features)]`` of the source.

    A chunk's rows are gathered once, in order, and a window is a slice of the
    chunk's flat array, so that a window costs one copy of its own values and
    not a frame gathered row by row.  The rows grow ``n``-fold behind the
    shuffle: its partitions keep their number, whatever their bytes."""
    ch = _chunked(df, n, lead, idx, chunk_rows)
    row = [F.col(idx).alias("_idx"), F.col("_home"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(carry))]
    row += [F.array(*[F.col(f).cast("double") for f in features]).alias("_values")]
    row += [label.alias("_label")] if label is not None else []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ch.select(*keys, "_chunk", F.struct(*row).alias("_row")).repartition(parts, *keys, "_chunk")
    chunks = chunks.groupBy(*keys, "_chunk").agg(F.sort_array(F.collect_list("_row")).alias("_rows")).sortWithinPartitions(*keys, "_chunk")
    cols = [F.flatten(F.transform("_rows", lambda r: r["_values"])).alias("_x")]
    if label is not None:
        cols.append(F.col("_rows._label").alias("_labels"))
    out = chunks.select(*keys, "_chunk", "_rows", *cols)
    out = out.select(*keys, "_chunk", *(["_labels"] if label is not None else []), "_x", F.posexplode("_rows").alias("_at", "_row"))
    keep = (F.col("_chunk") == F.col("_row._home")) & (F.col("_at") >= n - 1)
    cols = [F.col("_row._idx").alias(idx), *(F.col(f"_row._c{i}").alias(c) for i, c in enumerate(carry))]
    cols.append(F.slice("_x", (F.col("_at") - (n - 1)) * len(features) + 1, n * len(features)).alias("x"))
    if label is not None:
        cols.append(F.get("_labels", F.col("_at") + lead).alias("label"))
        keep = keep & F.get("_labels", F.col("_at") + lead).isNotNull()
    return out.where(keep).select(*keys, *cols)


def last_window(series: DataFrame, n: int, features: list[str], keys: tuple[str, ...] = ("sensor_id",), ts: str = "bucket") -> DataFrame:
    """The newest ``n`` rows of each key as one flat window ``x`` (row-major)
    with the last timestamp; a group holds at most ``n`` rows."""
    w = W.partitionBy(*keys).orderBy(F.col(ts).desc())
    newest = series.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    packed = F.struct(F.col(ts).alias("t"), F.array(*[F.col(f).cast("double") for f in features]).alias("v"))
    agg = newest.groupBy(*keys).agg(F.sort_array(F.collect_list(packed)).alias("_rows"), F.max(ts).alias("last_ts"))
    return agg.select(
        *keys,
        "last_ts",
        F.size("_rows").alias("n_rows"),
        F.flatten(F.transform("_rows", lambda r: r["v"])).alias("x"),
    )
