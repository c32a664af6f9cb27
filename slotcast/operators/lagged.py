"""Second moments of sliding windows from lagged products, without building the windows.

Take a series of rows ``v[t]`` (some columns and a constant 1) and its windows of ``n + 1`` rows, one
for each start ``s`` of a set ``S`` of runs of consecutive starts.  The moment of places ``i`` and ``j``
is ``G[i, j] = sum over s in S of v[s + i] v[s + j]'``.  Two facts make it cheap:

* the first row, ``G[0, j]``, is a sum of products at lag ``j`` over all starts, which adds up over chunks
  of the series: ``(n + 1) * columns ** 2`` numbers per chunk whatever its length;
* each other entry is its diagonal neighbour plus one edge term per end of a run,
  ``G[i + 1, j + 1] = G[i, j] - v[A + i] v[A + j]' + v[B + i] v[B + j]'`` for the run of starts A .. B - 1, as
  all inner terms cancel.  So beside the lag sums only ``n`` rows at each end of a run are needed.

Both are sums, so Spark merges them in any order.  A chunk holds ``chunk_rows + n + 1`` rows at most, and gives
``(n + 1) * columns ** 2`` numbers instead of ``chunk_rows * n * columns``.

Rows with a null value take no part in sums (they count as zeros); keys may repeat over groups;
a series without a window gives no statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.operators.sequences import DEFAULT_CHUNK, chunked

SUMS = "part string, kind string, place int, products array<double>"


def _lists(flat: np.ndarray, size: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) // size + 1) * size, pa.int32()), pa.array(flat))


def _chunk_sums(table: pa.Table, n: int, width: int) -> pa.Table:
    """Lag sums of the window starts of one chunk, and the n rows at each end of a run of starts that lies in it."""
    table = table.sort_by("idx")
    v = np.column_stack([*(np.nan_to_num(table.column(f"v{i}").to_numpy()) for i in range(width - 1)), np.ones(len(table))])
    home = table.column("home").to_numpy() == table.column("chunk").to_numpy()
    part = table.column("part").to_pylist()
    before = [None, *part[:-1]]  # a chunk brings the row before its own
    totals: dict[str, np.ndarray] = {}
    edges: list[tuple[str, str, np.ndarray]] = []
    changes = [i for i in np.flatnonzero(home).tolist() if part[i] != before[i]]
    for i in changes:
        edges += [(p, sign, v[i : i + n].ravel()) for p, sign in ((before[i], "edge+"), (part[i], "edge-")) if p is not None]
    own = np.flatnonzero(home)
    cuts = sorted({int(own[0]), *changes, int(own[-1]) + 1}) if len(own) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if part[a] is not None:
            total = totals.setdefault(part[a], np.zeros((n + 1, width, width)))
            for lag in range(n + 1):
                total[lag] += v[a:b].T @ v[a + lag : b + lag]
    k = len(totals)
    sums = np.concatenate([x.ravel() for x in totals.values()]) if totals else np.zeros(0)
    ends = np.concatenate([e for _, _, e in edges]) if edges else np.zeros(0)
    lags = pa.table({"part": pa.array(np.repeat(np.array(list(totals), object), n + 1), pa.string()), "kind": pa.array(["lag"] * (k * (n + 1)), pa.string()), "place": pa.array(np.tile(np.arange(n + 1), k), pa.int32()), "products": _lists(sums, width * width)})
    rows = pa.table({"part": pa.array([p for p, _, _ in edges], pa.string()), "kind": pa.array([s for _, s, _ in edges], pa.string()), "place": pa.array([0] * len(edges), pa.int32()), "products": _lists(ends, n * width)})
    return pa.concat_tables([lags, rows])


def _added(batches, size: tuple[int, int]):
    """Sums per (part, kind, place) of a task's rows; edges e become the rows of the sum of ``+- e e'``."""
    totals: dict[tuple, np.ndarray] = {}
    for b in batches:
        lists = b.column("products")
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        at = at - at[0] if len(at) else at
        kinds, parts = np.array(b.column("kind").to_pylist(), object), np.array(b.column("part").to_pylist(), object)
        for p in set(parts.tolist()):
            for kind, sign in (("edge+", 1.0), ("edge-", -1.0)):
                rows = np.flatnonzero((kinds == kind) & (parts == p))
                if len(rows):
                    e = np.array([flat[at[r] : at[r + 1]] for r in rows])
                    totals[p, "edge", None] = totals.get((p, "edge", None), 0) + sign * (e.T @ e)
        for r in np.flatnonzero((kinds == "lag") | (kinds == "edge")).tolist():
            k = (parts[r], kinds[r], b.column("place")[r].as_py())
            totals[k] = totals.get(k, 0) + flat[at[r] : at[r + 1]]
    for p, kind, place in [k for k in totals if k[2] is None]:
        for i, row in enumerate(totals.pop((p, kind, place))):
            totals[p, kind, i] = totals.get((p, kind, i), 0) + row
    for kind, length in (("lag", size[0]), ("edge", size[1])):
        own = [k for k in totals if k[1] == kind]
        flat = np.concatenate([totals[k] for k in own]) if own else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in own], pa.string()), pa.array([kind] * len(own), pa.string()), pa.array([k[2] for k in own], pa.int32()), _lists(flat, length)], ["part", "kind", "place", "products"])


def window_sums(rows: DataFrame, n: int, values: list[Column], part: Column, key: str = "sensor_id", idx: str = "idx", chunk_rows: int = DEFAULT_CHUNK) -> DataFrame:
    """(part, kind, place, products) from one pass over ``rows``: of kind ``lag`` the flat ``v[s] v[s + place]'`` summed over the
    window starts of a part (places 0 .. n), of kind ``edge`` row ``place`` of the signed edge sums.

    ``rows`` holds consecutive positions ``idx`` for each key; ``part`` names the part of the window that starts at a row,
    null where none starts, and a window that starts has n more rows after it."""
    width = len(values) + 1
    taken = rows.select(key, F.col(idx).alias("idx"), part.alias("part"), *(v.cast("double").alias(f"v{i}") for i, v in enumerate(values)))
    pieces = chunked(taken, 2, n, "idx", chunk_rows)
    found = pieces.groupBy(key, "chunk").applyInArrow(lambda table: _chunk_sums(table, n, width), SUMS)
    size = (width * width, n * width)
    once = found.mapInArrow(lambda batches: _added(batches, size), SUMS)  # a row per task and key crosses the shuffle
    return once.repartition("part", "kind", "place").mapInArrow(lambda batches: _added(batches, size), SUMS)


def moments(lags: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """G as a matrix of ``(n + 1) * width`` rows from the lag sums (n + 1, width * width) and the signed edge sums
    (n * width square)."""
    n = len(lags) - 1
    g = np.zeros((n + 1, width, n + 1, width))
    first = lags.reshape(n + 1, width, width)
    g[0] = first.transpose(1, 0, 2)
    g[:, :, 0] = first.transpose(0, 2, 1)
    e = edges.reshape(n, width, n, width)
    for i in range(n):
        g[i + 1, :, i + 1 :] = g[i, :, i:n] + e[i, :, i:]
        g[i + 1 :, :, i + 1] = g[i + 1, :, i + 1 :].transpose(1, 2, 0)
    return g.reshape((n + 1) * width, -1)
