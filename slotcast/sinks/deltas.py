"""Keyed tables of sorted delta runs: a write costs what its batch costs.

``DeltaTable.write`` puts a batch into a run of its own, partitioned by date and sorted; no old file is
read or rewritten.  ``read`` merges on read: of each key the row of the latest write, and only
dates that lie in several runs are merged.  ``fold`` joins neighbouring runs of about one size into
one (size-tiered), so a table of n writes has on the order of log n runs and every row is
rewritten on the order of log n times.

A run's folder is named after the writes it holds, ``run-<first>-<last>``, and counts once Spark has committed
it (``_SUCCESS``).  A run within the range of another one is superseded and not read.
That is all the bookkeeping, so each step can be repeated after a crash: an unfinished run doesn't
count, a folded run counts from its commit on whether or not the old ones are gone, and a batch that is written
again either replaces its run or, if it has been folded, is left out.  Superseded runs are
deleted by the next fold, so a query planned before a fold still finds its files.

Rows without a time have no date and are dropped; an empty batch makes an empty run."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast import session as SS
from slotcast.operators.dedup import keep_last

FAN_IN = 4  # neighbouring runs of one tier that are folded; a tier is so many times as large as the one below
UNIT = 1 << 20  # bytes of the largest run of the lowest tier
_RUN = re.compile(r"run-(\d+)-(\d+)$")


@dataclass(frozen=True)
class Run:
    first: int
    last: int
    path: str
    size: int  # bytes

    def tier(self) -> int:
        return max(0, math.ceil(math.log(max(self.size, 1) / UNIT, FAN_IN)))

    def within(self, other: "Run") -> bool:
        return other.first <= self.first and self.last <= other.last and (self.first, self.last) != (other.first, other.last)


class DeltaTable:
    """A table keyed by ``key`` and partitioned by the date of ``ts``, one of the key's columns.

    ``order`` decides between rows of one key within a batch; the column ``write_seq`` holds the number of the write."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], order: list[str], ts: str):
        self.spark, self.path, self.order, self.ts = spark, path.rstrip("/"), ["write_seq", *order], ts
        self.key = list(dict.fromkeys([*key, "date"]))  # the date follows from the key
        self.schema = T.StructType.fromDDL(schema)

    # ---- runs

    def committed(self) -> list[Run]:
        if not SS.path_exists(self.spark, self.path):
            return []
        out = []
        for name in SS.listed(self.spark, self.path):
            found, path = _RUN.match(name), f"{self.path}/{name}"
            if found and SS.table_ready(self.spark, path):
                out.append(Run(int(found[1]), int(found[2]), path, SS.bytes_under(self.spark, path)))
        return sorted(out, key=lambda r: (r.first, -r.last))

    def runs(self) -> list[Run]:
        """The runs that count, oldest writes first."""
        every = self.committed()
        return [r for r in every if not any(r.within(x) for x in every)]

    def _dates(self, run: Run) -> set[str]:
        return {x.removeprefix("date=") for x in SS.listed(self.spark, run.path) if x.startswith("date=")}

    # ---- writes

    def write(self, batch: DataFrame, write_seq: int | None = None) -> int | None:
        """Add a batch as write ``write_seq`` (the next number if None); the number, or None if that write has been folded already."""
        runs = self.runs()
        if write_seq is None:
            write_seq = max((r.last for r in runs), default=-1) + 1
        if any(r.first <= write_seq <= r.last and r.first < r.last for r in runs):
            return None
        rows = batch.withColumn("write_seq", F.lit(write_seq).cast("long")).withColumn("date", F.to_date(self.ts))
        rows = keep_last(rows.where(F.col("date").isNotNull()).select(*self.schema.names), self.key, self.order)
        self._commit(rows, write_seq, write_seq)
        return write_seq

    def _commit(self, rows: DataFrame, first: int, last: int) -> None:
        sorted_rows = rows.hint("rebalance", "date", self.key[0]).sortWithinPartitions("date", *(k for k in self.key if k != "date"))
        sorted_rows.write.mode("overwrite").partitionBy("date").parquet(f"{self.path}/run-{first:012d}-{last:012d}")

    # ---- reads

    def _read(self, run: Run) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(run.path)

    def merged(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        if len(runs) == 1:
            return self._read(runs[0])
        held: dict[str, int] = {}
        dates = [self._dates(r) for r in runs]
        for own in dates:
            for d in own:
                held[d] = held.get(d, 0) + 1
        alone, several = [], []
        for r, own in zip(runs, dates, strict=True):
            for out, picked in ((alone, sorted(d for d in own if held[d] == 1)), (several, sorted(d for d in own if held[d] > 1))):
                if picked:
                    out.append(self._read(r).where(F.col("date").isin([F.lit(d).cast("date") for d in picked])))
        union = lambda parts: reduce(DataFrame.unionByName, parts)
        if several:
            alone.append(keep_last(union(several), self.key, self.order).select(*self.schema.names))
        return union(alone) if alone else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """One row per key, that of the latest write.  Filters on the key and the date reach the scans."""
        return self.merged(self.runs())

    def before(self, write_seq: int) -> DataFrame:
        """The table without the writes from ``write_seq`` on, whose runs must not be folded yet."""
        return self.merged([r for r in self.runs() if r.last < write_seq])

    # ---- folding

    def clean(self) -> None:
        """Delete superseded runs."""
        every = self.committed()
        for r in every:
            if any(r.within(x) for x in every):
                SS.delete(self.spark, r.path)

    def fold(self) -> int:
        """Join neighbours of one tier until no ``FAN_IN`` of them stand together; how many folds it took."""
        self.clean()
        folds = 0
        while True:
            runs = self.runs()
            picked = next((runs[i : i + FAN_IN] for i in range(len(runs) - FAN_IN, -1, -1) if len({r.tier() for r in runs[i : i + FAN_IN]}) == 1), None)
            if picked is None:
                return folds
            self._commit(self.merged(picked), picked[0].first, picked[-1].last)
            folds += 1


def changes(table: DeltaTable, write_seq: int) -> DataFrame:
    """What write ``write_seq`` changed, as retractions and additions: the table's rows with ``sign`` -1 for the old row of a key
    and 1 for the new one.  Its run must not be folded yet; a row that is written again as it was cancels out."""
    own = [r for r in table.runs() if (r.first, r.last) == (write_seq, write_seq)]
    new = table.merged(own)
    first, last = new.agg(F.min(table.ts), F.max(table.ts)).first()
    if first is None:
        return new.withColumn("sign", F.lit(1))
    held = F.col(table.ts).between(F.lit(first), F.lit(last)) & F.col("date").between(F.lit(first.date()), F.lit(last.date()))
    old = table.before(write_seq).where(held).join(new.select(*table.key), table.key, "left_semi")
    return old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1)))
