"""Latest status per key as bucketed tables: runs are added as small parts and folded into a base from time to time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.operators.keyed import latest_per_key
from shelfscope.operators.pending import newest_snapshot

#: Parts that are kept beside the base before they are folded into it.
PARTS = 4


class StatusStore:
    """Tables `<name>_<n>` of (keys, run, status), all in the same buckets of the keys, one row per key each.

    Adding a run shuffles that run only. Folding joins the parts, which are
    short, and moves what comes out to the base, which stays. Other rows are joined with one table after the other and are all that moves. `names` are the tables in use, the base first; an object made later is given them.
    """

    def __init__(
        self, spark: SparkSession, name: str, keys: list[str], buckets: int, run: str = "run_id", status: str = "status", names: list[str] | None = None
    ):
        self.spark, self.name, self.keys, self.buckets, self.run, self.status = spark, name, keys, buckets, run, status
        self.names, self.made = list(names or []), len(names or [])

    def _write(self, rows: DataFrame) -> str:
        table, self.made = f"{self.name}_{self.made}", self.made + 1
        rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).format("parquet").mode("overwrite").saveAsTable(table)
        return table

    def add(self, log: DataFrame) -> None:
        """The log rows of a run, or of several; runs may be added in any order and repeatedly. Rows with a NULL key are left out."""
        usable = log.where(" AND ".join(f"{k} IS NOT NULL" for k in self.keys))
        latest = latest_per_key(usable, self.keys, [self.run], [self.status])
        self.names.append(self._write(latest.repartition(self.buckets, *self.keys)))
        if len(self.names) > PARTS + 1:
            self.fold()

    def fold(self) -> None:
        """One table again. The old ones are dropped when the new one is written."""
        new = self._write(self.latest())
        for old in self.names:
            self.spark.sql(f"DROP TABLE {old}")
        self.names = [new]

    def latest(self) -> DataFrame:
        """(keys, run, status) of the highest run over all tables."""
        base, *parts = (self.spark.table(t) for t in self.names)
        return self._newer(base, reduce(self._newer, parts)) if parts else base.select(*self.keys, self.run, self.status)

    def _newer(self, a: DataFrame, b: DataFrame) -> DataFrame:
        sides = [rows.select(*self.keys, F.struct(self.run, self.status).alias(f"_{i}")) for i, rows in enumerate((a, b))]
        best = F.greatest("_0", "_1")
        return sides[0].join(sides[1], self.keys, "full").select(*self.keys, best[self.run].alias(self.run), best[self.status].alias(self.status))

    def pending(self, catalogue: DataFrame, dt: str = "dt", retry: tuple[str, ...] = (fv.STATUS_ERROR,)) -> DataFrame:
        """Newest-snapshot rows never tried, or whose latest outcome is to be retried, with `last_status`; as `pending_work`."""
        rows = newest_snapshot(catalogue, dt)
        if not self.names:
            return rows.withColumn("last_status", F.lit(None).cast("string"))
        columns = rows.columns
        for i, table in enumerate(self.names):
            rows = rows.join(self.spark.table(table).select(*self.keys, F.struct(self.run, self.status).alias(f"_known_{i}")), self.keys, "left")
        known = [F.col(f"_known_{i}") for i in range(len(self.names))]
        best = F.greatest(*known) if len(known) > 1 else known[0]
        last: Column = F.col("last_status")
        return rows.select(*columns, best[self.status].alias("last_status")).where(last.isNull() | last.isin(list(retry)))
