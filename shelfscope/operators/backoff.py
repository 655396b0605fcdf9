"""Replay of the per-domain penalty: +1 on a retried request, minus the decay otherwise, never below 0.

The penalty is a random walk held at zero. With S the running sum of steps it equals
S - min(0, lowest S so far), so it needs two prefix aggregates and no row-by-row loop. To keep
a busy domain off a single task the rows of a domain are cut into time slices: prefix values
are computed inside each slice (a hot slice is cut finer), slices are chained through their totals (one row per slice),
and each row then adds what came before its slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions.text import backoff_delay, parse_number
from shelfscope.operators.keyed import HOT_ROWS


def step_of(status: Column, will_retry: Column, failed: Column | None = None, decay: int = 1) -> Column:
    """+1 for a retryable status or exception that is retried; anything else decays.

    An exception that is not retried leaves the penalty alone.
    """
    failed = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    again = F.coalesce(will_retry, F.lit(False))
    return (
        F.when(failed & again, 1).when(failed, 0)
        .when(status.isin(fv.RETRY_HTTP_CODES) & again, 1).otherwise(-decay)
    )


def _sliced(steps: DataFrame, domain: str, ts: Column, slice_seconds: int, hot_rows: int) -> DataFrame:
    """Adds `_slice` and `_part`, a time slice and, where a slice is hot, one of 1024 parts of it."""
    width = slice_seconds * 1_000_000
    timed = steps.withColumn("_us", F.unix_micros(ts)).withColumn("_slice", F.floor(F.col("_us") / F.lit(width)))
    hot = (
        timed.groupBy(domain, "_slice").agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
        .select(domain, "_slice", F.lit(True).alias("_hot"))
    )
    into = F.floor((F.col("_us") - F.col("_slice") * F.lit(width)) * F.lit(1024) / F.lit(width))
    # At most N / hot_rows slices are hot, so the list is small.
    return (
        timed.join(F.broadcast(hot), [domain, "_slice"], "left")
        .withColumn("_part", F.when(F.col("_hot"), into).otherwise(F.lit(0).cast("bigint"))).drop("_us", "_hot")
    )


def replay(
    steps: DataFrame, domain: str = "domain", order: list[str] = ["ts", "event_id"], step: str = "step",
    slice_seconds: int = 3600, start: DataFrame | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds `penalty` after each row. The first `order` column is a timestamp; `order` must be total.

    `start(domain, penalty)` carries penalties over from earlier data. A slice is what one task
    sorts, and slices of a domain are chained as one row each; a slice with more than `hot_rows`
    rows is cut into finer parts. Rows need a domain.
    """
    cut = [domain, "_slice", "_part"]
    sliced = _sliced(steps, domain, F.col(order[0]).cast("timestamp"), slice_seconds, hot_rows)
    in_slice = Window.partitionBy(*cut).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumn("_sum", F.sum(F.col(step).cast("bigint")).over(in_slice)).withColumn(
        "_low", F.min("_sum").over(in_slice)
    )
    totals = local.groupBy(*cut).agg(
        F.max_by("_sum", F.struct(*order)).alias("_total"), F.min("_sum").alias("_lowest")
    )
    earlier = Window.partitionBy(domain).orderBy("_slice", "_part").rowsBetween(Window.unboundedPreceding, -1)
    chained = totals.withColumn("_base", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).withColumn(
        "_floor", F.min(F.col("_base") + F.col("_lowest")).over(earlier)
    )
    if start is None:
        chained = chained.withColumn("_first", F.lit(0).cast("bigint"))
    else:
        carried = start.select(F.col("domain").alias(domain), F.col("penalty").alias("_first"))
        chained = chained.join(carried, domain, "left").withColumn("_first", F.coalesce("_first", F.lit(0)))
    offsets = chained.select(*cut, "_base", "_floor", "_first")
    # Slices are bounded, so no key of this join dominates.
    joined = local.join(offsets, cut)
    walk = F.col("_first") + F.col("_base") + F.col("_sum")
    lowest = F.col("_first") + F.least(F.col("_base") + F.col("_low"), F.coalesce("_floor", F.col("_base") + F.col("_low")))
    return joined.withColumn("penalty", walk - F.least(F.lit(0), lowest)).drop(
        "_slice", "_part", "_sum", "_low", "_base", "_floor", "_first"
    )


def with_delay(
    replayed: DataFrame, base: float = 1.0, cap: float = 300.0, retry_after: str | None = None, step: str = "step"
) -> DataFrame:
    """Adds `delay`. On a bump a readable Retry-After value replaces the computed delay."""
    delay = backoff_delay(F.col("penalty"), base, cap)
    if retry_after:
        asked = F.when(F.col(step) > 0, parse_number(F.col(retry_after)))
        delay = F.coalesce(asked, delay)
    return replayed.withColumn("delay", delay)


def final_penalties(replayed: DataFrame, domain: str = "domain", order: list[str] = ["ts", "event_id"]) -> DataFrame:
    """Penalty of every domain after its last row."""
    return replayed.groupBy(F.col(domain).alias("domain")).agg(
        F.max_by("penalty", F.struct(*order)).alias("penalty")
    )
