"""Pending work: what the newest snapshot wants and the log has not settled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.operators.keyed import join_spread, latest_per_key


def newest_snapshot(catalogue: DataFrame, dt: str = "dt") -> DataFrame:
    """Rows of the highest snapshot date (a scalar subquery; prunes partitions when dt is one)."""
    return catalogue.where(F.col(dt) == catalogue.agg(F.max(dt)).scalar())


def latest_status(
    log: DataFrame, keys: list[str], run: str = "run_id", status: str = "status"
) -> DataFrame:
    """Outcome of the highest run per key. Runs are ordered by id, not by load date."""
    return latest_per_key(log, keys, [run], [status])


def pending_work(
    catalogue: DataFrame,
    log: DataFrame,
    keys: list[str] = ["site", "primary_key", "url"],
    dt: str = "dt",
    run: str = "run_id",
    status: str = "status",
    retry: tuple[str, ...] = (fv.STATUS_ERROR,),
    limit: int | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Newest-snapshot rows never tried, or whose latest outcome is to be retried.

    A key logged as invalid is settled and does not come back. With `limit` the lowest keys are
    taken, so the same call gives the same rows.
    """
    newest = newest_snapshot(catalogue, dt)
    latest = latest_status(log, keys, run, status).select(*keys, F.col(status).alias("last_status"))
    joined = join_spread(newest, latest, keys, spread_by or newest.columns)
    found = joined.where(F.col("last_status").isNull() | F.col("last_status").isin(list(retry)))
    rest = [c for c in newest.columns if c not in keys]
    return found.orderBy(*keys, *rest).limit(limit) if limit else found


def usable_rows(rows: DataFrame, required: tuple[str, ...] = ("site", "primary_key", "url")) -> DataFrame:
    """Drops rows with a NULL or empty required column."""
    for c in required:
        rows = rows.where(F.col(c) != "")
    return rows
