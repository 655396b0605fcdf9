"""Latest per key, first wins, seen-before, and joins that survive hot keys.

A single key may hold a large share of all rows. None of these operators gathers a key's rows
in one task: latest and first are aggregates with map-side combining, and joins back to the
rows either use a unique position as the key or spread hot keys over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.session import materialize

# A key with more rows than this counts as hot. The hot-key list is small by arithmetic: N rows
# have at most N / HOT_ROWS such keys (100,000 for a trillion rows), so broadcasting it is safe.
HOT_ROWS = 10_000_000


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """One row per key: the payload of the highest `order`.

    An aggregate, not a window: each map task sends one row per key, however many it has read.
    Equal `order` values fall back to the payload itself, so the result is always the same.
    """
    newest = F.max(F.struct(*order, *payload)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"newest.{c}").alias(c) for c in [*order, *payload]])


def join_spread(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """rows JOIN lookup ON keys, where `lookup` has one row per key and `rows` may have hot keys.

    Hot keys are found by a counting aggregate; the rows of each are spread over one part per `hot_rows` of its own
    rows, by a hash of `spread_by` (columns that differ inside a key), and its lookup row is copied that
    often. Other keys are joined as usual. NULL keys match nothing and need no spreading.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    hot = (
        rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    part = F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    left = rows.join(F.broadcast(hot), keys, "left").withColumn("_part", part).drop("_parts")
    right = lookup.join(F.broadcast(hot), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")


def keep_keys(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the distinct `keys`, and no others, at any number of keys.

    The keys are written first, so the planner knows their size: a list below its broadcast threshold goes
    to the rows, which then stay where they are read; a longer one is joined by a shuffle.
    """
    return rows.join(materialize(keys.select(on).distinct(), "wanted-keys"), on, "left_semi")


def first_wins(rows: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """Adds `is_first`: true for the row with the lowest `position` of its key.

    `position` must be unique inside a key (for lines: file, line number). The winners, one per
    key, are joined back on key and position together, which no two rows share: a key with
    billions of copies is no heavier than any other. Rows with a NULL key are never first.
    """
    winners = (
        rows.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys)
        .agg(F.min(F.struct(*position)).alias("w"))
        .select(*keys, *[F.col(f"w.{c}").alias(c) for c in position if c not in keys], F.lit(True).alias("_won"))
    )
    return (
        rows.join(winners, [*keys, *[c for c in position if c not in keys]], "left")
        .withColumn("is_first", F.coalesce(F.col("_won"), F.lit(False)))
        .drop("_won")
    )


def not_seen(
    rows: DataFrame, seen: DataFrame, key: str, seen_key: str | Column | None = None, unique: bool = False
) -> DataFrame:
    """Rows whose key is not among the seen keys; rows with a NULL key stay.

    `unique` says that `rows` has each key once; otherwise hot keys are spread over tasks.
    """
    seen_col = seen_key if isinstance(seen_key, Column) else F.col(seen_key or key)
    keys = seen.select(seen_col.alias(key)).where(F.col(key).isNotNull()).distinct()
    return rows.join(keys, key, "left_anti") if unique else join_spread(rows, keys, [key], rows.columns, "left_anti")


def first_rows(rows: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """First n rows of every group. The rank filter is applied before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("row_no", rank).where(F.col("row_no") <= n)
