"""Stored pages followed from a seed list until nothing new is found."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.session import materialize


class SeenRuns:
    """Addresses seen so far, as runs in the shared folder.

    A batch is anti-joined with every run and then becomes the newest one. A run is merged with the next older while that
    is no longer than twice its length, so n addresses lie in about log n runs and each is rewritten about log n times.
    """

    def __init__(self, column: str):
        self.column, self.runs = column, []

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows (each address once) that no run holds."""
        for run, _ in reversed(self.runs):
            rows = rows.join(run, self.column, "left_anti")
        return rows

    def seen(self, rows: DataFrame) -> DataFrame:
        """Rows whose address is in a run; no address is in two."""
        found = [rows.join(run, self.column, "left_semi") for run, _ in self.runs]
        return reduce(DataFrame.union, found) if found else rows.limit(0)

    def add(self, rows: DataFrame) -> None:
        """Adds addresses that `unseen` let through; `rows` is a written table."""
        run, length = rows.select(self.column), rows.count()
        if not length:
            return
        while self.runs and self.runs[-1][1] <= 2 * length:
            older, more = self.runs.pop()
            run, length = materialize(run.union(older), "seen-run"), length + more
        self.runs.append((run, length))


def follow_pages(
    seeds: DataFrame, stored: DataFrame, expand: Callable[[DataFrame], DataFrame], url: str = "url", final_url: str | None = None,
    rounds: int | None = None,
) -> DataFrame:
    """(url, round, opened): every address that is asked for, in which round, and whether its stored page was expanded.

    Round 0 asks for the seeds. Each round reads the stored pages of the newest addresses only, `expand` turns them into rows with
    `found_url`, and those not seen before are asked for in the next. It ends when nothing is new, or after `rounds` rounds. Cycles
    and pages that everything links to cost nothing: an address enters once. No list of addresses passes the driver.

    `stored` may hold several rows of one address; all are expanded. With `final_url`, where the answer came from (NULL: from
    the address itself): an address whose answer came from one that was asked for or reached before is not opened; of several
    with the same new one the smallest is. What was reached counts as seen. NULL addresses are left out.
    """
    seen, parts, number = SeenRuns("url"), [], 0
    new = materialize(seeds.select(F.col(url).alias("url")).where("url is not null").distinct(), "frontier")
    while not new.isEmpty():
        seen.add(new)
        pages = stored.withColumnRenamed(url, "url").join(new, "url", "left_semi")
        if final_url:
            targets = materialize(
                pages.select("url", F.col(final_url).alias("target")).where("target is not null and target <> url").distinct()
                .withColumnRenamed("url", "asked").withColumnRenamed("target", "url"), "redirects",
            )
            known = seen.seen(targets).select("asked", "url")
            first = targets.join(known.select("url").distinct(), "url", "left_anti").groupBy("url").agg(F.min("asked").alias("asked"))
            first = materialize(first, "first-redirects")
            closed = materialize(targets.join(first, ["asked", "url"], "left_anti").select(F.col("asked").alias("url")).distinct(), "closed")
            pages = pages.join(closed, "url", "left_anti").withColumn("url", F.coalesce(final_url, "url"))
            moved = first.select("asked", F.col("url").alias("reached"))
            opened = new.join(stored.select(F.col(url).alias("url")).distinct(), "url", "left_semi").join(closed, "url", "left_anti")
            seen.add(moved.select(F.col("reached").alias("url")))
        else:
            opened = new.join(stored.select(F.col(url).alias("url")), "url", "left_semi")
        parts.append(new.join(opened.withColumn("opened", F.lit(True)), "url", "left").select(
            "url", F.lit(number).alias("round"), F.coalesce("opened", F.lit(False)).alias("opened")))
        number += 1
        if rounds is not None and number >= rounds:
            break
        found = expand(pages).select(F.col("found_url").alias("url")).where("url is not null").distinct()
        new = materialize(seen.unseen(found), "frontier")
    return reduce(DataFrame.union, parts) if parts else new.select("url", F.lit(0).alias("round"), F.lit(False).alias("opened"))
