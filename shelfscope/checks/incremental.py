"""Work that is kept up to date batch by batch: late events, bounded memory, repeated batches, partial aggregates, latest status."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks.extraction import API_PAGE_SQL, DOM_SQL, STATE_SQL, api_pages, dom_pages, state_pages
from shelfscope.checks.registry import query, table
from shelfscope.checks.work import BACKOFF_STEP, PENDING_SQL, event_log, order_catalogue, request_steps
from shelfscope.operators import products
from shelfscope.session import scratch_path
from shelfscope.sinks import tables as sinks
from shelfscope.sinks.status_store import StatusStore
from shelfscope.streaming import streams


def in_batches(rows: DataFrame, path: str, batch, batches: int) -> DataFrame:
    """A stream that gives the rows of batch 0, 1, .. one after the other; `batch` numbers the rows."""
    spark = rows.sparkSession
    for n in range(batches):
        # files are taken by time and name, one per batch
        rows.where(batch == n).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query(f"""
WITH e AS ({BACKOFF_STEP}),
s AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM e)
SELECT event_id, CAST(total - least(0, min(total) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS BIGINT) AS penalty FROM s
""")
def stream_penalty_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dealt to five batches against their order, up to eight days late, and a stop; the penalties are those of the order of time."""
    base = scratch_path(spark, "unordered")
    steps = request_steps(table(spark, sf_dir, "events"))
    # pieces of four days, of two neighbours the later one first: 1 | 0 and 3 | 2 and 5 | ..
    piece = F.floor(F.datediff("ts", F.lit("2024-01-01")) / 4)
    dealt = steps.select("*", F.floor((piece.bitwiseXOR(F.lit(1).cast("bigint")) + 1) / 2).alias("n"))
    rows = dealt.select("domain", F.col("ts").cast("timestamp").alias("ts"), "event_id", "step", "n")
    last = rows.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0] + 1
    stop = spark.createDataFrame([("end", 0, 0)], "domain string, event_id bigint, step bigint").select(
        "domain", F.lit("2100-01-01").cast("timestamp").alias("ts"), "event_id", "step", F.lit(last).cast("bigint").alias("n"))
    stream = in_batches(rows.union(stop), f"{base}/in", F.col("n"), last + 1).drop("n")
    streams.penalty_stream_unordered(stream, f"{base}/out", f"{base}/state", f"{base}/checkpoint", "8 days", 86400).awaitTermination()
    done = spark.read.option("basePath", f"{base}/out/rows").parquet(f"{base}/out/rows")
    return done.where("domain <> 'end'").select("event_id", "penalty")


#: How long a key is remembered after its first event.
MEMORY_DAYS = 3


@query(f"""
WITH RECURSIVE firsts AS (SELECT user_id, CAST(strftime(ts, '%j') AS BIGINT) AS day, min(ts) AS ts FROM events GROUP BY ALL)
, marks AS (SELECT day, lag(day, 1) OVER (ORDER BY day) AS before, lag(max(ts), 2) OVER (ORDER BY day) - INTERVAL {MEMORY_DAYS} DAYS AS mark FROM firsts GROUP BY day)
, steps AS (SELECT user_id, day, ts, mark, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM firsts JOIN marks USING (day))
, walk AS (
    SELECT user_id, day, i, ts AS kept, TRUE AS emitted FROM steps WHERE i = 1
    UNION ALL
    SELECT s.user_id, s.day, s.i, CASE WHEN w.kept + INTERVAL {MEMORY_DAYS} DAYS <= s.mark THEN s.ts ELSE w.kept END,
        coalesce(w.kept + INTERVAL {MEMORY_DAYS} DAYS <= s.mark, FALSE)
    FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.i = w.i + 1
)
SELECT user_id, day FROM walk WHERE emitted
""")
def stream_distinct_evicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that come back once their memory has ended: one batch per day, state in RocksDB with changelog checkpoints."""
    base = scratch_path(spark, "evicts")
    day = F.dayofyear("ts").cast("bigint").alias("day")
    firsts = table(spark, sf_dir, "events").groupBy("user_id", day).agg(F.min("ts").cast("timestamp").alias("ts"))
    days = sorted(r["day"] for r in firsts.select("day").distinct().collect())
    for d in days:
        firsts.where(F.col("day") == d).coalesce(1).write.mode("append").parquet(f"{base}/in")
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    kept = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.readStream.schema(firsts.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        distinct = streams.distinct_stream(rows, ["user_id"], "ts", f"{MEMORY_DAYS} days").select("user_id", "day")
        distinct.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/rows").awaitTermination()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema("user_id bigint, day bigint").parquet(f"{base}/rows")


@query("SELECT event_id, event_type, 'b' || event_id % 3 AS batch FROM events")
def replayed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: one run twice, one that was cut in half before it was run."""
    path = scratch_path(spark, "append")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    for n in (0, 1, 2):
        batch = events.where(F.col("event_id") % 3 == n)
        if n == 2:  # an attempt that wrote half of its files and never came to the ledger
            sinks.append_records(batch.where("event_id % 2 = 0"), os.path.join(path, "data", "batch=b2", "attempt=lost"), ["event_type"])
        for _ in range(2 if n == 1 else 1):
            sinks.append_batch(batch, path, f"b{n}", ["event_type"])
    return sinks.read_appended(spark, path, "event_id bigint, event_type string")


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS n_high, CAST(sum(user_id) AS BIGINT) AS users,
  min(event_id) AS low, max(event_id) AS high FROM events GROUP BY ALL
""")
def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily figures from twenty batches, each of which adds to all days; the first sixteen are folded."""
    base = scratch_path(spark, "difference")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    for n in range(20):
        events.where(F.col("event_id") % 20 == n).coalesce(1).write.mode("append").parquet(f"{base}/in")
    arrivals = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    measures = {
        "n": ("count", F.lit(1)), "n_high": ("count", F.when(F.col("value") > 50, 1)), "users": ("sum", F.col("user_id")),
        "low": ("min", F.col("event_id")), "high": ("max", F.col("event_id")),
    }
    by = ["dt", "event_type"]
    rows = arrivals.withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    streams.refresh_by_difference(rows, f"{base}/out", by, measures, f"{base}/checkpoint").awaitTermination()
    return streams.refreshed(spark, f"{base}/out", by, measures)


@query(PENDING_SQL)
def pending_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending work after seven runs that were added one by one, not in order, the second twice; folded once on the way."""
    store = StatusStore(spark, "status_" + os.path.basename(scratch_path(spark, "s")).rsplit("-", 1)[-1], ["primary_key"], 8)
    log = event_log(spark, sf_dir)
    for n in (0, 2, 1, 2, 5, 4, 3, 6):
        store.add(log.where(F.floor(F.col("run_id") / 16) % 7 == n))
    return store.pending(order_catalogue(spark, sf_dir)).select("o_orderkey", "primary_key", "last_status")


SHOWN = "site, url, country, portal_itemid, product_name, brand, category, price, currency, out_of_stock"


@query(f"""
SELECT '{fv.DOM_SITE}' AS {SHOWN} FROM ({DOM_SQL})
UNION ALL SELECT '{fv.STATE_SITE}' AS {SHOWN} FROM ({STATE_SQL})
UNION ALL SELECT '{fv.API_SITE}' AS {SHOWN} FROM ({API_PAGE_SQL})
""")
def mixed_site_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all three sites in one table, read once."""
    path = scratch_path(spark, "mixed-pages")
    made = {fv.DOM_SITE: dom_pages, fv.STATE_SITE: state_pages, fv.API_SITE: api_pages}
    for site, pages in made.items():
        pages(spark, sf_dir).select(F.lit(site).alias("site"), "url", "html").write.mode("append").parquet(path)
    found = products.mixed_products(spark.read.parquet(path), "run", "2024-02-01")
    return found.select(*SHOWN.split(", "))
