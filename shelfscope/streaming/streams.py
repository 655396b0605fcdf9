"""Streams: manifests, markers, de-duplication, penalties, partition refresh."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfscope import fixed_values as fv
from shelfscope import schemas
from shelfscope.functions import urls
from shelfscope.operators import assets, backoff, verify
from shelfscope.sinks import tables as sinks


def manifest_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(key path, raw) of every manifest.json that arrives below `path`."""
    return (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json")
        .option("maxFilesPerTrigger", files_per_batch).load(path)
        .select("path", F.decode("content", "UTF-8").alias("raw"))
    )


def verify_manifests(
    spark: SparkSession, root: str, env: str, documents_path: str, markers_path: str, checkpoint: str
) -> StreamingQuery:
    """Arriving manifests -> verified documents and run markers.

    Only the data folders of the runs in the batch are listed and read.
    """
    meta, data = f"bronze/{env}/crawls/metadata/", f"bronze/{env}/crawls/"

    def batch(arrived: DataFrame, batch_id: int) -> None:
        keyed = arrived.select(F.concat(F.lit(meta), F.substring_index("path", "/" + meta, -1)).alias("key"), "raw")
        facts = verify.manifest_facts(keyed, meta).persist()
        runs = [r for r in facts.select(*verify.RUN).distinct().toLocalIterator()]
        folders = [os.path.join(root, data, r.site, r.dt, r.run_id) for r in runs]
        if folders:
            observed = verify.observed_files(spark, folders, data)
        else:
            observed = spark.createDataFrame(
                [], "site string, dt string, run_id string, file_name string, sha256 string, row_count bigint, problem string"
            )
        verified = verify.verify(facts, observed).persist()
        sinks.write_run_partitions(verify.verified_documents(verified), documents_path, ("site", "dt", "run"))
        sinks.write_markers(verify.markers(verified), markers_path)
        verified.unpersist()
        facts.unpersist()

    return (
        manifest_stream(spark, os.path.join(root, meta)).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def marker_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New _SUCCESS rows of the marker table. A batch holds so many files at most, also the first one."""
    return spark.readStream.schema(schemas.RUN_MARKER).option("maxFilesPerTrigger", files_per_batch).json(path).where(F.col("marker") == fv.MARKER_SUCCESS)


def register_on_success(
    spark: SparkSession, markers_path: str, tables: list[str], checkpoint: str
) -> StreamingQuery:
    """A run's success adds its partition to the data and document tables; repeats do nothing."""

    def batch(done: DataFrame, batch_id: int) -> None:
        partitions = done.select("site", "dt", F.col("run_id").alias("run"))
        for table in tables:
            sinks.register_partitions(spark, table, partitions)

    return (
        marker_stream(spark, markers_path).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def route_marker_events(events: DataFrame, prefix: str) -> DataFrame:
    """Event keys -> (key, status, dt, run_id, message): other keys are ignored, malformed ones are errors."""
    key = urls.decode_event_key(F.col("key"))
    run = urls.parse_marker_key(key, prefix)
    success = key.endswith(fv.MARKER_SUCCESS)
    return events.select(
        key.alias("key"),
        F.when(~success, "ignored").when(run.isNull(), "error").otherwise("ok").alias("status"),
        F.when(success, run["dt"]).alias("dt"),
        F.when(success, run["run_id"]).alias("run_id"),
        F.when(success & run.isNull(), F.concat(F.lit("Unexpected key: "), key)).alias("message"),
    )


def validate_on_success(
    spark: SparkSession, markers_path: str, log_path: str, blobs_path: str, validated_path: str, checkpoint: str
) -> StreamingQuery:
    """An image run's success validates the images of exactly that (dt, run)."""

    def batch(done: DataFrame, batch_id: int) -> None:
        runs = done.select("dt", F.col("run_id").alias("run")).distinct()
        log = spark.read.schema(schemas.IMAGE_DOWNLOAD_LOG).json(log_path).join(F.broadcast(runs), ["dt", "run"], "left_semi")
        checked = assets.validate_images(log, spark.read.parquet(blobs_path))
        sinks.write_if_any(assets.validated_rows(checked), validated_path)

    return (
        marker_stream(spark, markers_path).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def distinct_stream(rows: DataFrame, keys: list[str], event_time: str | None = None, keep: str = "1 day") -> DataFrame:
    """First row per key. With `event_time` the memory of a key ends `keep` after the watermark."""
    if event_time:
        return rows.withWatermark(event_time, keep).dropDuplicatesWithinWatermark(keys)
    return rows.dropDuplicates(keys)


def penalty_stream(
    steps: DataFrame, output_path: str, state_path: str, checkpoint: str, slice_seconds: int = 3600
) -> StreamingQuery:
    """Replays penalties (domain, ts, event_id, step) batch by batch, carrying the last penalty over.

    A keyed state operator would run all events of a busy domain through one task, in order.
    Here each batch uses the sliced replay and starts from a small state table. That table has
    two slots: batch n reads slot (n-1) % 2 and writes slot n % 2, so a repeated batch finds its
    input unchanged. Events are expected in order across batches.
    """
    spark = steps.sparkSession

    def slot(n: int) -> str:
        return os.path.join(state_path, f"slot={n % 2}")

    def batch(arrived: DataFrame, batch_id: int) -> None:
        before = spark.read.schema(schemas.STATE_TABLE).parquet(slot(batch_id - 1)) if batch_id else None
        replayed = backoff.replay(arrived, slice_seconds=slice_seconds, start=before)
        out = os.path.join(output_path, f"batch={batch_id}")
        replayed.write.mode("overwrite").parquet(out)
        last = backoff.final_penalties(spark.read.parquet(out))
        if before is not None:
            last = last.unionByName(before.join(last.select("domain"), "domain", "left_anti"))
        last.where("penalty > 0").write.mode("overwrite").parquet(slot(batch_id))

    return (
        steps.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def refresh_partitions(
    arrivals: DataFrame, source: Callable[[], DataFrame], path: str, by: tuple[str, ...], checkpoint: str
) -> StreamingQuery:
    """Partition refresh: every batch rebuilds the partitions it touches from the whole source.

    Rows of one partition may arrive in several batches; each time the partition is written in
    full, so late rows are added and a repeated batch changes nothing. `source` gives the model's
    rows as they stand now; the semi join prunes it to the touched partitions.
    """

    def batch(arrived: DataFrame, batch_id: int) -> None:
        touched = arrived.select(*by).distinct()
        sinks.write_run_partitions(source().join(touched, list(by), "left_semi"), path, by)

    return (
        arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def penalty_stream_unordered(
    steps: DataFrame, output_path: str, state_path: str, checkpoint: str, wait: str = "1 hour", slice_seconds: int = 3600
) -> StreamingQuery:
    """Replays penalties (domain, ts, event_id, step) of events that arrive in any order, `wait` late at most.

    A batch's watermark is the latest time seen so far less `wait`. Events up to it are replayed in order of time by the sliced replay, so a
    busy domain is no single task; later ones are held back in a table for the batches to come. Events older than an earlier
    batch's watermark come too late to be put in order: they go to `late` below the output. The tables have two slots as in
    `penalty_stream`, so a repeated batch finds its input unchanged. The last watermark's events stay held until later ones arrive.
    """
    spark = steps.sparkSession
    schema = "domain string, ts timestamp, event_id bigint, step bigint"

    def slot(name: str, n: int) -> str:
        return os.path.join(state_path, name, f"slot={n % 2}")

    def batch(arrived: DataFrame, batch_id: int) -> None:
        before, held, reached = None, spark.createDataFrame([], schema), None
        if batch_id:
            before = spark.read.schema(schemas.STATE_TABLE).parquet(slot("penalty", batch_id - 1))
            held = spark.read.schema(schema).parquet(slot("held", batch_id - 1))
            reached = spark.read.schema("mark timestamp").parquet(slot("mark", batch_id - 1)).first()["mark"]
        arrived = arrived.select("domain", "ts", "event_id", "step")
        late = F.lit(False) if reached is None else F.coalesce(F.col("ts") <= F.lit(reached), F.lit(False))
        newest = arrived.agg(F.max(F.col("ts") - F.expr(f"INTERVAL {wait}")).alias("mark")).first()["mark"]
        mark = max((m for m in (reached, newest) if m is not None), default=None)
        spark.createDataFrame([(mark,)], "mark timestamp").write.mode("overwrite").parquet(slot("mark", batch_id))
        arrived.where(late).write.mode("overwrite").parquet(os.path.join(output_path, "late", f"batch={batch_id}"))
        open_ = held.unionByName(arrived.where(~late))
        due = F.lit(False) if mark is None else F.col("ts") <= F.lit(mark)
        replayed = backoff.replay(open_.where(due), slice_seconds=slice_seconds, start=before)
        out = os.path.join(output_path, "rows", f"batch={batch_id}")
        replayed.write.mode("overwrite").parquet(out)
        open_.where(~due).write.mode("overwrite").parquet(slot("held", batch_id))
        last = backoff.final_penalties(spark.read.schema(replayed.schema).parquet(out))
        if before is not None:
            last = last.unionByName(before.join(last.select("domain"), "domain", "left_anti"))
        last.where("penalty > 0").write.mode("overwrite").parquet(slot("penalty", batch_id))

    return steps.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(rows: DataFrame, path: str, checkpoint: str, by: list[str] = []) -> StreamingQuery:
    """Appends every micro-batch once: one that is run again after a failure finds itself in the ledger."""

    def batch(arrived: DataFrame, batch_id: int) -> None:
        sinks.append_batch(arrived, path, f"{batch_id:012}", by)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: How partial aggregates of one kind become one.
MERGES: dict[str, Callable[[str], Column]] = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
#: Batches after which their partial aggregates are written together.
FOLDED = 16


def refresh_by_difference(arrivals: DataFrame, path: str, by: list[str], measures: dict[str, tuple[str, Column]], checkpoint: str) -> StreamingQuery:
    """Aggregates kept up to date from what arrives alone: a batch adds its partial aggregates and reads no earlier rows.

    `measures` gives each column its kind (count, sum, min or max) and its value per row. The parts of a batch overwrite their own folder, so a
    repeated batch changes nothing; every FOLDED batches their parts become one. `refreshed` merges what is there.
    """
    spark = arrivals.sparkSession
    names = {n: kind for n, (kind, _) in measures.items()}

    def batch(arrived: DataFrame, batch_id: int) -> None:
        values = arrived.select(*by, *[value.alias(n) for n, (_, value) in measures.items()])
        first = {n: F.count(n) if kind == "count" else MERGES[kind](n) for n, kind in names.items()}
        part = values.groupBy(*by).agg(*[c.alias(n) for n, c in first.items()])
        part.write.mode("overwrite").parquet(os.path.join(path, "parts", f"batch={batch_id}"))
        if batch_id % FOLDED == FOLDED - 1:
            lots = [os.path.join(path, "parts", f"batch={n}") for n in range(batch_id - FOLDED + 1, batch_id + 1)]
            folded = _merged(spark.read.schema(part.schema).parquet(*lots), by, names)
            folded.write.mode("overwrite").parquet(os.path.join(path, "folded", f"lot={batch_id // FOLDED}"))

    return arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _merged(parts: DataFrame, by: list[str], names: dict[str, str]) -> DataFrame:
    return parts.groupBy(*by).agg(*[MERGES[kind](n).alias(n) for n, kind in names.items()])


def refreshed(spark: SparkSession, path: str, by: list[str], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """The aggregates over everything that has arrived: folded lots, and the parts of batches in none."""
    read = spark.read.parquet(os.path.join(path, "parts"))
    try:
        folded = spark.read.parquet(os.path.join(path, "folded"))
    except AnalysisException:
        folded = None
    parts = read.drop("batch")
    if folded is not None:
        # a lot is written after its parts, so parts of a lot that is not there still count
        lots = folded.select("lot").distinct()
        rest = read.withColumn("lot", F.floor(F.col("batch") / FOLDED)).join(lots, "lot", "left_anti")
        parts = rest.drop("batch", "lot").unionByName(folded.drop("lot"))
    return _merged(parts, by, {n: kind for n, (kind, _) in measures.items()})
