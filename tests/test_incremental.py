"""Stores and streams that are kept up to date: replays, late events, plans."""

import random

from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope import schemas
from shelfscope.operators import pending, products
from shelfscope.sinks import tables as sinks
from shelfscope.sinks.status_store import PARTS, StatusStore
from shelfscope.streaming import streams

STEPS = "domain string, ts timestamp, event_id long, step long"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def log_of(spark, rows):
    return spark.createDataFrame(rows, "site string, primary_key string, run_id string, status string")


def test_status_store_equals_the_whole_log(spark):
    pick = random.Random(8)
    runs = [[(pick.choice("ab"), pick.choice([str(i) for i in range(30)] + [None]), f"r{n:02}", pick.choice(["ok", "error"])) for _ in range(25)] for n in range(12)]
    keys = ["site", "primary_key"]
    store = StatusStore(spark, "store_a", keys, 4)
    order = [*range(12), 3]
    pick.shuffle(order)
    for n in order:
        store.add(log_of(spark, runs[n]))
        assert len(store.names) <= PARTS + 1
    log = log_of(spark, [r for run in runs for r in run if r[1] is not None])
    assert {tuple(r) for r in store.latest().collect()} == {tuple(r) for r in pending.latest_status(log, keys).collect()}
    catalogue = spark.createDataFrame(
        [(s, str(i), d) for s in "abc" for i in range(40) for d in ("1", "2") if (i + (d == "1")) % 3] + [("a", None, "2")], "site string, primary_key string, dt string"
    )
    found = store.pending(catalogue)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in pending.pending_work(catalogue, log, keys, spread_by=["dt"]).select(*found.columns).collect()}
    again = StatusStore(spark, "store_a", keys, 4, names=store.names)
    assert again.pending(catalogue).count() == found.count()


def test_only_the_catalogue_is_shuffled(spark):
    store = StatusStore(spark, "store_b", ["primary_key"], 8)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for n in range(3):
            store.add(log_of(spark, [("a", str(i), f"r{n}", "ok") for i in range(50)]))
        # the two parts are joined where they lie, and only they move to the base
        assert plan_of(store.latest()).count("Exchange hashpartitioning") == 1
        catalogue = spark.createDataFrame([(str(i), "1") for i in range(60)], "primary_key string, dt string")
        assert plan_of(store.pending(catalogue)).count("Exchange hashpartitioning") == 1
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_store_without_runs(spark):
    catalogue = spark.createDataFrame([("1", "1"), ("2", "2")], "primary_key string, dt string")
    assert [tuple(r) for r in StatusStore(spark, "store_c", ["primary_key"], 2).pending(catalogue).collect()] == [("2", "2", None)]


def test_appended_once(spark, tmp_path):
    path, rows = str(tmp_path / "a"), spark.createDataFrame([(1, "x"), (2, None)], "i long, k string")
    assert sinks.append_batch(rows, path, "one") and not sinks.append_batch(rows, path, "one")
    sinks.append_records(rows, f"{path}/data/batch=two/attempt=lost")
    (tmp_path / "a" / "ledger" / "two.json.cut.tmp").write_text('{"batch": "two", "attem')
    read = sinks.read_appended(spark, path, "i long, k string")
    assert sorted(tuple(r) for r in read.collect()) == [(1, "x", "one"), (2, None, "one")]
    assert sinks.append_batch(rows.limit(1), path, "two")
    assert sinks.read_appended(spark, path, "i long, k string").count() == 3


def test_append_stream_whose_checkpoint_is_lost(spark, tmp_path):
    rows = spark.createDataFrame([(i,) for i in range(10)], "i long")
    rows.write.parquet(str(tmp_path / "in"))
    for turn in range(2):
        source = spark.readStream.schema("i long").parquet(str(tmp_path / "in"))
        streams.append_stream(source, str(tmp_path / "out"), str(tmp_path / f"cp{turn}")).awaitTermination()
    assert sinks.read_appended(spark, str(tmp_path / "out"), "i long").count() == 10


def test_penalties_of_unordered_and_late_events(spark, tmp_path):
    pick = random.Random(2)
    events = [(d, 60 * i, 2 * i + (d == "b"), pick.choice([1, 1, -1, -2])) for i in range(60) for d in "ab"]
    batches = [[], [], [], []]
    for e in events:
        batches[min(3, (e[1] + pick.randrange(-600, 600)) // 1000 if e[1] > 600 else 0)].append(e)
    late = ("a", 30, 1000, 1)
    batches[3].append(late)
    batches.append([("stop", 10**7, 5000, 0)])
    for batch in batches:
        pick.shuffle(batch)
        frame = spark.createDataFrame(batch, "domain string, t long, event_id long, step long")
        frame.select("domain", F.timestamp_seconds("t").alias("ts"), "event_id", "step").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(STEPS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.penalty_stream_unordered(source, str(tmp_path / "out"), str(tmp_path / "s"), str(tmp_path / "cp"), "30 minutes", 600).awaitTermination()
    got = {r["event_id"]: r["penalty"] for r in spark.read.parquet(str(tmp_path / "out" / "rows")).collect()}
    want, at = {}, {}
    for d, _, i, s in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        at[d] = max(0, at.get(d, 0) + s)
        want[i] = at[d]
    assert got == want
    assert [r["event_id"] for r in spark.read.parquet(str(tmp_path / "out" / "late")).collect()] == [1000]


def test_differences_merge_with_and_without_folds(spark, tmp_path):
    by, measures = ["k"], {"n": ("count", F.col("v")), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    rows = [(i % 3 if i % 7 else None, i if i % 5 else None, i % 18) for i in range(200)]
    frame = spark.createDataFrame(rows, "k long, v long, b long")
    done = 0
    for upto in (3, 18):
        for n in range(done, upto):
            frame.where(F.col("b") == n).select("k", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        done = upto
        source = spark.readStream.schema("k long, v long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        streams.refresh_by_difference(source, str(tmp_path / "out"), by, measures, str(tmp_path / "cp")).awaitTermination()
        got = {tuple(r) for r in streams.refreshed(spark, str(tmp_path / "out"), by, measures).collect()}
        want = frame.where(F.col("b") < upto).groupBy("k").agg(F.count("v"), F.sum("v"), F.min("v"), F.max("v"))
        assert got == {tuple(r) for r in want.collect()}
    assert (tmp_path / "out" / "folded" / "lot=0").exists()


def test_mixed_pages_are_scanned_and_parsed_once(spark, tmp_path):
    dom = ("https://www.farfetch.com/ae/shopping/women/bag-item-7.aspx", "<p data-testid='product-short-description'>Bag</p>")
    pages = [(fv.DOM_SITE, *dom), (fv.DOM_SITE, "https://www.farfetch.com/ae/shopping/women/items.aspx", dom[1]), (fv.STATE_SITE, *dom), ("other", *dom), (None, *dom), (fv.API_SITE, "https://www.levelshoes.com/x-red.html", None)]
    spark.createDataFrame(pages, "site string, url string, html string").write.parquet(str(tmp_path / "p"))
    found = products.mixed_products(spark.read.parquet(str(tmp_path / "p")), "run", "2024-02-01")
    assert found.columns == [p.split()[0] for p in schemas.PRODUCT.split(", ")]
    assert sorted((r["site"], r["product_name"]) for r in found.collect() if r["site"] == fv.DOM_SITE) == [(fv.DOM_SITE, "Bag")]
    assert {r["site"] for r in found.collect()} == {fv.DOM_SITE, fv.API_SITE}
    assert plan_of(found).count("FileScan") <= 2 and "Union" not in plan_of(found)


def test_extractors_by_site_give_the_same(spark):
    page = ("https://www.farfetch.com/ae/shopping/women/bag-item-7.aspx", "<p data-testid='product-short-description'>Bag</p>")
    one = spark.createDataFrame([page], "url string, html string")
    mixed = products.mixed_products(one.withColumn("site", F.lit(fv.DOM_SITE)), "run", "2024-02-01").collect()
    assert mixed == products.extract_products(one, fv.DOM_SITE, "run", "2024-02-01").collect()


def test_streams_over_nothing(spark, tmp_path):
    frame = spark.createDataFrame([], STEPS)
    frame.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(STEPS).parquet(str(tmp_path / "in"))
    streams.penalty_stream_unordered(source, str(tmp_path / "o"), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert not (tmp_path / "o").exists() or spark.read.schema(STEPS).parquet(str(tmp_path / "o" / "rows")).count() == 0
