"""Images, content store, penalties, streams over them."""

import struct
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfscope import schemas
from shelfscope.functions import images
from shelfscope.operators import assets, backoff
from shelfscope.plans import image_run
from shelfscope.sinks import tables as sinks
from shelfscope.streaming import streams


def png(width, height):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + b"\0" * 3 * width for _ in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


JPEG_HEAD = b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + b"\0" * 9 + b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, 30, 40, 3) + b"\0" * 9
SCAN = b"\xff\xda" + struct.pack(">H", 12) + b"\3" + b"\0" * 9
JPEG = JPEG_HEAD + SCAN + b"ab\xff\0c\xff\xd3d" + b"\xff\xff\xc4\0\4xy" + SCAN + b"e" + b"\xff\xd9" + b"rest"
GIF = b"GIF89a" + struct.pack("<HH", 12, 13) + b"\x81\0\0" + b"\0" * 12 + b"!\xf9\4\0\0\0\0\0" + b"," + b"\0" * 8 + b"\x80" + b"\0" * 6 + b"\2\3abc\1d\0;"


def webp(*chunks):
    body = b"WEBP" + b"".join(kind + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2) for kind, data in chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def box(kind, *parts):
    body = kind + b"".join(parts)
    return struct.pack(">I", len(body) + 4) + body


VP8L = b"\x2f" + (49 | 59 << 14).to_bytes(4, "little") + b"data"
VP8 = (2 << 5).to_bytes(3, "little") + b"\x9d\x01\x2a" + struct.pack("<HH", 50, 60) + b"dd"
CANVAS = b"\0" * 4 + (49).to_bytes(3, "little") + (59).to_bytes(3, "little")
WEBP = webp((b"VP8X", CANVAS), (b"VP8L", VP8L))
FRAMES = webp((b"VP8X", CANVAS), (b"ANMF", b"\0" * 16 + b"VP8 " + struct.pack("<I", len(VP8)) + VP8))


def avif(large=False):
    size = box(b"ispe", b"\0" * 4, struct.pack(">II", 70, 80))
    properties = box(b"iprp", box(b"ipco", size), box(b"ipma", b"\0\0\0\1", struct.pack(">IHBH", 1, 3, 1, 0x8001)))
    head = box(b"ftyp", b"avif\0\0\0\0")

    def meta(start):
        place = box(b"iloc", b"\1\0\0\0\x44\0", struct.pack(">HHHHHII", 1, 3, 0, 0, 1, start, 5))
        return box(b"meta", b"\0" * 4, box(b"pitm", b"\0" * 4, b"\0\3"), place, properties)

    data = struct.pack(">I4sQ", 1, b"mdat", 21) + b"coded" if large else box(b"mdat", b"coded")
    return head + meta(len(head + meta(0)) + len(data) - 5) + data


AVIF = avif()


def test_every_cut_image_is_broken():
    wholes = {"png": png(20, 12), "jpeg": JPEG[:-4], "gif": GIF, "webp": WEBP, "avif": AVIF}
    for name, data in [*wholes.items(), ("webp", webp((b"VP8 ", VP8))), ("webp", FRAMES), ("avif", avif(large=True))]:
        assert images._probe(data)[0] == name and images._probe(data)[3] is None
        for length in range(len(data)):
            assert images._probe(data[:length])[3], (name, length)
    assert images._probe(JPEG_HEAD + b"\xff\xd9")[3] and images._probe(GIF[:25] + b";")[3] and images._probe(webp((b"VP8X", CANVAS)))[3]
    assert images._probe(JPEG[:2] + SCAN + b"\xff\xd9")[3] and images._probe(WEBP.replace(b"VP8L/", b"VP8L."))[3] is None


def test_image_headers(spark):
    cases = [(png(20, 12), "png", 20, 12), (JPEG, "jpeg", 40, 30), (GIF, "gif", 12, 13), (WEBP, "webp", 50, 60), (AVIF, "avif", 70, 80)]
    frame = spark.createDataFrame([(i, bytearray(c[0])) for i, c in enumerate(cases)], "i int, content binary")
    got = frame.select("i", images.image_info(F.col("content")).alias("info")).orderBy("i").collect()
    assert [(r["info"]["format"], r["info"]["width"], r["info"]["height"]) for r in got] == [c[1:] for c in cases]
    broken = [png(20, 12)[:50], png(20, 12)[:-20], b"<html>", b"", JPEG[:10], png(20, 12).replace(b"IDAT", b"IDAX"), None]
    frame = spark.createDataFrame([(bytearray(b) if b is not None else None,) for b in broken], "content binary")
    assert frame.where(images.image_info(F.col("content"))["problem"].isNull()).count() == 0


@pytest.fixture
def image_world(spark, tmp_path):
    """Two pending images with stored responses, run through the whole image run."""
    catalogue = spark.createDataFrame([("ounass", str(i), f"i.example/{i}.png", "2024-01-01") for i in range(5)], "site string, primary_key string, url string, dt string")
    log = spark.createDataFrame([], "site string, primary_key string, url string, run_id string, status string")
    content = {0: png(20, 12), 1: png(9, 50), 2: png(20, 12), 3: b"<html>"}
    responses = spark.createDataFrame([(f"https://i.example/{i}.png", 200, "image/png", bytearray(c), None, None) for i, c in content.items()], schemas.IMAGE_RESPONSE)
    paths = {n: str(tmp_path / n) for n in ("log", "markers", "blobs", "validated", "cp")}
    written = image_run.run_images(catalogue, log, responses, "run-1", "2024-01-02", paths["log"], paths["markers"], "by-hash")
    assert {r["primary_key"]: r["status"] for r in written.collect()} == {"0": "ok", "1": "ok", "2": "ok", "3": "ok", "4": "error"}
    sinks.store_contents(responses, "url", None, paths["blobs"], "by-hash", ".png")
    assert spark.read.parquet(paths["blobs"]).count() == 3  # 0 and 2 are the same bytes
    return paths


def test_image_run_and_validation(spark, image_world):
    blobs = spark.read.parquet(image_world["blobs"])
    counters = image_run.validate_run(spark, image_world["log"], blobs, "2024-01-02", "run-1", image_world["validated"])
    assert {r["outcome"]: r["n"] for r in counters.collect()} == {"ok": 2, "rejected": 2}
    rows = spark.read.schema(schemas.IMAGE_VALIDATED).json(image_world["validated"])
    assert {(r["primary_key"], r["width"], r["height"], r["dt"]) for r in rows.collect()} == {("0", 20, 12, "2024-01-02"), ("2", 20, 12, "2024-01-02")}
    shared = assets.shared_contents(rows.select("sha256", "primary_key"), "primary_key")
    assert {tuple(r[1:]) for r in shared.collect()} == {("0", 2), ("2", 2)}
    lost = image_run.validate_run(spark, image_world["log"], blobs.limit(0), "2024-01-02", "run-1", image_world["validated"] + "-none")
    assert {r["outcome"]: r["n"] for r in lost.collect()} == {"fetch_error": 4}


def test_new_marker_starts_a_pending_retry(spark, image_world):
    log = spark.read.schema(schemas.IMAGE_DOWNLOAD_LOG).json(image_world["log"])
    catalogue = log.select("site", "primary_key", "url", F.lit("2024-01-03").alias("dt"))
    from shelfscope.operators.pending import pending_work

    assert [r["primary_key"] for r in pending_work(catalogue, log).collect()] == ["4"]
    assert spark.read.schema(schemas.RUN_MARKER).json(image_world["markers"]).first()["marker"] == "_FAILED"


def fold(steps, start=0):
    """Row-by-row penalty, the plain definition."""
    out, p = [], start
    for s in steps:
        p = max(0, p + s)
        out.append(p)
    return out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 20000), st.sampled_from([1, 0, -1, -2])), min_size=1, max_size=60), st.sampled_from([60, 3600, 86400]), st.integers(0, 3), st.sampled_from([3, 10_000]))
def test_replay_matches_fold(spark, rows, width, start, hot):
    rows = sorted((t, i, s) for i, (t, s) in enumerate(rows))
    frame = spark.createDataFrame([("d", t, i, s) for t, i, s in rows], "domain string, t long, event_id long, step long")
    frame = frame.select("domain", F.timestamp_seconds("t").alias("ts"), "event_id", "step")
    first = spark.createDataFrame([("d", start)], schemas.STATE_TABLE)
    got = {r["event_id"]: r["penalty"] for r in backoff.replay(frame, slice_seconds=width, start=first, hot_rows=hot).collect()}
    assert [got[i] for _, i, _ in rows] == fold([s for _, _, s in rows], start)


def test_step_rules(spark):
    cases = [(503, True, False, 1), (503, False, False, -1), (404, True, False, -1), (200, None, None, -1), (None, True, True, 1), (None, False, True, 0)]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, status int, again boolean, failed boolean, want int")
    assert frame.where(backoff.step_of(F.col("status"), F.col("again"), F.col("failed")) != F.col("want")).count() == 0


def test_retry_after_replaces_the_delay(spark):
    frame = spark.createDataFrame([(1, 1, "90"), (2, -1, "90"), (2, 1, "x")], "penalty long, step long, header string")
    assert [r["delay"] for r in backoff.with_delay(frame, retry_after="header").collect()] == [90.0, 2.0, 2.0]


def test_penalty_stream_carries_state(spark, tmp_path):
    schema = "domain string, ts timestamp, event_id long, step long"
    source, out = str(tmp_path / "in"), {n: str(tmp_path / n) for n in ("rows", "state", "cp")}
    steps = {"a": [1, 1, -1, 1, 1, -2, -2, 1], "b": [-1, 1, 1, 1, 1, 1, 1, 1]}
    for part in range(4):
        rows = [(d, part * 2 + i, part * 2 + i, s[part * 2 + i]) for d, s in steps.items() if d == "a" or part != 1 for i in range(2)]
        frame = spark.createDataFrame(rows, "domain string, t long, event_id long, step long")
        frame.select("domain", F.timestamp_seconds("t").alias("ts"), "event_id", "step").write.mode("append").parquet(source)
        streams.penalty_stream(spark.readStream.schema(schema).parquet(source), out["rows"], out["state"], out["cp"], 60).awaitTermination()
    got = {(r["domain"], r["event_id"]): r["penalty"] for r in spark.read.parquet(out["rows"] + "/*").collect()}
    assert [got["a", i] for i in range(8)] == fold(steps["a"])
    kept = [i for i in range(8) if i not in (2, 3)]
    assert [got["b", i] for i in kept] == fold([steps["b"][i] for i in kept])


def test_bounded_distinct_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(20).select((F.col("id") % 4).alias("k"), F.timestamp_seconds("id").alias("ts")).coalesce(1).write.parquet(source)
    rows = streams.distinct_stream(spark.readStream.schema("k long, ts timestamp").parquet(source), ["k"], "ts", "1 hour")
    rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_silver_and_seed_sinks(spark, tmp_path):
    rows = spark.range(10).select(F.lit("s").alias("site"), F.lit("2024-01-01").alias("crawl_date"), F.concat(F.lit("u"), "id").alias("url"))
    for _ in range(2):
        sinks.write_silver(rows, str(tmp_path / "silver"))
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 10
    sinks.write_seed_csv(rows.withColumnRenamed("url", "pdp_url"), str(tmp_path / "seeds"))
    from shelfscope.sources.seeds import read_seed_csv

    assert read_seed_csv(spark, str(tmp_path / "seeds")).count() == 10
