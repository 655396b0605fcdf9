"""Content addressing and image validation. Image bytes are built from the part table."""

from __future__ import annotations

import re
import struct
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.checks.registry import query, table
from shelfscope.operators import assets
from shelfscope.session import materialize


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.encode("text", "UTF-8").alias("content"))
    return assets.content_keys(docs, "doc_id").join(docs.select("doc_id", "source"), "doc_id")


@query("""
WITH k AS (SELECT sha256(text) AS sha256, doc_id, source, strlen(text) AS bytes FROM documents)
SELECT sha256, min(doc_id) AS doc_id, min(bytes) AS bytes FROM k
WHERE sha256 NOT IN (SELECT sha256 FROM k WHERE source = 'src0') GROUP BY sha256
""")
def content_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id per new content; contents of one source count as stored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.encode("text", "UTF-8").alias("content"))
    stored = assets.content_keys(docs.where("source = 'src0'"), "doc_id")
    return assets.new_contents(assets.content_keys(docs, "doc_id"), "doc_id", stored)


@query("""
WITH k AS (SELECT DISTINCT sha256(text) AS sha256, source FROM documents)
SELECT sha256, source, owners FROM (SELECT *, count(*) OVER (PARTITION BY sha256) AS owners FROM k) WHERE owners > 1
""")
def shared_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content that more than one source holds, a row per source."""
    return assets.shared_contents(text_keys(spark, sf_dir), "source")


def _chunk(kind: str, body: Column) -> Column:
    """PNG chunk: length, type, body, checksum."""
    typed = F.concat(F.encode(F.lit(kind), "UTF-8"), body)
    size = F.unhex(F.lpad(F.hex(F.octet_length(body)), 8, "0"))
    return F.concat(size, typed, F.unhex(F.lpad(F.hex(F.crc32(typed)), 8, "0")))


def png(width: Column, height: Column, data: Column) -> Column:
    header = F.concat(
        F.unhex(F.lpad(F.hex(width), 8, "0")), F.unhex(F.lpad(F.hex(height), 8, "0")), F.unhex(F.lit("0802000000"))
    )
    return F.concat(F.unhex(F.lit("89504E470D0A1A0A")), _chunk("IHDR", header), _chunk("IDAT", data), _chunk("IEND", F.unhex(F.lit(""))))


def part_images(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(log, blobs): a PNG per part, sized by p_size; some logged wrongly, broken or lost."""
    key = F.col("p_partkey")
    good = png(F.col("p_size"), F.col("p_size") + 3, F.encode("p_name", "UTF-8"))
    broken = F.substring(good, 1, 40)
    is_broken = F.col("p_brand").endswith("1")
    content = F.when(is_broken, broken).otherwise(good)
    sha = F.when(F.col("p_brand").endswith("2"), F.sha2(F.lit("x"), 256)).otherwise(F.sha2("content", 256))
    blob_key = F.concat(F.lit("by-hash/"), F.col("p_partkey").cast("string"), F.lit("/"), sha, F.lit(".png"))
    made = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_name").select("p_partkey", "p_brand", "p_size", "p_name", content.alias("content")).select(
        "*", blob_key.alias("blob_key")
    )
    log = made.select(
        F.lit("shop").alias("site"), key.cast("string").alias("primary_key"), F.col("p_name").alias("url"), F.lit("run-1").alias("run_id"),
        F.when(F.col("p_brand").endswith("4"), "error").otherwise("ok").alias("status"), F.col("blob_key").alias("s3_blob_key"),
        F.lit("2024-02-01").alias("dt"), F.lit("run-1").alias("run"),
    )
    return log, made.where(~F.col("p_brand").endswith("3")).select("blob_key", "content")


CHECK_SQL = """
WITH c AS (SELECT p_partkey, p_size AS w, p_size + 3 AS h, CASE right(p_brand, 1)
    WHEN '3' THEN 'fetch_error' WHEN '2' THEN 'sha256_mismatch' WHEN '1' THEN 'invalid_image'
    ELSE CASE WHEN p_size < 10 THEN 'too_small' ELSE 'ok' END END AS verdict FROM part WHERE right(p_brand, 1) <> '4')
"""


@query(CHECK_SQL + """
SELECT CAST(p_partkey AS VARCHAR) AS primary_key, verdict, CASE WHEN verdict IN ('ok', 'too_small') THEN w END AS width,
  CASE WHEN verdict IN ('ok', 'too_small') THEN h END AS height, CASE WHEN verdict IN ('ok', 'too_small') THEN 'png' END AS format FROM c
""")
def image_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every logged image: hash, structure, size."""
    checked = assets.validate_images(*part_images(spark, sf_dir))
    seen = F.split_part("verdict", F.lit(":"), F.lit(1))
    shown = seen.isin("ok", "too_small")
    return checked.select(
        "primary_key", seen.alias("verdict"), *[F.when(shown, F.col(f"info.{c}")).alias(c) for c in ("width", "height", "format")]
    )


@query(CHECK_SQL + """
SELECT CASE WHEN verdict IN ('ok', 'fetch_error') THEN verdict ELSE 'rejected' END AS outcome, count(*) AS n FROM c GROUP BY 1
""")
def image_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.validation_counters(assets.validate_images(*part_images(spark, sf_dir)))


@query(CHECK_SQL + "SELECT CAST(p_partkey AS VARCHAR) AS primary_key, w AS width, h AS height, 'png' AS format, 'run-1' AS run FROM c WHERE verdict = 'ok'")
def validated_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assets.validated_rows(assets.validate_images(*part_images(spark, sf_dir)))
    return rows.select("primary_key", "width", "height", "format", "run")


# --- all formats --------------------------------------------------------------------------


def number(value: Column, size: int, little: bool = False) -> Column:
    """A whole number as `size` bytes."""
    parts = [F.unhex(F.lpad(F.hex(F.shiftright(value.cast("bigint"), 8 * i).bitwiseAND(255)), 2, "0")) for i in range(size)]
    return F.concat(*(parts if little else parts[::-1]))


def raw(text: str) -> Column:
    return F.unhex(F.lit(text.encode("latin-1").hex()))


def jpeg(width: Column, height: Column, data: Column) -> Column:
    frame = F.concat(raw("\xff\xc0\x00\x0b\x08"), number(height, 2), number(width, 2), raw("\x01\x01\x11\x00"))
    scan = F.concat(raw("\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00"), data, raw("\xff\x00\xff\xd0"), data)
    return F.concat(raw("\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00"), frame, scan, raw("\xff\xd9"))


def gif(width: Column, height: Column, data: Column) -> Column:
    size = F.concat(number(width, 2, True), number(height, 2, True))
    picture = F.concat(raw("\x2c\x00\x00\x00\x00"), size, raw("\x00\x02"), number(F.octet_length(data), 1), data, raw("\x00"))
    return F.concat(raw("GIF89a"), size, raw("\x80\x00\x00" + "\x00" * 6 + "\x21\xfe\x02hi\x00"), picture, raw("\x3b"))


def webp(width: Column, height: Column, data: Column) -> Column:
    bits = number((width - 1) + F.shiftleft(height - 1, 14), 4, True)
    odd = F.octet_length(data) % 2  # a chunk of data and five bytes more
    extended = F.concat(raw("VP8X\x0a\x00\x00\x00\x00\x00\x00\x00"), number(width - 1, 3, True), number(height - 1, 3, True))
    chunk = F.concat(raw("VP8L"), number(F.octet_length(data) + 5, 4, True), raw("\x2f"), bits, data, F.when(odd == 0, raw("\x00")).otherwise(raw("")))
    return F.concat(raw("RIFF"), number(F.octet_length(data) + 35 + (1 - odd), 4, True), raw("WEBP"), extended, chunk)


def avif(width: Column, height: Column, data: Column) -> Column:
    """The second of two sizes is the primary item's. All boxes but the last have a fixed length."""

    def box(kind: bytes, *parts: bytes) -> bytes:
        body = kind + b"".join(parts)
        return struct.pack(">I", len(body) + 4) + body

    sizes = box(b"ipco", box(b"ispe", bytes(4), struct.pack(">II", 1, 1)), box(b"ispe", bytes(4), b"<-w><-h>"))
    owners = box(b"ipma", struct.pack(">IIHBBHBB", 0, 2, 7, 1, 0x81, 9, 1, 0x82))
    head = box(b"ftyp", b"avif", bytes(4), b"avif")

    def meta(start: int) -> bytes:
        place = box(b"iloc", bytes(4), b"\x44\x00", struct.pack(">HHHHI", 1, 9, 0, 1, start), b"<-n>")
        return box(b"meta", bytes(4), box(b"pitm", struct.pack(">IH", 0, 9)), place, box(b"iprp", sizes, owners))

    fixed = head + meta(len(head) + len(meta(0)) + 8)
    filled = {b"<-w>": number(width, 4), b"<-h>": number(height, 4), b"<-n>": number(F.octet_length(data), 4)}
    parts = [filled.get(p, F.unhex(F.lit(p.hex()))) for p in re.split(b"(<-[whn]>)", fixed)]
    return F.concat(*parts, number(F.octet_length(data) + 8, 4), raw("mdat"), data)


FORMATS = {"png": png, "jpeg": jpeg, "gif": gif, "webp": webp, "avif": avif}


@query("""
WITH i AS (SELECT p_partkey, ['png', 'jpeg', 'gif', 'webp', 'avif'][p_partkey % 5 + 1] AS format, p_partkey % 3 = 0 AS cut, p_size AS w, p_size + 3 AS h FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS primary_key, CASE WHEN cut THEN 'invalid_image' WHEN w < 10 THEN 'too_small' ELSE 'ok' END AS verdict,
  CASE WHEN NOT cut THEN format END AS format, CASE WHEN NOT cut THEN w END AS width, CASE WHEN NOT cut THEN h END AS height FROM i
""")
def image_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of five formats, every third cut somewhere behind its head, the least by one byte."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.encode("p_name", "UTF-8").alias("data"))
    # one format at a time, and written before they are hashed: the expressions are long
    wholes = [
        part.where(F.col("p_partkey") % len(FORMATS) == i).select("p_partkey", build(F.col("p_size"), F.col("p_size") + 3, F.col("data")).alias("whole"))
        for i, build in enumerate(FORMATS.values())
    ]
    cut = F.expr("substring(whole, 1, octet_length(whole) - 1 - cast(p_partkey % 30 as int))")
    made = materialize(reduce(DataFrame.union, wholes), "images").select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, cut).otherwise(F.col("whole")).alias("content"))
    made = made.select("p_partkey", "content", F.concat(F.lit("by-hash/"), F.col("p_partkey").cast("string"), F.lit("/"), F.sha2("content", 256), F.lit(".img")).alias("blob_key"))
    log = made.select(
        F.lit("shop").alias("site"), F.col("p_partkey").cast("string").alias("primary_key"), F.col("blob_key").alias("url"), F.lit("run-1").alias("run_id"),
        F.lit("ok").alias("status"), F.col("blob_key").alias("s3_blob_key"), F.lit("2024-02-01").alias("dt"), F.lit("run-1").alias("run"))
    checked = assets.validate_images(log, made.select("blob_key", "content"))
    return checked.select("primary_key", F.split_part("verdict", F.lit(":"), F.lit(1)).alias("verdict"), "info.format", "info.width", "info.height")
