"""Format, size and structure of images: every format is walked from its first byte to its end, so a cut file is a broken one."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_INFO = "format string, width int, height int, problem string"


def _png(data: bytes) -> tuple[int, int]:
    """Walks all chunks up to IEND and checks each checksum."""
    size, at = None, 8
    while True:
        length, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 4 : at + 8 + length]
        (crc,) = struct.unpack_from(">I", data, at + 8 + length)
        if zlib.crc32(body) != crc:
            raise ValueError(f"bad checksum in {kind!r}")
        if kind == b"IHDR":
            size = struct.unpack_from(">II", body, 4)
        if kind == b"IEND":
            return size
        at += 12 + length


def _jpeg(data: bytes) -> tuple[int, int]:
    """Walks the segments, and through each scan's coded data to the marker that ends it, up to the end of image."""
    size, scans, at = None, 0, 2
    while True:
        if data[at] != 0xFF:
            raise ValueError("marker expected")
        marker = data[at + 1]
        if marker == 0xFF:  # fill byte
            at += 1
            continue
        if marker == 0xD9:
            if size is None or not scans:
                raise ValueError("no picture before the end")
            return size
        if marker == 0x01 or 0xD0 <= marker <= 0xD7:  # markers without a segment
            at += 2
            continue
        (length,) = struct.unpack_from(">H", data, at + 2)
        if length < 2 or at + 2 + length > len(data):
            raise ValueError("segment passes the end")
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack_from(">HH", data, at + 5)
            size = size or (width, height)
        at += 2 + length
        if marker == 0xDA:
            if size is None:
                raise ValueError("scan before the frame header")
            scans += 1
            # 0xFF 0x00 is a coded 0xFF, restarts stay inside the scan
            while True:
                at = data.index(b"\xff", at)
                if data[at + 1] != 0x00 and not 0xD0 <= data[at + 1] <= 0xD7:
                    break
                at += 2


def _gif(data: bytes) -> tuple[int, int]:
    """Walks images and extensions, each a chain of sub-blocks, up to the trailer."""
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at, images = 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0), 0

    def chain(at: int) -> int:
        while data[at]:
            at += data[at] + 1
        return at + 1

    while data[at] != 0x3B:
        if data[at] == 0x21:
            at = chain(at + 2)
        elif data[at] == 0x2C:
            flags = data[at + 9]
            at = chain(at + 11 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0))
            images += 1
        else:
            raise ValueError("unknown block")
    if not images:
        raise ValueError("no picture before the end")
    return width, height


def _riff(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start, end) of the chunks in a range; bodies of odd length are padded."""
    while at < end:
        kind, length = struct.unpack_from("<4sI", data, at)
        if at + 8 + length > end:
            raise ValueError("chunk passes the end")
        yield kind, at + 8, at + 8 + length
        at += 8 + length + length % 2


def _webp(data: bytes) -> tuple[int, int]:
    """Walks the chunks, those of animation frames included; there has to be a picture."""
    (length,) = struct.unpack_from("<I", data, 4)
    if length + 8 > len(data):
        raise ValueError("file is shorter than it says")
    canvas, pictures = None, []

    def walk(at: int, end: int) -> None:
        nonlocal canvas
        for kind, low, high in _riff(data, at, end):
            if kind == b"VP8X":
                canvas = (int.from_bytes(data[low + 4 : low + 7], "little") + 1, int.from_bytes(data[low + 7 : low + 10], "little") + 1)
            elif kind == b"ANMF":
                walk(low + 16, high)
            elif kind == b"VP8L":
                if data[low] != 0x2F:
                    raise ValueError("bad lossless signature")
                bits = int.from_bytes(data[low + 1 : low + 5], "little")
                pictures.append(((bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1))
            elif kind == b"VP8 ":
                first = int.from_bytes(data[low : low + 3], "little")
                if data[low + 3 : low + 6] != b"\x9d\x01\x2a" or low + 10 + (first >> 5) > high:
                    raise ValueError("bad frame header")
                width, height = struct.unpack_from("<HH", data, low + 6)
                pictures.append((width & 0x3FFF, height & 0x3FFF))

    walk(12, length + 8)
    if not pictures:
        raise ValueError("no picture in the file")
    return canvas or pictures[0]


def _boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start, end) of the boxes in a range."""
    while at < end:
        length, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if length == 1:
            (length,) = struct.unpack_from(">Q", data, at + 8)
            head = 16
        length = length or end - at
        if length < head or at + length > end:
            raise ValueError("box passes the end")
        yield kind, at + head, at + length
        at += length


def _item_extents(data: bytes, at: int) -> Iterator[tuple[int, int, int]]:
    """(item, offset, length) of parts that lie in the file itself, from an item location box."""
    version = data[at]
    sizes = data[at + 4] >> 4, data[at + 4] & 15, data[at + 5] >> 4, data[at + 5] & 15 if version else 0
    at += 6

    def number(width: int) -> int:
        nonlocal at
        at += width
        if at > len(data):
            raise ValueError("location passes the end")
        return int.from_bytes(data[at - width : at], "big")

    wide = 4 if version == 2 else 2
    for _ in range(number(wide)):
        item = number(wide)
        method = number(2) & 15 if version else 0
        number(2)
        base = number(sizes[2])
        for _ in range(number(2)):
            number(sizes[3])
            offset, length = number(sizes[0]), number(sizes[1])
            if method == 0:
                yield item, base + offset, length


def _avif(data: bytes) -> tuple[int, int]:
    """Walks the box tree; the primary item's size counts, and all items have to lie in the file."""
    meta = next(((a + 4, b) for kind, a, b in list(_boxes(data, 0, len(data))) if kind == b"meta"), None)
    if not meta:
        raise ValueError("no meta box")
    parts = {kind: (a, b) for kind, a, b in _boxes(data, *meta)}
    primary = None
    if b"pitm" in parts:
        at = parts[b"pitm"][0]
        primary = int.from_bytes(data[at + 4 : at + (8 if data[at] else 6)], "big")
    if b"iloc" not in parts or b"iprp" not in parts:
        raise ValueError("no items in the file")
    if any(offset + length > len(data) for _, offset, length in _item_extents(data, parts[b"iloc"][0])):
        raise ValueError("item passes the end")
    properties, wanted = [], None
    for kind, a, b in _boxes(data, *parts[b"iprp"]):
        if kind == b"ipco":
            properties = list(_boxes(data, a, b))
        elif kind == b"ipma":
            wanted = wanted or _associations(data, a).get(primary)
    sizes = [i for i, (kind, _, _) in enumerate(properties, 1) if kind == b"ispe"]
    if not sizes:
        raise ValueError("no size in the file")
    at = properties[next((i for i in sizes if i in (wanted or ())), sizes[0]) - 1][1]
    return struct.unpack_from(">II", data, at + 4)


def _associations(data: bytes, at: int) -> dict[int, list[int]]:
    """Item -> numbers of its properties, from 1."""
    version, long = data[at], data[at + 3] & 1
    (count,) = struct.unpack_from(">I", data, at + 4)
    at, found = at + 8, {}
    for _ in range(count):
        wide = 4 if version else 2
        item, n = int.from_bytes(data[at : at + wide], "big"), data[at + wide]
        at += wide + 1
        step = 2 if long else 1
        found[item] = [int.from_bytes(data[at + i * step : at + (i + 1) * step], "big") & (0x7FFF if long else 0x7F) for i in range(n)]
        at += n * step
    return found


def _probe(data: bytes | None) -> tuple[str | None, int | None, int | None, str | None]:
    if data is None:
        return None, None, None, "no content"
    data = bytes(data)
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return ("png", *_png(data), None)
        if data[:3] == b"\xff\xd8\xff":
            return ("jpeg", *_jpeg(data), None)
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return ("gif", *_gif(data), None)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return ("webp", *_webp(data), None)
        if data[4:12] in (b"ftypavif", b"ftypavis"):
            return ("avif", *_avif(data), None)
        return None, None, None, "cannot identify image"
    except Exception as problem:  # a broken file is a rejected row, never a failed job
        return None, None, None, f"broken image: {problem}"


def image_info(content: Column) -> Column:
    def probe(blobs: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([_probe(b) for b in blobs], columns=["format", "width", "height", "problem"])
        return out.astype({"width": "Int32", "height": "Int32"})

    return F.pandas_udf(probe, IMAGE_INFO)(content)
