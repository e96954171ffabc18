"""Image folder -> grey-scale pixel vectors.

Files are listed and decoded by Spark's ``image`` source (one row per file);
the resize and grey conversion run per Arrow batch in ``mapInPandas`` with
NumPy, so each task handles its own files and nothing passes through the
driver. PNG bytes that a table or ``binaryFile`` holds are decoded in Arrow
batches (``decode_images``).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import strip_scheme


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, height, width, channels, data) for every decodable image."""
    img = (spark.read.format("image").option("dropInvalid", True)
           .option("recursiveFileLookup", True).load(path))
    return img.select(strip_scheme(F.col("image.origin")).alias("path"),
                      F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                      F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def _grey_resize(data: bytes, h: int, w: int, c: int, out_w: int, out_h: int) -> list[float]:
    """Nearest-neighbour resize and luminance grey (BGR channel order as
    stored by the image source), values 0..255."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(h, w, c).astype(np.float64)
    if c >= 3:
        grey = 0.114 * a[:, :, 0] + 0.587 * a[:, :, 1] + 0.299 * a[:, :, 2]
    else:
        grey = a[:, :, 0]
    rows = (np.arange(out_h) * h // out_h).astype(int)
    cols = (np.arange(out_w) * w // out_w).astype(int)
    return grey[np.ix_(rows, cols)].ravel().tolist()


def pixel_vectors(images: DataFrame, width: int | None = 50, height: int | None = 50) -> DataFrame:
    """(path, pixels array<double> of width*height); None keeps an image's own width or height."""
    def conv(it):
        for pdf in it:
            vecs = [_grey_resize(d, h, w, c, width or w, height or h)
                    for d, h, w, c in zip(pdf["data"], pdf["height"], pdf["width"], pdf["channels"])]
            yield pd.DataFrame({"path": pdf["path"], "pixels": vecs})
    return images.select("path", "height", "width", "channels", "data").mapInPandas(
        conv, "path string, pixels array<double>")


def damaged_images(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the files that are not a decodable image."""
    img = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)
    return img.filter(F.col("image.height") < 0).select(strip_scheme(F.col("image.origin")).alias("path"))


_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}   # fixed values: samples a pixel of each PNG colour type


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(pixels, width: int, height: int) -> bytes:
    """A grey 8-bit PNG of ``width * height`` values from 0 to 255, row by row."""
    rows = np.asarray(pixels, dtype=np.uint8).reshape(height, width)
    raw = np.hstack([np.zeros((height, 1), np.uint8), rows]).tobytes()
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def _unfilter(raw: np.ndarray, step: int) -> np.ndarray:
    """Rows of bytes whose first byte names the filter, without their filters."""
    out = np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    above = np.zeros(raw.shape[1] - 1, np.uint8)
    for y, row in enumerate(raw):
        kind, line = row[0], row[1:].copy()
        if kind == 1:
            for c in range(step):
                line[c::step] = np.cumsum(line[c::step], dtype=np.uint64).astype(np.uint8)
        elif kind == 2:
            line += above
        elif kind in (3, 4):
            done = [0] * len(line)
            for i, v in enumerate(line.tolist()):
                left, up = (done[i - step] if i >= step else 0), int(above[i])
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    corner = int(above[i - step]) if i >= step else 0
                    far = [abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)]
                    guess = (left, up, corner)[far.index(min(far))]
                done[i] = (v + guess) & 255
            line = np.array(done, np.uint8)
        elif kind:
            raise ValueError("unknown filter")
        out[y] = above = line
    return out


def decode_png(content: bytes | None) -> tuple[int, int, int, bytes] | None:
    """(height, width, channels, data) of a PNG of 8-bit samples without
    interlace; colours in the order blue, green, red as the ``image`` source
    stores them. None for anything else, damaged files included."""
    try:
        if content is None or content[:8] != _SIGNATURE:
            return None
        at, head, packed, palette = 8, None, [], None
        while at < len(content):
            size, kind = struct.unpack(">I4s", content[at:at + 8])
            body, check = content[at + 8:at + 8 + size], content[at + 8 + size:at + 12 + size]
            if struct.unpack(">I", check)[0] != zlib.crc32(kind + body):
                return None
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", body)
            elif kind == b"PLTE":
                palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                packed.append(body)
            at += 12 + size
        width, height, depth, colour, _, _, interlaced = head
        if depth != 8 or interlaced:
            return None
        channels = _CHANNELS[colour]
        size = height * (1 + width * channels)
        flat = zlib.decompressobj().decompress(b"".join(packed), size + 1)   # no more than the header says
        raw = np.frombuffer(flat, np.uint8)
        if len(raw) != size:
            return None
        pixels = _unfilter(raw.reshape(height, -1), channels).reshape(height, width, channels)
        if colour == 3:
            pixels = palette[pixels[:, :, 0]]
        elif colour == 4:
            pixels = pixels[:, :, :1]
        if pixels.shape[2] >= 3:
            pixels = pixels[:, :, [2, 1, 0, *range(3, pixels.shape[2])]]
        return height, width, pixels.shape[2], pixels.tobytes()
    except (struct.error, zlib.error, ValueError, KeyError, IndexError, TypeError):
        return None


def decode_images(files: DataFrame, content: str = "content") -> DataFrame:
    """(path, height, width, channels, data) of files with a ``path`` and PNG
    bytes, as ``binaryFile`` reads them or a table holds them. A damaged file
    keeps its row, with nulls, so that it can be counted."""
    def conv(it):
        for pdf in it:
            got = [decode_png(c) or (None,) * 4 for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"]}).join(pd.DataFrame(
                got, columns=["height", "width", "channels", "data"], index=pdf.index).astype(
                {"height": "Int32", "width": "Int32", "channels": "Int32", "data": object}))
    return files.select("path", F.col(content).alias("content")).mapInPandas(
        conv, "path string, height int, width int, channels int, data binary")


def encode_images(vectors: DataFrame, pixels: str, height: int = 1) -> DataFrame:
    """(path, content) of rows with a ``path`` and grey values of ``height`` rows; null and empty vectors give null."""
    def conv(it):
        for pdf in it:
            yield pd.DataFrame({"path": pdf["path"], "content": [
                None if p is None or not len(p) else encode_png(p, len(p) // height, height) for p in pdf["pixels"]]})
    return vectors.select("path", F.col(pixels).cast("array<int>").alias("pixels")).mapInPandas(
        conv, "path string, content binary")
