"""Delimited / text / whole-file readers, matrix sink, image vectors."""

import struct
import tempfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarry.sources import files, images


def _tmp():
    return tempfile.mkdtemp(prefix="quarry-test-", dir="/tmp")


def test_delimited_roundtrip(spark):
    d = _tmp()
    for sep, name in ((",", "comma"), ("|", "pipe"), ("\t", "tab")):
        with open(f"{d}/{name}.txt", "w") as fh:
            fh.write(f"user{sep}product{sep}price\n")
            fh.write(f"John{sep}iPhone Cover{sep}9.99\n")
            fh.write(f"Jack{sep}\"Quoted\"{sep}?\n")
        df = files.read_delimited(spark, f"{d}/{name}.txt", "user string, product string, price double", sep=sep,
                                  header=True)
        rows = df.collect()
        assert rows[0].price == 9.99 and rows[1].product == "Quoted" and rows[1].price is None


def test_whole_files_and_topic_label(spark):
    d = _tmp()
    import os
    for topic in ("sci.space", "rec.autos"):
        os.makedirs(f"{d}/{topic}")
        for i in range(2):
            with open(f"{d}/{topic}/{i}", "w") as fh:
                fh.write(f"post {i} about {topic}\nsecond line")
    df = files.read_whole_files(spark, f"{d}/*/*")
    got = df.select(files.label_from_path(files.strip_scheme(F.col("path"))).alias("t"), "text")
    rows = got.collect()
    assert sorted(r.t for r in rows) == ["rec.autos", "rec.autos", "sci.space", "sci.space"]
    assert all("\n" in r.text for r in rows)
    assert files.read_lines(spark, f"{d}/sci.space/0").count() == 2


def test_matrix_sink(spark):
    d = _tmp()
    m = spark.createDataFrame([(0, i, float(i)) for i in range(5)], "component int, index int, value double")
    files.write_matrix(m, f"{d}/m")
    back = spark.read.option("header", True).schema("component int, index int, value double").csv(f"{d}/m")
    assert sorted(back.collect()) == sorted(m.collect())


def test_persist_named_and_checkpoint(spark):
    df = files.persist_named(spark.range(10), "ten")
    assert spark.sql("SELECT count(*) FROM ten").first()[0] == 10
    assert files.checkpointed(df).count() == 10
    df.unpersist()


def _png(path, w, h, rgb):
    raw = b"".join(b"\x00" + bytes(rgb[y * w * 3:(y + 1) * w * 3]) for y in range(h))
    def chunk(t, data):
        c = struct.pack(">I", len(data)) + t + data
        return c + struct.pack(">I", zlib.crc32(t + data) & 0xffffffff)
    with open(path, "wb") as fh:
        fh.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
                 + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_image_vectors(spark):
    d = _tmp()
    import os
    os.makedirs(f"{d}/person_a")
    w, h = 20, 10
    rgb = []
    for y in range(h):
        for x in range(w):
            rgb += [x * 10 % 256, y * 20 % 256, 100]
    _png(f"{d}/person_a/img_0001.png", w, h, rgb)
    _png(f"{d}/person_a/img_0002.png", w, h, [255] * (w * h * 3))
    vecs = images.pixel_vectors(images.read_images(spark, d), 5, 5)
    rows = {r.path.split("/")[-1]: r.pixels for r in vecs.collect()}
    assert set(rows) == {"img_0001.png", "img_0002.png"}
    assert len(rows["img_0001.png"]) == 25
    assert np.allclose(rows["img_0002.png"], 255.0)
    # top-left pixel of the first image: r=0, g=0, b=100 -> grey 0.114 * 100
    assert abs(rows["img_0001.png"][0] - 11.4) < 1e-9


def _filtered_png(pixels, kinds):
    """An RGB PNG whose rows use the given filters, written without the library."""
    h, w, _ = pixels.shape
    flat = pixels.reshape(h, w * 3).astype(int)
    body = b""
    for y, kind in enumerate(kinds):
        line = []
        for i in range(w * 3):
            a, b = (flat[y, i - 3] if i >= 3 else 0), (flat[y - 1, i] if y else 0)
            c = flat[y - 1, i - 3] if y and i >= 3 else 0
            p = a + b - c
            paeth = min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]
            line.append((flat[y, i] - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        body += bytes([kind] + line)
    def chunk(k, d):
        return struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b""))


def test_png_bytes(spark):
    pixels = np.random.default_rng(1).integers(0, 256, (10, 7, 3))
    good = _filtered_png(pixels, [0, 1, 2, 3, 4, 4, 3, 2, 1, 0])
    h, w, c, data = images.decode_png(good)
    assert (h, w, c) == (10, 7, 3)
    assert (np.frombuffer(data, np.uint8).reshape(10, 7, 3)[:, :, ::-1] == pixels).all()
    assert images.decode_png(images.encode_png(range(12), 4, 3)) == (3, 4, 1, bytes(range(12)))
    bad = [None, b"", b"text", good[:40], good[:-20], good[:50] + b"x" + good[51:], good[:8]]
    d = spark.createDataFrame([(f"{i}", b) for i, b in enumerate([good, *bad])], "path string, content binary")
    got = {r.path: r.data for r in images.decode_images(d).collect()}
    assert len(got) == 8 and got["0"] == data and all(got[str(i)] is None for i in range(1, 8))


def test_jpeg_and_damaged_files(spark):
    d = _tmp()
    java = spark._jvm
    picture = java.java.awt.image.BufferedImage(40, 20, 1)
    for x in range(40):
        for y in range(20):
            picture.setRGB(x, y, 0x404040 if x < 20 else 0xC0C0C0)
    assert java.javax.imageio.ImageIO.write(picture, "jpg", java.java.io.File(f"{d}/half.jpg"))
    with open(f"{d}/broken.jpg", "wb") as fh:
        fh.write(b"\xff\xd8\xff no image")
    got = images.pixel_vectors(images.read_images(spark, d), 4, 2).collect()
    assert [r.path.split("/")[-1] for r in got] == ["half.jpg"]
    assert np.allclose(got[0].pixels, [64, 64, 192, 192] * 2, atol=4)
    assert [r.path.split("/")[-1] for r in images.damaged_images(spark, d).collect()] == ["broken.jpg"]
