"""Evidence kernels, images, reports and configuration."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from selenite.config import Config
from selenite.functions import reports as T
from selenite.raster import evidence as E
from selenite.raster import kernels as K
from selenite.sources import images


def test_measures():
    a = np.random.default_rng(0).normal(100, 3, (64, 64))
    a[28:36, 28:36] = 254
    m = E.measure(a, (28, 28, 8, 8))
    assert m["polarity"] == "bright" and m["contrast"] > 10 and m["sat_frac"] == 1 and m["column_smear"] < 2
    b = np.random.default_rng(0).normal(100, 3, (64, 64))
    b[:, 30:32] = 220
    s = E.measure(b, (28, 28, 6, 6))
    assert s["column_smear"] >= 2 and s["smear_narrow"]
    assert E.edge_sharpness(a, (26, 26, 12, 12)) > E.edge_sharpness(K.box_blur(a, 9), (26, 26, 12, 12))
    assert 0 < E.contrast_stability(a, (28, 28, 8, 8)) <= 1 and E.original_z(a, (56, 56, 16, 16)) > 10


def test_shadow_axis():
    up, across = (np.full((64, 64), 50.0) for _ in range(2))
    up[10:54, 30:34] = across[30:34, 10:54] = 200
    assert E.shadow_alignment(up, 0) > 0.6 and E.shadow_alignment(across, 0) < 0.3
    assert E.shadow_alignment(up, None) is None and E.shadow_alignment(up, 0, 85) is None and E.shadow_alignment(up, 0, 20, "dark") is None


def test_renderings():
    ref = K.box_blur(np.random.default_rng(1).random((96, 96)), 5) * 200
    same = E.compared(ref, np.roll(ref, (-4, 3), (0, 1)), [(40, 40, 16, 16), (90, 90, 16, 16)])
    assert (abs(same["dx"]), abs(same["dy"])) == (3, 4) and same["verdict"] == "PERSISTS" and same["persistence"][1] is None
    assert E.compared(ref, np.random.default_rng(2).random((48, 48)))["verdict"] in ("MODERATE DIVERGENCE", "STRONG DIVERGENCE")
    assert E.compared(ref, ref, role="fom")["verdict"] == "FOM"
    assert E.anaglyph(ref, ref).shape == (96, 96, 3) and set(E.enhanced(ref)) == {"stretch", "residual", "sharp"}
    scene = K.synthetic_scene((200, 200), 3)
    scene[80:110, 80:110] += 120
    best = E.analysed(scene, 1, (2,), 135.0)[0]
    assert best["x"] <= 95 <= best["x"] + best["w"] and best["polarity"] == "bright"


def png(rows, color, depth, filters):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w = len(rows), len(rows[0])
    raw = b"".join(bytes([f]) + bytes(r) for f, r in zip(filters, rows, strict=True))
    return images.PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    want = np.array([[10, 20, 30], [40, 55, 60], [70, 80, 95], [5, 5, 5], [1, 2, 4]])
    rows, up = [], np.zeros(3, int)
    for f, line in zip((0, 1, 2, 3, 4), want, strict=True):
        out = []
        for i, v in enumerate(line):
            a, b, c = (line[i - 1] if i else 0), up[i], (up[i - 1] if i else 0)
            p = a + b - c
            guess = (0, a, b, (a + b) // 2, a if abs(p - a) <= min(abs(p - b), abs(p - c)) else b if abs(p - b) <= abs(p - c) else c)[f]
            out.append(int(v - guess) % 256)
        rows.append(out)
        up = line
    (tmp_path / "a.png").write_bytes(png(rows, 0, 8, (0, 1, 2, 3, 4)))
    (tmp_path / "b.pgm").write_bytes(b"P5\n# c\n3 5\n255\n" + want.astype(np.uint8).tobytes())
    (tmp_path / "c.txt").write_bytes(b"none")
    got = {r["path"][-5:]: r for r in images.read_images(spark, str(tmp_path)).collect()}
    for name in ("a.png", "b.pgm"):
        assert (got[name]["height"], got[name]["width"]) == (5, 3)
        assert np.array_equal(np.frombuffer(got[name]["pixels"], "<f4").reshape(5, 3), want)
    assert got["c.txt"]["width"] is None
    assert images.read_images(spark, str(tmp_path), "*.png", pixels=False).first()["pixels"] is None


def test_reports(spark):
    one = lambda c: spark.range(1).select(c.alias("o")).first()["o"]
    assert [one(T.shown(F.lit(v))) for v in ("", "3.0", "2.5004", "x", "-0.25")] == ["-", "3", "2.5", "x", "-0.25"]
    assert one(T.age(F.lit(75))) == "1m" and one(T.percent(F.lit(1), F.lit(0))) == 0 and one(T.escaped(F.lit('<a & "b">'))) == "&lt;a &amp; &quot;b&quot;&gt;"
    assert tuple(one(T.crop_box(F.lit("ESP_1_RED_x12_y3_w4_h5.png")))) == ("ESP_1_RED", 12, 3, 4, 5)
    assert one(T.finding(F.lit("# F-1\n**Date:** 2026\n- **Verdict:** WEAK"))) == {"title": "F-1", "date": "2026", "verdict": "WEAK"}
    pictures = spark.createDataFrame([("d/A_MIRB.browse.jpg",), ("d/A_MIRB.jpg",), ("d/B.jpg",)], "path string")
    labels = spark.createDataFrame([("d/A_MIRB.LBL",)], "path string")
    assert {r["path"]: r["label_path"] for r in T.with_labels(pictures, labels).collect()} == {"d/A_MIRB.browse.jpg": "d/A_MIRB.LBL", "d/A_MIRB.jpg": "d/A_MIRB.LBL", "d/B.jpg": None}
    site = spark.sql("SELECT 'RDR' AS name, array(struct('ORB' AS name, array(struct('F' AS name, array(struct('p' AS product, 3 AS bytes), struct('q' AS product, 4 AS bytes)) AS products)) AS footprints)) AS shards")
    assert T.flattened(site).agg(F.sum("bytes")).first()[0] == 7
    report = spark.sql("SELECT map('v.browse', map('k', 0.7D, 'l', 0D), 'v.NOMAP', map('k', 0.9D)) AS candidate_persistence")
    assert [tuple(r) for r in T.persistence_ratios(report).collect()] == [("v.browse", "k", 0.7)]
    a, b = spark.createDataFrame([("x1",)], "k string"), spark.createDataFrame([("x",)], "k string")
    assert T.resolved([a, b], "k", "x").first()["k"] == "x1"


def test_config():
    assert Config.load('{"z": 4, "scales": [8, 4]}', z=None, border=0.1) == Config(scales=(8, 4), z=4, border=0.1)
    with pytest.warns(UserWarning):
        assert Config.load('{"z": "x", "no_such": 1}') == Config()
