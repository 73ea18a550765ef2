"""Columns and operators against tables of cases."""

import math

import pytest
from pyspark.sql import functions as F

from selenite.functions import columns as C
from selenite.functions import names as N
from selenite.functions import phrases as P
from selenite.functions import scoring as S
from selenite.operators import relational as R
from selenite.sources import files, pds


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col.alias("out")).first()["out"]


def test_p_value(spark):
    for z in (-1.0, 0.0, 0.5, 1.0, 2.0, 3.5, 9.0):
        exact = 0.5 if z <= 0 else 0.0 if z >= 8 else 0.5 * math.erfc(z / math.sqrt(2))
        assert one(spark, C.upper_tail(F.col("z")), z=z) == pytest.approx(exact, abs=2e-7)


def test_q_values(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.5, 0.04]
    df = spark.createDataFrame(list(enumerate(p)), "k int, p double")
    got = {r["k"]: r["fdr_q"] for r in R.adjusted(df, "p").collect()}
    order = sorted(range(6), key=lambda i: p[i])
    least, want = 1.0, {}
    for rank in range(6, 0, -1):
        least = min(least, p[order[rank - 1]] * 6 / rank)
        want[order[rank - 1]] = least
    assert got == pytest.approx(want)
    assert R.adjusted(df.limit(0), "p").count() == 0


def test_running_over_ranges(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 13).alias("v"))
    for parts in (1, 5):
        up = {r["k"]: r["s"] for r in R.running(df, "k", F.col("v"), "sum", "s", parts=parts).collect()}
        down = {r["k"]: r["m"] for r in R.running(df, "k", F.col("v"), "min", "m", True, parts).collect()}
        held = {r["k"]: r["v"] for r in df.collect()}
        total, least = 0, 99
        for k in range(1000):
            total += held[k]
            assert up[k] == total
        for k in range(999, -1, -1):
            least = min(least, held[k])
            assert down[k] == least


def test_names(spark):
    cases = {
        "ESP_011261_1960_RED.browse.jpg": ("red", "rdr_browse", "browse", "map"),
        "ESP_011261_1960_MIRB.NOMAP.browse.jpg": ("color", "rdr_browse", "browse", "nomap"),
        "ESP_011261_1960_RED.QLOOK.JP2": ("red", "rdr_fullres", "fullres", "quicklook"),
        "ESP_011261_1960_COLOR.LBL": ("other", "rdr_label", "", "map"),
        "DTEEC_011261_1960_011962_1960_A01.ca.jpg": ("dtm", "dtm_derivative", "browse", "dtm"),
        "ESP_011261_1960_RED_A_01_ORTHO.jpg": ("other", "unknown", "", ""),
        "ESP_011261_1960_RED_C_01_ORTHO.th.jpg": ("ortho_red", "ortho_browse", "thumbnail", "ortho"),
        "ESP_011261_1960_ESP_011962_1960_RED.browse.png": ("anaglyph", "anaglyph_browse", "browse", "anaglyph"),
        "README.TXT": ("other", "readme", "", ""),
        "ESP_011261_1960_IR10_0.thumb.jpg": ("color", "edr_browse", "thumb", "map"),
    }
    df = N.classified(spark.createDataFrame([(n,) for n in cases], "name string"))
    assert {r["name"]: (r["role"], r["product_class"], r["scale"], r["geometry"]) for r in df.collect()} == cases
    assert one(spark, N.mission(F.col("n")), n="ESP_1") == "hirise" and one(spark, N.mission(F.col("n")), n="zz") == "unknown"


def test_verdicts(spark):
    base = {"score": 50.0, "evidence_class": 2, "agrees": 0, "compactness": 0.6, "aspect": 1.5, "area_px": 900, "xv_collapse": 0, "xv_tested": 0, "contrast": 2.0, "dtm_known_artifacts": ""}
    cases = [({}, [], "PROMISING"), ({"evidence_class": 1}, [], "EXPLAINED-ARTIFACT"), ({"agrees": 1}, [], "CONFIRMED-LEAD"), ({"agrees": 1, "contrast": 1.0}, [], "TERRAIN"), ({"agrees": 1}, ["streak"], "TERRAIN"), ({"xv_tested": 2, "xv_collapse": 2, "agrees": 1}, [], "BAND-DEPENDENT"), ({"dtm_known_artifacts": "boxes"}, [], "DTM-ARTIFACT-RISK"), ({"score": 30.0}, [], "WEAK"), ({"score": 3.0}, [], "NOISE")]
    for change, flags, want in cases:
        cols = [F.lit(v).alias(k) for k, v in (base | change).items()] + [F.lit(S.bits(flags)).alias("flag_bits")]
        assert spark.range(1).select(*cols).select(S.verdict().alias("v")).first()["v"] == want, (change, flags)


def test_phrases():
    assert P.parse("bright features on Mars") == {"polarity": "bright", "body": "Mars"}
    assert P.parse("score between 80 and 50") == {"min_score": 50.0, "max_score": 80.0}
    assert P.parse("top ones, score > 90") == {"min_score": 90.0}
    assert "verdict" not in P.parse("no terrain") and P.parse("") == {}


def test_geometry(spark):
    assert one(spark, C.bearing(*map(F.lit, (0.0, 0.0, 0.0, 10.0)))) == pytest.approx(90)
    assert one(spark, C.axial_distance(F.lit(-5.0), F.lit(170.0))) == pytest.approx(5)
    assert one(spark, C.quantity(F.lit("57.508 <deg>"))) == (57.508, "DEG")
    assert one(spark, C.based_int(F.lit("2#1010#"))) == 10 and one(spark, C.based_int(F.lit("16#FF#"))) == 255
    assert one(spark, C.file_size(F.lit("5.6M"))) == int(5.6 * 1024**2) and one(spark, C.file_size(F.lit("-"))) is None
    assert one(spark, C.height_from_shadow(F.lit(10.0), F.lit(0.5), F.lit(45.0))) == pytest.approx(5)


def test_instants(spark):
    cases = {"17-May-2011 10:00": "2011-05-17 10:00:00", " 2011-05-17 10:00 ": "2011-05-17 10:00:00", "2008-11-05T12:34:56.789": "2008-11-05 12:34:56.789", "2008-310T12:34:56Z": "2008-11-05 12:34:56", "2011-05-17": "2011-05-17 00:00:00", "": None, "soon": None, "2011-02-30": None}
    got = spark.createDataFrame([(t,) for t in cases], "t string").select("t", C.instant(F.col("t")).cast("string").alias("v")).collect()
    assert {r["t"]: r["v"] and r["v"].ljust(19) for r in got} == cases


def test_joins_and_pages(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "k int, o int, v string")
    assert sorted(map(tuple, R.last_wins(left, right, ["k"], ["o"]).select("k", "v").collect())) == [(1, "b"), (2, None)]
    assert [r[0] for r in R.circular_page(left, [F.col("k")], 2, 3).collect()] == [3, 1, 2]
    assert [r[0] for r in R.circular_page(left, [F.col("k")], 5, 9).collect()] == [3, 1, 2]
    assert sorted(r[0] for r in R.merged(right.limit(3), right.filter("v = 'b'"), "k").select("v").collect() if r[0]) == ["b"]


def test_groups_chain(spark):
    df = spark.createDataFrame([(i, 1, i * 7, 0) for i in range(40)] + [(100, 2, 0, 0), (101, 1, 400, 0), (102, 1, 400, 0)], "node long, base int, x int, y int")
    got = {r["node"]: r["feature"] for r in R.groups(df, "node", "base", 8).collect()}
    assert {got[i] for i in range(40)} == {0} and got[100] == 100 and got[101] == got[102] == 101


def test_files(spark, tmp_path):
    assert files.read_csv(spark, str(tmp_path / "none.csv"), ["a", "b"]).count() == 0
    (tmp_path / "x.csv").write_text("﻿a,b\n1,x\n,nan\n", encoding="utf-8")
    got = files.read_csv(spark, str(tmp_path / "x.csv"), ["a", "b"]).select(files.number(F.col("a"), 0.0).alias("n"), "b").collect()
    assert [tuple(r) for r in got] == [(1.0, "x"), (0.0, "nan")]
    page = '<a href="?C=N">x</a> <a href="ORB_1/">d</a> 17-May-2011 10:00 - <a href="a.jpg">a.jpg</a> 17-May-2011 10:00 5.6M'
    rows = one(spark, files.listing(F.lit(page)))
    assert [(r["name"], r["is_dir"], r["bytes"]) for r in rows] == [("ORB_1", True, 0), ("a.jpg", False, int(5.6 * 1024**2))]


def test_labels_and_cubes(spark, tmp_path):
    import numpy as np

    text = 'PDS_VERSION_ID = PDS3\r\nRECORD_BYTES = 1\r\n^IMAGE = 4097\r\nNOTE = "two\r\n lines"\r\nOBJECT = IMAGE\r\n LINES = 8\r\n LINE_SAMPLES = 8\r\n SAMPLE_BITS = 16\r\n SAMPLE_TYPE = MSB_UNSIGNED_INTEGER\r\n SAMPLE_BIT_MASK = 2#1111111111110000#\r\nEND_OBJECT = IMAGE\r\nEND\r\n'
    (tmp_path / "a.img").write_bytes(text.encode().ljust(4096) + (np.arange(64) << 4).astype(">u2").tobytes())
    (tmp_path / "b.img").write_bytes(b"no label")
    got = {r["path"][-5:]: r for r in pds.read_products(spark, str(tmp_path), glob="*.img").collect()}
    assert got["a.img"]["width"] == 8 and np.frombuffer(got["a.img"]["pixels"], "<f4")[-1] == 63 and got["b.img"]["width"] is None
    cube = np.arange(32, dtype=">u2").reshape(2, 4, 4)
    for storage, order in (("BAND_SEQUENTIAL", (0, 1, 2)), ("LINE_INTERLEAVED", (1, 0, 2)), ("SAMPLE_INTERLEAVED", (1, 2, 0))):
        label = {"LINES": 4, "LINE_SAMPLES": 4, "BANDS": 2, "SAMPLE_BITS": 16, "SAMPLE_TYPE": "MSB_UNSIGNED_INTEGER", "BAND_STORAGE_TYPE": storage}
        data = np.ascontiguousarray(cube.transpose(order)).tobytes()
        assert np.array_equal(pds.decode(label, data, 0), cube)
        with pytest.raises(ValueError):
            pds.decode(label, data[:-1], 0)
    assert pds.parse_label("<?xml version='1.0'?><P xmlns='x'><a>1</a><b>t</b><a>2</a></P>") == {"a": 1, "b": "t"}


def test_streams(spark, tmp_path):
    from selenite.streaming import events as E

    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows.write.parquet(str(tmp_path / "in"))
    q = E.trailing(E.read_stream(spark, str(tmp_path / "in")).withColumn("ts", F.col("ts")), size=5).writeStream.format("memory").queryName("trail").outputMode("update").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("trail").count() == rows.select("user_id").distinct().count()
    merge = E.upsert_into(spark, str(tmp_path / "out"), "user_id", "event_id")
    half = rows.filter("event_id % 2 = 0").select("user_id", "event_id"), rows.filter("event_id % 2 = 1").select("user_id", "event_id")
    for k, part in enumerate(half):
        merge(part, k)
    want = rows.groupBy("user_id").agg(F.max("event_id").alias("m"))
    assert spark.read.parquet(str(tmp_path / "out/v1")).join(want, "user_id").filter("event_id <> m").count() == 0


def test_derived_names_with_longer_orbits(spark):
    """Orbits of seven digits, as in tables with over 900 000 parts; renderings keep the archive's six."""
    cases = {"DTEEC_1000001_1410_020000_1410_A01.th.jpg": "dtm", "ESP_1000001_1410_RED_C_01_ORTHO.ab.jpg": "ortho", "ESP_1000001_1410_RED_C_01_ORTHO.JP2": "ortho_full", "ESP_1000001_1410_ESP_020000_1410_RED.thumb.png": "anaglyph", "ESP_1000001_1410_BG12_0.browse.jpg": "edr", "ESP_1000001_1410_RED.browse.jpg": "other"}
    got = N.classified(spark.createDataFrame([(n,) for n in cases], "name string")).select("name", "kind").collect()
    assert {r["name"]: r["kind"] for r in got} == cases
