"""The jobs: against their SQL, run again over growing input, and from pixels to verdicts against a plain version."""

import math

import duckdb
import pytest

from jobs import crawl_catalogue, investigate, queries
from jobs.common import configured

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "events", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, DATA).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    text = lambda f: sorted(map(tuple, f[cols].convert_dtypes().astype(str).to_numpy().tolist()))
    assert text(got) == text(want)


def pages(spark, *given):
    return spark.createDataFrame(given, "page_id long, url string, html string")


FIRST = [(1, "https://A.example/en/x?q=1", '<a href="/a">'), (2, "https://a.example/fr/y", None), (3, None, "x"), (4, "no address", "x"), (None, "https://a.example/en/z", "x")]
SECOND = [(7, "https://a.example/en/x#part", '<a href="/a"><a href="b">'), (8, "http://b.example/de/", "x" * 5000), (8, "http://b.example/de/", "x" * 5000)]


def test_catalogue_grows(spark, tmp_path):
    source, out = str(tmp_path / "pages.parquet"), str(tmp_path / "out")
    pages(spark, *FIRST).coalesce(1).write.parquet(source)
    now = {r["page"]: r.asDict() for r in crawl_catalogue.run(spark, source, out).collect()}
    assert sorted(now) == ["https://a.example/en/x", "https://a.example/fr/y"] and now["https://a.example/en/x"]["n_links"] == 1
    pages(spark, *SECOND).coalesce(1).write.mode("append").parquet(source)
    got = {r["page"]: r.asDict() for r in crawl_catalogue.run(spark, source, out).collect()}
    x, b = got["https://a.example/en/x"], got["http://b.example/de/"]
    assert (x["versions"], x["first_page_id"], x["page_id"], x["n_links"], x["n_folders"], x["status"]) == (2, 1, 7, 2, 1, "fetch")
    assert (b["versions"], b["page_id"], b["host"], b["branch"], b["status"]) == (2, 8, "b.example", "de", "refused")
    assert got["https://a.example/fr/y"] == now["https://a.example/fr/y"] and len(got) == 3
    before = rows(crawl_catalogue.catalogue(spark, out))
    assert rows(crawl_catalogue.run(spark, source, out)) == before  # nothing new
    whole = crawl_catalogue.run(spark, source, str(tmp_path / "other"), {"files_per_batch": 1})
    assert rows(whole) == before  # in one run, file by file


def test_catalogue_batch_comes_again(spark, tmp_path):
    """A batch that was written, but not committed to the checkpoint, is taken once more: the result stays the same."""
    source, out = str(tmp_path / "pages.parquet"), str(tmp_path / "out")
    pages(spark, *FIRST, *SECOND).coalesce(1).write.parquet(source)
    before = rows(crawl_catalogue.run(spark, source, out))
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/checkpoint/commits")
    fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs, True)
    assert rows(crawl_catalogue.run(spark, source, out)) == before


def test_settings(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"buckets": 4}')
    (tmp_path / "bad.json").write_text('{"bucket": 4}')
    assert configured(spark, crawl_catalogue.DEFAULTS, str(tmp_path / "good.json"))["buckets"] == 4
    with pytest.raises(ValueError, match="bucket"):
        configured(spark, crawl_catalogue.DEFAULTS, str(tmp_path / "bad.json"))


SIZE, SCALE = 60, 4


def scene(image):
    """Even ground with a faint texture; in images 0 and 1 a bright square of 6 cells (24 px), in image 2 one of 16 (64 px), in 3 nothing."""
    ground = [[100.0 + 3.0 * math.sin(0.9 * x) * math.cos(0.7 * y + image) for x in range(SIZE)] for y in range(SIZE)]
    at, n = {0: ((20, 30), 6), 1: ((20, 30), 6), 2: ((12, 15), 16)}.get(image, ((0, 0), 0))
    for y in range(at[0], at[0] + n):
        for x in range(at[1], at[1] + n):
            ground[y][x] += 80.0
    return ground, at, n


def test_pixels_to_verdicts(spark, tmp_path):
    """Squares of 24 and 64 px are found, nothing else is; measures by plain arithmetic; a second run gives the same rows."""
    source, out = str(tmp_path / "events.parquet"), str(tmp_path / "out")
    values = [(i * SIZE * SIZE + y * SIZE + x, v) for i in range(4) for y, line in enumerate(scene(i)[0]) for x, v in enumerate(line)]
    spark.createDataFrame([*values, (None, 1.0), (5, None)], "event_id long, value double").write.parquet(source)
    config = {"width": SIZE, "lines": SIZE, "scale": SCALE, "box": 25, "z": 3.0, "min_cells": 9, "renderings": 2}
    got = {r["image"]: r.asDict() for r in investigate.run(spark, source, out, config).collect()}
    assert sorted(got) == [0, 1, 2]
    for image, r in got.items():
        ground, (y0, x0), n = scene(image)
        assert (r["x"], r["y"], r["w"], r["h"]) == (x0 * SCALE, y0 * SCALE, n * SCALE, n * SCALE)
        inside = [ground[y][x] for y in range(y0, y0 + n) for x in range(x0, x0 + n)]
        around = [ground[y][x] for y in range(y0 - 5, y0 + n + 5) for x in range(x0 - 5, x0 + n + 5) if not (y0 <= y < y0 + n and x0 <= x < x0 + n)]
        mean = sum(around) / len(around)
        std = math.sqrt(sum((v - mean) ** 2 for v in around) / len(around))
        assert r["contrast"] == pytest.approx((sum(inside) / len(inside) - mean) / (std + 1e-6), abs=1e-4) and r["polarity"] == "bright" and r["survives"]
    assert [(got[i]["agrees"], got[i]["disagrees"]) for i in (0, 1, 2)] == [(1, 0), (1, 0), (0, 1)]
    assert got[0]["verdict"] == "CONFIRMED-LEAD" and got[2]["verdict"] == "PROMISING"
    before = rows(spark.read.parquet(f"{out}/verdicts"))
    assert rows(investigate.run(spark, source, out, config)) == before


def test_no_pixels(spark, tmp_path):
    source = str(tmp_path / "events.parquet")
    spark.createDataFrame([], "event_id long, value double").write.parquet(source)
    assert investigate.run(spark, source, str(tmp_path / "out")).count() == 0


def test_no_pages(spark, tmp_path):
    source, out = str(tmp_path / "pages.parquet"), str(tmp_path / "out")
    pages(spark).write.parquet(source)
    assert crawl_catalogue.run(spark, source, out).count() == 0
    pages(spark, *FIRST).write.mode("append").parquet(source)
    assert crawl_catalogue.run(spark, source, out).count() == 2
