"""Queries over all rows of their tables, against plain versions without a subset."""

from collections import defaultdict

import duckdb
import numpy as np
import pytest
from test_oracles import TABLES

from selenite.operators import throttle
from selenite.plans import registry, text
from selenite.raster import kernels as K
from selenite.sources.tables import BOXES

DATA = "/root/testdata/sf0.001"


def plain_throttle(kinds):
    delay, clean = 0.4, 0
    for kind in kinds:
        if kind == "error":
            delay, clean = min(30.0, delay * 2), 0
        else:
            clean += 1
            if clean >= 25:
                delay, clean = max(0.4, delay / 2), 0
    return round(delay, 6), clean


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_throttle_folds_all_events(spark, size):
    kinds = [r[0] for r in duckdb.sql(f"SELECT event_type FROM '/root/testdata/{size}/events.parquet' ORDER BY event_id, event_type NULLS FIRST").fetchall()]
    assert len(kinds) > 400
    assert [tuple(r) for r in registry.QUERIES["throttle"](spark, f"/root/testdata/{size}").collect()] == [plain_throttle(kinds)]


def test_throttle_composes_ranges(spark):
    kinds = [("error" if k % 37 < 3 else None if k % 11 == 0 else "view") for k in range(3000)] + ["error"] * 9 + ["view"] * 160
    log = spark.createDataFrame(list(enumerate(kinds)), "event_id long, event_type string").repartition(7)
    assert [tuple(r) for r in throttle.final_state(log).collect()] == [plain_throttle(kinds)]
    assert [tuple(r) for r in throttle.final_state(log.limit(0)).collect()] == [(0.4, 0)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_comparisons_have_rows(name):
    """Both sides of a comparison being empty would say nothing."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    assert con.sql(registry.ORACLES[name]).limit(1).fetchall()


def plain_greedy(found):
    """The boxes (x, y, w, h) of ``found`` that stay, each compared with all kept before."""
    kept = []
    for box in found:
        if all(K.overlap_share(box, k) <= 0.5 for k in kept):
            kept.append(box)
    return kept


def test_kernel_nms_is_by_image(spark, duck):
    by = defaultdict(list)
    for image, scale, *box in duck.sql(f"SELECT image, l_linenumber, x, y, w, h FROM ({BOXES}) ORDER BY l_linenumber, l_orderkey, l_partkey, x, y, w, h").fetchall():
        by[image].append((scale, tuple(box)))
    assert all(len({s for s, _ in v}) > 1 for v in by.values())
    want = sorted((image, *box) for image, v in by.items() for box in plain_greedy([b for _, b in v]))
    got = registry.QUERIES["kernel_nms"](spark, DATA).collect()
    assert sorted((r["image"], r["x"], r["y"], r["w"], r["h"]) for r in got) == want
    assert {r["scale"] for r in got} == {s for v in by.values() for s, _ in v}


def test_overlaps_by_grid():
    rng = np.random.default_rng(8)
    found = [{"x": int(x), "y": int(y), "w": int(w), "h": int(h), "scale": 1} for x, y, w, h in zip(*rng.integers(-60, 60, (2, 800)), *rng.integers(0, 50, (2, 800)), strict=True)]
    assert [tuple(r[c] for c in "xywh") for r in K.without_overlaps(found)] == plain_greedy([tuple(r[c] for c in "xywh") for r in found])


@pytest.mark.parametrize("first", [10, 100, 4096])
def test_suppression_by_stages(spark, first):
    """Crowded boxes, copies among them: the same ones stay however the stages are cut, and later stages meet few pairs."""
    from selenite.operators import relational as R

    rng = np.random.default_rng(4)
    rows = [(k % 2, k, *map(int, rng.integers(0, 60, 2)), *map(int, rng.integers(1, 25, 2))) for k in range(1200)]
    rows += [(i, k + 1200, *box) for i, k, *box in rows[:40]]
    df = spark.createDataFrame(rows, "image int, k int, x int, y int, w int, h int").repartition(5)
    want = sorted((i, *box) for i in (0, 1) for box in plain_greedy([tuple(r[2:]) for r in rows if r[0] == i]))
    assert sorted((r["image"], r["x"], r["y"], r["w"], r["h"]) for r in R.without_overlaps(df, "image", ["k"], first=first).collect()) == want
