"""What plans must not hold: generated methods that the JVM won't compile, joins that compare all pairs, stages of one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from selenite.functions import scoring as S
from selenite.operators import relational as R
from selenite.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["verdict_counts", "confidence_recommend", "interest_scores", "stress_curve", "nl_query_bright", "packages", "crops_by_box"])
def test_generated_methods_are_compiled(spark, name):
    """Methods over 8000 bytes are interpreted. Spark's own default limit, which splits nothing, holds here."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        stages = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.length())]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("name", ["baseline_join", "footprint_candidates", "gradient_p95", "diff_stats", "shift_change", "measure_fg_bg"])
def test_no_pairs_and_no_single_buffer(spark, name):
    """No join of all pairs, no exact percentile of all rows in one buffer."""
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
    assert not any(what in plan for what in ("NestedLoop", "CartesianProduct", "percentile(", "median("))


def test_ranks(spark):
    """Exact quantiles and deep pages, with many equal values and nulls, against plain lists."""
    values = sorted([float(k % 97) for k in range(5000)] + [3.0] * 3000 + [-1.5, 1e9])
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 10, "v double").repartition(8)
    got = R.quantiles(df, F.col("v"), {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}).first().asDict()
    for name, q in {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}.items():
        at = (len(values) - 1) * q
        low = values[int(at)]
        assert got[name] == pytest.approx(low + (values[min(int(at) + 1, len(values) - 1)] - low) * (at - int(at)))
    assert R.quantiles(df.filter("v IS NULL"), F.col("v"), {"m": 0.5}).first()["m"] is None
    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    want = sorted(((k % 7, k) for k in range(1000)))
    for offset, limit in ((0, 5), (990, 20), (2573, 40), (500, 1)):
        page = [want[(offset + i) % 1000][1] for i in range(limit)]
        got = R.circular_page(rows, [F.col("k"), F.col("id")], offset, limit, repeat=True, key=F.col("k")).orderBy("turn").collect()
        assert [r["id"] for r in got] == page and [r["turn"] for r in got] == list(range(limit))


def test_names_that_hold_names(spark):
    names = ["abc", "xabc", "bc", "c", "", "zz", "abcabc"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "t string")
    parts = spark.createDataFrame([(n,) for n in ["bc", "abc", "", "q", "zz"]], "p string")
    got = {tuple(r) for r in R.containing(df, parts, "t", "p").collect()}
    assert got == {(t, p) for t in names for p in ["bc", "abc", "zz"] if p in t}
    look = spark.createDataFrame([("bc", 1), ("xabc", 2), ("0zz", 3)], "n string, v int")
    got = {r["t"]: r["v"] for r in R.by_suffix(df, look, "t", "n", "v").collect()}
    assert got == {"abc": 1, "xabc": 2, "bc": 1, "c": 1, "": None, "zz": 3, "abcabc": 1, None: None}


def test_greedy_suppression(spark):
    """Boxes of very different sizes, equal ones, empty ones and a chain of overlapping ones, against a plain loop."""
    rng = np.random.default_rng(3)
    rows = [(int(k % 2), k, int(x), int(y), int(w), int(h)) for k, (x, y, w, h) in enumerate(zip(*rng.integers(-50, 150, (2, 300)), *rng.integers(0, 40, (2, 300)), strict=True))]
    rows += [(0, 1000 + k, -40, -40, 200 + k, 150) for k in range(3)] + [(1, 2000 + k, 5, 5, 9, 9) for k in range(20)] + [(2, k, 4 * k, 0, 10, 10) for k in range(12)]
    rows += [(0, 3000, 500, 500, 5000, 4000)]
    want = []
    for image in (0, 1, 2):
        kept = []
        for i, _, x, y, w, h in sorted(r for r in rows if r[0] == image):
            lap = lambda b: max(0, min(x + w, b[0] + b[2]) - max(x, b[0])) * max(0, min(y + h, b[1] + b[3]) - max(y, b[1])) > 0.5 * min(w * h, b[2] * b[3])  # noqa: E731, B023
            if not any(lap(b) for b in kept):
                kept.append((x, y, w, h))
        want += [(image, *b) for b in kept]
    df = spark.createDataFrame(rows, "image int, p int, x int, y int, w int, h int").repartition(5)
    got = [tuple(r) for r in R.without_overlaps(df, "image", ["p"]).select("image", *"xywh").collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("reach", [0, 1, 6, 8])
def test_groups_by_cells(spark, reach):
    """Places as dense as in large tables, at every offset in their cells, against a plain closure; rows without a place stay alone."""
    rng = np.random.default_rng(reach)
    side = 6 * (reach + 1)
    rows = [(k, int(b), int(x), int(y)) for k, (b, x, y) in enumerate(zip(rng.integers(0, 12, 400), *rng.integers(-side, side, (2, 400)), strict=True))]
    rows += [(1000 + k, 0, None, 3) for k in range(3)] + [(2000, None, 1, 1), (2001, None, 1, 1)]
    root = {r[0]: r[0] for r in rows}
    changed = True
    near = [(a[0], b[0]) for a in rows for b in rows if None not in a + b and a[1] == b[1] and abs(a[2] - b[2]) <= reach and abs(a[3] - b[3]) <= reach]
    while changed:
        changed = False
        for a, b in near:
            if root[a] < root[b]:
                root[b], changed = root[a], True
    df = spark.createDataFrame(rows, "node long, base int, x int, y int").repartition(5)
    assert {r["node"]: r["feature"] for r in R.groups(df, "node", "base", reach).collect()} == root
    assert R.count_groups(df, "node", "base", reach, "n").first()["n"] == len(set(root.values()))


def test_edges_grow_with_cells_not_with_boxes(spark):
    """Boxes on every pixel of a frame, twenty of each: a run a row of cells, and an edge between two rows."""
    df = spark.range(20 * 90 * 90).selectExpr("id AS node", "1 AS base", "id % 90 AS x", "id DIV 90 % 90 AS y")
    cells, edges = R.linked_cells(df, "node", "base", 8)
    assert cells.count() == 100 and edges.count() == 9


def test_dashboard_writes_no_rows(spark, monkeypatch):
    """What is written down are cells, counts and links: fewer rows than candidates."""
    from selenite.plans import features

    written, real = [], R.cut
    keep = lambda df: written.append(real(df)) or written[-1]
    monkeypatch.setattr(R, "cut", keep)
    monkeypatch.setattr(features, "cut", keep)
    features.Q["dashboard_stats"](spark, DATA)
    assert written and not any({"x", "y"} & set(df.columns) for df in written)


@pytest.mark.parametrize("name", ["overlay_anti_join", "semi_hit"])
def test_dealt_marks_are_not_broadcast(spark, name):
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_equal_marks_and_copies(spark):
    """Many equal marks and boxes: every box is judged, each row once."""
    boxes = spark.createDataFrame([(k % 2, k, 10 * (k % 7), 0, 5, 5) for k in range(100)], "frame int, id int, x int, y int, w int, h int")
    marks = spark.createDataFrame([(0, 10, 0, 40, 40)] * 50, "frame int, mx int, my int, mw int, mh int")
    inside = (F.col("x") >= F.col("mx")) & (F.col("x") < F.col("mx") + F.col("mw"))
    hit = {k for k in range(100) if k % 2 == 0 and 10 <= 10 * (k % 7) < 50}
    for how, want in (("left_semi", hit), ("left_anti", set(range(100)) - hit)):
        assert sorted(r["id"] for r in R.touching(boxes, marks, "frame", inside, how).collect()) == sorted(want)


def test_survivors_are_rounded_once(spark, tmp_path):
    """A q-value just under 0.0505 is 0.050 at three digits, though six digits make it 0.0505."""
    import math

    low, high = 80_000.0, 240_000.0
    while high - low > 1e-4:
        mid = (low + high) / 2
        low, high = (mid, high) if 0.5 * math.erfc(mid / 80_000 / math.sqrt(2)) > 0.05049975 else (low, mid)
    spark.createDataFrame([(1, low)], "o_orderkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    assert tuple(registry.QUERIES["fdr_survivors"](spark, str(tmp_path)).first()) == (1, 1)
    assert registry.QUERIES["fdr_q"](spark, str(tmp_path)).first()["fdr_q"] == 0.0505


@pytest.mark.parametrize("name", ["insights", "enriched_features", "category_histogram"])
def test_lines_travel_not_what_is_derived(spark, name, monkeypatch):
    """Features are made of lines dealt once by feature: one exchange below them, and it holds no sets, structs or names."""
    from selenite.functions import phrases

    seen = []
    monkeypatch.setattr(phrases, "cut", lambda df: seen.append(df) or df)
    df = registry.QUERIES[name](spark, DATA)
    plan = (seen or [df])[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [line for line in plan if "Exchange hashpartitioning(feature" in line]
    assert len(dealt) == 1 and "REPARTITION" in dealt[0]
    assert not seen or not {"flags", "bands", "polarities"} & set(seen[0].columns)


@pytest.mark.parametrize("name", ["insights_by_flags", "enriched_features"])
def test_features_are_made_as_rows_pass(spark, name, monkeypatch):
    """Lines are sorted where they arrive, before anything is derived from them; above them features are made without another sort or sets."""
    from selenite.functions import phrases

    seen = []
    monkeypatch.setattr(phrases, "cut", lambda df: seen.append(df) or df)
    df = registry.QUERIES[name](spark, DATA)
    plan = (seen or [df])[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    above = plan[: next(k for k, line in enumerate(plan) if "Exchange hashpartitioning(feature" in line)]
    assert "Sort [feature" in above[-1] and sum("Sort [" in line for line in above) == 1
    assert sum("SortAggregate(" in line for line in above) == 2 and not any("ObjectHash" in line for line in above)


def test_bits_of_names(spark):
    """Names gathered as bits are those that a sorted set holds; nulls are none."""
    rows = [(k % 3, [None, "", "RED", "MIRB"][(k * k) % 4]) for k in range(9)] + [(7, None)]
    df = spark.createDataFrame(rows, "g int, name string")
    names = ("MIRB", "RED", "")
    got = df.groupBy("g").agg(F.bit_or(S.mask(F.col("name"), names)).alias("m")).select("g", S.named(F.col("m"), names).alias("names"))
    assert {r["g"]: r["names"] for r in got.collect()} == {g: sorted({n for h, n in rows if h == g and n is not None}) for g in (0, 1, 2, 7)}


def test_leads_are_read_once(spark, monkeypatch):
    """Where no taxes are asked for, leads are filtered lines: nothing is shuffled before they are written down."""
    from selenite.plans import features

    plans, real = [], features.cut
    monkeypatch.setattr(features, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    features.cards(spark, DATA)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "Exchange" not in plans[0]


def test_leads_with_and_without_taxes(spark, tmp_path):
    """Lines whose key has a null are no leads, equal keys are, either way."""
    from selenite.plans import features

    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").limit(3000)
    odd = lines.limit(300)
    lines.unionByName(odd).unionByName(odd.withColumn("l_orderkey", F.lit(None).cast("long"))).unionByName(odd.withColumn("l_suppkey", F.lit(None).cast("long"))).write.parquet(str(tmp_path / "lineitem.parquet"))
    keys = [sorted(tuple(r) for r in features.leads(spark, str(tmp_path), taxes=taxes).select(*features.KEY).collect()) for taxes in (False, True)]
    assert keys[0] == keys[1] and keys[0] and len(set(keys[0])) < len(keys[0])


def test_neighbours_are_dealt_sparingly(spark):
    """Places on and beside the borders of cells, negative ones, copies: each pair once; the dealt side is under three times its rows."""
    rng = np.random.default_rng(5)
    rows = [(int(k % 3), k, int(x), int(y)) for k, (x, y) in enumerate(rng.integers(-120, 260, (300, 2)))]
    a = spark.createDataFrame(rows + rows[:50], "stem int, id int, x int, y int")
    b = a.select(*[F.col(c).alias("o_" + c) for c in a.columns])
    close = (F.abs(F.col("x") - F.col("o_x")) <= 24) & (F.abs(F.col("y") - F.col("o_y")) <= 24)
    joined = R.nearby(a, b, ["stem"], (24, 24), "inner", close)
    got = sorted((r["id"], r["o_id"]) for r in joined.collect())
    assert got == sorted((p[1], q[1]) for p in rows for q in rows if p[0] == q[0] and abs(p[2] - q[2]) <= 24 and abs(p[3] - q[3]) <= 24)
    assert R.nearby(a.limit(0), b, ["stem"], (24, 24), "right", F.lit(True)).count() < 3 * len(rows)
    plan = registry.QUERIES["sibling_matches"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("Exchange hashpartitioning(stem") == 1


def test_readmes_are_dealt_and_flattened_once(spark):
    """Rows of a small file are dealt out before their texts are made, and a text is made one line once, not for each field."""
    plan = registry.QUERIES["readme_fields"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(p_partkey" in plan and plan.count("regexp_replace") == 1
