"""Kernels by bands of a few lines, against the same kernels of whole images."""

import numpy as np
import pytest

from selenite.operators import relational as R
from selenite.plans import registry
from selenite.raster import bands as B
from selenite.raster import evidence as E
from selenite.raster import kernels as K

TALL = 8


def scene(high: int, seed: int) -> np.ndarray:
    """Noise with a long hook and discs, some of them on the borders of bands, float32 as in the tables."""
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 1, (high, 30))
    a[3:29, 4] += 40
    a[28, 4:12] += 40
    a[20:28, 11] += 40
    for y, x in ((40, 20), (47, 6), (high - 3, 25)):
        a[y - 2 : y + 3, x - 2 : x + 3] += 25
    return a.astype(np.float32)


@pytest.fixture(scope="module")
def images():
    return {0: scene(61, 1), 1: np.roll(scene(67, 1), (2, 1), (0, 1)), 2: scene(64, 3), 3: scene(64, 4), 5: scene(90, 5)}


@pytest.fixture(scope="module")
def lines(spark, images):
    rows = [(k, 1000 - k + 7 * y, line.tolist()) for k, a in images.items() for y, line in enumerate(a)]
    return B.lined(spark.createDataFrame(rows, "label int, vec_id long, embedding array<float>").repartition(5), "label", "vec_id", "embedding")


def by_image(df):
    return {r["image_id"]: r.asDict() for r in df.collect()}


def test_lines_are_numbered_by_ranges(lines, images):
    got = lines.collect()
    assert len(got) == sum(len(a) for a in images.values())
    assert all(r["values"] == images[r["image_id"]][r["y"]].tolist() for r in got)


def test_quantiles_by_key(spark):
    rng = np.random.default_rng(2)
    by = {0: rng.normal(size=5000), 1: rng.integers(0, 4, 3000) * 1.0, 2: np.array([7.0]), 3: np.array([1.0, 2.0])}
    df = spark.createDataFrame([(k, float(x)) for k, v in by.items() for x in v] + [(2, None)], "k int, v double").repartition(7)
    shares = {"a": 0.0, "b": 0.02, "c": 0.5, "d": 0.99, "e": 1.0}
    for r in R.quantiles_by(df, ["k"], df["v"], shares).collect():
        assert [r[n] for n in shares] == pytest.approx(np.quantile(by[r["k"]], list(shares.values())).tolist(), abs=1e-12)


def test_compare_by_bands(lines, images):
    """Also images of other sizes than the reference, and alone in their footprint."""
    got = by_image(B.compared(lines, B.F.floor(B.F.col("image_id") / 2), tall=TALL))
    assert set(got) == {1, 3}
    for k, r in got.items():
        want = E.compared(images[k - 1].astype(np.float64), images[k].astype(np.float64))
        assert {n: r[n] for n in want if n != "persistence"} == {n: v for n, v in want.items() if n != "persistence"}
    assert got[1]["footprint"] == 0


def test_compare_moved(spark, images):
    """A shift is told, applied across bands, and what it uncovers is filled with the mean."""
    a = images[2]
    both = {0: a, 1: np.roll(a, (-3, 2), (0, 1))}
    df = spark.createDataFrame([(k, y, line.tolist()) for k, v in both.items() for y, line in enumerate(v)], "label int, vec_id long, embedding array<float>")
    r = B.compared(B.lined(df, "label", "vec_id", "embedding"), B.F.lit(0).cast("long"), tall=TALL).first()
    want = E.compared(*(v.astype(np.float64) for v in both.values()))
    assert (r["dx"], r["dy"]) == (want["dx"], want["dy"]) != (0, 0)
    assert all(r[n] == want[n] for n in ("mean_abs", "max_abs", "p95", "likeness", "verdict", "trusted"))


def test_kernel_compare_goes_by_bands(spark, monkeypatch):
    """The query's images meet their references as bands."""
    seen, real = [], B.resized
    monkeypatch.setattr(B, "resized", lambda *a, **k: seen.append(1) or real(*a, **k))
    assert registry.QUERIES["kernel_compare"](spark, "/root/testdata/sf0.001").count() == 5 and seen


@pytest.mark.parametrize(("cap", "most_side"), [(256, 1600), (24, 40)])
def test_measures_by_bands(lines, images, cap, most_side):
    """With and without a thinned spectrum and a smaller copy for captions."""
    got = by_image(B.measures(lines, cap, most_side, TALL))
    assert set(got) == set(images)
    for k, a in images.items():
        a = a.astype(np.float64)
        h, w = a.shape
        box = (w // 4, h // 4, w // 2, h // 2)
        assert got[k] == {"image_id": k, "grid_energy": K.grid_energy(a, cap), "roundness": K.roundness(a), "persistence": K.median_persistence(a, box), "flagged": K.text_lines(a, most_side)["flagged"]}


@pytest.mark.parametrize("name", ["kernel_detect", "kernel_evidence"])
def test_boxes_by_bands(lines, images, name):
    """Components across bands are one; boxes and the best one's evidence are those of whole images."""
    if name == "kernel_detect":
        got = sorted((r["image_id"], r["x"], r["y"], r["w"], r["h"], r["fill"], r["score"]) for r in B.detected(lines, 2.5, 3, tall=TALL).collect())
        want = sorted((k, *(r[c] for c in ("x", "y", "w", "h", "fill", "score"))) for k, a in images.items() for r in K.detect(a.astype(np.float64), (1,), 2.5, 3))
        assert got == want and max(r[4] for r in got) > 2 * TALL
        return
    got = by_image(B.evidence(lines, 2.5, 3, TALL))
    assert set(got) == set(images)
    for k, a in images.items():
        a = a.astype(np.float64)
        want = E.analysed(E.greys(a, a.min(), a.max()), 1, (1,), z=2.5, least=3)[0]
        assert all(v == want.get(n) for n, v in got[k].items() if n != "image_id")


def test_shift_is_told_from_the_whole_image(spark):
    """A middle part that lies still doesn't hide that the image around it is moved; images of over 700 lines, by bands and blocks."""
    rng = np.random.default_rng(6)
    for high, wide in ((720, 16), (40, 705)):
        a = rng.normal(0, 1, (high, wide)).astype(np.float32)
        b = np.roll(a, (-5, 2), (0, 1))
        side = min(high, wide)
        y, x = (high - side) // 2, (wide - side) // 2
        b[y : y + side, x : x + side] = a[y : y + side, x : x + side]
        df = spark.createDataFrame([(k, i, line.tolist()) for k, v in enumerate((a, b, a)) for i, line in enumerate(v)], "label int, vec_id long, embedding array<float>")
        got = by_image(B.compared(B.lined(df, "label", "vec_id", "embedding"), B.F.lit(0).cast("long"), tall=100, side=40))
        assert set(got) == {1, 2}
        for k, v in ((1, b), (2, a)):
            want = E.compared(a.astype(np.float64), v.astype(np.float64))
            assert (got[k]["dx"], got[k]["dy"]) == (want["dx"], want["dy"]) == ((-2, 5) if k == 1 else (0, 0))
            assert all(got[k][n] == want[n] for n in ("mean_abs", "max_abs", "p95", "likeness", "verdict", "trusted"))


def test_equal_peaks(spark):
    """Where copies in both images make many shifts fit alike, the first is taken, by bands as in whole images."""
    rng = np.random.default_rng(7)
    a = np.tile(rng.normal(0, 1, (90, 13)), (9, 1)).astype(np.float32)
    b = np.tile(np.roll(a[:90], (-5, 2), (0, 1)), (9, 1))
    df = spark.createDataFrame([(k, i, line.tolist()) for k, v in enumerate((a, b)) for i, line in enumerate(v)], "label int, vec_id long, embedding array<float>")
    r = B.compared(B.lined(df, "label", "vec_id", "embedding"), B.F.lit(0).cast("long"), most_shift=0.2, tall=100, side=40).first()
    want = E.compared(a.astype(np.float64), b.astype(np.float64), most_shift=0.2)
    assert (r["dx"], r["dy"]) == (want["dx"], want["dy"]) == (-2, 5)


def energy(a: np.ndarray) -> float:
    """Share of the strongest hundredth of all coefficients but the mean's."""
    power = np.abs(np.fft.rfft2(a - a.mean())) ** 2
    power[0, 0] = 0
    flat = np.sort(power.ravel())[::-1]
    return float(flat[: max(1, round(flat.size * 0.01))].sum() / flat.sum())


def test_spectrum_is_whole(spark):
    """Every line and column counts in images of over 256 a side, as do all of equal strength; constant and tiny images have none."""
    rng = np.random.default_rng(8)
    odd = rng.normal(0, 1, (301, 20))
    odd[::2] = odd[:, ::2] = 0  # what every second line and column holds
    spot = np.zeros((60, 9))
    spot[7, 5] = 3
    grid = rng.normal(0, 1, (40, 517)) + 3 * np.sin(np.arange(517) * 2.9)
    images = {k: a.astype(np.float32).astype(np.float64) for k, a in enumerate((odd, spot, grid, np.full((33, 10), 0.1), rng.normal(0, 1, (7, 9))))}
    whole = [K.grid_energy(a) for a in images.values()]
    assert whole[:3] == pytest.approx([energy(images[k]) for k in range(3)], abs=6e-5) and whole[3:] == [0, 0]
    assert [K.grid_energy(a, 20) for a in images.values()] == whole
    df = spark.createDataFrame([(k, y, line.tolist()) for k, a in images.items() for y, line in enumerate(a)], "label int, vec_id long, embedding array<float>")
    lines = B.lined(df, "label", "vec_id", "embedding")
    facts = B.sizes(lines).join(B.pixels(lines).groupBy("image_id").agg(B.F.avg("v").alias("mean")), "image_id")
    got = {r["image_id"]: r["top"] / r["total"] if r["total"] else 0.0 for r in B.energies(lines, facts, 40, 64).collect()}
    assert [got[k] for k in images] == pytest.approx(whole, abs=6e-5)


def test_large_box_has_its_whole_spectrum(spark):
    """kernel_evidence on a box whose surroundings are over 256 lines high."""
    a = np.random.default_rng(9).normal(0, 1, (420, 24))
    a[60:330, 11:13] += 30
    a = a.astype(np.float32)
    df = spark.createDataFrame([(4, y, line.tolist()) for y, line in enumerate(a)], "label int, vec_id long, embedding array<float>")
    r = B.evidence(B.lined(df, "label", "vec_id", "embedding"), 2.5, 3, 100).first()
    a = a.astype(np.float64)
    part, _ = E.crop(E.greys(a, a.min(), a.max()), (r["x"], r["y"], r["w"], r["h"]))
    assert len(part) > 256 and r["grid_energy"] == pytest.approx(energy(part), abs=6e-5)
