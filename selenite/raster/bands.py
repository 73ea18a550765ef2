"""Kernels of images of any height. An image is lines of pixels (image_id, y, values), dealt by bands with the lines around them that a
kernel looks at: no task gets a whole image. What is known of an image as a whole, one row of numbers, is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..session import cut
from . import evidence as E
from . import kernels as K

#: Lines of a band.
TALL = 1024
#: Side of a square of about as many Fourier coefficients as a block of whole columns of them has.
SIDE = 256


def lined(df: DataFrame, image: str, order: str, values: str) -> DataFrame:
    """Lines of the images ``image``, a whole number, in the order of a distinct number; ranges of it are numbered on their own."""
    e = df.filter(F.col(values).isNotNull()).select(F.col(image).cast("long").alias("image_id"), F.col(order).alias("_o"), F.col(values).alias("values"))
    ranges = R.cuts_of(e, "_o")
    ranged = e.withColumn("_part", F.size(F.filter(F.array(*map(F.lit, ranges)), lambda c: c < F.col("_o"))) if ranges else F.lit(0))
    earlier = Window.partitionBy("image_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    heads = ranged.groupBy("image_id", "_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    heads = cut(heads.drop("_n"))
    own = F.row_number().over(Window.partitionBy("image_id", "_part").orderBy("_o")) - 1
    y = (own + F.col("_before")).cast("int").alias("y")
    return cut(ranged.join(F.broadcast(heads), ["image_id", "_part"]).select("image_id", y, "values"))


def sizes(lines: DataFrame) -> DataFrame:
    return lines.groupBy("image_id").agg((F.max("y") + 1).alias("height"), F.max(F.size("values")).alias("width"))


def pixels(lines: DataFrame) -> DataFrame:
    return lines.select("image_id", F.explode(F.col("values").cast("array<double>")).alias("v"))


def array_of(f: pd.DataFrame) -> np.ndarray:
    return np.stack(f.sort_values("y")["values"].to_numpy()).astype(np.float64)


def per_band(lines: DataFrame, facts: DataFrame, halo: int, kernel: Callable[[np.ndarray, int, int, pd.Series], dict | pd.DataFrame], schema: str, tall: int = TALL) -> DataFrame:
    """Rows that ``kernel`` makes of each band, with their image_id. It gets the band's lines with up to ``halo`` lines, as far as there are
    any, on each side; the place among them and the number in the image of the band's first line; its image's row of ``facts``
    (image_id, height, width and more). The band's own lines are ``tall`` from there, fewer at the image's end."""
    at = lambda y: F.floor(y / tall).cast("int")
    first, last = F.greatest(F.lit(0), at(F.col("y") - halo)), F.least(at(F.col("height") - 1), at(F.col("y") + halo))
    dealt = lines.join(F.broadcast(facts), "image_id").withColumn("_band", F.explode(F.sequence(first, last)))

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        top = int(key[1]) * tall
        made = kernel(array_of(f), top - int(f["y"].min()), top, f.iloc[0])
        return (made if isinstance(made, pd.DataFrame) else pd.DataFrame([made])).assign(image_id=key[0])

    return dealt.groupBy("image_id", "_band").applyInPandas(run, schema)


def resized(lines: DataFrame, facts: DataFrame, before: Callable[[np.ndarray, pd.Series], np.ndarray] = lambda a, _: a, tall: int = TALL) -> DataFrame:
    """Lines, of doubles, of images brought to to_height x to_width of their ``facts`` as by kernels.resized(), after ``before``.

    A line goes to the bands of new lines that it has a weight in; about ``tall`` old lines make a band.
    """
    c = F.col
    scale = c("height") / c("to_height")
    reach = F.greatest(scale, F.lit(1.0))
    each = F.greatest(F.lit(1), F.floor(F.lit(tall) / reach).cast("int"))
    near = lambda s, f: f((c("y") + 0.5 + s * reach) / scale - 0.5)
    first, last = F.greatest(F.lit(0), near(-1, F.ceil)), F.least(c("to_height") - 1, near(1, F.floor))
    dealt = lines.join(F.broadcast(facts.withColumn("_each", each)), "image_id").withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    dealt = dealt.withColumn("_band", F.explode(F.sequence(F.floor(c("_first") / c("_each")), F.floor(c("_last") / c("_each"))))).drop("_first", "_last")

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        r = f.iloc[0]
        new = np.arange(key[1] * r._each, min((key[1] + 1) * r._each, r.to_height))
        weight = K.triangle(new, np.sort(f["y"].to_numpy()), r.height / r.to_height)
        a = weight @ before(array_of(f), r)
        a = a @ K.triangle(np.arange(r.to_width), np.arange(r.width), r.width / r.to_width).T if r.to_width != r.width else a
        return pd.DataFrame({"image_id": key[0], "y": new, "values": list(a)})

    return dealt.groupBy("image_id", "_band").applyInPandas(run, "image_id long, y int, values array<double>")


def transformed(lines: DataFrame, facts: DataFrame, before: Callable[[np.ndarray, pd.Series], np.ndarray] = lambda a, _: a, side: int = SIDE, tall: int = TALL) -> DataFrame:
    """Fourier coefficients of each line, after ``before``, the half that real numbers have, dealt for a transform down the columns:
    image_id, block, top, wide, part, a row a band (from line ``top`` on) and block of ``wide`` columns. A block has about
    ``side`` x ``side`` coefficients of an image, or one column."""
    facts = facts.withColumn("_each", F.greatest(F.lit(1), F.floor(F.lit(side * side) / F.col("height")).cast("int")))

    def run(a: np.ndarray, own: int, top: int, r: pd.Series) -> pd.DataFrame:
        half = np.fft.rfft(before(a, r), axis=1)
        blocks = np.split(half, range(r["_each"], half.shape[1], r["_each"]), axis=1)
        return pd.DataFrame([(k, top, v.shape[1], v.tobytes()) for k, v in enumerate(blocks)], columns=["block", "top", "wide", "part"])

    return per_band(lines, facts, 0, run, "image_id long, block int, top int, wide int, part binary", tall)


def _parts(f: pd.DataFrame, by: str) -> list[np.ndarray]:
    """Parts of a spectrum in the order of their bands or blocks."""
    return [np.frombuffer(r.part, np.complex128).reshape(-1, r.wide) for r in f.sort_values(by).itertuples()]


def strongest(powers: DataFrame, wanted: DataFrame) -> DataFrame:
    """image_id, top, total: the sum of the ``wanted`` largest values of each image, a number in its row, and that of all of them.
    ``powers`` (image_id, part) has the values, none negative, as bytes of doubles.

    A selection by the bits of the values, which are in the order of the values: they are counted by their first 19 bits, those that share
    them with the wanted rank by the next 22, and then by the last. No task gets more than a row a bin of an image.
    """
    c = F.col
    image = Window.partitionBy("image_id")
    larger = image.orderBy(F.desc("key")).rowsBetween(Window.unboundedPreceding, -1)
    left = wanted.select("image_id", "wanted", F.lit(0).cast("long").alias("head"), F.lit(0.0).alias("top"), F.lit(None).cast("double").alias("total"))
    for above, low in ((63, 44), (44, 22), (22, 0)):

        def counted(frames, above=above, low=low):
            for f in frames:
                for r in f.itertuples():
                    v = np.frombuffer(r.part)
                    bits = v.view(np.int64) & np.iinfo(np.int64).max
                    own = bits >> above == r.head
                    if own.any():
                        keys, at, n = np.unique(bits[own] >> low, return_inverse=True, return_counts=True)
                        yield pd.DataFrame({"image_id": r.image_id, "key": keys, "n": n, "s": np.bincount(at, v[own])})

        told = powers.join(F.broadcast(left.select("image_id", "head")), "image_id").mapInPandas(counted, "image_id long, key long, n long, s double")
        bins = told.groupBy("image_id", "key").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).join(F.broadcast(left.select("image_id", "wanted", "top", "total")), "image_id")
        bins = bins.withColumns({"_n": F.coalesce(F.sum("n").over(larger), F.lit(0)), "_s": F.coalesce(F.sum("s").over(larger), F.lit(0.0)), "total": F.coalesce("total", F.sum("s").over(image))})
        bins = bins.filter((c("_n") < c("wanted")) & (c("_n") + c("n") >= c("wanted")))
        left = cut(bins.select("image_id", (c("wanted") - c("_n")).alias("wanted"), c("key").alias("head"), (c("top") + c("_s")).alias("top"), "total", (c("s") / c("n")).alias("each")))
    return left.select("image_id", (c("top") + c("wanted") * c("each")).alias("top"), "total")


def energies(lines: DataFrame, facts: DataFrame, side: int = SIDE, tall: int = TALL) -> DataFrame:
    """image_id, top, total: the power of the strongest hundredth of the whole spectrum and of all of it but the mean, whose ratio is
    kernels.grid_energy(); of images under 64 pixels the total is 0. ``facts`` has height, width and mean."""

    def power(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        v = np.abs(np.fft.fft(np.concatenate(_parts(f, "top")), axis=0)) ** 2
        if key[1] == 0:
            v[0, 0] = 0
        return pd.DataFrame({"image_id": [key[0]], "part": [v.tobytes()]})

    c = F.col
    parts = transformed(lines, facts, lambda a, r: a - r["mean"], side, tall)
    powers = cut(parts.groupBy("image_id", "block").applyInPandas(power, "image_id long, part binary"))
    wanted = F.greatest(F.lit(1), F.rint(c("height") * (F.floor(c("width") / 2) + 1) * 0.01).cast("long"))
    found = strongest(powers, facts.select("image_id", wanted.alias("wanted"))).join(F.broadcast(facts), "image_id")
    return found.select("image_id", "top", F.when(c("height") * c("width") < 64, F.lit(0.0)).otherwise(c("total")).alias("total"))


def _moments(name: str) -> list[Column]:
    return [F.sum(f"{name}_{c}_{s}").alias(f"{name}_{c}_{s}") for c in ("in", "out") for s in "nsq"]


def _contrast(r, name: str) -> float:
    """kernels.box_contrast() from the counts, sums and squares, less the image's mean, in and out of the box."""
    n, m = r[f"{name}_in_n"], r[f"{name}_out_n"]
    if not n or not m:
        return 0.0
    out = r[f"{name}_out_s"] / m
    return abs(r[f"{name}_in_s"] / n - out) / (np.sqrt(max(0.0, r[f"{name}_out_q"] / m - out**2)) + 1e-6)


def measures(lines: DataFrame, side: int = SIDE, most_side: int = 1600, tall: int = TALL) -> DataFrame:
    """image_id, grid_energy, roundness, persistence of the middle box and flagged (captions), as kernels.py has them of a whole image.

    In one task are at most a band, a block of columns of the spectrum, and ``most_side`` x ``most_side`` pixels for the captions.
    """
    c = F.col
    values = pixels(lines)
    q = R.quantiles_by(values, ["image_id"], c("v"), {"low": 0.01, "mid": 0.5, "high": 0.99})
    facts = sizes(lines).join(values.groupBy("image_id").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std")), "image_id").join(q, "image_id")
    small = F.least(F.lit(1.0), F.lit(float(most_side)) / F.greatest("height", "width"))
    shrunk = lambda n: F.when(c("small") < 1, F.greatest(F.lit(8), F.floor(c(n) * c("small")).cast("int"))).otherwise(c(n))
    facts = facts.withColumn("small", small)
    facts = cut(facts.withColumns({"to_height": shrunk("height"), "to_width": shrunk("width")}))

    def band(a: np.ndarray, own: int, top: int, r: pd.Series) -> dict:
        core = slice(own, own + tall)
        m, edge = K.opened(np.abs(a - r["mid"]) > 1.5 * (r["std"] + 1e-6))
        box = np.zeros(a.shape, bool)
        y0 = r["height"] // 4 - top + own
        box[max(0, y0) : max(0, y0 + r["height"] // 2), r["width"] // 4 : r["width"] // 4 + r["width"] // 2] = True
        out = {"area": int(m[core].sum()), "edge": int(edge[core].sum())}
        for name, v in (("before", a), ("after", K.median5(a))):
            for part, inside in (("in", box[core]), ("out", ~box[core])):
                d = v[core][inside] - r["mean"]
                out |= {f"{name}_{part}_n": d.size, f"{name}_{part}_s": d.sum(), f"{name}_{part}_q": (d**2).sum()}
        return out

    sums = ", ".join(f"{n}_{p}_n long, {n}_{p}_s double, {n}_{p}_q double" for n in ("before", "after") for p in ("in", "out"))
    told = per_band(lines, facts, 3, band, f"image_id long, area long, edge long, {sums}", tall)
    told = told.groupBy("image_id").agg(F.sum("area").alias("area"), F.sum("edge").alias("edge"), *_moments("before"), *_moments("after"))

    def grey(a: np.ndarray, r: pd.Series) -> np.ndarray:
        v = np.clip((a - r["low"]) * (255.0 / (r["high"] - r["low"])), 0, 255) if r["high"] - r["low"] >= 1e-6 else np.zeros(a.shape)
        return np.floor(v) if r["small"] < 1 else v

    def captions(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        a, r = array_of(f), f.iloc[0]
        found = K.text_in(np.rint(a) if r["small"] < 1 else a, float(r["small"]), int(r["height"]), int(r["width"]))
        return pd.DataFrame({"image_id": [key[0]], "flagged": [found["flagged"]]})

    text = resized(lines, facts, grey, tall).join(F.broadcast(facts.select("image_id", "small", "height", "width")), "image_id")
    text = text.groupBy("image_id").applyInPandas(captions, "image_id long, flagged boolean")

    def rows(frames):
        for f in frames:
            before = f.apply(_contrast, axis=1, args=("before",), result_type="reduce")
            after = f.apply(_contrast, axis=1, args=("after",), result_type="reduce")
            kept = [round(float(np.clip(a / b, 0, 1)), 3) if b > 0 else 0.0 for a, b in zip(after, before, strict=True)]
            energy = [round(float(a / b), 4) if b > 0 else 0.0 for a, b in zip(f["top"], f["total"], strict=True)]
            yield pd.DataFrame({"image_id": f["image_id"], "grid_energy": energy, "roundness": [K.round_of(m, e) for m, e in zip(f["area"], f["edge"], strict=True)], "persistence": kept, "flagged": f["flagged"]})

    return told.join(energies(lines, facts, side, tall), "image_id").join(text, "image_id").mapInPandas(rows, "image_id long, grid_energy double, roundness double, persistence double, flagged boolean")


def _unit() -> Column:
    """evidence.unit() of each value of a line, with the percentiles p and q beside it."""
    scaled = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - F.col("p")) / F.greatest(F.col("q") - F.col("p"), F.lit(1e-6))))
    return F.transform("values", scaled)


def peaks(lines: DataFrame, pairs: DataFrame, side: int = SIDE, tall: int = TALL) -> DataFrame:
    """image_id, y, x: where the normalised cross power of the images ``ref`` and image_id of ``pairs``, both to_height x to_width, is
    largest, as kernels.phase_shift() has it of whole images, before it wraps.

    Lines are transformed by bands, columns by blocks, where both images meet, then lines back by bands: a task has a band or a block.
    """
    c = F.col
    roles = pairs.select("image_id", c("image_id").alias("pair"), F.lit(False).alias("first"), "to_width")
    roles = roles.unionByName(pairs.select(c("ref").alias("image_id"), c("image_id").alias("pair"), F.lit(True).alias("first"), "to_width"))
    facts = pairs.select("image_id", "to_height").unionByName(pairs.select(c("ref").alias("image_id"), "to_height")).distinct().withColumnRenamed("to_height", "height")
    met = transformed(lines, facts, side=side, tall=tall).join(F.broadcast(roles), "image_id").drop("image_id")

    def cross(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        a, b = (np.fft.fft(np.concatenate(_parts(f[f["first"] == first], "top")), axis=0) for first in (True, False))
        both = a * np.conj(b)
        if key[1] == 0:
            both[0, 0] = 0  # the means
        v = np.fft.ifft(both / (np.abs(both) + 1e-12), axis=0)
        rows = [(key[0], key[1], top, v.shape[1], int(f["to_width"].iloc[0]), v[top : top + tall].tobytes()) for top in range(0, len(v), tall)]
        return pd.DataFrame(rows, columns=["image_id", "block", "top", "wide", "to_width", "part"])

    def peak(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        v, y, x = K.peak_of(np.fft.irfft(np.concatenate(_parts(f, "block"), axis=1), f["to_width"].iloc[0], axis=1))
        return pd.DataFrame({"image_id": [key[0]], "y": [y + key[1]], "x": [x], "v": [v]})

    crossed = met.groupBy("pair", "block").applyInPandas(cross, "image_id long, block int, top int, wide int, to_width int, part binary")
    found = crossed.groupBy("image_id", "top").applyInPandas(peak, "image_id long, y int, x int, v double")
    return R.keep_best(found, ["image_id"], [F.desc("v"), c("y"), c("x")]).drop("v")


def compared(lines: DataFrame, group: Column, most_shift: float = 0.15, tall: int = TALL, side: int = SIDE) -> DataFrame:
    """Images of a ``group`` of image_id against the one of the smallest id, as evidence.compared() has them of whole images of any size.

    In one task are at most a band of lines, or a block of columns of both images' spectra.
    """
    c = F.col
    of = sizes(lines).withColumn("footprint", group)
    of = of.withColumn("ref", F.min("image_id").over(Window.partitionBy("footprint")))
    refs = of.filter("image_id = ref").select("ref", c("height").alias("to_height"), c("width").alias("to_width"))
    pairs = cut(of.filter("image_id <> ref").join(refs, "ref"))
    others = resized(lines.join(F.broadcast(pairs.select("image_id")), "image_id", "left_semi"), pairs, tall=tall)
    first = lines.join(F.broadcast(pairs.select(c("ref").alias("image_id")).distinct()), "image_id", "left_semi")
    both = cut(others.unionByName(first.withColumn("values", c("values").cast("array<double>"))))
    q = cut(R.quantiles_by(pixels(both), ["image_id"], c("v"), {"p": 0.02, "q": 0.98}))
    unit = both.join(F.broadcast(q), "image_id").select("image_id", "y", _unit().alias("values"))
    of_refs = unit.select(c("image_id").alias("ref"), "y", c("values").alias("a"))
    dx, dy = (F.when(c(p) > F.floor(c(n) / 2), c(p) - c(n)).otherwise(c(p)) for p, n in (("x", "to_width"), ("y", "to_height")))
    shifts = peaks(unit, pairs, side, tall).join(pairs, "image_id").select("image_id", dx.alias("dx"), dy.alias("dy"), "to_height", "to_width")
    shifts = shifts.withColumn("trusted", (F.abs("dx") <= most_shift * c("to_width")) & (F.abs("dy") <= most_shift * c("to_height")))
    shifts = shifts.select("image_id", *[F.when(c("trusted"), c(n)).otherwise(0).cast("int").alias(n) for n in ("dx", "dy")], "trusted")
    fill = pixels(unit).groupBy("image_id").agg(F.avg("v").alias("fill"))
    pairs = cut(pairs.join(shifts, "image_id").join(fill, "image_id"))
    moved = unit.join(F.broadcast(pairs.select("image_id", "dy")), "image_id").select("image_id", (c("y") + c("dy")).alias("y"), c("values").alias("b"))
    lying = of_refs.join(F.broadcast(pairs.select("image_id", "ref", "dx", "fill")), "ref").join(moved, ["image_id", "y"], "left")

    def apart(frames):
        for f in frames:
            shifted = (np.full(len(r.a), r.fill) if r.b is None else K.shift_image(np.asarray(r.b)[None], r.dx, 0, r.fill)[0] for r in f.itertuples())
            yield pd.DataFrame({"image_id": f["image_id"], "values": [np.abs(np.asarray(a) - b) for a, b in zip(f["a"], shifted, strict=True)]})

    d = pixels(cut(lying.select("image_id", "a", "b", "dx", "fill").mapInPandas(apart, "image_id long, values array<double>")))
    told = d.groupBy("image_id").agg(F.avg("v").alias("mean"), F.max("v").alias("most")).join(R.quantiles_by(d, ["image_id"], c("v"), {"p95": 0.95}), "image_id").join(pairs, "image_id")

    def rows(frames):
        for f in frames:
            made = [(r.footprint, r.image_id, r.dx, r.dy, r.trusted, round(r.mean, 4), round(r.most, 4), round(r.p95, 4), round(1 - min(1.0, r.mean), 4), E.divergence(r.mean)) for r in f.itertuples()]
            yield pd.DataFrame(made, columns=["footprint", "image_id", "dx", "dy", "trusted", "mean_abs", "max_abs", "p95", "likeness", "verdict"])

    return told.mapInPandas(rows, "footprint long, image_id long, dx int, dy int, trusted boolean, mean_abs double, max_abs double, p95 double, likeness double, verdict string")


def detected(lines: DataFrame, z: float, least: int, stretch: bool = False, tall: int = TALL) -> DataFrame:
    """Boxes of connected local outliers of each image at its own scale: image_id, label (their first cell), x, y, w, h, fill, score, as
    kernels.detect() has them of a whole image, whatever its size. ``stretch``: greys are brought to 0-255 first.

    A band's components are pieces, told by their first cell; a band looks one line into the next one, and pieces that share a cell
    there are linked. So only numbers of pieces and cells of border lines leave a task.
    """
    c = F.col
    facts = sizes(lines).join(pixels(lines).groupBy("image_id").agg(F.min("v").alias("low"), F.max("v").alias("high")), "image_id")

    def detail(a: np.ndarray, r: pd.Series) -> np.ndarray:
        a = E.greys(a, r["low"], r["high"]) if stretch else a
        return np.abs(a - K.box_blur(a, 9))

    def sums(a: np.ndarray, own: int, top: int, r: pd.Series) -> dict:
        d = detail(a, r)[own : own + tall]
        return {"n": d.size, "s": d.sum(), "q": ((d - d.mean()) ** 2).sum() + d.size * d.mean() ** 2}

    told = per_band(lines, facts, 4, sums, "image_id long, n long, s double, q double", tall).groupBy("image_id").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("mean"), F.sum("q").alias("q"))
    facts = cut(facts.join(told.select("image_id", "mean", F.sqrt(F.greatest(F.lit(0.0), c("q") / c("n") - c("mean") ** 2)).alias("std")), "image_id"))
    columns = ["piece", "cell", "over", "n", "x0", "x1", "y0", "y1", "s"]

    def pieces(a: np.ndarray, own: int, top: int, r: pd.Series) -> pd.DataFrame:
        score = ((detail(a, r) - r["mean"]) / (r["std"] + 1e-6))[own : own + tall + 1]
        high, wide = score.shape
        label = K.components(score > z)
        y, x = np.nonzero(label)
        f = pd.DataFrame({"piece": label[y, x].astype(np.int64) - 1 + top * wide, "y": y + top, "x": x, "s": score[y, x]})
        f["cell"] = f["y"].astype(np.int64) * wide + f["x"]
        mine = f[f["y"] < top + tall].groupby("piece").agg(n=("s", "size"), x0=("x", "min"), x1=("x", "max"), y0=("y", "min"), y1=("y", "max"), s=("s", "sum")).reset_index()
        links = [f.loc[f["y"] == at, ["piece", "cell"]].assign(over=over) for at, over in ((top, False), (top + tall, True)) if at]
        return pd.concat([mine, *links]).reindex(columns=columns)

    made = cut(per_band(lines, facts, 5, pieces, "image_id long, piece long, cell long, over boolean, n long, x0 int, x1 int, y0 int, y1 int, s double", tall))
    node = F.struct("image_id", "piece")
    side = lambda over, name: made.filter(c("cell").isNotNull() & (c("over") == over)).select("image_id", "cell", node.alias(name))
    roots = R.components(side(True, "a").join(side(False, "b"), ["image_id", "cell"]).select("a", "b").distinct())
    whole = made.filter("n > 0").withColumn("node", node).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = whole.groupBy("root").agg(F.sum("n").alias("n"), F.min("x0").alias("x"), F.min("y0").alias("y"), (F.max("x1") - F.min("x0") + 1).alias("w"), (F.max("y1") - F.min("y0") + 1).alias("h"), F.sum("s").alias("s")).filter(c("n") >= least)
    boxes = whole.select("root.image_id", c("root.piece").alias("label"), *"xywh", F.round(c("n") / (c("w") * c("h")), 3).alias("fill"), F.round(c("s") / c("n"), 3).alias("score"))
    return R.without_overlaps(boxes, "image_id", ["label"])


def evidence(lines: DataFrame, z: float, least: int, tall: int = TALL) -> DataFrame:
    """The best box of each image with its evidence, greys brought to 0-255, as evidence.analysed() has it of a whole image.

    Whole in one task is the best box with its surroundings.
    """
    c = F.col
    best = R.keep_best(detected(lines, z, least, True, tall), ["image_id"], [F.desc("score"), c("label")])
    grey = pixels(lines).groupBy("image_id").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    best = cut(best.join(grey, "image_id").withColumn("m", F.floor(F.greatest("w", "h") / 2).cast("int")))
    best = best.withColumns({"bx": c("x") - F.greatest(F.lit(0), c("x") - c("m")), "by": c("y") - F.greatest(F.lit(0), c("y") - c("m"))})
    rows = lines.withColumnRenamed("y", "_y").join(F.broadcast(best), "image_id").filter((c("_y") >= c("y") - c("m")) & (c("_y") < c("y") + c("h") + c("m")))
    rows = rows.withColumn("values", F.slice("values", c("x") - c("bx") + 1, c("bx") + c("w") + c("m")))
    kept = ("x", "y", "w", "h", "score", "polarity", "contrast", "grid_energy", "edge_sharpness", "contrast_stability", "roundness", "persistence")

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        r = f.iloc[0]
        part = E.greys(array_of(f.drop(columns="y").rename(columns={"_y": "y"})), r["low"], r["high"])
        shown = E.shown(part, tuple(int(r[n]) for n in ("bx", "by", "w", "h")))
        return pd.DataFrame([{n: r[n] if n in ("x", "y", "w", "h", "score") else shown.get(n) for n in kept}]).assign(image_id=key[0])

    return rows.groupBy("image_id").applyInPandas(run, "image_id long, x int, y int, w int, h int, score double, polarity string, contrast double, grid_energy double, edge_sharpness double, contrast_stability double, roundness double, persistence double")
