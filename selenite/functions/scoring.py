"""Candidate features, artifact flags, scores and verdicts, as columns over a row's measurements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import rounded

#: Flags that keep a candidate from being a lead. Fixed values.
DISQUALIFYING = ("streak", "hot_pixel", "compression", "dark_band", "elongated_large", "edge_artifact")
#: What to do next, by verdict.
ADVICE = {
    "EXPLAINED-ARTIFACT": "discard: known artifact",
    "DTM-ARTIFACT-RISK": "check the terrain model's defects first",
    "BAND-DEPENDENT": "discard: only in the reference rendering",
    "CONFIRMED-LEAD": "fetch the original and look for an independent pass",
    "PROMISING": "compare with siblings",
    "TERRAIN": "ordinary terrain",
    "WEAK": "watch list",
    "NOISE": "discard: below the floor",
}


def with_geometry(df: DataFrame, wide: Column, high: Column) -> DataFrame:
    """Adds area_px, aspect, on_grid8, near_edge, in_corner, dark_band to boxes x, y, w, h (with dark_frac) in a frame."""
    x, y, w, h = (F.col(c) for c in "xywh")
    near = lambda v: F.pmod(v + 2, F.lit(8)) <= 4
    # from the nearest corner: on each axis the nearer side
    side = lambda v, size: F.least(v, size - v)
    dx, dy = side(x + w * 0.5, wide), side(y + h * 0.5, high)
    corner = F.sqrt(dx * dx + dy * dy)
    return df.withColumns(
        {
            "area_px": w.cast("long") * h,
            "aspect": rounded(F.greatest(w, h) / F.greatest(F.lit(1), F.least(w, h)).cast("double"), 2),
            "on_grid8": near(x) & near(y),
            "near_edge": (x <= 1) | (y <= 1) | (x + w >= wide - 1) | (y + h >= high - 1),
            "in_corner": corner <= F.sqrt(wide * wide + high * high) * 0.07,
            "dark_band": (F.col("dark_frac") >= 0.9) & ((y <= high * 0.02) | (y + h >= high * 0.98)),
        }
    )


def flag_rules() -> dict[str, Column]:
    """Condition of each artifact flag."""
    c = F.col
    thin = (c("w") <= 12) | (c("h") <= 12)
    return {
        "streak": (c("aspect") >= 4) & thin,
        "hot_pixel": (c("area_px") <= 800) & (c("sat_frac") >= 0.3) & (c("contrast") >= 3),
        "small_blob": (c("area_px") < 1500) & (c("aspect") < 3),
        "compression": (c("on_grid8") & (c("fill") <= 0.3)) | ((c("fill") <= 0.12) & (c("aspect") < 3)),
        "saturation": c("sat_frac") >= 0.5,
        "edge_artifact": c("near_edge"),
        "dark_band": c("dark_band"),
        "elongated_large": (c("aspect") >= 4) & (c("area_px") >= 50000),
        "column_smear": c("smear_narrow") & (c("column_smear") >= 2.0),
        "corner": c("in_corner"),
    }


def bits(names) -> int:
    """The bit mask of some flags; bit k is the k-th name in order."""
    return sum(1 << k for k, name in enumerate(sorted(flag_rules())) if name in names)


def flag_bits() -> Column:
    """All flags that hold as one whole number, so that what follows tests bits and the conditions stand in a plan once.

    Folding an array also ends a generated method: with geometry, flags, scores and verdicts in one, the method passed the
    8000 bytes from which on the JVM only interprets it.
    """
    rules = flag_rules()
    held = F.array(*(F.when(rules[name], 1 << k).otherwise(0) for k, name in enumerate(sorted(rules))))
    return F.aggregate(held, F.lit(0), lambda bits, bit: bits.bitwiseOR(bit))


def has(names) -> Column:
    """Whether any of the flags holds."""
    return F.col("flag_bits").bitwiseAND(F.lit(bits(names))) != 0


def flags() -> Column:
    """Sorted array of the flags that hold."""
    return F.array_compact(F.array(*(F.when(has([name]), name) for name in sorted(flag_rules()))))


def mask(value: Column, names) -> Column:
    """A bit for the name that a value is, by the names' order; null for none. What bit_or() gathers of it is a number of fixed width, not a set."""
    return reduce(lambda w, k: w.when(value == k[1], 1 << k[0]), enumerate(sorted(names)), F.when(F.lit(False), 0))


def named(mask: Column, names) -> Column:
    """Sorted array of the names whose bits are set; empty for null."""
    return F.array_compact(F.array(*(F.when(mask.bitwiseAND(1 << k) != 0, name) for k, name in enumerate(sorted(names)))))


def interest() -> Column:
    """0 to 100; a null measurement earns nothing."""
    c = F.col
    zero = F.lit(0.0)
    part = lambda v, weight: F.least(F.coalesce(v, zero), F.lit(1.0)) * weight
    gain = [
        part(c("contrast") * 0.25, 35.0),
        part(c("area_px") / 30000.0, 15.0),
        F.coalesce(F.when(c("aspect").isNotNull(), (1.0 - F.least((c("aspect") - 1) / 9.0, F.lit(1.0))) * 15.0), zero),
        F.when(~c("near_edge"), 10.0).otherwise(0.0),
        F.when(c("sat_frac") < 0.3, 10.0).otherwise(0.0),
        part(c("matches") / 3.0, 15.0),
    ]
    # each flag costs 20; a streak 10 more, a small blob 5 less
    loss = F.bit_count("flag_bits") * 20.0 + F.when(has(["streak"]), 10.0).otherwise(0.0) - F.when(has(["small_blob"]), 5.0).otherwise(0.0)
    return rounded(F.greatest(zero, F.least(F.lit(100.0), reduce(Column.__add__, gain) - loss)), 1)


def not_small() -> Column:
    """Whether any flag but small_blob holds."""
    return has([n for n in flag_rules() if n != "small_blob"])


def evidence_class() -> Column:
    return F.when(not_small(), 1).when(F.col("matches") >= 2, 3).otherwise(2)


def adjudicated() -> Column:
    """Score from interest, agreement, persistence, compactness, ground, edge, flags, shadow and size; null signals count nothing."""
    c = F.col
    step = lambda *cases: reduce(lambda w, k: w.when(*k), cases[1:], F.when(*cases[0])).otherwise(0.0)
    terms = [
        step((c("agrees") >= 2, 30.0), (c("agrees") >= 1, 12.0)),  # 12 each for two of them, 6 more for the second
        step((c("persistence") >= 0.65, 6.0), (c("persistence") < 0.35, -6.0)),
        step((c("compactness") >= 0.7, 4.0), (c("compactness") < 0.2, -4.0)),
        step((c("bg_std") < 8, 8.0), (c("bg_std") < 14, 3.0)),
        step((c("near_edge"), -5.0)),
        step((not_small(), -8.0)),
        step((c("shadow_alignment") >= 0.75, 4.0), (c("shadow_alignment") < 0.35, -4.0)),
        step((c("shadow_expected") & (c("size_m") > 2000.0), -6.0)),
    ]
    return rounded(F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(c("interest"), F.lit(0.0)) + reduce(Column.__add__, terms))), 1)


def verdict(contrast_bar: float = 1.5) -> Column:
    c = F.col
    bad = has(DISQUALIFYING)
    discrete = (c("compactness") >= 0.5) & (c("aspect") < 3)
    lead = discrete & ~bad & c("area_px").between(200, 50000) & (c("contrast").isNull() | (c("contrast") >= contrast_bar))
    return (
        F.when(c("evidence_class") == 1, "EXPLAINED-ARTIFACT")
        .when(F.coalesce(c("dtm_known_artifacts"), F.lit("")) != "", "DTM-ARTIFACT-RISK")
        .when((c("xv_tested") >= 2) & (c("xv_collapse") == c("xv_tested")), "BAND-DEPENDENT")
        .when(c("agrees") >= 1, F.when(lead, "CONFIRMED-LEAD").otherwise("TERRAIN"))
        .when((c("score") >= 45) & ~bad, "PROMISING")
        .when(c("score") >= 28, "WEAK")
        .otherwise("NOISE")
    )


def confidence() -> Column:
    c = F.col
    return F.when(c("evidence_class") == 1, "low").when((c("agrees") >= 1) & (c("persistence") >= 0.6), "high").when(c("score") >= 50, "medium").otherwise("low")


def advice(verdict: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in ADVICE.items() for x in kv)), verdict)


def evaluate(boxes: DataFrame, wide: float, high: float) -> DataFrame:
    """Geometry, flags (as bits and as an array), class and interest of measured boxes."""
    df = with_geometry(boxes, F.lit(float(wide)), F.lit(float(high))).withColumn("flag_bits", flag_bits())
    return df.withColumns({"flags": flags(), "evidence_class": evidence_class(), "interest": interest()})


def adjudicate(evaluated: DataFrame, contrast_bar: float = 1.5) -> DataFrame:
    """Score, verdict and confidence of evaluated boxes with their evidence."""
    return evaluated.withColumn("score", adjudicated()).withColumns({"verdict": verdict(contrast_bar), "confidence": confidence()})
