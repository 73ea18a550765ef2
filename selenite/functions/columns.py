"""Column functions: names, numbers, geometry of boxes and of light."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of the rational approximation of erfc, constant term first. Fixed values.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def rounded(x: Column, digits: int) -> Column:
    """Half up by plain arithmetic, the same on every engine."""
    return F.floor(x * 10**digits + 0.5).cast("double") / 10**digits


# names


def acquisition(image: Column) -> Column:
    """Instrument, orbit and target of a name, else what stands before its first dot."""
    return F.coalesce(F.nullif(F.regexp_extract(image, r"^([A-Za-z]+_\d+_\d+)", 1), F.lit("")), F.split_part(image, F.lit("."), F.lit(1)))


def band(image: Column) -> Column:
    return F.regexp_extract(image, r"_(MIRB|MRGB|RED)\.", 1)


def base_frame(image: Column) -> Column:
    """Name without band and scale; empty: what stands before the first dot."""
    stem = F.regexp_replace(image, r"_(MIRB|MRGB|RED)\.(browse|abrowse|thumb).*$", "")
    return F.coalesce(F.nullif(stem, F.lit("")), F.split_part(image, F.lit("."), F.lit(1)))


def sibling_stem(image: Column) -> Column:
    """File names of one footprint share it, in whatever folder; other names stand alone, without folder and extension."""
    name = F.regexp_replace(image, r"^.*[/\\\\]", "")
    own = F.regexp_extract(name, r"^(ESP_\d+_\d+|PIA\d+)", 1)
    return F.when(own != "", own).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def body(path: Column) -> Column:
    low = F.lower(path)
    return F.when(low.rlike("moon|lunar|lroc|apollo"), "Moon").when(low.rlike("mars|esp_|psp_|hirise"), "Mars").otherwise("unknown")


def band_token(path: Column) -> Column:
    """Last ``_`` part of a file's name before its first dot."""
    return F.element_at(F.split(F.split_part(F.regexp_replace(path, r"^.*[/\\\\]", ""), F.lit("."), F.lit(1)), "_"), -1)


def product_of(path: Column) -> Column:
    """The folder under data/processed, else the first two ``_`` parts of the file's name, else the name."""
    norm = F.regexp_replace(path, r"\\", "/")
    parts, name = F.split(norm, "/"), F.regexp_replace(norm, r"^.*/", "")
    under = (F.size(parts) >= 3) & (F.get(parts, 0) == "data") & (F.get(parts, 1) == "processed")
    bits = F.split(name, "_")
    return F.when(under, F.get(parts, 2)).when(F.size(bits) > 1, F.concat_ws("_", F.get(bits, 0), F.get(bits, 1))).otherwise(name)


def raw_stem(path: Column) -> Column:
    """Where the raw file of a processed one lies, without its extension; null outside a processed folder."""
    norm = F.regexp_replace(path, r"\\", "/")
    rest = F.regexp_extract(norm, r"^(?:.*?/)?processed/(.+)$", 1)
    return F.when(rest != "", F.concat(F.lit("data/raw/"), F.regexp_replace(rest, r"_enh\.png$", "")))


def quantity(value: Column) -> Column:
    """struct(value, unit) of a label's number such as ``57.5 <DEG>``; null value for anything else."""
    number = F.regexp_replace(F.trim(F.split_part(value, F.lit("<"), F.lit(1))), ",", "")
    unit = F.upper(F.trim(F.regexp_extract(value, r"<([^>]*)>", 1)))
    return F.struct(number.try_cast("double").alias("value"), F.coalesce(unit, F.lit("")).alias("unit"))


def based_int(value: Column) -> Column:
    """``2#1010#``, ``16#FF#`` or another base up to 16, or a plain integer; anything else: null."""
    base, digits = (F.regexp_extract(F.trim(value), r"^(\d+)#([0-9A-Fa-f]+)#$", k) for k in (1, 2))
    out = value.try_cast("bigint")
    for b in range(2, 17):
        out = F.when(base == str(b), F.conv(digits, b, 10).try_cast("bigint")).otherwise(out)
    return out


#: How listings and labels write a time: day and month, a plain date, ISO dates, days of the year. Fixed formats.
TIMES = ("dd-MMM-yyyy HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss[.SSS]['Z']", "yyyy-DDD'T'HH:mm:ss[.SSS]['Z']", "yyyy-MM-dd")


def instant(text: Column) -> Column:
    """Timestamp of a listing's or a label's time in one of TIMES; null for blanks and anything else."""
    t = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(form)) for form in TIMES])


def file_size(text: Column) -> Column:
    """Bytes of ``12``, ``3.4K``, ``5M``, ``1G``; anything else: null."""
    number = F.regexp_extract(F.trim(text), r"(?i)^([\d.]+)\s*([KMG]?)B?$", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(F.trim(text), r"(?i)^([\d.]+)\s*([KMG]?)B?$", 2))
    return F.floor(number * F.when(unit == "K", 1024).when(unit == "M", 1024**2).when(unit == "G", 1024**3).otherwise(1)).cast("long")


def persistence_key(image: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.format_string("%s|%d,%d@%dx%d", image, x, y, w, h)


def safe_name(text: Column, most: int = 120) -> Column:
    return F.left(F.regexp_replace(F.regexp_replace(text, r"[^0-9A-Za-z._-]", "_"), r"^[._]+|[._]+$", ""), F.lit(most))


def version_of(text: Column, digits: int = 10) -> Column:
    """First hex digits of a text's sha256."""
    return F.left(F.sha2(text, 256), F.lit(digits))


# statistics


def upper_tail(z: Column) -> Column:
    """One-sided normal p-value by the rational approximation; 0.5 for z <= 0, 0 from 8 on."""
    x = z / math.sqrt(2.0)
    t = 1 / (1 + 0.5 * x)
    poly = F.lit(ERFC[-1])
    for c in reversed(ERFC[1:-1]):
        poly = F.lit(c) + t * poly
    tau = t * F.exp(-x * x + F.lit(ERFC[0]) + t * poly)
    return F.when(z <= 0, 0.5).when(z >= 8, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.5), 0.5 * tau)))


# geometry


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial great-circle bearing in degrees, clockwise from north."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return F.pmod(F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))) + 360.0, F.lit(360.0))


def clamped_cos(degrees: Column) -> Column:
    return F.cos(F.radians(F.least(F.greatest(degrees, F.lit(0.0)), F.lit(89.9))))


def lambert(v: Column, incidence: Column, emission: Column) -> Column:
    c = clamped_cos(incidence) * clamped_cos(emission)
    return F.when(c < 1e-3, v).otherwise(v / c)


def lommel_seeliger(v: Column, incidence: Column, emission: Column) -> Column:
    i, e = clamped_cos(incidence), clamped_cos(emission)
    return F.when(i + e < 1e-3, v).otherwise(v * ((i + e) / i))


def axial_distance(a: Column, b: Column) -> Column:
    """Between two axes in degrees, 0 to 90."""
    d = F.pmod(a - b, F.lit(180.0))
    return F.least(d, 180.0 - d)


def height_from_shadow(shadow_px: Column, scale_m: Column, elevation: Column) -> Column:
    """Null outside an elevation of 1 to 89 degrees."""
    return F.when((elevation > 1) & (elevation < 89), shadow_px * scale_m * F.tan(F.radians(elevation)))


def sun_vector(elevation: Column, azimuth: Column) -> Column:
    """struct(east, north, up): unit vector towards the sun."""
    e, a = F.radians(elevation), F.radians(azimuth)
    return F.struct((F.cos(e) * F.sin(a)).alias("east"), (F.cos(e) * F.cos(a)).alias("north"), F.sin(e).alias("up"))


def shadow_direction(azimuth: Column) -> Column:
    """struct(dx, dy) along which shadows fall in an image, y down, north up; null without azimuth."""
    a = F.radians(azimuth)
    return F.when(azimuth.isNotNull(), F.struct((-F.sin(a)).alias("dx"), F.cos(a).alias("dy")))


def shadow_for_height(height_m: Column, scale_m: Column, elevation: Column) -> Column:
    """Pixels of shadow; null outside an elevation of 1 to 89 degrees or without a scale."""
    return F.when((elevation > 1) & (elevation < 89) & (scale_m > 0), height_m / (scale_m * F.tan(F.radians(elevation))))


def mask_shift(mask: Column) -> Column:
    """Zero bits at a mask's low end; 0 for no mask."""
    low = mask.bitwiseAND(-mask)
    return F.when(F.coalesce(mask, F.lit(0)) == 0, 0).otherwise(F.bit_count(low - 1))


def shown_size(side_px: Column, map_scale: Column, line_samples: Column, width: Column, elevation: Column) -> list[Column]:
    """eff_scale_m, size_m, height_m of a box: the label's scale is that of the whole product, ``line_samples`` wide, of which an
    image ``width`` wide is shown. Zero and null tell nothing."""
    known = lambda c: F.when(c != 0, c)
    scale = known(map_scale) * F.coalesce(known(line_samples) / known(width), F.lit(1.0))
    size = rounded(side_px * scale, 1)
    return [rounded(scale, 3).alias("eff_scale_m"), size.alias("size_m"), rounded(known(size) * F.tan(F.radians(known(elevation))), 1).alias("height_m")]


# boxes: columns x, y, w, h each


def overlap(ax, ay, aw, ah, bx, by, bw, bh) -> Column:
    wide = F.greatest(F.lit(0), F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    high = F.greatest(F.lit(0), F.least(ay + ah, by + bh) - F.greatest(ay, by))
    return wide * high


def iou(*b: Column) -> Column:
    both = overlap(*b)
    union = b[2] * b[3] + b[6] * b[7] - both
    return F.when(union > 0, both / union).otherwise(0.0)


def hit(*b: Column) -> Column:
    """The first box holds the second's centre, or they overlap by more than a fifth."""
    cx, cy = b[4] + b[6] / 2, b[5] + b[7] / 2
    return ((b[0] <= cx) & (cx <= b[0] + b[2]) & (b[1] <= cy) & (cy <= b[1] + b[3])) | (iou(*b) > 0.2)


def inside(x: Column, y: Column, w: Column, h: Column, wide: Column, high: Column) -> Column:
    return F.coalesce((x >= 0) & (y >= 0) & (w >= 1) & (h >= 1) & (x + w <= wide) & (y + h <= high), F.lit(False))
