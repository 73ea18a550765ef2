"""Texts of reports: numbers and ages for people, escapes, file keys, fields of findings and of crop names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import rounded

#: What a rendering's name has between its stem and its extension. Fixed values.
SCALE_TOKENS = (".browse", ".abrowse", ".quicklook", ".thumb", ".nomap", ".qlook", ".ab", ".br", ".ca", ".cb", ".ct", ".sa", ".sb", ".st", ".th")


def shown(value: Column) -> Column:
    """Blank: a dash; whole numbers as such; others to three places without trailing zeros; no number: as it is."""
    n = F.trim(value).try_cast("double")
    short = F.regexp_replace(F.format_string("%.3f", n), r"\.?0+$", "")
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", "-").when(n.isNull(), value).when(n == F.floor(n), F.floor(n).cast("string")).otherwise(short)


def age(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm", F.floor(s / 60))).otherwise(F.format_string("%dh", F.floor(s / 3600)))


def escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """0 of nothing."""
    return F.when(whole == 0, 0.0).otherwise(F.floor(100 * part / whole * 10**digits + 0.5) / 10**digits)


def label_keys(path: Column) -> Column:
    """Stems under which an image's label may lie, best first: its own, then without a scale token."""
    stem = F.regexp_replace(path, r"\.[^./]*$", "")
    tokens = "|".join(t.replace(".", r"\.") for t in SCALE_TOKENS)
    return F.array_distinct(F.array(stem, F.regexp_replace(stem, f"(?i)({tokens})$", "")))


def with_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds label_path: the label of the first of label_keys() that exists; both have path. One row an image."""
    keys = images.select("path", F.posexplode(label_keys(F.col("path"))).alias("rank", "stem"))
    stems = labels.select(F.regexp_replace("path", r"(?i)\.(lbl|xml)$", "").alias("stem"), F.col("path").alias("label_path"))
    best = keys.join(stems, "stem").groupBy("path").agg(F.min(F.struct("rank", "label_path")).alias("b"))
    return images.join(best.select("path", "b.label_path"), "path", "left")


def crop_box(name: Column) -> Column:
    """struct(image, x, y, w, h) of ``image_x12_y34_w5_h6.png``; nulls for other names."""
    rx = r"^(.*)_x(\d+)_y(\d+)_w(\d+)_h(\d+)\.\w+$"
    n = lambda k: F.regexp_extract(name, rx, k).try_cast("int")
    return F.struct(F.nullif(F.regexp_extract(name, rx, 1), F.lit("")).alias("image"), n(2).alias("x"), n(3).alias("y"), n(4).alias("w"), n(5).alias("h"))


def finding(markdown: Column) -> Column:
    """Map of the ``**Name:** value`` lines of a finding, names in lower case, and its title."""
    lines = F.filter(F.split(markdown, r"\r?\n"), lambda s: s.rlike(r"^\s*[-*]?\s*\*\*[^*]+:\*\*\s*\S|^# "))
    key = lambda s: F.when(s.startswith("# "), "title").otherwise(F.lower(F.regexp_extract(s, r"\*\*([^*]+):\*\*", 1)))
    value = lambda s: F.when(s.startswith("# "), F.trim(F.substr(s, F.lit(3)))).otherwise(F.trim(F.regexp_extract(s, r":\*\*\s*(.*)$", 1)))
    keys = F.array_distinct(F.transform(lines, key))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.transform(F.filter(lines, lambda s: key(s) == k), value), 1)))


def crop_index(files: DataFrame, name: str) -> DataFrame:
    """x, y, w, h, crops (sorted names): crop files by the box in their names, whatever image they are of; other names are left out."""
    b = files.select(name, crop_box(F.col(name)).alias("b")).filter("b.x IS NOT NULL")
    return b.groupBy("b.x", "b.y", "b.w", "b.h").agg(F.sort_array(F.collect_list(name)).alias("crops"))


def baselines(benchmark: DataFrame) -> DataFrame:
    """scene, baseline_fp: of each benchmark file's rows (scene, blob_size_px, recall_hit: texts) the negative control's count, which
    stands in the first of the two columns that is a number."""
    control = F.concat_ws(" ", "blob_size_px", "scene").contains("negative_control_fp")
    number = F.coalesce(F.col("blob_size_px").try_cast("long"), F.col("recall_hit").try_cast("long"))
    return benchmark.filter(control).groupBy("scene").agg(F.min(number).alias("baseline_fp")).filter("baseline_fp IS NOT NULL")


def rates(total: int) -> list[Column]:
    """Columns of a pass over ``total`` images from window_images, total_s and dl_s (of the trailing window), processed and life_s."""
    c = F.col
    rate = c("window_images") / F.greatest(c("total_s"), F.lit(1e-6))
    return [
        c("window_images"),
        rounded(c("total_s") / c("window_images"), 1).alias("sec_per_image"),
        rounded(100.0 * c("dl_s") / F.greatest(c("total_s"), F.lit(1e-6)), 1).alias("download_share_pct"),
        rounded(rate * 60.0, 2).alias("images_per_min"),
        rounded((total - c("processed")) / rate / 3600.0, 1).alias("eta_hours"),
        rounded(c("processed") / F.greatest(c("life_s"), F.lit(1e-6)) * 60.0, 2).alias("lifetime_images_per_min"),
    ]


def finding_fields(markdown: Column, stem: Column) -> list[Column]:
    """id (else the file's stem), status, evidence_class, image and path of a finding's text; blank where it doesn't say."""
    grab = lambda rx: F.regexp_extract(F.coalesce(markdown, F.lit("")), rx, 1)
    path = F.replace(grab(r"File: `([^`]+\.png)`"), F.lit("\\"), F.lit("/"))
    return [
        F.coalesce(F.nullif(grab(r"Finding ID: (F-\d+)"), F.lit("")), stem).alias("id"),
        grab(r"Status: (\S+)").alias("status"),
        grab(r"Evidence class: (\d)").try_cast("int").alias("evidence_class"),
        F.regexp_replace(path, r"^.*/", "").alias("image"),
        path.alias("path"),
    ]


def manifest_of(manifest: DataFrame, product: str) -> DataFrame:
    """Lines (file, url) of a download log that name a product; none for a blank one."""
    return manifest.filter(F.concat_ws(" ", "file", "url").contains(product) & F.lit(bool(product)))


def flattened(site: DataFrame) -> DataFrame:
    """One row a product of branches[shards[footprints[products]]]; totals of a footprint are left to groupBy."""
    s = site.select(F.col("name").alias("branch"), F.explode("shards").alias("s"))
    f = s.select("branch", F.col("s.name").alias("shard"), F.explode("s.footprints").alias("f"))
    p = f.select("branch", "shard", F.col("f.name").alias("footprint"), F.explode("f.products").alias("p"))
    return p.select("branch", "shard", "footprint", "p.*")


def resolved(sources: list[DataFrame], key: str, text: str) -> DataFrame:
    """The first row, over tables in turn, whose key is ``text``, else holds it."""
    ranked = [s.withColumn("_rank", F.struct(F.lit(k), F.when(F.col(key) == text, 0).otherwise(1), F.col(key))) for k, s in enumerate(sources)]
    both = ranked[0]
    for r in ranked[1:]:
        both = both.unionByName(r, allowMissingColumns=True)
    return both.filter(F.col(key).contains(text)).orderBy("_rank").limit(1).drop("_rank")


def persistence_ratios(report: DataFrame) -> DataFrame:
    """variant, box_key, ratio of a map of maps, those that kept_ratios() keeps."""
    v = report.select(F.explode("candidate_persistence").alias("variant", "m"))
    return kept_ratios(v.select("variant", F.explode("m").alias("box_key", "ratio")))


def kept_ratios(ratios: DataFrame) -> DataFrame:
    """Rows (variant, box_key, ratio) without original-geometry, quick-look and thumbnail variants and without ratios of 0 or less."""
    return ratios.filter(~F.lower("variant").rlike("nomap|qlook|quicklook|thumb") & (F.col("ratio") > 0))
