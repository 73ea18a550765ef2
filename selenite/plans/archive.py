"""Queries of the archive family: geometry, verification, plans, coverage and report texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import geometry as G
from ..operators import relational as R
from ..sources.tables import boxes, cells, table
from .relational import ADJUDICATED, BOXES, KEY, judged, rnd

Q: dict = {}
O: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if oracle:
            O[f.__name__] = oracle
        return f

    return add


@query(f"""WITH s AS (SELECT *, s_suppkey % 4 AS k FROM supplier) SELECT s_suppkey, {rnd('CASE WHEN k <> 3 THEN abs(s_acctbal) / 100.0 END', 4)} AS incidence, {rnd('CASE WHEN k <> 3 THEN 90 - abs(s_acctbal) / 100.0 END', 4)} AS elevation, {rnd('CASE WHEN k = 1 THEN 12.5 END', 4)} AS emission, {rnd('CASE WHEN k = 2 THEN s_suppkey / 10.0 END', 4)} AS phase,
{rnd('CASE WHEN k = 0 THEN s_suppkey * 1.0 WHEN k = 3 THEN 90.0 ELSE NULL END', 4)} AS azimuth, {rnd('CASE k WHEN 0 THEN 300.0 WHEN 1 THEN 255.5 ELSE NULL END', 4)} AS altitude_km, {rnd('CASE k WHEN 0 THEN 0.5 WHEN 1 THEN 250.0 WHEN 2 THEN 3.141592653589793 / 180 * (3394.0 * 1000) / 128.0 ELSE NULL END', 4)} AS scale_m,
CASE WHEN k < 2 THEN 'MARS' END AS target, CASE k WHEN 0 THEN 'HIRISE' WHEN 1 THEN 'CTX' END AS instrument, CASE k WHEN 0 THEN s_name WHEN 1 THEN concat('P', s_suppkey) END AS observation_id, CASE WHEN k = 2 THEN 'RED' END AS band, CASE WHEN k = 0 THEN '2010-01-02T03:04:05' END AS start_time FROM s""")
def label_geometry(spark, d):
    """Geometry and names of labels in four dialects."""
    s, k = table(spark, d, "supplier"), F.col("s_suppkey") % 4
    angle = F.concat((F.abs("s_acctbal") / 100.0).cast("string"), F.lit(" <DEG>"))
    entry = lambda key, v: F.struct(F.lit(key).alias("k"), v.cast("string").alias("v"))
    fields = [
        entry("INCIDENCE_ANGLE", F.when(k == 0, angle)), entry("SOLAR_INCIDENCE_ANGLE", F.when(k.isin(1, 2), angle)), entry("EMISSION_ANGLE_OBSERVER", F.when(k == 1, F.lit("12.5"))), entry("PHASE_ANGLE", F.when(k == 2, F.col("s_suppkey") / 10.0)),
        entry("SUB_SOLAR_AZIMUTH", F.when(k == 0, F.col("s_suppkey") * 1.0)), *(entry(f, F.when(k == 3, F.lit(v))) for f, v in (("SUB_SOLAR_LATITUDE", "0.0"), ("SUB_SOLAR_LONGITUDE", "10.0"), ("SUB_SPACECRAFT_LATITUDE", "0.0"), ("OBSERVER_LONGITUDE", "0.0"))),
        entry("SPACECRAFT_ALTITUDE", F.when(k == 0, F.lit("300,000 <M>")).when(k == 1, F.lit("255.5 <KM>"))), entry("MAP_SCALE", F.when(k == 0, F.lit("0.5 <METERS/PIXEL>")).when(k == 1, F.lit("0.25 <KM/PIXEL>"))), entry("MAP_RESOLUTION", F.when(k == 2, F.lit("128 <PIX/DEG>"))), entry("A_AXIS_RADIUS", F.when(k == 2, F.lit("3394.0 <KM>"))),
        entry("TARGET_NAME", F.when(k == 0, F.lit('"MARS"'))), entry("TARGET", F.when(k == 1, F.lit("MARS")).when(k == 2, F.lit(""))), entry("INSTRUMENT_ID", F.when(k == 0, F.lit("HIRISE"))), entry("INSTRUMENT_NAME", F.when(k == 1, F.lit("CTX"))), entry("OBSERVATION_ID", F.when(k == 0, F.col("s_name"))), entry("PRODUCT_ID", F.when(k.isin(0, 1), F.concat(F.lit("P"), F.col("s_suppkey").cast("string")))), entry("FILTER_NAME", F.when(k == 2, F.lit("RED"))), entry("START_TIME", F.when(k == 0, F.lit("2010-01-02T03:04:05"))),
    ]
    g = G.from_label(F.col("f"))
    held = s.select("s_suppkey", F.map_from_entries(F.filter(F.array(*fields), lambda e: e["v"].isNotNull())).alias("f"))
    return held.select("s_suppkey", *[C.rounded(g[c], 4).alias(c) for c in ("incidence", "elevation", "emission", "phase", "azimuth", "altitude_km", "scale_m")], *[g[c].alias(c) for c in G.TEXTS])


@query(f"""SELECT p_partkey, {rnd('p_size / 4.0', 4)} AS post_spacing_m, {rnd('-p_retailprice', 4)} AS valid_min_m, {rnd('p_retailprice', 4)} AS valid_max_m, {rnd('0.11643', 5)} AS rms_total_px, {rnd('p_size / 10.0', 4)} AS rms_x_m, {rnd('p_size / 5.0', 4)} AS rms_y_m, CAST(NULL AS DOUBLE) AS rms_z_m,
{rnd('2.5', 4)} AS mola_mean_m, {rnd('6.486', 4)} AS mola_stdev_m, 'SOCET SET 5.6' AS software, concat('Place_', p_size, CASE WHEN p_size % 2 = 0 THEN 'E' ELSE 'W' END, '_', p_size * 3, CASE WHEN p_size % 3 = 0 THEN 'N' ELSE 'S' END) AS project, {rnd('CASE WHEN p_size % 2 = 0 THEN p_size / 10.0 ELSE -p_size / 10.0 END', 4)} AS longitude,
{rnd('CASE WHEN p_size % 3 = 0 THEN p_size * 3 / 10.0 ELSE -p_size * 3 / 10.0 END', 4)} AS latitude, CASE WHEN p_size % 5 = 0 THEN '' ELSE concat('PSP_00', p_size, '_1410,PSP_01', p_size, '_1410') END AS source_images, CASE WHEN p_size % 2 = 0 THEN 'ccd_seams' ELSE '' END AS known_artifacts FROM part""")
def readme_fields(spark, d):
    n, p = F.col("p_size"), F.col("p_size").cast("string")
    name = F.concat(F.lit("Place_"), p, F.when(n % 2 == 0, "E").otherwise("W"), F.lit("_"), (n * 3).cast("string"), F.when(n % 3 == 0, "N").otherwise("S"))
    text = F.concat(
        F.lit("PROJECT NAME\n  "), name, F.lit("\nHIRISE SOURCE IMAGES\n"), F.when(n % 5 != 0, F.concat(F.lit("  PSP_00"), p, F.lit("_1410\n  PSP_01"), p, F.lit("_1410\n"))).otherwise("none\n"), F.lit("The post spacing in DTM is "), (n / 4.0).cast("string"), F.lit(" m.\nVALID_MINIMUM = "), F.format_string("%.2f", -F.col("p_retailprice")), F.lit(" m\nVALID_MAXIMUM = "), F.format_string("%.2f", F.col("p_retailprice")),
        F.lit(" m\nTotal RMS ==> 0.11643 px\nRMS x ==> "), (n / 10.0).cast("string"), F.lit(" m\nRMS y ==> "), (n / 5.0).cast("string"), F.lit(" m\nMean difference from MOLA 2.5 m, standard deviation 6.486.\nSOCET SET 5.6 was used.\n"), F.when(n % 2 == 0, "There are CCD seams.").otherwise(""),
    )
    # a few bytes a part become a text to be read: rows are dealt out, as their small file is one task
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    g = G.with_fields(p.select("p_partkey", text.alias("t")), "t")
    numbers = [C.rounded(F.col(c), 5 if c == "rms_total_px" else 4).alias(c) for c in (*G.README, "longitude", "latitude")]
    return g.select("p_partkey", *numbers, "software", "project", F.array_join("source_images", ",").alias("source_images"), F.array_join("known_artifacts", ",").alias("known_artifacts"))


@query("""SELECT o_orderkey, coalesce(first_value(v IGNORE NULLS) OVER w, -1) AS truth FROM (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END AS v, o_custkey FROM orders)
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def parent_geometry(spark, d):
    """A pair takes the first geometry that its observations have; none: -1."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice")).alias("v"))
    first = o.filter("v IS NOT NULL").groupBy("o_custkey").agg(F.min_by("v", "o_orderkey").alias("truth"))
    return o.join(first, "o_custkey", "left").select("o_orderkey", F.coalesce("truth", F.lit(-1.0)).alias("truth"))


@query(f"WITH m AS (SELECT max(p_size) AS full_res FROM part WHERE p_partkey % 2 = 0) SELECT p_partkey, {rnd('CASE WHEN p_size < full_res THEN p_retailprice / 1000 * full_res / p_size ELSE p_retailprice / 1000 END', 4)} AS scale_m FROM part, m")
def downsampled_scale(spark, d):
    """Scale of narrower renderings, from the widest map-projected one; a function of the scale as given."""
    p = table(spark, d, "part")
    p = p.withColumn("full_res", p.filter("p_partkey % 2 = 0").agg(F.max("p_size")).scalar())
    base = F.col("p_retailprice") / 1000
    scale = F.when(F.col("p_size") < F.col("full_res"), base * F.col("full_res") / F.col("p_size")).otherwise(base)
    return p.select("p_partkey", C.rounded(scale, 4).alias("scale_m"))


@query("SELECT count(*) AS leads, count(*) FILTER (WHERE s_suppkey IS NOT NULL) AS with_strip, count(*) FILTER (WHERE s_suppkey IS NULL) AS missing FROM part LEFT JOIN supplier ON s_suppkey = p_partkey")
def strip_coverage(spark, d):
    j = table(spark, d, "part").join(table(spark, d, "supplier"), F.col("s_suppkey") == F.col("p_partkey"), "left")
    return j.agg(F.count("*").alias("leads"), F.count("s_suppkey").alias("with_strip"), F.count_if(F.col("s_suppkey").isNull()).alias("missing"))


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_partkey)")
def strips_missing(spark, d):
    return table(spark, d, "part").join(table(spark, d, "supplier"), F.col("s_suppkey") == F.col("p_partkey"), "left_anti").select("p_partkey")


@query(f"SELECT o_orderpriority, count(*) AS footprints, {rnd('sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) / 100.0', 2)} AS bytes, sum(CAST(o_orderstatus = 'O' AS BIGINT))::BIGINT AS open FROM orders GROUP BY o_orderpriority")
def plan_by_branch(spark, d):
    cents = F.sum(F.floor(F.col("o_totalprice") * 100 + 0.5))
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("footprints"), C.rounded(cents / 100.0, 2).alias("bytes"), F.count_if(F.col("o_orderstatus") == "O").alias("open"))


@query("SELECT w, count(*) FILTER (WHERE contrast >= 1.0) AS hit, count(*) AS n, CAST(floor(count(*) FILTER (WHERE contrast >= 1.0) * 100.0 / count(*) * 10 + 0.5) AS DOUBLE) / 10 AS recall_pct FROM (" + BOXES + ") GROUP BY w")
def recall_by_size(spark, d):
    hit = F.count_if(F.col("contrast") >= 1.0)
    return boxes(spark, d).groupBy("w").agg(hit.alias("hit"), F.count("*").alias("n"), C.rounded(hit * 100.0 / F.count("*"), 1).alias("recall_pct"))


@query(f"SELECT event_type, {rnd('quantile_cont(value, 0.5)', 3)} AS median_ratio, count(*) AS n FROM events WHERE value > 0 GROUP BY event_type")
def variant_persistence(spark, d):
    return table(spark, d, "events").filter("value > 0").groupBy("event_type").agg(C.rounded(F.median("value"), 3).alias("median_ratio"), F.count("*").alias("n"))


@query(f"""WITH g AS (SELECT y, x, x - lag(x) OVER (PARTITION BY y ORDER BY x) AS gap FROM (SELECT CAST(event_id // 100 AS INTEGER) AS y, CAST(event_id % 100 AS INTEGER) AS x, value AS v FROM events) WHERE v > 100)
SELECT y, count(*) AS glyphs, {rnd('stddev_pop(gap) / avg(gap)', 5)} AS gap_cv FROM g GROUP BY y HAVING count(*) >= 4""")
def line_gaps(spark, d):
    """How evenly what stands out is spaced along a line."""
    w = Window.partitionBy("y").orderBy("x")
    g = cells(spark, d).filter("v > 100").withColumn("gap", F.col("x") - F.lag("x").over(w))
    return g.groupBy("y").agg(F.count("*").alias("glyphs"), C.rounded(F.stddev_pop("gap") / F.avg("gap"), 5).alias("gap_cv")).filter("glyphs >= 4")


@query("SELECT user_id, event_id, CAST(k AS BIGINT) AS stalled_for FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, grp ORDER BY event_id) - 1 AS k FROM (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) = event_type THEN 0 ELSE 1 END AS chg FROM events))) WHERE k >= 2")
def stalls(spark, d):
    """Events after at least two others without a change of type."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, d, "events").withColumn("chg", F.when(F.lag("event_type").over(w) == F.col("event_type"), 0).otherwise(1))
    e = e.withColumn("grp", F.sum("chg").over(w))
    k = F.row_number().over(Window.partitionBy("user_id", "grp").orderBy("event_id")) - 1
    return e.select("user_id", "event_id", k.cast("long").alias("stalled_for")).filter("stalled_for >= 2")


@query("SELECT ts, event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 40")
def audit_recent(spark, d):
    return table(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(40).select("ts", "event_id", "event_type")


@query("SELECT event_type, count(*) AS n, max(CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT)) AS max_k FROM events WHERE props IS NOT NULL GROUP BY event_type")
def audit_payload(spark, d):
    return table(spark, d, "events").filter("props IS NOT NULL").groupBy("event_type").agg(F.count("*").alias("n"), F.max(F.get_json_object("props", "$.k").try_cast("bigint")).alias("max_k"))


@query("SELECT page_id, url, status FROM (SELECT page_id, url, CASE WHEN NOT starts_with(url, 'https://') THEN 'refused' WHEN length(html) > 4000 THEN 'too large' WHEN NOT regexp_matches(url, '/(en|de)/') THEN 'pattern' ELSE 'fetch' END AS status FROM pages)")
def crawl_filter(spark, d):
    status = F.when(~F.col("url").startswith("https://"), "refused").when(F.length("html") > 4000, "too large").when(~F.col("url").rlike("/(en|de)/"), "pattern").otherwise("fetch")
    return table(spark, d, "pages").select("page_id", "url", status.alias("status"))


@query(f"""WITH b AS ({BOXES}), z AS (SELECT *, contrast * 2 - 3 AS z FROM b) SELECT {', '.join(KEY)}, CASE WHEN abs(z) >= 3.0 THEN 'SURVIVES-ORIGINAL' ELSE 'BACKGROUND-LIMITED' END AS status,
CASE WHEN l_suppkey % 10 = 0 THEN 'NO-FINDING: map product' WHEN abs(z) < 3.0 THEN 'NO-FINDING: collapses' WHEN l_suppkey % 10 < 8 THEN 'CANDIDATE' ELSE 'NO-FINDING: background' END AS chase, CASE WHEN l_suppkey % 10 = 0 OR abs(z) >= 3.0 THEN 'high' ELSE 'medium' END AS certainty FROM z""")
def chase_verdicts(spark, d):
    z, kind = F.col("contrast") * 2 - 3, F.col("l_suppkey") % 10
    strong = F.abs(z) >= 3.0
    chase = F.when(kind == 0, "NO-FINDING: map product").when(~strong, "NO-FINDING: collapses").when(kind < 8, "CANDIDATE").otherwise("NO-FINDING: background")
    return boxes(spark, d).select(*KEY, F.when(strong, "SURVIVES-ORIGINAL").otherwise("BACKGROUND-LIMITED").alias("status"), chase.alias("chase"), F.when((kind == 0) | strong, "high").otherwise("medium").alias("certainty"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('greatest(l_quantity, l_linenumber * 6) * 0.25', 3)} AS size_m, CASE WHEN abs(l_discount * 10) >= 0.6 THEN 'relief' WHEN abs(l_discount * 10) < 0.3 THEN 'flat' ELSE 'unclear' END AS stereo FROM lineitem")
def physical_size(spark, d):
    r = F.abs(F.col("l_discount") * 10)
    return table(spark, d, "lineitem").select(*KEY, C.rounded(F.greatest(F.col("l_quantity"), (F.col("l_linenumber") * 6).cast("double")) * 0.25, 3).alias("size_m"), F.when(r >= 0.6, "relief").when(r < 0.3, "flat").otherwise("unclear").alias("stereo"))


@query("SELECT DISTINCT l_suppkey, w, h FROM (" + BOXES + ")")
def distinct_boxes(spark, d):
    return boxes(spark, d).select("l_suppkey", "w", "h").distinct()


@query(f"""WITH {ADJUDICATED}, lead AS (SELECT * FROM judged WHERE verdict = 'CONFIRMED-LEAD'), none AS (SELECT * FROM lead WHERE score > 1000),
pick AS (SELECT 'leads' AS page, verdict FROM lead UNION ALL SELECT 'leads', verdict FROM judged WHERE NOT EXISTS (SELECT 1 FROM lead)
UNION ALL SELECT 'no leads', verdict FROM none UNION ALL SELECT 'no leads', verdict FROM judged WHERE NOT EXISTS (SELECT 1 FROM none)) SELECT page, verdict, count(*) AS n FROM pick GROUP BY page, verdict""")
def fallback_union(spark, d):
    """Leads if there are any, else all judged rows; for a table that has leads and for one that has none."""
    j = judged(spark, d).select("verdict", "score")
    lead = j.filter("verdict = 'CONFIRMED-LEAD'")
    pages = [R.else_all(part, j).select(F.lit(page).alias("page"), "verdict") for page, part in (("leads", lead), ("no leads", lead.filter("score > 1000")))]
    return pages[0].unionByName(pages[1]).groupBy("page", "verdict").agg(F.count("*").alias("n"))


@query(f"WITH b AS ({BOXES}) SELECT image, regexp_extract(image, '^([A-Za-z]+_[0-9]+_[0-9]+)', 1) AS acquisition, regexp_extract(image, '_(MIRB|MRGB|RED)[.]', 1) AS band, regexp_replace(image, '_(MIRB|MRGB|RED)[.](browse|abrowse|thumb).*$', '') AS base, regexp_extract(image, '^(ESP_[0-9]+_[0-9]+|PIA[0-9]+)', 1) AS stem, CASE WHEN contains(path, 'moon') THEN 'Moon' WHEN contains(lower(path), 'mars') THEN 'Mars' ELSE 'unknown' END AS body, count(*) AS n FROM (SELECT image, CASE l_suppkey % 3 WHEN 0 THEN 'raw/moon/a' WHEN 1 THEN 'raw/Mars/b' ELSE 'raw/c' END AS path FROM b) GROUP BY image, path")
def name_parts(spark, d):
    i, k = F.col("image"), F.col("l_suppkey") % 3
    b = boxes(spark, d).withColumn("path", F.when(k == 0, "raw/moon/a").when(k == 1, "raw/Mars/b").otherwise("raw/c"))
    return b.groupBy("image", "path").agg(F.count("*").alias("n")).select("image", C.acquisition(i).alias("acquisition"), C.band(i).alias("band"), C.base_frame(i).alias("base"), C.sibling_stem(F.concat_ws("/", "path", "image")).alias("stem"), C.body(F.col("path")).alias("body"), "n")


@query("SELECT branch, CAST(to_json(shards) AS VARCHAR) AS shards FROM (SELECT r_name AS branch, list(struct_pack(name := n_name, footprints := n) ORDER BY n_name) AS shards FROM (SELECT r_name, n_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY r_name)")
def site_tree(spark, d):
    """Branches with their shards as JSON."""
    t = table(spark, d, "region").join(table(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).join(table(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"))
    per = t.groupBy("r_name", "n_name").agg(F.count("*").alias("n"))
    return per.groupBy(F.col("r_name").alias("branch")).agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n").alias("footprints"))))).cast("string").alias("shards"))
