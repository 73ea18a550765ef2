"""Queries over the archive's catalogue: geometry passed on, labels and read-me files, products by name, sources, slices of manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import geometry as G
from ..functions import names as N
from ..functions import reports as T
from ..sources import registry as S
from ..sources.tables import table
from .relational import rnd
from .text import NAMES

Q: dict = {}
O: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if oracle:
            O[f.__name__] = oracle
        return f

    return add


#: Six renderings of one observation after another, of which only the labelled ones know their geometry.
CATALOG = """SELECT ord, obs, kind, concat(obs, CASE kind WHEN 0 THEN '_MIRB.browse.jpg' WHEN 1 THEN '_RED.browse.jpg' WHEN 2 THEN '_RED.thumb.jpg' WHEN 3 THEN '_MRGB.browse.jpg' WHEN 4 THEN '_RED.NOMAP.browse.jpg' ELSE '_MIRB.thumb.jpg' END) AS name,
CASE WHEN kind IN (0, 3) THEN obs ELSE '' END AS observation_id, CASE kind WHEN 4 THEN 'nomap' ELSE 'map' END AS geometry, CASE WHEN kind IN (2, 5) THEN 'thumb' ELSE 'browse' END AS scale_class,
CASE WHEN k % 4 = 0 THEN NULL WHEN kind = 0 AND p_size % 5 <> 0 THEN p_size * 1.5 WHEN kind = 3 THEN p_size * 1.25 END AS incidence_angle, CASE WHEN kind IN (0, 3) AND p_size % 2 = 0 THEN p_size * 7.0 END AS solar_azimuth,
CASE WHEN kind = 0 THEN 0.5 WHEN kind = 5 AND p_size % 3 = 0 THEN 4.0 END AS pixel_scale_m
FROM (SELECT p_partkey AS ord, p_size, CAST(p_partkey % 6 AS INT) AS kind, CAST(floor(p_partkey / 6.0) AS BIGINT) AS k, concat('ESP_', CAST(100000 + CAST(floor(p_partkey / 6.0) AS BIGINT) AS STRING), '_1410') AS obs FROM part) p"""


def _sql(spark, text, **tables):
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(text, **tables)


def catalog(spark, d):
    return _sql(spark, CATALOG, part=table(spark, d, "part"))


@query(f"""WITH c AS ({CATALOG}), t AS (SELECT obs, incidence_angle, solar_azimuth FROM c WHERE incidence_angle IS NOT NULL QUALIFY row_number() OVER (PARTITION BY obs ORDER BY ord) = 1),
s AS (SELECT obs, geometry, scale_class, pixel_scale_m FROM c WHERE pixel_scale_m IS NOT NULL QUALIFY row_number() OVER (PARTITION BY obs, geometry, scale_class ORDER BY ord) = 1)
SELECT ord, CASE WHEN observation_id = '' AND t.obs IS NOT NULL THEN c.obs ELSE observation_id END AS observation_id, CAST(coalesce(c.incidence_angle, t.incidence_angle) AS DOUBLE) AS incidence_angle, CAST(coalesce(c.solar_azimuth, t.solar_azimuth) AS DOUBLE) AS solar_azimuth, CAST(coalesce(c.pixel_scale_m, s.pixel_scale_m) AS DOUBLE) AS pixel_scale_m
FROM c LEFT JOIN t ON t.obs = c.obs LEFT JOIN s ON s.obs = c.obs AND s.geometry = c.geometry AND s.scale_class = c.scale_class""")
def geometry_propagation(spark, d):
    """Blanks filled from the labelled renderings of the same observation; the scale only within one kind of rendering."""
    done = G.propagated(catalog(spark, d).drop("obs", "kind"), "ord")
    return done.select("ord", "observation_id", *[F.col(c).cast("double").alias(c) for c in ("incidence_angle", "solar_azimuth", "pixel_scale_m")])


PAIRS = "SELECT s_suppkey, concat('ESP_', CAST(100000 + s_suppkey AS STRING), '_1410') AS o1, concat('ESP_', CAST(100000 + s_suppkey * 7 AS STRING), '_1410') AS o2 FROM supplier"


@query(f"""WITH c AS ({CATALOG}), k AS (SELECT * FROM c WHERE observation_id <> ''), t AS (SELECT obs, incidence_angle, solar_azimuth FROM k WHERE incidence_angle IS NOT NULL QUALIFY row_number() OVER (PARTITION BY obs ORDER BY ord) = 1), p AS ({PAIRS})
SELECT s_suppkey, CASE WHEN a.obs IS NOT NULL THEN a.obs ELSE b.obs END AS observation_id, CAST(CASE WHEN a.obs IS NOT NULL THEN a.incidence_angle ELSE b.incidence_angle END AS DOUBLE) AS incidence_angle, CAST(CASE WHEN a.obs IS NOT NULL THEN a.solar_azimuth ELSE b.solar_azimuth END AS DOUBLE) AS solar_azimuth,
array_to_string(list_sort(list_distinct(list_filter([CASE WHEN o1 NOT IN (SELECT obs FROM k) THEN o1 END, CASE WHEN o2 NOT IN (SELECT obs FROM k) THEN o2 END], lambda x: x IS NOT NULL))), ',') AS missing FROM p LEFT JOIN t a ON a.obs = o1 LEFT JOIN t b ON b.obs = o2""")
def pair_geometry(spark, d):
    """Lighting of a stereo pair from the first of its observations that has some, and the observations that aren't catalogued."""
    p = _sql(spark, PAIRS, supplier=table(spark, d, "supplier")).select("s_suppkey", F.array("o1", "o2").alias("observations"))
    got = G.from_parents(p, catalog(spark, d).filter("observation_id <> ''"), "s_suppkey", "ord")
    return got.select("s_suppkey", "observation_id", *[F.col(c).cast("double").alias(c) for c in ("incidence_angle", "solar_azimuth")], F.array_join("missing", ",").alias("missing"))


@query(f"""WITH n AS ({NAMES}), i AS (SELECT n.p_partkey, concat('d', n.p_partkey % 40, '/', name) AS path, CASE WHEN p_size % 3 = 0 THEN p_size / 10.0 END AS scale_m, n.p_partkey % 40 AS k, lower(name) AS low FROM n JOIN part USING (p_partkey)),
r AS (SELECT s_suppkey % 40 AS k, max(s_suppkey * 0.25) AS post FROM supplier WHERE s_suppkey % 40 < 20 GROUP BY 1), j AS (SELECT i.*, CASE WHEN NOT starts_with(low, 'fom_map_legend') AND (starts_with(low, 'dteec_') OR contains(low, 'ortho')) THEN post END AS post FROM i LEFT JOIN r USING (k))
SELECT p_partkey, CAST(coalesce(post, scale_m) AS DOUBLE) AS scale_m, CASE WHEN post IS NOT NULL THEN 'readme' WHEN scale_m IS NOT NULL THEN 'label' END AS scale_source FROM j""")
def readme_scale(spark, d):
    """Scale of products: of terrain products the read-me's post spacing, whatever a label says."""
    p = table(spark, d, "part").select("p_partkey", "p_size")
    n = _sql(spark, NAMES, part=table(spark, d, "part")).join(p, "p_partkey")
    folder = lambda key: F.concat(F.lit("d"), (F.col(key) % 40).cast("string"), F.lit("/"))
    images = n.select("p_partkey", F.concat(folder("p_partkey"), "name").alias("path"), F.when(F.col("p_size") % 3 == 0, F.col("p_size") / 10.0).alias("scale_m"))
    readmes = table(spark, d, "supplier").filter("s_suppkey % 40 < 20").select(F.concat(folder("s_suppkey"), F.lit("README.TXT")).alias("path"), (F.col("s_suppkey") * 0.25).cast("double").alias("post_spacing_m"))
    return G.with_readme(images, readmes).select("p_partkey", "scale_m", "scale_source")


@query(f"""WITH c AS ({CATALOG}), l AS (SELECT DISTINCT concat('x/', obs, '_MIRB.LBL') AS label_path, concat('x/', obs, '_MIRB') AS stem FROM c WHERE ord % 3 <> 0 UNION SELECT concat('x/', obs, '_RED.browse.lbl'), concat('x/', obs, '_RED.browse') FROM c WHERE kind = 1 AND ord % 5 = 0),
i AS (SELECT ord, regexp_replace(concat('x/', name), '[.][^./]*$', '') AS s1 FROM c), k AS (SELECT ord, s1, regexp_replace(s1, '([.]browse|[.]abrowse|[.]quicklook|[.]thumb|[.]nomap|[.]qlook|[.]ab|[.]br|[.]ca|[.]cb|[.]ct|[.]sa|[.]sb|[.]st|[.]th)$', '', 'i') AS s2 FROM i)
SELECT ord, coalesce(a.label_path, b.label_path) AS label_path FROM k LEFT JOIN l a ON a.stem = s1 LEFT JOIN l b ON b.stem = s2""")
def label_paths(spark, d):
    """Label of every rendering: under its own name, else under its name without the rendering's scale."""
    c = catalog(spark, d)
    shared = c.filter("ord % 3 <> 0").select(F.concat(F.lit("x/"), "obs", F.lit("_MIRB.LBL")).alias("path"))
    own = c.filter("kind = 1 AND ord % 5 = 0").select(F.concat(F.lit("x/"), "obs", F.lit("_RED.browse.lbl")).alias("path"))
    images = c.select("ord", F.concat(F.lit("x/"), "name").alias("path"))
    return T.with_labels(images, shared.union(own).distinct()).select("ord", "label_path")


PATHS = f"SELECT p_partkey, name, CASE p_partkey % 3 WHEN 0 THEN concat('data/processed/set', p_partkey % 7, '/', name) WHEN 1 THEN concat('data\\\\processed\\\\b', p_partkey % 5, '\\\\', name) ELSE concat('raw/', name) END AS path FROM ({NAMES})"


def paths(spark, d):
    n, k = _sql(spark, NAMES, part=table(spark, d, "part")), F.col("p_partkey")
    odd = F.concat(F.lit("data\\processed\\b"), (k % 5).cast("string"), F.lit("\\"), "name")
    return n.select("p_partkey", "name", F.when(k % 3 == 0, F.concat(F.lit("data/processed/set"), (k % 7).cast("string"), F.lit("/"), "name")).when(k % 3 == 1, odd).otherwise(F.concat(F.lit("raw/"), "name")).alias("path"))


@query(f"""WITH p AS ({PATHS.replace(chr(92) * 2, chr(92))}) SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN concat('set', p_partkey % 7) WHEN 1 THEN concat('b', p_partkey % 5) ELSE CASE WHEN contains(name, '_') THEN concat(split_part(name, '_', 1), '_', split_part(name, '_', 2)) ELSE name END END AS product,
split_part(split_part(name, '.', 1), '_', -1) AS band_token, CASE WHEN p_partkey % 3 <> 2 THEN concat('data/raw/', CASE p_partkey % 3 WHEN 0 THEN concat('set', p_partkey % 7) ELSE concat('b', p_partkey % 5) END, '/', name) END AS raw_stem, left(sha256(path), 10) AS version FROM p""")
def product_names(spark, d):
    p = F.col("path")
    return paths(spark, d).select("p_partkey", C.product_of(p).alias("product"), C.band_token(p).alias("band_token"), C.raw_stem(p).alias("raw_stem"), C.version_of(p).alias("version"))


@query(f"""WITH n AS ({NAMES}), k AS (SELECT p_partkey, name, bytes, upper(name) AS u FROM n), l AS (SELECT *, CASE WHEN regexp_matches(u, '^DTEEC.*[.]TH[.]JPG$') THEN 'DTM thumbnail' WHEN regexp_matches(u, '^DTEEC') THEN 'DTM derivative' WHEN regexp_matches(u, '^(DTFEC|FOM)') THEN 'FOM correlation map'
WHEN contains(u, 'ORTHO') AND regexp_matches(u, '_RED([.]NOMAP|[.]QLOOK|_C_[0-9]+_ORTHO)?[.]') THEN 'ORTHO B&W (RED)' WHEN contains(u, 'ORTHO') AND contains(u, '_IRB') THEN 'ORTHO color (IRB)' WHEN contains(u, '_IRB') THEN 'filtered color (IRB)' WHEN contains(u, '_MIRB') THEN 'filtered color (MIRB)'
WHEN regexp_matches(u, '_COLOR([.]|$)') THEN 'COLOR quicklook composite' WHEN regexp_matches(u, '_RED([.]NOMAP|[.]QLOOK|_C_[0-9]+_ORTHO)?[.]') THEN 'B&W panchromatic (RED)' ELSE 'browse variant' END AS label FROM k)
SELECT p_partkey, label, CASE WHEN starts_with(label, 'DTM') THEN 'dtm' WHEN starts_with(label, 'FOM') THEN 'fom' WHEN label = 'ORTHO B&W (RED)' THEN 'ortho_red' WHEN label = 'browse variant' THEN 'other' WHEN label = 'B&W panchromatic (RED)' THEN 'red' WHEN contains(u, 'ORTHO') THEN 'ortho_color' ELSE 'color' END AS role FROM l""")
def renderings(spark, d):
    r = N.rendering(F.col("name"))
    return _sql(spark, NAMES, part=table(spark, d, "part")).select("p_partkey", r["label"].alias("label"), r["role"].alias("role"))


@query(f"""WITH n AS (SELECT *, p_partkey % 97 AS footprint, upper(name) AS u FROM ({NAMES})), k AS (SELECT *, CASE WHEN NOT regexp_matches(u, '^(DTEEC|DTFEC|FOM)') AND regexp_matches(u, '_RED([.]NOMAP|[.]QLOOK|_C_[0-9]+_ORTHO)?[.]') THEN CASE WHEN contains(u, 'ORTHO') THEN 1 ELSE 0 END ELSE 2 END AS a FROM n),
o AS (SELECT *, CASE WHEN a < 2 AND (contains(u, 'NOMAP') OR contains(u, 'QLOOK')) THEN 1 ELSE 0 END AS b, CASE WHEN a = 2 THEN 0 WHEN contains(u, 'ABROWSE') THEN 1 WHEN contains(u, 'BROWSE') THEN 0 WHEN contains(u, 'THUMB') THEN 2 ELSE 3 END AS c FROM k)
SELECT footprint, arg_min(name, struct_pack(a := a, b := b, c := c, d := -bytes, n := name)) AS reference FROM o GROUP BY footprint""")
def comparison_reference(spark, d):
    n = _sql(spark, NAMES, part=table(spark, d, "part")).withColumn("footprint", F.col("p_partkey") % 97)
    return N.comparison_reference(n, "footprint").select("footprint", "reference")


KNOWN = "SELECT concat('PIA', s_suppkey) AS pid, concat('mission ', s_nationkey) AS mission, CASE s_suppkey % 3 WHEN 0 THEN 'map' ELSE 'imagery' END AS type FROM supplier WHERE s_suppkey % 2 = 0"
PIDS = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('PIA', p_partkey % 100) WHEN 1 THEN concat('ESP_', p_partkey) WHEN 2 THEN concat('M1', p_partkey, 'L') WHEN 3 THEN concat('x_sol', p_partkey) ELSE p_name END AS pid, CASE WHEN p_size % 7 <> 0 THEN p_size / 8.0 - 3 END AS z, p_size % 11 = 0 AS explained FROM part"


@query(f"""WITH k AS ({KNOWN}), p AS ({PIDS}), j AS (SELECT p.*, coalesce(mission, CASE WHEN starts_with(p.pid, 'ESP') THEN 'MRO' WHEN regexp_matches(p.pid, '^M1?[0-9]') THEN 'LRO' WHEN regexp_matches(lower(p.pid), '^mars_|sol') THEN 'Mars 2020 / MSL' ELSE 'unknown' END) AS mission,
coalesce(type, CASE WHEN starts_with(p.pid, 'ESP') OR regexp_matches(p.pid, '^M1?[0-9]') OR regexp_matches(lower(p.pid), '^mars_|sol') THEN 'imagery' ELSE 'unknown' END) AS type, k.pid IS NOT NULL AS listed FROM p LEFT JOIN k ON k.pid = p.pid)
SELECT p_partkey, mission, type, CASE WHEN z IS NULL THEN 'NO-RAW' WHEN abs(z) >= 3 THEN 'SURVIVES-ORIGINAL' ELSE 'BACKGROUND-LIMITED' END AS status,
CASE WHEN type = 'map' THEN 'NO-FINDING: map product' WHEN explained THEN 'NO-FINDING: explained' WHEN z IS NULL THEN 'INCOMPLETE' WHEN abs(z) < 3 THEN 'NO-FINDING: collapses' WHEN NOT listed AND type = 'imagery' THEN 'CANDIDATE' ELSE 'NO-FINDING: persists' END AS verdict,
CASE WHEN type = 'map' OR abs(coalesce(z, 0)) >= 3 THEN 'high' ELSE 'medium' END AS certainty FROM j""")
def chased_leads(spark, d):
    """Leads looked up in their originals, with what is known of their source."""
    p = _sql(spark, PIDS, part=table(spark, d, "part"))
    s = N.source_of(p, "pid", _sql(spark, KNOWN, supplier=table(spark, d, "supplier")))
    c = N.chased(F.col("z").cast("double"), F.col("type"), F.col("listed"), F.col("explained"))
    return s.select("p_partkey", "mission", "type", c["status"].alias("status"), c["verdict"].alias("verdict"), c["certainty"].alias("certainty"))


@query(f"SELECT p_partkey, name FROM ({NAMES}) WHERE (ends_with(lower(name), '.jpg') OR ends_with(lower(name), '.jp2')) AND NOT regexp_matches(name, 'NOMAP|_A_0[0-9]_')")
def pruned_files(spark, d):
    return N.pruned(_sql(spark, NAMES, part=table(spark, d, "part")), suffixes=(".JPG", ".jp2"), skip=r"NOMAP|_A_0\d_").select("p_partkey", "name")


@query("SELECT page_id, url FROM pages WHERE contains(url, '/en/')")
def manifest_slice(spark, d):
    """Lines of a download log whose file or address holds a product's name."""
    return T.manifest_of(table(spark, d, "pages").withColumn("file", F.lit("")), "/en/").select("page_id", "url")


@query(f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS w, l_linenumber * 6.0 AS h, CASE WHEN l_partkey % 9 <> 0 THEN l_tax * 10 END AS map_scale, CASE WHEN l_partkey % 4 <> 0 THEN 4000.0 END AS line_samples, 1000.0 + l_suppkey AS width, CASE WHEN l_partkey % 5 <> 0 THEN 80 - l_discount * 500 END AS elevation FROM lineitem),
e AS (SELECT *, CASE WHEN map_scale <> 0 THEN CASE WHEN line_samples IS NOT NULL THEN map_scale * (line_samples / width) ELSE map_scale END END AS eff FROM l), s AS (SELECT *, {rnd('greatest(w, h) * eff', 1)} AS size_m FROM e)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('eff', 3)} AS eff_scale_m, size_m, CASE WHEN elevation <> 0 AND size_m <> 0 THEN {rnd('size_m * tan(radians(elevation))', 1)} END AS height_m FROM s""")
def packaged_scale(spark, d):
    """Ground size in a package: the label's scale at the width that is shown."""
    li, k = table(spark, d, "lineitem"), F.col("l_partkey")
    got = C.shown_size(F.greatest(F.col("l_quantity"), F.col("l_linenumber") * 6.0), F.when(k % 9 != 0, F.col("l_tax") * 10), F.when(k % 4 != 0, 4000.0), F.col("l_suppkey") + 1000.0, F.when(k % 5 != 0, 80 - F.col("l_discount") * 500))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *got)


@query(f"""SELECT s_suppkey, {rnd('cos(radians(e)) * sin(radians(a))', 6)} AS east, {rnd('cos(radians(e)) * cos(radians(a))', 6)} AS north, {rnd('sin(radians(e))', 6)} AS up, {rnd('-sin(radians(a))', 6)} AS dx, {rnd('cos(radians(a))', 6)} AS dy, {rnd('CASE WHEN e > 1 AND e < 89 THEN 25.0 / (0.5 * tan(radians(e))) END', 4)} AS shadow_px
FROM (SELECT s_suppkey, abs(s_acctbal) / 120.0 AS e, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey * 3.0 END AS a FROM supplier)""")
def sun_vectors(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", (F.abs("s_acctbal") / 120.0).alias("e"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey") * 3.0).alias("a"))
    v, w = C.sun_vector(F.col("e"), F.col("a")), C.shadow_direction(F.col("a"))
    r = lambda c, n: C.rounded(c, 6).alias(n)
    return s.select("s_suppkey", r(v["east"], "east"), r(v["north"], "north"), r(v["up"], "up"), r(w["dx"], "dx"), r(w["dy"], "dy"), C.rounded(C.shadow_for_height(F.lit(25.0), F.lit(0.5), F.col("e")), 4).alias("shadow_px"))


@query("SELECT * FROM (VALUES ('apollo_orbital', 'moon', 2, false), ('clementine', 'moon', 3, false), ('ctx', 'mars', 3, true), ('lunar_orbiter', 'moon', 3, false), ('m3', 'moon', 3, false), ('mex_hrsc', 'mars', 2, false), ('moc', 'mars', 3, true), ('themis', 'mars', 3, false), ('viking1', 'mars', 3, true), ('viking2', 'mars', 3, true)) t(source, target, depth, verified)")
def source_registry(spark, d):
    return S.sources(spark).select("source", "target", "depth", "verified")


@query("""WITH r AS (SELECT ts, event_id, event_type, props FROM events ORDER BY event_id LIMIT 500) SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM r""")
def first_events(spark, d):
    """The first 500 good lines of a log, oldest first: a page of it."""
    return table(spark, d, "events").orderBy("event_id").limit(500).select("event_id", "event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('F-', doc_id) ELSE concat('f', doc_id) END AS id, CASE WHEN doc_id % 3 = 0 THEN 'OPEN' ELSE '' END AS status, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 4 AS INTEGER) END AS evidence_class, CASE WHEN doc_id % 7 = 0 THEN concat('ESP_', doc_id, '.png') ELSE '' END AS image, CASE WHEN doc_id % 7 = 0 THEN concat('a/b/ESP_', doc_id, '.png') ELSE '' END AS path FROM documents""")
def finding_fields(spark, d):
    """Fields of finding reports, made from ids and read again."""
    k, t = F.col("doc_id"), F.col("doc_id").cast("string")
    text = F.concat(F.lit("# x\n"), F.when(k % 2 == 0, F.concat(F.lit("Finding ID: F-"), t, F.lit("\n"))).otherwise(""), F.when(k % 3 == 0, "Status: OPEN now\n").otherwise(""), F.when(k % 5 != 0, F.concat(F.lit("Evidence class: "), (k % 4).cast("string"), F.lit("\n"))).otherwise(""), F.when(k % 7 == 0, F.concat(F.lit("File: `a\\b\\ESP_"), t, F.lit(".png`\n"))).otherwise(""))
    f = T.finding_fields(F.col("body"), F.col("stem"))
    return table(spark, d, "documents").select("doc_id", text.alias("body"), F.concat(F.lit("f"), t).alias("stem")).select("doc_id", *f)
