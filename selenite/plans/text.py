"""Queries over names, phrases and event windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import names as N
from ..functions import phrases as P
from ..functions import scoring as S
from ..sources.files import pds3_fields
from ..sources.tables import BANDS, HIGH, POLARITIES, WIDE, boxes_by, table
from ..streaming import events as E
from .relational import ADJUDICATED, TIES, rnd

Q: dict = {}
O: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def add(f):
        Q[name or f.__name__] = f
        if oracle:
            O[name or f.__name__] = oracle
        return f

    return add


#: Names made from parts, of every kind that the table of patterns knows.
NAMES = """SELECT p_partkey, CAST(p_partkey * 1000 AS BIGINT) AS bytes, CASE p_partkey % 12
WHEN 0 THEN 'README.TXT' WHEN 1 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_1410_RED.browse.jpg') WHEN 2 THEN concat('PSP_', CAST(100000 + p_partkey AS STRING), '_1410_COLOR.NOMAP.thumb.jpg')
WHEN 3 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_2000_MIRB.LBL') WHEN 4 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_2000_RED.JP2')
WHEN 5 THEN concat('DTEEC_', CAST(100000 + p_partkey AS STRING), '_1410_020000_1410_A01.th.jpg') WHEN 6 THEN 'DTFEC_1_2_A01.JP2' WHEN 7 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_1410_IRB_A_01_ORTHO.jpg')
WHEN 8 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_1410_RED_C_01_ORTHO.ab.jpg') WHEN 9 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_1410_ESP_020000_1410_RED.thumb.png')
WHEN 10 THEN concat('ESP_', CAST(100000 + p_partkey AS STRING), '_1410_BG12_0.browse.jpg') ELSE p_name END AS name FROM part"""
OBS = "[A-Z]{3}_[0-9]{6}_[0-9]{4}"


@query(f"""WITH n AS ({NAMES}), k AS (SELECT *, CASE WHEN lower(name) = 'readme.txt' THEN 'readme' WHEN regexp_matches(name, '^{OBS}_(RED|IRB|MIRB|MRGB|RGB|COLOR)([.](NOMAP|QLOOK))?([.](browse|abrowse|thumb)[.]jpg|[.]LBL|[.]JP2)$') THEN 'rdr'
WHEN name LIKE 'DTEEC%.jpg' THEN 'dtm' WHEN name LIKE 'DTFEC%' THEN 'fom' WHEN name LIKE '%_C_01_ORTHO%' THEN 'ortho' WHEN name LIKE '%.png' THEN 'anaglyph' WHEN name LIKE '%_BG12_0%' THEN 'edr' ELSE 'other' END AS kind FROM n),
c AS (SELECT *, CASE kind WHEN 'rdr' THEN CASE WHEN name LIKE '%.LBL' THEN '' WHEN name LIKE '%.JP2' THEN 'fullres' WHEN name LIKE '%thumb%' THEN 'thumb' ELSE 'browse' END WHEN 'dtm' THEN 'thumbnail' WHEN 'ortho' THEN 'browse' WHEN 'anaglyph' THEN 'thumb' WHEN 'edr' THEN 'browse' WHEN 'fom' THEN 'fullres' ELSE '' END AS scale,
CASE kind WHEN 'rdr' THEN CASE WHEN name LIKE '%NOMAP%' THEN 'nomap' ELSE 'map' END WHEN 'dtm' THEN 'dtm' WHEN 'fom' THEN 'dtm' WHEN 'ortho' THEN 'ortho' WHEN 'anaglyph' THEN 'anaglyph' WHEN 'edr' THEN 'map' ELSE '' END AS geometry,
CASE kind WHEN 'rdr' THEN CASE WHEN name LIKE '%.LBL' THEN 'other' WHEN name LIKE '%_RED%' THEN 'red' ELSE 'color' END WHEN 'edr' THEN 'color' WHEN 'dtm' THEN 'dtm' WHEN 'fom' THEN 'fom' WHEN 'ortho' THEN 'ortho_red' WHEN 'anaglyph' THEN 'anaglyph' ELSE 'other' END AS role FROM k)
SELECT p_partkey, kind, scale, geometry, role, CASE WHEN kind = 'readme' OR name LIKE '%.LBL' THEN true WHEN name LIKE '%.JP2' THEN false WHEN geometry NOT IN ('', 'map', 'ortho', 'dtm', 'anaglyph') THEN false WHEN scale IN ('browse', 'thumb') THEN true WHEN scale <> '' THEN false ELSE true END AS acquire FROM c""")
def taxonomy(spark, d):
    n = spark.sql(NAMES.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    return N.classified(n).select("p_partkey", "kind", "scale", "geometry", "role", N.acquire()["acquire"].alias("acquire"))


@query(f"WITH n AS ({NAMES}) SELECT p_partkey, CASE WHEN regexp_matches(name, '^{OBS}_{OBS}$') THEN 'stereo_pair' WHEN regexp_matches(name, '^{OBS}$') THEN 'observation' ELSE 'unclassified' END AS kind, split_part(regexp_extract(name, '{OBS}', 0), '_', 1) AS instrument, TRY_CAST(split_part(regexp_extract(name, '{OBS}', 0), '_', 2) AS INTEGER) AS orbit FROM (SELECT p_partkey, CASE WHEN p_partkey % 12 = 9 THEN replace(name, '_RED.thumb.png', '') WHEN p_partkey % 12 = 1 THEN replace(name, '_RED.browse.jpg', '') ELSE name END AS name FROM n)")
def footprints(spark, d):
    n = spark.sql(NAMES.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    k = F.col("p_partkey") % 12
    n = n.select("p_partkey", F.when(k == 9, F.replace("name", F.lit("_RED.thumb.png"), F.lit(""))).when(k == 1, F.replace("name", F.lit("_RED.browse.jpg"), F.lit(""))).otherwise(F.col("name")).alias("name"))
    f = N.footprint(F.col("name"))
    return n.select("p_partkey", f["kind"].alias("kind"), f["instrument"].alias("instrument"), f["orbit"].alias("orbit"))


FEATURES = f"""WITH {ADJUDICATED}, r AS (SELECT l_suppkey * 200 + l_partkey % 200 AS feature, max(score) AS max_score, max(contrast) AS max_contrast, CAST(sum(area_px) AS BIGINT) AS area, list_sort(list(DISTINCT verdict)) AS verdicts,
list_sort(list(DISTINCT regexp_extract(image, '_(MIRB|MRGB|RED)[.]', 1))) AS bands, list_sort(list(DISTINCT polarity)) AS polarities, list_sort(list_distinct(flatten(list(flags)))) AS flags,
arg_min(struct_pack(aspect := aspect, compactness := compactness, polarity := polarity, verdict := verdict), struct_pack(s := -score, i := image, {', '.join(f'{c} := {c}' for c in TIES)})) AS best,
CASE WHEN feature % 2 = 0 THEN 'Mars' ELSE 'Moon' END AS body FROM judged GROUP BY l_suppkey * 200 + l_partkey % 200),
g AS (SELECT *, best.aspect AS aspect, coalesce(best.compactness, 0) AS compactness, best.polarity AS polarity, best.verdict AS verdict, array_to_string(flags, ' ') AS words FROM r),
s AS (SELECT *, CASE WHEN aspect <= 1.8 THEN 2 ELSE 0 END + CASE WHEN compactness >= 0.7 THEN 2 ELSE 0 END AS s1, CASE WHEN aspect <= 3 THEN 2 ELSE 0 END + CASE WHEN compactness >= 0.5 THEN 2 ELSE 0 END AS s2, CASE WHEN aspect <= 8 THEN 2 ELSE 0 END + 1 AS s3, CASE WHEN aspect >= 2.5 THEN 2 ELSE 0 END AS s4,
CASE WHEN contains(words, 'streak') THEN 3 ELSE 0 END AS f4, CASE WHEN contains(words, 'pixel') THEN 6 ELSE 0 END + CASE WHEN contains(words, 'band') THEN 3 ELSE 0 END + CASE WHEN contains(words, 'compression') THEN 6 ELSE 0 END AS f5, CASE WHEN contains(words, 'blob') THEN 3 ELSE 0 END AS f6 FROM g),
f AS (SELECT *, CASE greatest(s1, s2, s3, s4) WHEN s1 THEN 'crater' WHEN s2 THEN 'boulder' WHEN s3 THEN 'albedo' ELSE 'linear' END AS category,
CASE greatest(s1, s2, s3, s4 + f4, f5, f6) WHEN s1 THEN 'crater' WHEN s2 THEN 'boulder' WHEN s3 THEN 'albedo' WHEN s4 + f4 THEN 'linear' WHEN f5 THEN 'artifact' ELSE 'irregular' END AS flagged FROM s)"""
SHOWN = "feature, body, category, max_score, array_to_string(verdicts, ',') AS verdicts, array_to_string(bands, ',') AS bands"


def features(spark, d):
    """Judged candidates in small groups, all of them; shape, polarity and verdict are those of the best member.

    Lines come dealt and sorted by feature, and what a feature has seen is gathered as bits: so groups are made as rows pass, where
    sets would make Spark sort, and spill, all that is derived from the lines, twice.
    """
    best = F.min_by(F.struct("aspect", "compactness", "polarity", "verdict"), F.struct((-F.col("score")).alias("s"), "image", *TIES))
    b = boxes_by(spark, d, "feature", F.col("l_suppkey") * 200 + F.col("l_partkey") % 200)
    sets = {"verdicts": (F.col("verdict"), S.ADVICE), "bands": (C.band(F.col("image")), BANDS), "polarities": (F.col("polarity"), POLARITIES)}
    seen = [F.bit_or(S.mask(c, names)).alias(name) for name, (c, names) in sets.items()]
    g = S.adjudicate(S.evaluate(b, WIDE, HIGH)).groupBy("feature").agg(F.max("score").alias("max_score"), F.max("contrast").alias("max_contrast"), F.sum("area_px").alias("area"), *seen, F.bit_or("flag_bits").alias("flag_bits"), best.alias("best"))
    g = g.withColumns({"flags": S.flags()} | {name: S.named(F.col(name), names) for name, (_, names) in sets.items()}).drop("flag_bits")
    return g.select("*", "best.*").drop("best").withColumns({"body": F.when(F.col("feature") % 2 == 0, "Mars").otherwise("Moon"), "base": F.col("feature").cast("string")})


#: Phrases and the same conditions in SQL, written by hand.
PHRASES = {
    "nl_query_bright": ("bright features on Mars", "body = 'Mars' AND list_contains(polarities, 'bright')"),
    "nl_query_confirmed": ("confirmed craters on the moon", "body = 'Moon' AND list_contains(verdicts, 'CONFIRMED-LEAD') AND category = 'crater'"),
    "nl_query_range": ("score between 30 and 70", "max_score BETWEEN 30 AND 70"),
    "nl_query_compare": ("large dark ones, contrast >= 2", "area >= 5000 AND list_contains(polarities, 'dark') AND max_contrast >= 2"),
    "nl_query_negated": ("no terrain, mirb", "list_contains(bands, 'MIRB')"),
}


def _phrase(text):
    def run(spark, d):
        return P.matching(features(spark, d), text).select("feature", "body", "category", "max_score", F.array_join("verdicts", ",").alias("verdicts"), F.array_join("bands", ",").alias("bands"))

    return run


for _name, (_text, _sql) in PHRASES.items():
    query(f"{FEATURES} SELECT {SHOWN} FROM f WHERE {_sql}", _name)(_phrase(_text))


@query(f"{FEATURES} SELECT body, category, count(*) AS n, max(max_score) AS best FROM f GROUP BY body, category")
def category_histogram(spark, d):
    return features(spark, d).withColumn("category", P.category()).groupBy("body", "category").agg(F.count("*").alias("n"), F.max("max_score").alias("best"))


#: What stands out, by the column that holds the category.
INSIGHTS = """, i AS (SELECT 'top lead' AS kind, CAST(arg_max(feature, struct_pack(a := max_score, b := -feature)) AS VARCHAR) AS subject, CAST(max(max_score) AS DOUBLE) AS value, 0 AS priority FROM f WHERE verdict = 'CONFIRMED-LEAD' HAVING count(*) > 0
UNION ALL SELECT 'several bands', CAST(count(*) AS VARCHAR), CAST(count(*) AS DOUBLE), 1 FROM f WHERE len(bands) >= 2 HAVING count(*) > 0
UNION ALL SELECT 'artifact rate', CAST(count(*) FILTER (WHERE {0} = 'artifact') AS VARCHAR), count(*) FILTER (WHERE {0} = 'artifact') * 100.0 / count(*), 3 FROM f HAVING count(*) FILTER (WHERE {0} = 'artifact') > 0 AND count(*) > 10
UNION ALL SELECT 'busy body', body, sum(max_score) FILTER (WHERE rn <= 3) / 3, 1 FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY max_score DESC, feature) AS rn FROM f) GROUP BY body HAVING count(*) >= 5 AND sum(max_score) FILTER (WHERE rn <= 3) / 3 > 50
UNION ALL SELECT 'rare category', {0}, CAST(count(*) AS DOUBLE), 2 FROM f GROUP BY {0} HAVING count(*) <= 2) SELECT kind, subject, """


@query(f"{FEATURES}{INSIGHTS.format('category')}{rnd('value', 4)} AS value, priority FROM i")
def insights(spark, d):
    out = P.insights(features(spark, d).withColumn("category", P.category()))
    return out.select("kind", "subject", C.rounded(F.col("value"), 4).alias("value"), "priority")


@query(f"{FEATURES}{INSIGHTS.format('flagged')}{rnd('value', 4)} AS value, priority FROM i")
def insights_by_flags(spark, d):
    """The same with categories that the words of flags settle too."""
    out = P.insights(features(spark, d).withColumn("category", P.category(use_flags=True)))
    return out.select("kind", "subject", C.rounded(F.col("value"), 4).alias("value"), "priority")


@query(f"""{FEATURES} SELECT feature, flagged AS category, CASE flagged WHEN 'crater' THEN 'Circular or bowl-shaped depression, likely impact origin' WHEN 'boulder' THEN 'Compact raised feature, likely rock or boulder'
WHEN 'albedo' THEN 'Area of different brightness, likely albedo variation' WHEN 'linear' THEN 'Elongated feature, linear or arc-shaped' WHEN 'artifact' THEN 'Known sensor or processing artifact' ELSE 'Amorphous or complex shape without clear class' END AS category_desc, true AS ready FROM f""")
def enriched_features(spark, d):
    return P.enriched(features(spark, d), use_flags=True).select("feature", "category", "category_desc", "ready")


@query(f"""{FEATURES}, m AS (SELECT * FROM f WHERE body = 'Mars' AND list_contains(polarities, 'bright')), c AS (SELECT category AS k, count(*) AS n FROM m GROUP BY 1), b AS (SELECT body AS k, count(*) AS n FROM m GROUP BY 1),
t AS (SELECT * FROM m ORDER BY max_score DESC, CAST(feature AS VARCHAR) LIMIT 3)
SELECT count(*) AS total, count(*) FILTER (WHERE verdict = 'CONFIRMED-LEAD') AS confirmed, count(*) FILTER (WHERE verdict = 'PROMISING') AS promising, (SELECT string_agg(k || ': ' || n, ', ' ORDER BY n DESC, k) FROM c) AS categories,
(SELECT string_agg(k || ': ' || n, ', ' ORDER BY k) FROM b) AS bodies, (SELECT string_agg(feature || ' ' || printf('%.0f', max_score) || ' ' || category, '; ' ORDER BY max_score DESC, CAST(feature AS VARCHAR)) FROM t) AS top FROM m""")
def phrase_summary(spark, d):
    """The whole way from a phrase to its summary."""
    return P.answered(features(spark, d), "bright features on Mars")["summary"]


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, sum(CAST(floor(value * 100 + 0.5) AS BIGINT))::BIGINT AS cents FROM events GROUP BY 1, 2")
def tumbling_window(spark, d):
    """An extension: hourly counts, the same plan as the stream's."""
    return E.tumbling(table(spark, d, "events"))


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh, event_id FROM events), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM s)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM g GROUP BY user_id, k""")
def session_windows(spark, d):
    return E.sessions(table(spark, d, "events"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat('F_', l_suppkey, '|', CAST(l_partkey AS INTEGER), ',', CAST(l_orderkey % 100 AS INTEGER), '@', CAST(l_quantity AS INTEGER), 'x', l_linenumber) AS box_key, CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_quantity * 1024 AS BIGINT) WHEN l_suppkey % 3 = 1 THEN CAST(l_quantity AS BIGINT) END AS bytes FROM lineitem")
def keys_and_sizes(spark, d):
    li = table(spark, d, "lineitem")
    q = F.col("l_quantity").cast("int")
    text = F.when(F.col("l_suppkey") % 3 == 0, F.format_string("%dK", q)).when(F.col("l_suppkey") % 3 == 1, q.cast("string")).otherwise(F.lit("-"))
    key = C.persistence_key(F.concat(F.lit("F_"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("int"), (F.col("l_orderkey") % 100).cast("int"), q, F.col("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", key.alias("box_key"), C.file_size(text).alias("bytes"))


@query(f"SELECT s_suppkey, {rnd('90 - s_acctbal / 200.0', 4)} AS elevation, 'DEG' AS unit, upper(s_name) AS target FROM supplier")
def label_fields(spark, d):
    """Fields of labels written from suppliers and parsed again."""
    s = table(spark, d, "supplier")
    text = F.format_string('PDS_VERSION_ID = PDS3\r\nTARGET_NAME = "%s"\r\nINCIDENCE_ANGLE = %s <deg>\r\nEND\r\n', F.upper("s_name"), (F.col("s_acctbal") / 200.0).cast("string"))
    f = s.select("s_suppkey", pds3_fields(text).alias("f"))
    q = C.quantity(F.col("f")["INCIDENCE_ANGLE"])
    return f.select("s_suppkey", C.rounded(90 - q["value"], 4).alias("elevation"), q["unit"].alias("unit"), F.regexp_replace(F.col("f")["TARGET_NAME"], '"', "").alias("target"))
