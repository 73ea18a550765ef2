"""Queries over leads grouped into features: rollups, dashboards, filters of cards, numbering, false-discovery control and lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import phrases as P
from ..functions import reports as T
from ..functions import scoring as S
from ..operators import relational as R
from ..session import cut
from ..sources.tables import BANDS, POLARITIES, boxes, table
from .relational import ADJUDICATED, BOXES, EVALUATED, KEY, TIE_SQL, TIES, evaluated, judged, rnd, tail

Q: dict = {}
O: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if oracle:
            O[f.__name__] = oracle
        return f

    return add


BASE = "regexp_replace(image, '_(MIRB|MRGB|RED)[.](browse|abrowse|thumb).*$', '')"


def grouped(rows: str, reach: int, name: str) -> str:
    """CTEs that group rows (node, base, x, y) of a CTE into features by a recursive closure."""
    return f"""e_{name} AS (SELECT a.node AS a, c.node AS b FROM {rows} a JOIN {rows} c ON a.base = c.base AND abs(a.x - c.x) <= {reach} AND abs(a.y - c.y) <= {reach} AND a.node <> c.node),
r_{name} AS (SELECT node, node AS r FROM {rows} UNION SELECT e.b, s.r FROM r_{name} s JOIN e_{name} e ON e.a = s.node),
{name} AS (SELECT l.*, f.feature FROM {rows} l JOIN (SELECT node, min(r) AS feature FROM r_{name} GROUP BY node) f USING (node))"""


ROLLUP = f"""WITH RECURSIVE {ADJUDICATED}, leads AS (SELECT *, row_number() OVER (ORDER BY {TIE_SQL}) AS node, {BASE} AS base, regexp_extract(image, '_(MIRB|MRGB|RED)[.]', 1) AS band, CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_tax AS DOUBLE) END AS q
FROM judged JOIN (SELECT l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4, any_value(l_tax) AS l_tax FROM lineitem GROUP BY ALL) ON l_orderkey = k1 AND l_linenumber = k2 AND l_partkey = k3 AND l_suppkey = k4 WHERE verdict IN ('CONFIRMED-LEAD', 'PROMISING')),
{grouped('leads', 6, 'g')},
f AS (SELECT feature, any_value(base) AS base, count(*) AS members, max(score) AS max_score, max(contrast) AS max_contrast, max(evidence_class) AS evidence_class, max(interest) AS interest, min(coalesce(q, 1)) AS fdr_q,
list_sort(list(DISTINCT band) FILTER (WHERE band <> '')) AS bands, list_sort(list(DISTINCT verdict)) AS verdicts, list_sort(list(DISTINCT polarity)) AS polarities, list_sort(list_distinct(flatten(list(flags)))) AS flags,
arg_min(struct_pack(rep := concat_ws('-', l_orderkey, l_linenumber, l_partkey), image := image, verdict := verdict, polarity := polarity, area_px := area_px, strip := CASE WHEN l_orderkey % 3 = 0 THEN concat('T', l_orderkey) ELSE '' END), struct_pack(s := -score, i := image, {', '.join(f'{c} := {c}' for c in TIES)})) AS best,
list_transform(list_sort(list(struct_pack(s := -score, i := image, {', '.join(f'{c} := {c}' for c in TIES)}, t := concat(image, ' ', x, ',', y, ' ', verdict)))), lambda m: m.t) AS member_texts FROM g GROUP BY feature),
cards AS (SELECT *, best.rep AS rep, best.image AS image, best.verdict AS verdict, best.polarity AS polarity, best.area_px AS area_px, best.strip AS strip, CASE WHEN ends_with(base, '_1003') THEN 'Moon' ELSE 'Mars' END AS body FROM f)"""


def leads(spark, d, reach: int = 6, taxes: bool = False):
    """Leads with the feature that they are grouped into; 6 px as on the cards, 8 on the dashboard. ``taxes``: with q, for which all
    lines are grouped by their keys and joined."""
    # a numbered row keeps the filter on verdicts from being pushed down as the whole of the rules behind them
    cols = [*KEY, "image", *"xywh", "score", "contrast", "evidence_class", "interest", "verdict", "polarity", "flag_bits", "area_px", "sat_frac", "fill"]
    j = judged(spark, d).select(*cols, F.monotonically_increasing_id().alias("node")).filter(F.col("verdict").isin("CONFIRMED-LEAD", "PROMISING")).dropna(subset=KEY)
    if taxes:
        j = j.join(table(spark, d, "lineitem").groupBy(*KEY).agg(F.first("l_tax").alias("l_tax")), KEY).withColumn("q", F.when(F.col("l_partkey") % 5 != 0, F.col("l_tax").cast("double"))).drop("l_tax")
    return R.groups(cut(j.withColumn("base", C.base_frame(F.col("image")))), "node", "base", reach)


def cards(spark, d, taxes: bool = False):
    """One row a feature, with what its members have: the best and worst of their measures, and all of their names; fdr_q with ``taxes``
    only. Sets of fixed names are gathered as bits."""
    sets = {"bands": (C.band(F.col("image")), BANDS[1:]), "verdicts": (F.col("verdict"), S.ADVICE), "polarities": (F.col("polarity"), POLARITIES)}
    seen = [F.bit_or(S.mask(c, names)).alias(name) for name, (c, names) in sets.items()]
    fdr = [F.min(F.coalesce("q", F.lit(1.0))).alias("fdr_q")] if taxes else []
    order = [(-F.col("score")).alias("s"), "image", *TIES]
    strip = F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("T"), F.col("l_orderkey").cast("string"))).otherwise("")
    best = F.min_by(F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("rep"), "image", "verdict", "polarity", "area_px", strip.alias("strip")), F.struct(*order))
    text = F.concat("image", F.lit(" "), F.col("x").cast("string"), F.lit(","), F.col("y").cast("string"), F.lit(" "), "verdict")
    members = F.transform(F.array_sort(F.collect_list(F.struct(*order, text.alias("t")))), lambda m: m["t"])
    g = leads(spark, d, taxes=taxes).groupBy("feature").agg(
        F.first("base").alias("base"), F.count("*").alias("members"), F.max("score").alias("max_score"), F.max("contrast").alias("max_contrast"), F.max("evidence_class").alias("evidence_class"),
        F.max("interest").alias("interest"), *fdr, *seen, F.bit_or("flag_bits").alias("flag_bits"), best.alias("best"), members.alias("member_texts"),
    )
    g = g.withColumns({"flags": S.flags()} | {name: S.named(F.col(name), names) for name, (_, names) in sets.items()}).drop("flag_bits")
    return g.select("*", "best.*").drop("best").withColumn("body", F.when(F.col("base").endswith("_1003"), "Moon").otherwise("Mars"))


TEXT = "array_to_string(bands, ',') AS bands, array_to_string(verdicts, ',') AS verdicts, array_to_string(flags, ',') AS flags"


def _texts(*names):
    return [F.array_join(c, ",").alias(c) for c in names]


@query(f"{ROLLUP} SELECT base, rep, members, max_score, max_contrast, evidence_class, interest, fdr_q, {TEXT}, array_to_string(member_texts, ';') AS member_texts FROM cards")
def showcase_rollup(spark, d):
    return cards(spark, d, taxes=True).select("base", "rep", "members", "max_score", "max_contrast", "evidence_class", "interest", "fdr_q", *_texts("bands", "verdicts", "flags"), F.array_join("member_texts", ";").alias("member_texts"))


@query(f"""{ROLLUP} SELECT 'leads' AS stat, '' AS name, CAST(sum(members) AS BIGINT) AS n FROM cards UNION ALL SELECT 'features', '', count(*) FROM cards UNION ALL SELECT 'band variants', '', CAST(sum(members) - count(*) AS BIGINT) FROM cards
UNION ALL SELECT 'with strip', '', count(*) FROM cards WHERE strip <> '' UNION ALL SELECT 'verdict', verdict, count(*) FROM cards GROUP BY verdict UNION ALL SELECT 'body', body, count(*) FROM cards GROUP BY body
UNION ALL SELECT 'band', b, count(*) FROM (SELECT unnest(bands) AS b FROM cards) GROUP BY b""")
def showcase_stats(spark, d):
    c = cut(cards(spark, d).select("members", "strip", "verdict", "body", "bands"))
    one = c.agg(F.sum("members").alias("leads"), F.count("*").alias("features"), (F.sum("members") - F.count("*")).alias("band variants"), F.count_if(F.col("strip") != "").alias("with strip"))
    return _long(one).unionByName(_counted(c, verdict=F.col("verdict"), body=F.col("body"), band=F.explode("bands")))


def _long(one):
    """A one-row table as rows (stat, name, n)."""
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("stat"), F.lit("").alias("name"), F.col(f"`{c}`").cast("long").alias("n")) for c in one.columns])).alias("s")).select("s.*")


def _counted(df, n=None, **columns):
    """Rows (stat, name, n): counts of the values of each column, or other sums; nulls and blanks aren't counted."""
    out = None
    for stat, c in columns.items():
        part = df.withColumn("name", c).filter("name <> ''").groupBy("name").agg((F.count("*") if n is None else n).alias("n")).select(F.lit(stat).alias("stat"), "name", "n")
        out = part if out is None else out.unionByName(part)
    return out


BODY_SQL = "CASE WHEN contains(image, 'ESP_') THEN 'Mars' ELSE '' END"


@query(f"""WITH RECURSIVE {ADJUDICATED}, allrows AS (SELECT *, row_number() OVER (ORDER BY {TIE_SQL}) AS node, {BASE} AS base, regexp_extract(image, '_(MIRB|MRGB|RED)[.]', 1) AS band FROM judged), leads AS (SELECT * FROM allrows WHERE verdict IN ('CONFIRMED-LEAD', 'PROMISING')),
{grouped('allrows', 8, 'ga')}, {grouped('leads', 8, 'gl')}
SELECT 'leads_total' AS stat, '' AS name, count(*) AS n FROM leads UNION ALL SELECT 'adjudicated_total', '', count(*) FROM allrows UNION ALL SELECT 'evaluated_total', '', count(*) FROM classed UNION ALL SELECT 'catalog_rows', '', count(*) FROM part
UNION ALL SELECT 'audit_recent', '', least(20, count(*)) FROM events UNION ALL SELECT 'grouped_features', '', count(DISTINCT feature) FROM gl UNION ALL SELECT 'distinct_anomalies', '', count(DISTINCT feature) FROM ga
UNION ALL SELECT 'verdict', verdict, count(*) FROM leads GROUP BY verdict UNION ALL SELECT 'body', 'Mars', count(*) FROM leads UNION ALL SELECT 'band', band, count(*) FROM leads GROUP BY band""")
def dashboard_stats(spark, d):
    """Counts over the four tables that the dashboard reads; near detections in variants of one frame are one anomaly."""
    node = F.monotonically_increasing_id().alias("node")
    all_ = boxes(spark, d).select("x", "y", C.base_frame(F.col("image")).alias("base"), node)
    # a numbered row keeps the filter on verdicts from being pushed down as the whole of the rules behind them
    lead = judged(spark, d).select("x", "y", "verdict", C.base_frame(F.col("image")).alias("base"), node).filter(F.col("verdict").isin("CONFIRMED-LEAD", "PROMISING"))
    per = cut(judged(spark, d).groupBy("verdict", "image").agg(F.count("*").alias("n")))  # verdicts times images
    led = per.filter(F.col("verdict").isin("CONFIRMED-LEAD", "PROMISING"))
    count, total = (lambda df: df.agg(F.count("*")).scalar()), (lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar())
    one = spark.range(1).select(
        total(led).alias("leads_total"), total(per).alias("adjudicated_total"), count(evaluated(spark, d)).alias("evaluated_total"), count(table(spark, d, "part")).alias("catalog_rows"), count(table(spark, d, "events").limit(20)).alias("audit_recent"),
        *[R.count_groups(rows, "node", "base", 8, name).scalar().alias(name) for name, rows in (("grouped_features", lead), ("distinct_anomalies", all_))],
    )
    body = F.when(F.col("image").contains("ESP_"), "Mars").when(F.col("image").startswith("M"), "Moon")
    return _long(one).unionByName(_counted(led, F.sum("n"), verdict=F.col("verdict"), body=body, band=C.band(F.col("image"))))


@query(f"{ROLLUP} SELECT base, rep, max_score FROM cards WHERE list_contains(verdicts, 'CONFIRMED-LEAD') AND len(polarities) = 1 AND polarities[1] = 'bright' AND max_score >= 60 AND max_contrast >= 2 AND strip <> '' AND body = 'Mars' AND list_contains(bands, 'RED') AND len(list_filter(member_texts, lambda m: contains(lower(m), 'red.browse'))) > 0")
def card_filter(spark, d):
    """Cards whose members are all bright, and more."""
    found = P.card_condition("CONFIRMED-LEAD", "Mars", "RED", "bright", 60, 2, True, "RED.browse")
    return cards(spark, d).filter(found).select("base", "rep", "max_score")


@query(f"{ROLLUP} SELECT base, rep, max_contrast FROM cards WHERE len(list_intersect(verdicts, ['PROMISING'])) > 0 AND max_contrast >= 1.5 AND (contains(lower(array_to_string(flags, ',')), 'blob') OR contains(lower(array_to_string(member_texts, ' ')), 'blob'))")
def explorer_filter(spark, d):
    return cards(spark, d).filter(P.explorer_condition(("PROMISING",), 1.5, "Blob")).select("base", "rep", "max_contrast")


@query(f"{ROLLUP}, o AS (SELECT base, rep, max_contrast, row_number() OVER (ORDER BY max_contrast DESC, base, rep) - 1 AS p, count(*) OVER () AS n FROM cards WHERE list_contains(verdicts, 'PROMISING')) SELECT base, rep, max_contrast, CAST((p - 1000003 % n + n) % n AS BIGINT) AS turn FROM o WHERE (p - 1000003 % n + n) % n < 40")
def features_page(spark, d):
    """A page of the feature list: filtered, sorted by contrast, from an offset that runs over the end."""
    c = cut(cards(spark, d).filter(F.array_contains("verdicts", "PROMISING")).select("base", "rep", "max_contrast", "max_score"))
    order = R.sorted_by(c, "contrast", {"score": "max_score", "contrast": "max_contrast"}, [F.col("base"), F.col("rep")])
    return R.circular_page(c, order, 1000003, 40, repeat=True, key=-F.coalesce(F.col("max_contrast"), F.lit(0.0))).select("base", "rep", "max_contrast", "turn")


@query("SELECT n_nationkey, n_name, CAST(i AS BIGINT) AS turn FROM (SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS p, count(*) OVER () AS n FROM nation) JOIN range(0, 60) r(i) ON (7 + i) % n = p")
def looped_page(spark, d):
    """A page longer than its table starts over; an unknown sort leaves the order as it is."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return R.circular_page(n, R.sorted_by(n, "colour", {"name": "n_name"}, [F.col("n_nationkey")]), 7, 60, repeat=True)


@query(f"WITH {EVALUATED} SELECT {', '.join(KEY)}, x, y, image, row_number() OVER (PARTITION BY image ORDER BY {TIE_SQL}) AS n FROM classed")
def numbered_in_image(spark, d):
    return R.numbered(evaluated(spark, d), "image", [F.col(c) for c in TIES]).select(*KEY, "x", "y", "image", "n")


@query(f"WITH {EVALUATED} SELECT {', '.join(KEY)}, interest, image, row_number() OVER (PARTITION BY image ORDER BY interest DESC, {TIE_SQL}) AS n FROM classed")
def numbered_by_score(spark, d):
    return R.numbered(evaluated(spark, d), "image", [F.desc("interest"), *[F.col(c) for c in TIES]]).select(*KEY, "interest", "image", "n")


@query(f"WITH {EVALUATED} SELECT {', '.join(KEY)}, interest FROM (SELECT *, row_number() OVER (ORDER BY interest DESC, {TIE_SQL}) AS rn FROM classed) WHERE rn = 8")
def kth_candidate(spark, d):
    """The candidate of rank 8: sorted as far as that only."""
    return evaluated(spark, d).orderBy(F.desc("interest"), *TIES).offset(7).limit(1).select(*KEY, "interest")


@query(f"WITH {EVALUATED} SELECT image, count(*) AS n, count(*) FILTER (WHERE NOT (near_edge AND contrast < 5.0)) AS kept, {rnd('avg(CASE WHEN evidence_class >= 3 THEN 1.0 ELSE 0.0 END)', 3)} AS class3_share FROM classed GROUP BY image")
def image_shares(spark, d):
    """Per image: candidates, those that the rule for edges keeps, and the share of the best class."""
    drop = F.col("near_edge") & (F.col("contrast") < 5.0)
    return evaluated(spark, d).groupBy("image").agg(F.count("*").alias("n"), F.count_if(~drop).alias("kept"), C.rounded(F.avg((F.col("evidence_class") >= 3).cast("int")), 3).alias("class3_share"))


@query(f"""WITH {ADJUDICATED}, p AS (SELECT {', '.join(KEY)}, contrast, {tail('contrast')} AS p FROM (SELECT *, 1 / (1 + 0.5 * (contrast / 1.4142135623730951)) AS t FROM judged WHERE verdict <> 'EXPLAINED-ARTIFACT')),
r AS (SELECT *, row_number() OVER (ORDER BY p) AS rk, count(*) OVER () AS n FROM p), q AS (SELECT *, min(least(1.0, p * n / rk)) OVER (ORDER BY rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM r)
SELECT {', '.join(KEY)}, contrast, {rnd('q', 6)} AS fdr_q FROM q""")
def fdr_tested(spark, d):
    """q-values of all candidates but explained ones, which are not tested."""
    t = cut(judged(spark, d).select(*KEY, "contrast", "verdict")).filter("verdict <> 'EXPLAINED-ARTIFACT'").select(*KEY, "contrast", C.upper_tail(F.col("contrast")).alias("p"))
    return R.adjusted(t, "p").select(*KEY, "contrast", C.rounded(F.col("fdr_q"), 6).alias("fdr_q"))


SCENES = "SELECT CASE n_nationkey % 3 WHEN 0 THEN concat('ESP_0', n_nationkey + 10, '00_1003_RED.browse') WHEN 1 THEN concat(n_nationkey + 10, '00_1005_RED.browse.jpg') ELSE concat('x/ESP_0', n_nationkey + 10, '00_1002_MIRB.browse.jpg') END AS scene, n_nationkey * 3 AS fp, n_nationkey % 4 = 0 AS told FROM nation"


@query(f"""WITH s AS (SELECT * FROM ({SCENES}) WHERE NOT told), i AS (SELECT image, count(*) AS candidates FROM ({BOXES}) GROUP BY image),
m AS (SELECT image, scene, fp, row_number() OVER (PARTITION BY image ORDER BY CASE WHEN image = scene THEN 0 ELSE 1 END, scene) AS rn FROM i JOIN s ON image = scene OR ends_with(image, scene) OR ends_with(scene, image))
SELECT i.image, candidates, fp AS baseline_fp FROM i LEFT JOIN m ON m.image = i.image AND rn = 1""")
def baseline_join(spark, d):
    """Candidates of an image beside the detections in a clean scene of its name, of all benchmark rows those of the negative control."""
    n = table(spark, d, "nation").withColumn("k", F.col("n_nationkey") + 10)
    name = F.when(F.col("n_nationkey") % 3 == 0, F.format_string("ESP_0%d00_1003_RED.browse", "k")).when(F.col("n_nationkey") % 3 == 1, F.format_string("%d00_1005_RED.browse.jpg", "k")).otherwise(F.format_string("x/ESP_0%d00_1002_MIRB.browse.jpg", "k"))
    bench = n.select(name.alias("scene"), F.when(F.col("n_nationkey") % 4 == 0, "24").otherwise("negative_control_fp").alias("blob_size_px"), (F.col("n_nationkey") * 3).cast("string").alias("recall_hit"))
    images = boxes(spark, d).groupBy("image").agg(F.count("*").alias("candidates"))
    return R.by_suffix(images, T.baselines(bench), "image", "scene", "baseline_fp").select("image", "candidates", "baseline_fp")


@query(f"""WITH {ADJUDICATED}, c AS (SELECT x, y, w, h, count(*) AS crops, min(concat('ESP', l_orderkey, '_x', x, '_y', y, '_w', w, '_h', h, '.png')) AS first_crop FROM boxes GROUP BY x, y, w, h)
SELECT {', '.join(KEY)}, crops, first_crop FROM judged JOIN c USING (x, y, w, h) WHERE verdict = 'CONFIRMED-LEAD'""")
def crops_by_box(spark, d):
    """Crops of a lead's box, whatever image they are of, from an index of crop files' names."""
    b = boxes(spark, d).select(F.concat(F.lit("ESP"), F.col("l_orderkey").cast("string"), F.format_string("_x%d_y%d_w%d_h%d.png", *"xywh")).alias("file"))
    index = T.crop_index(b, "file").select(*"xywh", F.size("crops").cast("long").alias("crops"), F.get("crops", F.lit(0)).alias("first_crop"))
    return cut(judged(spark, d).select(*KEY, *"xywh", "verdict")).filter("verdict = 'CONFIRMED-LEAD'").join(index, list("xywh")).select(*KEY, "crops", "first_crop")


@query(f"WITH i AS (SELECT image, count(*) AS n FROM ({BOXES}) GROUP BY image), f AS (SELECT DISTINCT concat('00_100', s_suppkey % 9, '_') AS footprint FROM supplier) SELECT footprint, count(image) AS images, CAST(coalesce(sum(n), 0) AS BIGINT) AS candidates FROM f LEFT JOIN i ON contains(image, footprint) GROUP BY footprint")
def footprint_candidates(spark, d):
    """Candidates whose image's name holds a footprint's: compared by image, not by candidate."""
    f = table(spark, d, "supplier").select(F.concat(F.lit("00_100"), (F.col("s_suppkey") % 9).cast("string"), F.lit("_")).alias("footprint")).distinct()
    i = boxes(spark, d).groupBy("image").agg(F.count("*").alias("n"))
    met = R.containing(i, f, "image", "footprint").join(i, "image")
    return f.join(met, "footprint", "left").groupBy("footprint").agg(F.count("image").alias("images"), F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"))


@query(f"""WITH b AS ({BOXES}), k AS (SELECT *, concat(image, '|', x, ',', y, '@', w, 'x', h) AS box_key FROM b), v AS (SELECT concat(image, '|', x, ',', y, '@', w, 'x', h) AS box_key, fill AS ratio, concat('V', l_linenumber % 4, CASE WHEN l_linenumber % 4 = 3 THEN '.NOMAP.jpg' ELSE '.browse.jpg' END) AS variant FROM b WHERE polarity = 'dark'),
s AS (SELECT box_key, count(*) FILTER (WHERE ratio >= 0.65) AS hold, count(*) FILTER (WHERE ratio < 0.35) AS collapse, count(*) AS tested FROM v WHERE ratio > 0 AND NOT contains(lower(variant), 'nomap') GROUP BY box_key)
SELECT {', '.join(KEY)}, coalesce(hold, 0) AS xv_hold, coalesce(collapse, 0) AS xv_collapse, coalesce(tested, 0) AS xv_tested FROM k LEFT JOIN s USING (box_key)""")
def persistence_join(spark, d):
    """Boxes with how many renderings hold or lose them, by the key of image and box."""
    b = boxes(spark, d).withColumn("box_key", C.persistence_key(F.col("image"), *[F.col(c) for c in "xywh"]))
    k = F.col("l_linenumber") % 4
    variant = F.concat(F.lit("V"), k.cast("string"), F.when(k == 3, ".NOMAP.jpg").otherwise(".browse.jpg"))
    s = T.kept_ratios(b.filter("polarity = 'dark'").select(variant.alias("variant"), "box_key", F.col("fill").alias("ratio")))
    s = s.groupBy("box_key").agg(F.count_if(F.col("ratio") >= 0.65).alias("hold"), F.count_if(F.col("ratio") < 0.35).alias("collapse"), F.count("*").alias("tested"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return b.join(s, "box_key", "left").select(*KEY, zero("hold").alias("xv_hold"), zero("collapse").alias("xv_collapse"), zero("tested").alias("xv_tested"))


@query(f"""WITH w AS (SELECT user_id, event_id, value, value * 0.6 AS dl, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events),
s AS (SELECT user_id, count(*) FILTER (WHERE back <= 50) AS window_images, sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) FILTER (WHERE back <= 50) / 100.0 AS total_s, sum(CAST(floor(dl * 100 + 0.5) AS BIGINT)) FILTER (WHERE back <= 50) / 100.0 AS dl_s, count(*) AS processed, sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) / 100.0 AS life_s FROM w GROUP BY user_id)
SELECT user_id, window_images, {rnd('total_s / window_images', 1)} AS sec_per_image, {rnd('100.0 * dl_s / greatest(total_s, 1e-6)', 1)} AS download_share_pct, {rnd('window_images / greatest(total_s, 1e-6) * 60.0', 2)} AS images_per_min,
{rnd('(500 - processed) / (window_images / greatest(total_s, 1e-6)) / 3600.0', 1)} AS eta_hours, {rnd('processed / greatest(life_s, 1e-6) * 60.0', 2)} AS lifetime_images_per_min FROM s""")
def throughput(spark, d):
    """Rates over the last 50 events of each user, what is left of 500 at that rate, and the rate over all."""
    w = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
    cents = lambda c: F.floor(c * 100 + 0.5)
    e = table(spark, d, "events").select("user_id", cents(F.col("value")).alias("s"), cents(F.col("value") * 0.6).alias("dl"), (F.row_number().over(w) <= 50).alias("recent"))
    g = e.groupBy("user_id").agg(F.count_if("recent").alias("window_images"), (F.sum(F.when(F.col("recent"), F.col("s"))) / 100.0).alias("total_s"), (F.sum(F.when(F.col("recent"), F.col("dl"))) / 100.0).alias("dl_s"), F.count("*").alias("processed"), (F.sum("s") / 100.0).alias("life_s"))
    return g.select("user_id", *T.rates(total=500))


@query("SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS BIGINT) AS so_far FROM events GROUP BY 1, 2")
def running_tallies(spark, d):
    per = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return per.withColumn("so_far", F.sum("n").over(Window.partitionBy("event_type").orderBy("day")))


@query("""SELECT level, problem, count(*) AS n FROM (SELECT unnest([CASE WHEN NOT coalesce(p_size > 3, false) THEN {'level': 'error', 'problem': 'size'} END, CASE WHEN NOT coalesce(p_retailprice < 1800, false) THEN {'level': 'error', 'problem': 'price'} END,
CASE WHEN NOT coalesce(p_brand <> 'Brand#11', false) THEN {'level': 'warning', 'problem': 'brand'} END], recursive := true) FROM part) WHERE problem IS NOT NULL GROUP BY level, problem""")
def violation_counts(spark, d):
    """Broken rules by their weight: what is required, and what only deserves a look."""
    p = table(spark, d, "part")
    rules = {"error": {"size": F.col("p_size") > 3, "price": F.col("p_retailprice") < 1800}, "warning": {"brand": F.col("p_brand") != "Brand#11"}}
    parts = [R.violations(p, own, ["p_partkey"]).withColumn("level", F.lit(level)) for level, own in rules.items()]
    return parts[0].unionByName(parts[1]).groupBy("level", "problem").agg(F.count("*").alias("n"))


@query("SELECT 'missing' AS what, c AS name, CAST(NULL AS BIGINT) AS n FROM (SELECT unnest(['s_suppkey', 's_name', 'verdict', 'score']) AS c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE supplier)) UNION ALL SELECT 'branch', r_name, count(*) FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE', 'ATLANTIS') GROUP BY r_name UNION ALL SELECT 'unknown', b, NULL FROM (SELECT unnest(['ASIA', 'EUROPE', 'ATLANTIS']) AS b) WHERE b NOT IN (SELECT r_name FROM region)")
def checked_names(spark, d):
    """Columns that a table lacks, rows of the branches asked for, and branches that nobody knows."""
    r, wanted = table(spark, d, "region"), ("ASIA", "EUROPE", "ATLANTIS")
    lacking = R.missing_columns(table(spark, d, "supplier"), ["s_suppkey", "s_name", "verdict", "score"]).select(F.lit("missing").alias("what"), "name", F.lit(None).cast("long").alias("n"))
    known = r.filter(F.col("r_name").isin(*wanted)).join(table(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("n")).select(F.lit("branch").alias("what"), "name", "n")
    return lacking.unionByName(known).unionByName(R.unknown(r, "r_name", wanted).select(F.lit("unknown").alias("what"), "name", F.lit(None).cast("long").alias("n")))


@query("SELECT count(DISTINCT r_name) AS branches, count(DISTINCT n_name) AS shards, count(*) AS footprints FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def catalogue_progress(spark, d):
    """Branches, shards and footprints of a nested catalogue, counted from the inside out."""
    t = table(spark, d, "region").join(table(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).join(table(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"))
    branches = t.groupBy("r_name", "n_name").agg(F.count("*").alias("n")).groupBy("r_name").agg(F.count("*").alias("shards"), F.sum("n").alias("n"))
    return branches.agg(F.count("*").alias("branches"), F.sum("shards").alias("shards"), F.sum("n").alias("footprints"))


@query(f"""WITH p AS (SELECT split_part(image, '_', 2) AS product, x, y, w, h, score, {TIE_SQL}, image FROM (WITH {ADJUDICATED} SELECT * FROM judged) WHERE verdict = 'CONFIRMED-LEAD'),
g AS (SELECT product, x, y, w, h, count(*) AS leads_in_package, max(score) AS score, min(image) AS first_image FROM p GROUP BY product, x, y, w, h)
SELECT concat('ESP_', product, '__x', x, '_y', y, '_', w, 'x', h) AS package, leads_in_package, score FROM g""")
def packages(spark, d):
    """One package a product and box: band variants of one anomaly share it."""
    j = cut(judged(spark, d).select("image", *"xywh", "score", "verdict")).filter("verdict = 'CONFIRMED-LEAD'").withColumn("product", C.product_of(F.col("image")))
    g = j.groupBy("product", *"xywh").agg(F.count("*").alias("leads_in_package"), F.max("score").alias("score"))
    return g.select(C.safe_name(F.concat(F.col("product"), F.lit("__"), F.format_string("x%d_y%d_%dx%d", *"xywh"))).alias("package"), "leads_in_package", "score")
