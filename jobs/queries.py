"""The jobs as registered queries: each runs twice into a folder of its own, and returns what is there after the second run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from selenite.plans.relational import ADJUDICATED, ADVICE_SQL, BOXES, rnd, tail
from selenite.session import shared_folder

from . import crawl_catalogue, investigate


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_crawl_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of all pages; the second run finds nothing new."""
    out = _folder(spark, "crawl")
    for _ in range(2):
        crawl_catalogue.run(spark, f"{sf_dir}/pages.parquet", out)
    return crawl_catalogue.catalogue(spark, out)


def job2_investigate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all regions that stand out; the second run writes them anew."""
    out = _folder(spark, "investigate")
    for _ in range(2):
        done = investigate.run(spark, f"{sf_dir}/events.parquet", out)
    return done


QUERIES = {f.__name__: f for f in (job1_crawl_catalogue, job2_investigate)}

_CONTRAST = "coalesce(abs(avg(v) FILTER (WHERE fg) - avg(v) FILTER (WHERE NOT fg)) / (stddev_pop(v) FILTER (WHERE NOT fg) + 1e-6), 0.0)"
#: Regions in the columns that the verdict's SQL names, by cells in ranges instead of tiles, and labels by a closure.
_REGIONS = f"""
px AS (SELECT event_id // 10000 AS image, CAST(event_id % 10000 // 100 AS INT) AS y, CAST(event_id % 100 AS INT) AS x, value AS v FROM events),
ext AS (SELECT image, max(y) AS my, max(x) AS mx FROM px GROUP BY image),
b1 AS MATERIALIZED (SELECT c.image, c.y, c.x, c.v, avg(n.v) AS b FROM px c JOIN ext USING (image), range(-4, 5) a(dx) JOIN px n ON n.image = c.image AND n.y = c.y AND n.x = greatest(0, least(mx, c.x + dx)) GROUP BY ALL),
bl AS MATERIALIZED (SELECT c.image, c.y, c.x, c.v, avg(n.b) AS b FROM b1 c JOIN ext USING (image), range(-4, 5) a(dy) JOIN b1 n ON n.image = c.image AND n.x = c.x AND n.y = greatest(0, least(my, c.y + dy)) GROUP BY ALL),
det AS (SELECT *, abs(v - b) AS detail FROM bl), st AS (SELECT image, avg(detail) AS m, stddev_pop(detail) + 1e-6 AS s FROM det GROUP BY image),
ma AS MATERIALIZED (SELECT image, y, x, image * 10000 + y * 100 + x AS node FROM det JOIN st USING (image) WHERE detail > m + 1.5 * s),
reach AS (SELECT node, node AS r FROM ma UNION SELECT b.node, reach.r FROM reach JOIN ma a ON a.node = reach.node JOIN ma b ON a.image = b.image AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND a.node <> b.node),
la AS MATERIALIZED (SELECT node, min(r) AS label FROM reach GROUP BY node),
bo AS (SELECT image, label, count(*) AS n, min(x) AS bx, min(y) AS by2, max(x) - min(x) + 1 AS bw, max(y) - min(y) + 1 AS bh FROM ma JOIN la USING (node) GROUP BY image, label HAVING count(*) >= 3),
tg AS MATERIALIZED (SELECT bo.*, ext.image AS target FROM bo JOIN ext ON bo.image // 4 = ext.image // 4),
me AS MATERIALIZED (SELECT image, label, target, any_value(n) AS n, any_value(bx) AS bx, any_value(by2) AS by2, any_value(bw) AS bw, any_value(bh) AS bh, {rnd(_CONTRAST, 4)} AS contrast,
  CASE WHEN avg(v) FILTER (WHERE fg) >= coalesce(avg(v) FILTER (WHERE NOT fg), 0.0) THEN 'bright' ELSE 'dark' END AS polarity, {rnd('avg(CASE WHEN v >= 253 THEN 1.0 ELSE 0.0 END) FILTER (WHERE fg)', 4)} AS sat_frac,
  {rnd('avg(CASE WHEN v <= 2 THEN 1.0 ELSE 0.0 END) FILTER (WHERE fg)', 4)} AS dark_frac, {rnd('coalesce(stddev_pop(v) FILTER (WHERE NOT fg), 0.0)', 4)} AS bg_std
  FROM (SELECT tg.*, v, x >= bx AND x < bx + bw AND y >= by2 AND y < by2 + bh AS fg FROM tg JOIN px ON px.image = tg.target AND x >= bx - 5 AND x < bx + bw + 5 AND y >= by2 - 5 AND y < by2 + bh + 5) GROUP BY image, label, target),
rg AS MATERIALIZED (SELECT *, image // 4 AS scene, {rnd('n / CAST(bw * bh AS DOUBLE)', 4)} AS fill FROM me WHERE target = image),
ag AS (SELECT a.image, a.label, CAST(count(*) FILTER (WHERE b.polarity = a.polarity AND a.contrast / (b.contrast + 1e-6) BETWEEN 0.35 AND 2.8) AS INT) AS agrees, CAST(count(b.target) AS INT) AS others
  FROM rg a LEFT JOIN (SELECT * FROM tg WHERE target <> image) t ON t.label = a.label LEFT JOIN me b ON b.label = t.label AND b.target = t.target GROUP BY ALL)"""
_BOXES = """SELECT scene, image, label, bx * 10 AS x, by2 * 10 AS y, bw * 10 AS w, bh * 10 AS h, polarity, contrast, fill, agrees, others - agrees AS disagrees, sat_frac, dark_frac, bg_std, agrees AS matches, fill AS compactness,
  CAST(NULL AS DOUBLE) AS column_smear, false AS smear_narrow, 0 AS xv_tested, 0 AS xv_collapse, CAST(NULL AS DOUBLE) AS persistence, '' AS dtm_known_artifacts, CAST(NULL AS DOUBLE) AS shadow_alignment, false AS shadow_expected, CAST(NULL AS DOUBLE) AS size_m FROM rg JOIN ag USING (image, label)"""

ORACLES = {
    "job1_crawl_catalogue": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*')) || regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS page FROM pages WHERE page_id IS NOT NULL),
f AS (SELECT page, page_id, CAST(length(html) AS BIGINT) AS n_chars, regexp_extract_all(html, 'href="([^"?]*)"', 1) AS hrefs, regexp_extract(page, '://([^/]*)', 1) AS host, regexp_extract(page, '://[^/]*/([^/]*)', 1) AS branch FROM p WHERE page <> ''),
r AS (SELECT page, host, branch, page_id, n_chars, CAST(len(hrefs) AS BIGINT) AS n_links, CAST(len([h FOR h IN hrefs IF starts_with(h, '/')]) AS BIGINT) AS n_folders,
CASE WHEN NOT starts_with(page, 'https://') THEN 'refused' WHEN n_chars > 4000 THEN 'too large' WHEN branch NOT IN ('en', 'de') THEN 'other branch' ELSE 'fetch' END AS status FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY page_id DESC, n_chars DESC, n_links DESC, n_folders DESC, status DESC) AS rn, count(*) OVER (PARTITION BY page) AS versions, min(page_id) OVER (PARTITION BY page) AS first_page_id FROM r)
SELECT page, host, branch, versions, first_page_id, page_id, n_chars, n_links, n_folders, status FROM n WHERE rn = 1""",
    "job2_investigate": f"""
WITH RECURSIVE {_REGIONS}, {ADJUDICATED.replace(f'boxes AS ({BOXES})', f'boxes AS ({_BOXES})')},
pv AS MATERIALIZED (SELECT *, {tail('contrast')} AS p FROM (SELECT *, 1 / (1 + 0.5 * (contrast / 1.4142135623730951)) AS t FROM judged)),
rk AS (SELECT *, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS rk, count(*) OVER () AS total FROM pv),
q AS (SELECT *, {rnd('min(least(1.0, p * total / rk)) OVER (ORDER BY rk DESC)', 6)} AS fdr_q FROM rk)
SELECT scene, image, label, x, y, w, h, polarity, contrast, fill, agrees, disagrees, array_to_string(flags, ',') AS flags, interest, score, confidence, {ADVICE_SQL} AS advice, fdr_q, fdr_q <= 0.05 AS survives, verdict FROM q""",
}
