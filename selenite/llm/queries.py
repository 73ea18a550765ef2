"""The registered queries of this folder: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, extract_html, filters, langid, mixing, simhash, substrings, suffixes, topk, toxicity, urls
from .common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 highest scores of each query (vec_id divisible by 50) against all rows. Rows without an id or with unsound vectors take no part."""
    e = table(spark, sf_dir, "embeddings")
    return topk.top_k(e.filter("vec_id % 50 = 0"), e, 5)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each conversation, read back from the formatted turns; null text and role: empty, null conv_id: one conversation."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.format_turns(t.unionByName(probe)))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page; null url: empty host and path, which no rule fits. Repeated rows stay repeated."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.fit(spark))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed words of every document; null text: none. A null doc_id neither loses nor removes anything."""
    found = substrings.repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; null text is scored as an empty one. Repeated rows stay repeated."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", langid.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; null or blank text: fingerprint 0. Without an id: the component of the others."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; und, 0 for null or letterless text. Repeated rows stay repeated."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes of every document; null text: empty. A null doc_id neither loses nor removes anything."""
    found = suffixes.repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows; null text: no words. Each row is judged on its own."""
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture with default parameters; null source: the source "". Blank texts are never used."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of the 120 orders of five filters in every part. Null text: empty; null lang: the part ""; null doc_id: no copy of
    any; a row repeated under its own id isn't a copy of itself; several labels of one id count as the highest."""
    return filters.audit(filters.flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; null html: empty. Repeated rows stay repeated."""
    return extract_html.extract(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_topk, op2_chat, op3_urls, op4_substrings, op5_toxicity, op6_simhash, op7_langid, op8_suffixes, op9_decontaminate, op10_mix, op11_filters, op12_extract)}
#: A-Z to a-z alone.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES: dict[str, str] = {
    "op1_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s) WHERE rn <= 5""",
    # a turn is 14 characters of grammar, role, text, and a backslash before each backslash, close and opening in the text
    "op2_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) p(t, r)),
n AS (SELECT *, length(text) - length(replace(text, '\', '')) AS slashes, (length(text) - length(replace(text, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '### ', ''))) // 4 AS marks FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
CAST(sum(14 + length(role) + length(text) + slashes + marks) AS BIGINT) AS formatted_chars FROM n GROUP BY conv_id""",
    "op4_substrings": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w), k AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM g),
m AS (SELECT k, min(doc_id) AS d FROM k GROUP BY k), hit AS (SELECT k.doc_id, k.i FROM k JOIN m USING (k) WHERE m.d < k.doc_id),
cov AS (SELECT DISTINCT doc_id, i + o AS p FROM hit, range(13) r(o)),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM w),
y AS (SELECT x.doc_id, count(cov.p) AS n_removed, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE cov.p IS NULL) AS kept FROM x LEFT JOIN cov ON x.doc_id = cov.doc_id AND x.p = cov.p GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN y USING (doc_id)""",
    "op8_suffixes": """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), g AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM h), k AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS k FROM g),
m AS (SELECT k, min(doc_id) AS d FROM k GROUP BY k), hit AS (SELECT k.doc_id, k.i FROM k JOIN m USING (k) WHERE m.d < k.doc_id),
o AS (SELECT doc_id, i, max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hit),
s AS (SELECT doc_id, i, sum(CASE WHEN reach >= i THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM o),
r AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM s GROUP BY doc_id, span),
e AS (SELECT r.doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS since FROM r),
t AS (SELECT e.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substring(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substring(any_value(h), 2 * max(b) + 1) AS kept FROM e JOIN h USING (doc_id) GROUP BY e.doc_id)
SELECT h.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM h LEFT JOIN t USING (doc_id)""",
    "op9_decontaminate": rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bg AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0), bk AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS k FROM bg),
lens AS (SELECT DISTINCT n FROM bk), g AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, lens), hit AS (SELECT g.doc_id, g.i, g.n, bk.item FROM g JOIN bk ON bk.n = g.n AND array_to_string(w[g.i:g.i + g.n - 1], ' ') = bk.k),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op11_filters": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least_id AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b, 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) AS c,
regexp_matches(text, '[#$%&*|]') AS d, coalesce(first < doc_id, false) AS e, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad FROM d JOIN least_id USING (text) LEFT JOIN lab USING (doc_id)),
n AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS failed, good, bad, count(*) AS n FROM f GROUP BY ALL),
o(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || k FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) l(k) WHERE NOT contains(filter_order, k)),
st AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit, CAST(list_sum(list_transform(range(1, step + 1), lambda i: CASE WHEN i < step THEN 1 << (ascii(filter_order[i]) - 65) ELSE 0 END)) AS INT) AS past FROM o, range(1, 6) s(step) WHERE len(filter_order) = 5),
r AS (SELECT part, filter_order, CAST(step AS INT) AS step, any_value(bit) AS bit, sum(n) FILTER (WHERE failed & (past | bit) = 0) AS kept, sum(n) FILTER (WHERE failed & past = 0 AND failed & bit > 0) AS removed,
sum(n) FILTER (WHERE failed & past > 0 AND failed & bit > 0) AS redundant, sum(n) FILTER (WHERE failed = bit) AS unique_fails, sum(n) FILTER (WHERE failed & past = 0 AND failed & bit > 0 AND good) AS good_lost,
sum(n) FILTER (WHERE failed & past = 0 AND failed & bit > 0 AND bad) AS toxic_lost FROM st, n GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r""",
}
