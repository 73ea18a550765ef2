"""URL filters: host and path rules first, then a logistic regression on hashed character n-grams.

Everything runs as SQL expressions; the regression is fitted by Spark's own estimator on a small labelled table.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 8192
#: Words that hosts and paths of wanted and of unwanted pages are made of. Fixed values; labelled() makes the small table of them.
WANTED = (
    "library museum science history archive university college school academy institute research journal paper arxiv preprint lecture course "
    "stanford cambridge physics biology chemistry maths geology astronomy medicine engineering language dictionary grammar wiki encyclopedia "
    "docs python manual tutorial reference guide handbook software opensource github kernel database statistics weather climate ocean forest "
    "garden recipes cooking travel city council parliament government ministry court law news times herald gazette press radio "
    "theatre music opera gallery literature poetry novel books reading blog forum health hospital nature wildlife energy transport railway"
).split()
UNWANTED = (
    "casino poker roulette slots jackpot betting gamble bingo lottery bonus viagra cialis pills pharmacy pharma drugstore slimming "
    "replica watches handbags rolex outlet discount cheap deals coupon clearance adult xxx porn sex nude escort webcam dating hookup singles "
    "payday loans credit cash refinance forex bitcoin invest crack keygen serial warez torrent cracked adserver adclick popads tracker tracking "
    "banner affiliate redirect spam giveaway prize winner free freebie miracle detox"
).split()
WANTED_ENDS, UNWANTED_ENDS = ("org", "edu", "net", "com", "gov", "eu", "example", "info"), ("biz", "shop", "top", "xyz", "com", "net", "click", "info")
WANTED_PATHS = ("/", "/en/{0}/{2}", "/{1}/{2}.html", "/de/{1}", "/fr/2021/03/{1}", "/abs/{2}", "/3/{1}/index.html", "/articles/{1}-{0}", "/courses/{2}", "/es/{2}")
UNWANTED_PATHS = ("/", "/{1}", "/buy/{1}", "/order?id={2}", "/sale/{1}-{0}", "/win/{2}", "/free/{0}", "/click/redirect", "/claim-{1}", "/apply/now", "/best-{0}-online")
HOSTS = ("{0}.{3}", "www.{0}-{1}.{3}", "{1}.{0}.{3}", "{0}{1}.{3}", "m.{0}.{3}", "{0}-online.{3}")


def labelled(wanted: list[str] = WANTED, unwanted: list[str] = UNWANTED) -> list[tuple[str, int]]:
    """The small table of labelled URLs, 1: block: every word in each form of a host, with a neighbour, an ending and a path in turn."""
    rows = []
    for label, words, ends, paths in ((0, wanted, WANTED_ENDS, WANTED_PATHS), (1, unwanted, UNWANTED_ENDS, UNWANTED_PATHS)):
        for k, word in enumerate(words):
            for j, host in enumerate(HOSTS):
                n = 5 * k + 7 * j
                parts = (word, words[(k + 3 * j + 1) % len(words)], str(n), ends[n % len(ends)])
                rows.append((f"http{'s' * (n % 2)}://" + host.format(*parts) + paths[n % len(paths)].format(*parts), label))
    return rows


LABELLED = labelled()
#: (verdict, host, path): fits the host and all its subdomains if the URL's path starts with the rule's. Fixed values.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct(verdict, rule) of the longest rule that fits, else null; between rules of one length, block wins."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def _grams(text: Column, mark: str, sizes: tuple[int, ...], buckets: int) -> Column:
    """Buckets of the n-grams of ``^text$``; ``mark`` keeps host and path apart. Taken from an array of characters, made once a
    text: to find the i-th character of a text is i steps, so a long one would take its length squared."""
    chars = F.filter(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: c != "")

    def of(c: Column, n: int) -> Column:
        gram = lambda i: F.concat(F.lit(mark), *[F.coalesce(F.get(c, i + k), F.lit("")) for k in range(n)])
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(c) - n, F.lit(0))), lambda i: F.pmod(F.xxhash64(gram(i)), F.lit(buckets)).cast("int"))

    return F.flatten(F.transform(F.array(chars), lambda c: F.flatten(F.array(*[of(c, n) for n in sizes]))))


def features(host: Column, path: Column, sizes: tuple[int, ...] = (3, 4), buckets: int = BUCKETS) -> Column:
    """Sorted distinct bucket numbers of the hashed n-grams of host and path."""
    return F.array_sort(F.array_union(_grams(host, "h", sizes, buckets), _grams(path, "p", sizes, buckets)))


def fit(spark: SparkSession, examples: DataFrame | None = None, buckets: int = BUCKETS) -> tuple[float, list[float]]:
    """(intercept, weights) of the regression on a small table (url, label); LABELLED if none is given.

    Rows with a null label are left out. The table is meant to be small: it is fitted in one partition.
    """
    if examples is None:
        rows = json.dumps([{"url": u, "label": y} for u, y in LABELLED])
        examples = spark.range(1).select(F.explode(F.from_json(F.lit(rows), "array<struct<url:string,label:int>>")).alias("r")).select("r.*")
    marks = features(host_of(F.col("url")), path_of(F.col("url")), buckets=buckets)
    places = CountVectorizerModel.from_vocabulary([str(k) for k in range(buckets)], inputCol="marks", outputCol="features")
    rows = examples.filter("label IS NOT NULL").select(F.col("label").cast("double").alias("label"), marks.cast("array<string>").alias("marks"))
    train = places.transform(rows).select("label", "features").coalesce(1).cache()
    model = LogisticRegression(maxIter=50, regParam=0.001, standardization=False).fit(train)
    train.unpersist()
    return float(model.intercept), [float(w) for w in model.coefficients]


def judge(pages: DataFrame, model: tuple[float, list[float]], rules: tuple = RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score: the rule's verdict where one fits, else block from ``threshold`` on.

    Null url: empty host and path, which no rule fits; the score is then that of the empty string. Repeated rows stay
    repeated; an empty table gives no rows; further columns are left out. No shuffle, no Python: one pass over page_id, url.
    """
    intercept, weights = model
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    df = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    total = F.aggregate(features(F.col("host"), F.col("path"), buckets=len(weights)), F.lit(intercept), lambda s, i: s + F.element_at(table, i + 1))
    df = df.withColumns({"fit": rule_of(F.col("host"), F.col("path"), rules), "score": 1 / (1 + F.exp(-total))})
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return df.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "score")
