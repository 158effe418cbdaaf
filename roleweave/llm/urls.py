"""Operator 2, URL filters: allow and block rules, else a logistic regression on hashed character n-grams.

DataFrame and SQL functions only. Host and path are cut by expressions; rules are one expression over the (short) rule
list; the n-grams of "^host$" and "^path$" are hashed into a count vector and judged by a model fitted on a small
labelled URL table. Judging is one scan of the url column without a shuffle; the vector of a row is the only state.

A null url or one without "://" has empty host and path, meets no rule and is judged by the model on the empty strings.
Repeated rows are judged alike. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roleweave.llm.arrays import ascii_lower

# (verdict, rule): host, then path from its first "/" on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
GRAMS = (3, 4)
BUCKETS = 1 << 13
BLOCK_FROM = 0.5

# The small labelled URL table: names of junk sites and of ordinary ones under each prefix and suffix, and paths of junk
# and of ordinary pages. A page is junk if its host or its path is.
JUNK_HOSTS = (
    "buy-pills pills-online link-farm casino-bonus best-casino casino-online online-poker free-poker bet-now sports-bets "
    "live-betting hot-singles xxx-videos adult-chat payday-loans fast-loans replica-watches cheap-watches win-prizes win-cash "
    "free-money popup-ads banner-ads seo-links spam-mailer viagra-shop crypto-doubler miracle-diet warez-download torrent-farm "
    "cheap-meds clickbait"
).split()
FAIR_HOSTS = (
    "library garden news-city docs project weather wiki science bookshop museum travel school chess-club hospital census "
    "kitchen theatre radio music history images printer maths harbour river-side sea-side letter railway national-park "
    "station information education bakery village-hall observatory gardening architecture translation farmers-market"
).split()
JUNK_PATHS = (
    "/casino-online/123 /best-casino.html /free-spins/45/ /online-poker/table /sports-bets/7 /buy-pills.html /cheap-meds/12 "
    "/viagra/order /payday-loans/apply /win-cash-now /free-money/claim /xxx-videos/9.html /adult-chat/room /hot-singles/en/3 "
    "/replica-watches/sale /warez/download/88 /en/casino-bonus/456 /de/poker-bonus.html /fr/pills-online/78 /es/betting/ "
    "/casino/play/4 /live-casino/en/8.html /pills/order/2 /fr/poker/56 /bets/today.html /loans/fast/3 /prizes/win/"
).split()
FAIR_PATHS = (
    "/en/123 /de/456/ /fr/78.html /es/9 / /about/team /news/2021/weather.html /articles/history/7 /docs/install/ "
    "/products/list/45 /blog/travel-notes /contact.html /images/88/ /en/science/page /de/garten.html /fr/musique/3 "
    "/es/noticias/ /archive/12.html /library/books /events/calendar "
    "/en/station/4 /de/8.html /fr/12/ /es/56.html /garden/plants/2 /school/maths.html /weather/today/"
).split()
PREFIXES = ("", "www.", "blog.", "m.")
SUFFIXES = ("example.com", "example.net", "example.org")


def _rest(url: Column) -> Column:
    """What stands behind the first "://"; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits host (or a parent domain) and path; null if none does."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, prefix = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + prefix))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def char_grams(text: Column, sizes: tuple[int, ...] = GRAMS) -> Column:
    """All character n-grams of `text` with its ends marked; a text shorter than n has none of that size."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(marked) - (n - 1), F.lit(1)))
        grams = F.transform(starts, lambda i: F.substr(marked, i, F.lit(n)))
        return F.when(F.char_length(marked) >= n, grams).otherwise(F.array().cast("array<string>"))

    lists = [of_size(n) for n in sizes]
    return F.concat(*lists)


def features(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`table` with a hashed count vector of host grams (marked h:) and path grams (marked p:) as `_vector`."""
    grams = F.concat(
        F.transform(char_grams(F.col("host")), lambda g: F.concat(F.lit("h:"), g)),
        F.transform(char_grams(F.col("path")), lambda g: F.concat(F.lit("p:"), g)),
    )
    return HashingTF(numFeatures=buckets, binary=True, inputCol="_grams", outputCol="_vector").transform(table.withColumn("_grams", grams))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url and label (1: junk)."""
    both = lambda junk, fair: [F.struct(F.lit(t).alias("text"), F.lit(x).alias("junk")) for x, ts in ((1.0, junk), (0.0, fair)) for t in ts]
    forms = [F.struct(F.lit(p).alias("prefix"), F.lit(s).alias("suffix")) for p in PREFIXES for s in SUFFIXES]
    hosts = spark.range(1, numPartitions=1).select(F.explode(F.array(*both(JUNK_HOSTS, FAIR_HOSTS))).alias("h"))
    pages = hosts.select("h", F.explode(F.array(*forms)).alias("f")).select("h", "f", F.explode(F.array(*both(JUNK_PATHS, FAIR_PATHS))).alias("p"))
    url = F.concat(F.lit("https://"), F.col("f.prefix"), F.col("h.text"), F.lit("."), F.col("f.suffix"), F.col("p.text"))
    return pages.select(url.alias("url"), F.greatest("h.junk", "p.junk").alias("label"))


def fit(labelled: DataFrame) -> LogisticRegressionModel:
    """Logistic regression on (url, label); the table is small by contract and read once per optimizer step."""
    table = labelled.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("label").cast("double").alias("label"))
    # Both labels weigh the same, however many rows have them.
    junk, n = table.agg(F.sum("label"), F.count("*")).first()
    weighted = table.withColumn("_weight", F.when(F.col("label") == 1, n / (2 * max(junk, 1))).otherwise(n / (2 * max(n - junk, 1))))
    regression = LogisticRegression(featuresCol="_vector", labelCol="label", weightCol="_weight", regParam=0.001, maxIter=40, standardization=False)
    return regression.fit(features(weighted))



def judge(pages: DataFrame, model: LogisticRegressionModel, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's junk probability for every row of `pages`."""
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    model = model.copy().setProbabilityCol("_probability").setPredictionCol("_prediction").setRawPredictionCol("_raw")
    judged = model.transform(features(rows)).withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    junk = vector_to_array("_probability")[1]
    own = F.when(junk >= BLOCK_FROM, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", own).alias("verdict"), junk.alias("junk_probability")
    )
