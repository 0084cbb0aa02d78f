"""URL verdicts: longest matching rule, else a model over character n-grams.

DataFrame functions and Spark ML only. The model is a logistic regression on
hashed character n-grams (3 to 5) of host and path, trained on a small
labelled URL table: the distinct (host, path) that a rule decides, with that
rule's verdict. Of each verdict the ``per_verdict`` URLs that come first in
the order of a hash are taken (a bounded sample of labelled rows; the bound
is a parameter, the order does not depend on partitioning).

Defined results: the host is what follows the first ``://`` up to ``/``,
``?``, ``#`` or the end, A-Z lower-cased; the path follows up to ``?``, ``#``
or the end. Null urls and urls without ``://`` have empty host and path and
no rule. A rule fits its host and every subdomain, if the path starts with
the rule's path; the longest rule wins. Urls no rule decides are blocked
from a block probability of 0.5 up; without labelled urls of both verdicts
all of them get the only verdict there is, else ``allow``. Repeated rows and
null ids pass through, extra columns are ignored, an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityair.llm.common import landed

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PER_VERDICT = 5000
BUCKETS = 1 << 13
SIZES = (3, 4, 5)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"(?s)^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def ngrams(host: Column, path: Column, sizes=SIZES) -> Column:
    """Character n-grams of host and path, each marked with its part."""
    def part(mark: str, text: Column, n: int) -> Column:
        last = F.length(text) - F.lit(n - 1)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                            lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n))))
        return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*(part(mark, F.concat(F.lit("^"), text, F.lit("$")), n)
                      for mark, text in (("h", host), ("p", path)) for n in sizes))


def labelled_urls(urls: DataFrame, per_verdict: int = PER_VERDICT) -> DataFrame:
    """The small labelled URL table: distinct (host, path) decided by a rule."""
    known = urls.where("rule is not null").groupBy("host", "path").agg(
        F.first("verdict_by_rule").alias("verdict"))
    order = F.xxhash64("host", "path"), F.col("host"), F.col("path")
    return known.where("verdict = 'allow'").orderBy(*order).limit(per_verdict).unionByName(
        known.where("verdict = 'block'").orderBy(*order).limit(per_verdict))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               per_verdict: int = PER_VERDICT, buckets: int = BUCKETS) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability (of the model;
    null where it was not needed)."""
    host, path = host_and_path(F.col("u"))
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("u")).select(
        "page_id", host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    urls = parsed.select("page_id", "host", "path", name.alias("rule"),
                         verdict.alias("verdict_by_rule"))
    grams = ngrams(F.col("host"), F.col("path"))
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True)
    train = landed(labelled_urls(urls, per_verdict), "url-labels")
    verdicts = [r[0] for r in train.select("verdict").distinct().collect()]
    if len(verdicts) < 2:
        only = F.lit(verdicts[0] if verdicts else "allow")
        return urls.select("page_id", "host", "path", "rule",
                           F.coalesce("verdict_by_rule", only).alias("verdict"),
                           F.lit(None).cast("double").alias("block_probability"))
    model = LogisticRegression(
        featuresCol="features", labelCol="label", regParam=0.002, maxIter=40,
        probabilityCol="p", rawPredictionCol="raw", predictionCol="predicted").fit(
            hashed.transform(train.select(
                F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("label"),
                grams.alias("grams"))))
    open_ = urls.where("rule is null").withColumn("grams", grams)
    judged = model.transform(hashed.transform(open_)).withColumn(
        "block_probability", vector_to_array("p")[1])
    by_model = judged.select(
        "page_id", "host", "path", "rule",
        F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow").alias("verdict"),
        "block_probability")
    by_rule = urls.where("rule is not null").select(
        "page_id", "host", "path", "rule", F.col("verdict_by_rule").alias("verdict"),
        F.lit(None).cast("double").alias("block_probability"))
    return by_rule.unionByName(by_model)
