"""URL filtering: rules first, and gradient-boosted trees on lexical features for the rest.

Everything is DataFrame operations and Spark's own tree learner; no Python runs on
the executors. Rules (host and path prefix) give a verdict to the urls they fit.
Those urls are the labelled ones: a boosted-tree classifier learns from a bounded
sample of them (``fit_rows``, chosen by a hash of the url) and judges all others by
length, depth, digit ratio, entropy, parameter counts and statistics of the host's
suffix, which are counted over all urls.

Defined results: a url that is null or has no ``://`` has an empty host and path, no
rule, and the verdict of an empty url's features; without labelled urls of both
verdicts every other url gets the verdict that is labelled, ``allow`` if there is none;
equal urls get equal verdicts and repeated rows are kept; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medoria.llm.common import bounded_sample

ALLOW, BLOCK = "allow", "block"
FEATURES = [
    "length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digit_ratio",
    "path_digit_ratio",
    "hyphens",
    "entropy",
    "host_entropy",
    "params",
    "fragment",
    "secure",
    "suffix_share",
    "suffix_digits",
    "suffix_length",
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does.

    A rule is a pair like ``("block", "net/es/")``: a host, and what the path must begin with, slash included.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, begin = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + begin)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.char_length(text), F.lit(1))
    shares = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n
    )
    return F.aggregate(shares, F.lit(0.0), lambda sum_, p: sum_ - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _digits(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.char_length(text), F.lit(1))


def _count(text: Column, what: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(what), F.lit("")))


def features(urls: DataFrame) -> DataFrame:
    """The lexical features beside the columns of a table with ``url``, ``host`` and ``path`` (none null)."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    number = lambda c: c.cast("double")
    lexical = urls.select(
        "*",
        F.substring_index(host, ".", -1).alias("suffix"),
        number(F.char_length(url)).alias("length"),
        number(F.char_length(host)).alias("host_length"),
        number(F.char_length(path)).alias("path_length"),
        number(_count(path, "/")).alias("depth"),
        number(_count(host, ".")).alias("labels"),
        _digits(url).alias("digit_ratio"),
        _digits(path).alias("path_digit_ratio"),
        number(_count(host, "-")).alias("hyphens"),
        _entropy(url).alias("entropy"),
        _entropy(host).alias("host_entropy"),
        number(_count(url, "=")).alias("params"),
        number(F.instr(url, "#") > 0).alias("fragment"),
        number(url.startswith("https")).alias("secure"),
    )
    # combined before it is shuffled: a suffix may hold most urls
    counted = lexical.groupBy("suffix").agg(
        F.count("*").alias("n"), F.avg("digit_ratio").alias("suffix_digits"), F.avg("host_length").alias("suffix_length")
    )
    total = counted.agg(F.sum("n")).first()[0] or 1
    statistics = counted.select("suffix", (F.col("n") / total).alias("suffix_share"), "suffix_digits", "suffix_length")
    return lexical.join(statistics, "suffix").drop("suffix")


def train(labelled: DataFrame, rounds: int = 12, depth: int = 4) -> GBTClassificationModel:
    """Boosted trees over ``features`` and a ``label`` column (1.0: block)."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(labelled).select("x", "label")
    return GBTClassifier(featuresCol="x", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=1).fit(rows)


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id: str = "page_id",
    url: str = "url",
    fit_rows: int = 20_000,
) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the method's chance of ``block``; null where a rule fits)."""
    rows = pages.select(F.col(id).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"))
    known = features(rows)
    labelled = known.where(F.col("rule").isNotNull()).withColumn("label", (F.col("verdict") == BLOCK).cast("double"))
    sample = bounded_sample(labelled, "url", fit_rows)
    seen = sorted(r[0] for r in sample.select("verdict").distinct().collect())
    if len(seen) < 2:
        alone = seen[0] if seen else ALLOW
        score = F.when(F.col("rule").isNull(), F.lit(float(alone == BLOCK)))
        judged = known.withColumn("score", score)
    else:
        model = train(sample)
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(known))
        score = vector_to_array("probability")[1]
        judged = scored.withColumn("score", F.when(F.col("rule").isNull(), score))
    by_method = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(
        F.col("id").alias(id), "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "score"
    )
