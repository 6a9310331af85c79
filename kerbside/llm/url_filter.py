"""URL filter: fixed rules, then boosted trees (operator 2), in DataFrame
functions only.

A rule ``host/path`` fits its host and all subdomains if the url's path starts
with the rule's path; the longest rule that fits decides. Urls that a rule
decides are the labelled urls: gradient-boosted trees are trained on lexical
features of a bounded sample of them (the ``max_train`` distinct urls with the
smallest hashes, each weighted by its rows) and judge the urls that no rule
fits. Features: lengths, depth, digit ratio,
character entropy, parameter counts, and statistics of the host's last label,
of its last two labels and of the path's first segment (how many urls have it,
and the smoothed block rate among labelled urls). The statistics cover all
urls. Without labelled urls of both kinds there is nothing to learn, and urls
without a rule get the one known verdict, or ``allow``.

Cases: a NULL url or one without ``://`` has an empty host and path and is
judged like any other; repeated rows each get a verdict; an empty table gives
no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the registered query (fixed values).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

STATISTICS = ("suffix_1", "suffix_2", "first_dir")
FEATURES = ["url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "entropy", "n_params", "query_len",
            *(f"{s}_{x}" for s in STATISTICS for x in ("log_n", "rate"))]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL where none does."""
    rule = verdict = None
    for action, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    return (F.lit(None).cast("string"),) * 2 if rule is None else (rule, verdict)


def entropy(text: Column) -> Column:
    """Bits per character: runs of the sorted characters are their counts."""
    def of_starts(starts, n):
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(n))
        part = F.aggregate(F.zip_with(starts, ends, lambda a, b: (b - a) * F.log2((b - a).cast("double"))),
                           F.lit(0.0), lambda s, x: s + x)
        return F.log2(n.cast("double")) - part / n

    def of_sorted(s):
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.transform(F.array(starts), lambda p: of_starts(p, F.size(s)))[0]

    chars = F.array_sort(F.split(text, ""))
    return F.when(F.length(text) > 0, F.transform(F.array(chars), of_sorted)[0]).otherwise(0.0)


def lexical(df: DataFrame, id_col: str, url_col: str, rules) -> DataFrame:
    """One row per url: parts, rule and lexical features."""
    host, path = url_parts(F.col(url_col))
    parts = df.select(F.col(id_col).alias("row_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                      host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    query = F.regexp_extract("url", r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    size = F.length("url")
    return (parts.withColumns({"rule": rule, "rule_verdict": verdict, "query": query, "host_labels": labels})
            .select("row_id", "host", "path", "rule", "rule_verdict", F.xxhash64("url").alias("url_hash"),
                    size.cast("double").alias("url_len"), F.length("host").cast("double").alias("host_len"),
                    F.length("path").cast("double").alias("path_len"),
                    (F.size(F.split("path", "/")) - 1).cast("double").alias("depth"),
                    F.size("host_labels").cast("double").alias("labels"),
                    F.when(size > 0, F.length(F.regexp_replace("url", "[^0-9]+", "")) / size).otherwise(0.0).alias("digit_ratio"),
                    entropy(F.col("url")).alias("entropy"),
                    F.when(F.length("query") > 0, F.size(F.split("query", "&"))).otherwise(0).cast("double").alias("n_params"),
                    F.length("query").cast("double").alias("query_len"),
                    F.get("host_labels", F.size("host_labels") - 1).alias("suffix_1"),
                    F.array_join(F.slice("host_labels", F.greatest(F.size("host_labels") - 1, F.lit(1)), 2), ".").alias("suffix_2"),
                    F.regexp_extract("path", "^/([^/]*)/", 1).alias("first_dir")))


def with_statistics(urls: DataFrame, smoothing: float = 10.0) -> DataFrame:
    """Add, per statistic key, the log count over all urls and the smoothed
    block rate over labelled ones. Each table is aggregated map-side first and
    joined by its size; a key with very many urls is one that adaptive
    execution can split."""
    blocked = F.sum((F.col("rule_verdict") == "block").cast("long"))
    for key in STATISTICS:
        table = urls.groupBy(key).agg(
            F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{key}_log_n"),
            ((F.coalesce(blocked, F.lit(0)) + smoothing / 2) / (F.count("rule_verdict") + smoothing)).alias(f"{key}_rate"))
        urls = urls.join(table, key)
    return urls


def train(featured: DataFrame, max_train: int = 20000, trees: int = 12, depth: int = 4, seed: int = 7):
    """A model fitted on the ``max_train`` distinct labelled urls with the
    smallest hashes, weighted by their rows, or the only verdict there is
    (``allow`` without labelled urls). Urls are counted by hash first, so only
    the chosen ones' features move; the chosen hashes (``max_train`` at most)
    are broadcast."""
    labelled = featured.where("rule_verdict IS NOT NULL").select(
        "url_hash", (F.col("rule_verdict") == "block").cast("double").alias("label"), *FEATURES)
    counted = labelled.groupBy("url_hash", "label").agg(F.count(F.lit(1)).cast("double").alias("n_rows"))
    chosen = settle(counted.orderBy("url_hash", "label").limit(max_train), "chosen")
    urls = labelled.join(F.broadcast(chosen), ["url_hash", "label"]).distinct()
    sample = settle(urls.orderBy("url_hash", "label", *FEATURES).limit(max_train), "labelled")
    kinds = [r.label for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return "block" if kinds == [1.0] else "allow"
    gbt = GBTClassifier(labelCol="label", featuresCol="features", weightCol="n_rows", predictionCol="predicted", maxIter=trees,
                        maxDepth=depth, stepSize=0.3, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), gbt]).fit(sample)


def judge_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, max_train: int = 20000) -> DataFrame:
    """Per row: id, host, path, rule and verdict."""
    featured = settle(with_statistics(settle(lexical(df, id_col, url_col, rules), "urls")), "featured")
    model = train(featured, max_train)
    if isinstance(model, str):
        judged = featured.withColumn("verdict", F.coalesce("rule_verdict", F.lit(model)))
    else:
        judged = model.transform(featured).withColumn("verdict", F.coalesce(
            "rule_verdict", F.when(F.col("predicted") == 1.0, "block").otherwise("allow")))
    return judged.select(F.col("row_id").alias(id_col), "host", "path", "rule", "verdict")
