"""URL filters: host and path rules, and gradient-boosted trees on lexical features.

Features are column expressions: lengths, depth, digit ratio, character entropy, parameter
counts, and statistics of the host's suffix. The suffix table and the trees are fitted on labelled
URLs; here the labels are the verdicts of the rules, taken from a sample of bounded size in the
order of a hash. A rule decides the URLs it fits, the trees decide all others.

The host is the part after the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; the
path follows it, up to `?`, `#` or the end. A null URL, or one without `://`, has neither. A rule
fits its host and all subdomains if the path starts with the rule's; the longest rule wins.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.session import keep

SAMPLE = 20_000  # labelled URLs used for fitting, at most
ROUNDS, DEPTH = 20, 4
SMOOTHING = 20.0
FEATURES = ["url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "host_digits", "hyphens",
            "entropy", "parameters", "query_length", "fragment", "secure", "suffix_share", "suffix_rate"]


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
         UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/")]


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path; both empty for a null URL or one without `://`."""
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase), "path": path})


def rule_columns(rules: list[UrlRule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits host and path; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is tested first
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add the features that need no statistics, and `suffix`, the last label of the host."""
    u = F.coalesce(F.col(url), F.lit(""))
    size = F.greatest(F.length(u), F.lit(1)).cast("double")
    share = lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / size
    entropy = F.aggregate(F.array_distinct(F.split(u, "")), F.lit(0.0),
                          lambda acc, c: acc - F.when((c != "") & (share(c) > 0), share(c) * F.log2(share(c))).otherwise(0.0))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    return urls.withColumns({
        "url_length": F.length(u).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "labels": _count(F.col("host"), r"\."),
        "depth": _count(F.col("path"), "/"), "digit_ratio": _count(u, "[0-9]") / size,
        "host_digits": _count(F.col("host"), "[0-9]"), "hyphens": _count(F.col("host"), "-"), "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        "query_length": F.length(query).cast("double"), "fragment": F.contains(u, F.lit("#")).cast("double"),
        "secure": F.startswith(u, F.lit("https://")).cast("double"),
        "suffix": F.regexp_extract("host", r"([^.]*)$", 1)})


@dataclass
class UrlModel:
    """Suffix statistics (at most one row per sampled URL) and the trees."""

    suffixes: DataFrame | None
    trees: Model | None
    share: float  # of labelled URLs that are blocked; the score of everything if there is one class

    def score(self, urls: DataFrame) -> DataFrame:
        """Add p_block to rows that have host, path and the lexical features."""
        if self.trees is None:
            return urls.withColumn("p_block", F.lit(self.share))
        # the suffix table has at most SAMPLE rows
        rows = urls.join(F.broadcast(self.suffixes), "suffix", "left").fillna(
            {"suffix_share": 0.0, "suffix_rate": self.share})
        vector = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(rows)
        scored = self.trees.transform(vector)
        return scored.withColumn("p_block", vector_to_array(scored["probability"])[1]).drop(
            "__features", "rawPrediction", "probability", "prediction", "suffix_share", "suffix_rate")


def fit(labelled: DataFrame, label: str, key: str, sample: int = SAMPLE, rounds: int = ROUNDS, depth: int = DEPTH) -> UrlModel:
    """Fit on at most `sample` rows with features and a 0/1 `label`, chosen by the hash of `key`, one of each key and label."""
    wanted = labelled.select(key, label, "suffix", *[f for f in FEATURES if not f.startswith("suffix_")])
    rows = keep(wanted.distinct().orderBy(F.xxhash64(key), key, label).limit(sample).withColumn("label", F.col(label).cast("double"))
                .select("label", "suffix", *[f for f in FEATURES if not f.startswith("suffix_")]).coalesce(1))
    n, share, classes = rows.agg(F.count("*"), F.avg("label"), F.countDistinct("label")).first()
    if classes < 2:
        return UrlModel(None, None, float(share or 0.0))
    suffixes = keep(rows.groupBy("suffix").agg(
        (F.count("*") / F.lit(float(n))).alias("suffix_share"),
        ((F.sum("label") + F.lit(SMOOTHING * share)) / (F.count("*") + F.lit(SMOOTHING))).alias("suffix_rate")).coalesce(1))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(rows.join(F.broadcast(suffixes), "suffix"))
    trees = GBTClassifier(labelCol="label", featuresCol="__features", maxIter=rounds, maxDepth=depth, seed=7).fit(
        keep(vector.select("label", "__features")))
    return UrlModel(suffixes, trees, float(share))


def judge(urls: DataFrame, rules: list[UrlRule] = RULES, url: str = "url", sample: int = SAMPLE,
          threshold: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """Per row of `urls`, its columns with host, path, rule, verdict and p_block.

    Rows that no rule fits get the trees' verdict: block where p_block >= threshold. Equal URLs get
    equal verdicts. Columns of `urls` that bear one of the new names are replaced.
    """
    own = ["host", "path", "rule", "verdict", "p_block"]
    kept = [c for c in urls.columns if c not in own]
    inner = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(kept)]  # no clash with feature names
    rows = with_parts(urls.select(F.col(f"`{url}`").alias("__url"), *inner), "__url")
    name, verdict = rule_columns(rules)
    rows = lexical(rows.withColumns({"rule": name, "__by_rule": verdict}), "__url")
    labelled = rows.filter(F.col("rule").isNotNull()).withColumn("__label", (F.col("__by_rule") == "block").cast("int"))
    model = fit(labelled, "__label", "__url", sample, rounds)
    scored = model.score(rows)
    by_trees = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return scored.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(kept)], "host", "path", "rule",
                         F.coalesce("__by_rule", by_trees).alias("verdict"), "p_block")
