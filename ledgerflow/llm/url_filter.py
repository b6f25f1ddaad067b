"""URL filters: host and path rules, and gradient-boosted trees on lexical features of the URL.

Everything is a DataFrame function: features are column expressions, suffix statistics are counted over all labelled
URLs, the trees are fitted on a bounded sample of them, and scoring is a map over the rows. The only join is with the
suffix statistics, which are broadcast as long as they are few.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import ascii_lower, materialise
from ledgerflow.llm.components import BROADCAST_ROWS

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Characters whose shares make up the entropy; anything else counts as one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%:#~+,@"
FEATURES = ("n_url", "n_host", "n_path", "depth", "n_labels", "digit_ratio", "hyphens", "entropy", "n_params", "n_percent", "has_fragment", "is_https", "has_extension", "suffix_rate", "suffix_log_n")


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next slash, question mark or hash, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does.

    rules: (verdict, rule), a rule being a host and a path from the first slash on. It fits its host and all
    subdomains if the path starts with its path. Of rules of one length the first in the list wins."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda x: -len(x[1])):
        name, slash, rest = rule.partition("/")
        fits.append((((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest), rule, verdict))
    first = lambda at: F.coalesce(*[F.when(x[0], F.lit(x[at])) for x in fits]) if fits else F.lit(None).cast("string")
    return first(1), first(2)


def count_of(col: Column, what: str) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit(what), F.lit("")))


def entropy(col: Column) -> Column:
    """Bits a character, from the shares of the characters of ALPHABET and of all others together; 0 if empty."""
    n = F.length(col)
    known = F.transform(F.array(*[F.lit(c) for c in ALPHABET]), lambda c: F.length(col) - F.length(F.replace(col, c, F.lit(""))))
    counts = F.concat(known, F.array(n - F.aggregate(known, F.lit(0), lambda a, x: a + x)))
    bits = F.aggregate(counts, F.lit(0.0), lambda a, x: a + F.when(x > 0, -(x / n) * F.log2(x / n)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical_features(urls: DataFrame) -> DataFrame:
    """urls (with host and path) plus the features that need no statistics."""
    url = ascii_lower(F.coalesce(F.col("url"), F.lit("")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return urls.select(
        "*",
        F.length(url).cast("double").alias("n_url"),
        F.length("host").cast("double").alias("n_host"),
        F.length("path").cast("double").alias("n_path"),
        count_of(F.col("path"), "/").cast("double").alias("depth"),
        count_of(F.col("host"), ".").cast("double").alias("n_labels"),
        F.when(F.length(url) > 0, F.regexp_count(url, F.lit("[0-9]")) / F.length(url)).otherwise(0.0).alias("digit_ratio"),
        count_of(F.col("host"), "-").cast("double").alias("hyphens"),
        entropy(url).alias("entropy"),
        F.when(query == "", 0.0).otherwise(count_of(query, "&") + 1.0).alias("n_params"),
        count_of(url, "%").cast("double").alias("n_percent"),
        url.contains("#").cast("double").alias("has_fragment"),
        url.startswith("https://").cast("double").alias("is_https"),
        F.col("path").rlike(r"\.[a-z0-9]{1,5}$").cast("double").alias("has_extension"),
        suffix_of(F.col("host")).alias("suffix"),
    )


class UrlModel:
    """Fitted trees and the suffix statistics they rely on."""

    def __init__(self, trees: GBTClassificationModel | None, suffixes: DataFrame, rate: float):
        self.trees, self.rate = trees, rate
        self.suffixes = F.broadcast(suffixes) if suffixes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else suffixes

    def score(self, urls: DataFrame) -> DataFrame:
        """urls (url, host, path, ...) plus block_score, the probability that a URL should be blocked."""
        joined = lexical_features(urls).join(self.suffixes, "suffix", "left")
        rate = (F.coalesce("s_bad", F.lit(0.0)) + 5 * self.rate) / (F.coalesce("s_n", F.lit(0)) + 5)
        ready = joined.withColumn("suffix_rate", rate).withColumn("suffix_log_n", F.log1p(F.coalesce("s_n", F.lit(0)).cast("double")))
        out = self.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ready))
        return out.select(*urls.columns, vector_to_array("probability")[1].alias("block_score"))


def listed(host: Column, words: tuple[str, ...]) -> Column:
    """Whether one of a host's labels, cut at hyphens, is one of words; false for null."""
    return F.coalesce(F.arrays_overlap(F.split(host, r"[.-]"), F.array(*map(F.lit, words))), F.lit(False))


def train(labelled: DataFrame, max_rows: int = 40_000, trees: int = 12, depth: int = 4, seed: int = 7) -> UrlModel:
    """Trees fitted on at most about max_rows rows of labelled (url, label: 1 block, 0 allow; key, if there is one).

    Suffix statistics cover all labelled rows; a row's own label is left out of its statistics. The sample is drawn by
    a hash of url and key, which tells rows of one url apart, so reruns agree; never more than twice max_rows are
    taken, whatever the table holds. Rows without a label are not used; without both labels, one row of each is added
    so that trees can be fitted."""
    key = F.col("key") if "key" in labelled.columns else F.lit(0)
    place = F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), key, F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    rows = labelled.where("label is not null").select("url", F.col("label").cast("double").alias("label"), host_of(F.col("url")).alias("host"), place.alias("place"))
    rows = materialise(rows.withColumn("suffix", suffix_of(F.col("host"))), "labelled")
    suffixes = materialise(rows.groupBy("suffix").agg(F.count(F.lit(1)).alias("s_n"), F.sum("label").alias("s_bad")), "suffixes")
    n, bad = suffixes.agg(F.sum("s_n"), F.sum("s_bad")).first()
    rate = bad / n if n else 0.5
    sample = rows.where(F.col("place") < max_rows / max(1, n or 0)).select("url", "label").limit(2 * max_rows)
    both = sample.sparkSession.createDataFrame([("", 0.0), ("", 1.0)], sample.schema)
    seen = {r[0] for r in sample.select("label").distinct().collect()}
    sample = sample.unionByName(both.where(~F.col("label").isin([float(x) for x in seen]))) if len(seen) < 2 else sample
    sample = materialise(lexical_features(sample.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))), "urls")
    model = UrlModel(None, suffixes, float(rate))
    own = sample.join(model.suffixes, "suffix", "left")
    others, others_bad = F.greatest(F.coalesce("s_n", F.lit(0)) - 1, F.lit(0)), F.greatest(F.coalesce("s_bad", F.lit(0.0)) - F.col("label"), F.lit(0.0))
    own = own.withColumn("suffix_rate", (others_bad + 5 * rate) / (others + 5)).withColumn("suffix_log_n", F.log1p(others.cast("double")))
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(own).select("features", "label")
    model.trees = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=32, subsamplingRate=1.0).fit(ready)
    return model


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...], model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """pages (with url) plus host, path, rule, block_score and verdict: the rule's, else block from threshold on.

    A null url or one without :// has an empty host and path, fits no rule and gets the trees' verdict. Rows are
    neither merged nor lost, and an empty table gives an empty result. Columns of pages named like a result give way."""
    made = ("host", "path", "rule", "block_score", "verdict")
    kept = pages.drop(*made, *[c for c in pages.columns if c in {*FEATURES, "suffix", "s_n", "s_bad", "features", "rawPrediction", "probability", "prediction"}])
    scored = model.score(kept.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return scored.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, F.when(F.col("block_score") >= threshold, "block").otherwise("allow")))
