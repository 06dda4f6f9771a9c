"""Operator 3: URL filter by host/path rules and gradient-boosted trees (native).

Rules decide first (the longest fitting rule wins).  Every other url is judged by
boosted trees on lexical features: lengths, depth, digit ratio, entropy, parameter
counts and the block rate of its host suffixes among labelled urls.  All of it is
DataFrame expressions and the JVM's tree trainer; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from itemtrack.llm.common import materialize
from itemtrack.operators.common import join_split

# Characters whose frequencies make up the entropy; all others form one class.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~/?#=&%:"
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits",
            "entropy", "hyphens", "params", "query_length", "fragment", "https", "escapes", "dots",
            "suffix1_rate", "suffix2_rate", "host_rate"]
FOLDS = 5


def with_parts(urls: DataFrame, url_col: str) -> DataFrame:
    """Adds host (A-Z lower-cased) and path; null or no ``://``: both empty."""
    rest = F.when(F.instr(url_col, "://") > 0, F.expr(f"substr(`{url_col}`, instr(`{url_col}`, '://') + 3)"))
    lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (urls.withColumn("_rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", F.translate(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1), lower, lower.lower()))
            .withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def with_rule(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` (null if none fits).  A rule is ``host/path``:
    it fits its host and all subdomains where the url's path starts with the rule's.
    The longest wins; equally long ones cannot fit one url twice unless listed twice.
    The rules are a parameter, so their number is the caller's and they are literals."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, word in sorted(rules, key=lambda r: len(r[0])):
        host, _, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith("/" + path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _count(column: str, text: str) -> Column:
    return F.length(column) - F.length(F.replace(F.col(column), F.lit(text), F.lit("")))


def lexical(urls: DataFrame, url_col: str) -> DataFrame:
    """Adds the lexical features; needs host and path.  All stay inside codegen."""
    url = urls.withColumn("_url", F.lower(F.coalesce(F.col(url_col), F.lit(""))))
    n = F.greatest(F.length("_url"), F.lit(1)).cast("double")
    counts = [_count("_url", c) for c in ALPHABET]
    rest = n - sum(counts[1:], counts[0])

    def part(count: Column) -> Column:
        p = count / n
        return F.when(p > 0, -p * F.log2(p)).otherwise(0.0)

    digits = F.length("_url") - F.length(F.regexp_replace("_url", "[0-9]", ""))
    query = F.regexp_extract("_url", r"\?([^#]*)", 1)
    return url.select(
        "*", F.length("_url").alias("url_length"), F.length("host").alias("host_length"),
        F.length("path").alias("path_length"), _count("path", "/").alias("depth"),
        _count("host", ".").alias("labels"), (digits / n).alias("digit_ratio"),
        (F.length("host") - F.length(F.regexp_replace("host", "[0-9]", ""))).alias("host_digits"),
        (sum((part(c) for c in counts[1:]), part(counts[0])) + part(rest)).alias("entropy"),
        _count("_url", "-").alias("hyphens"), _count("_url", "=").alias("params"),
        F.length(query).alias("query_length"), F.instr("_url", "#").cast("boolean").cast("int").alias("fragment"),
        F.col("_url").startswith("https").cast("int").alias("https"), _count("_url", "%").alias("escapes"),
        _count("path", ".").alias("dots"),
        F.substring_index("host", ".", -1).alias("suffix1"), F.substring_index("host", ".", -2).alias("suffix2"),
    ).drop("_url")


class UrlFilter:
    """Boosted trees with the suffix statistics that its features need.

    ``fit`` uses at most ``max_labelled`` distinct labelled urls (those of the smallest hash,
    so the choice is the same on every run), each weighted by its rows; the statistics
    therefore have at most that many rows, which bounds their broadcast.
    """

    def __init__(self, max_labelled: int = 20_000, trees: int = 20, depth: int = 4, smoothing: float = 20.0,
                 threshold: float = 0.5, seed: int = 7):
        self.max_labelled, self.trees, self.depth = max_labelled, trees, depth
        self.smoothing, self.threshold, self.seed = smoothing, threshold, seed
        self.model, self.rates, self.prior = None, {}, 0.0

    def fit(self, labelled: DataFrame, url_col: str = "url", label_col: str = "label",
            count_col: str | None = None) -> "UrlFilter":
        """``label``: 1 block, 0 allow; rows with a null url or label do not count.  With
        labels of one kind only (or none) the verdict is that kind (none: allow).  ``count_col``:
        how many rows a row stands for."""
        times = F.lit(1) if count_col is None else F.col(count_col)
        rows = (labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label"),
                                times.cast("double").alias("times"))
                .filter("url IS NOT NULL AND label IS NOT NULL")
                .groupBy("url").agg(F.sum(F.col("label") * F.col("times")).alias("ones"), F.sum("times").alias("n"))
                .orderBy(F.xxhash64("url"), "url").limit(self.max_labelled))
        # A url with rows of both labels is one example of each.
        rows = rows.select("url", F.inline(F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("ones").alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("ones")).alias("weight"))))).filter("weight > 0")
        rows = lexical(with_parts(rows, "url"), "url").withColumn("host_key", F.col("host"))
        rows = materialize(rows.coalesce(4), "url-train")
        ones = F.sum(F.col("label") * F.col("weight"))
        seen = rows.agg(F.count(F.lit(1)).alias("n"), (ones / F.sum("weight")).alias("p")).first()
        self.prior = float(seen["p"] or 0.0)
        if not seen["n"] or self.prior in (0.0, 1.0):
            return self
        for key in ("suffix1", "suffix2", "host_key"):
            self.rates[key] = materialize(rows.groupBy(key).agg(
                ((ones + self.smoothing * self.prior) / (F.sum("weight") + self.smoothing))
                .alias(f"{key}_rate")).coalesce(1), "url-rates")
        train = materialize(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(self._out_of_fold(rows))
                            .select("features", "label", "weight").coalesce(4), "url-vectors")
        self.model = GBTClassifier(maxIter=self.trees, maxDepth=self.depth, seed=self.seed,
                                   stepSize=0.1, weightCol="weight").fit(train)
        return self

    def _out_of_fold(self, rows: DataFrame) -> DataFrame:
        """Training rows with their keys' block rates among the urls of the other folds, as an
        unseen url gets them: a url's own label is no part of its features."""
        rows = rows.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)))
        ones = F.sum(F.col("label") * F.col("weight"))
        for key in ("suffix1", "suffix2", "host_key"):
            all_folds = rows.groupBy(key).agg(ones.alias("_ones"), F.sum("weight").alias("_n"))
            own = rows.groupBy(key, "fold").agg(ones.alias("_own"), F.sum("weight").alias("_own_n"))
            rate = ((F.col("_ones") - F.col("_own") + self.smoothing * self.prior)
                    / (F.col("_n") - F.col("_own_n") + self.smoothing)).alias(f"{key}_rate")
            # At most as many rows as labelled urls.
            rows = rows.join(F.broadcast(own.join(all_folds, key).select(key, "fold", rate)), [key, "fold"])
        return rows.withColumnRenamed("host_key_rate", "host_rate")

    def _vectors(self, rows: DataFrame) -> DataFrame:
        for key, rates in self.rates.items():
            rows = rows.join(F.broadcast(rates), key, "left")
        rows = rows.fillna(self.prior, [f"{k}_rate" for k in self.rates])
        rows = rows.withColumnRenamed("host_key_rate", "host_rate")
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)

    def block_probability(self, urls: DataFrame, key_col: str, url_col: str) -> DataFrame:
        """(key, host, path, url, probability); needs host and path."""
        rows = urls.select(F.col(key_col).alias("key"), F.col(url_col).alias("url"), "host", "path")
        if self.model is None:
            return rows.withColumn("probability", F.lit(self.prior))
        scored = self.model.transform(self._vectors(lexical(rows, "url").withColumn("host_key", F.col("host"))))
        return scored.select("key", "url", "host", "path", vector_to_array("probability")[1].alias("probability"))

    def judge(self, urls: DataFrame, rules: list[tuple[str, str]], key_col: str = "page_id",
              url_col: str = "url") -> DataFrame:
        """page_id, host, path, rule, verdict, probability for every row.

        Null, empty or malformed urls have an empty host and path and are judged by the
        trees like any other; repeated rows are judged alike; extra columns are ignored.
        """
        parts = with_parts(urls.select(F.col(key_col).alias("key"), F.col(url_col).alias("url")), "url")
        scored = with_rule(self.block_probability(parts, "key", "url"), rules)
        method = F.when(F.col("probability") > self.threshold, "block").otherwise("allow")
        return scored.select(F.col("key").alias("page_id"), "host", "path", "rule",
                             F.coalesce("rule_verdict", method).alias("verdict"), "probability")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label, pages) of the urls of pages whose document is labelled: the url's last path
    segment names the document; label 1 (block) if the document is of low quality or toxic.
    Equal urls are one row before the join, and a document that many urls name is split."""
    number = F.regexp_extract(F.col("url"), r"/([0-9]{1,18})(?:\.html|/)?(?:[?#].*)?$", 1)
    marks = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
                                               .otherwise(0)).alias("label"))
    named = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id")).filter("doc_id IS NOT NULL")
    named = named.groupBy("url", "doc_id").agg(F.count(F.lit(1)).alias("pages"))
    return join_split(named, marks, "doc_id", "inner").select("url", "label", "pages")
