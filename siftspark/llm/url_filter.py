"""URL filter (DataFrame, SQL and spark.ml functions only).

Rules of the form ``host/path`` allow or block a host with its subdomains below
a path; the longest rule that fits wins. URLs without a rule are judged by
gradient-boosted trees on lexical features, trained on the URLs that the rules
have labelled.

The trees are fitted on distinct labelled URLs, each weighted by its rows. The
share of blocked URLs under a suffix is learned in folds: what a labelled URL
sees of it comes from the URLs of the other folds.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no rule, and is judged by the trees like any other. Where the labelled
URLs are all of one class, that class is the verdict for the rest; where there
are none it is ``allow``. Repeated rows are judged alike; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: The rule list of the registered query.
RULES = {
    "com/": ALLOW,
    "example.com/en/": BLOCK,
    "www.example.com/en/": ALLOW,
    "net/es/": BLOCK,
    "net/fr/": BLOCK,
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Params:
    """``max_training``: expected number of distinct labelled URLs that the trees are fitted on, half of it
    for each class at most; more are thinned by a hash of the URL. ``hot_share``: suffixes with more than this
    share of the URLs, at most 2 / hot_share of them, are broadcast to be joined.
    """

    max_training: int = 50_000
    hot_share: float = 0.001
    folds: int = 5
    trees: int = 20
    depth: int = 4
    seed: int = 7


FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "host_labels",
    "digit_ratio",
    "host_digit_ratio",
    "hyphens",
    "entropy",
    "host_entropy",
    "n_params",
    "has_query",
    "has_fragment",
    "first_segment_length",
    "suffix_blocked",
    "second_suffix_blocked",
    "suffix_count",
)


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    base = pages.select("page_id", url.alias("url"), rest.alias("_rest"))
    return base.select(
        "page_id",
        "url",
        F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def with_rule(urls: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add ``rule`` and ``label``, both null where no rule fits."""
    best: Column | None = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        best = F.when(fits, rule) if best is None else best.when(fits, rule)
    rule = F.lit(None).cast("string") if best is None else best
    blocked = [r for r, v in rules.items() if v == BLOCK]
    return urls.withColumn("rule", rule).withColumn("label", F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocked).cast("double")))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n == 0, 0.0).otherwise(F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda a, c: a - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c)))))


def lexical(urls: DataFrame) -> DataFrame:
    """Add the features that depend on the URL alone, and its host's suffixes of one and two labels."""
    c = F.col
    digits = lambda x: F.length(x) - F.length(F.translate(x, "0123456789", ""))
    count = lambda x, y: F.length(x) - F.length(F.replace(x, F.lit(y), F.lit("")))
    # What follows the first ? up to the fragment; its parameters are separated by &.
    query = F.regexp_extract("url", "^[^?#]*\\?([^#]*)", 1)
    return urls.select(
        "*",
        F.length("url").cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.size(F.array_remove(F.split("path", "/"), "")).cast("double").alias("depth"),
        F.size(F.split("host", "\\.")).cast("double").alias("host_labels"),
        F.coalesce(F.try_divide(digits(c("url")), F.length("url")), F.lit(0.0)).alias("digit_ratio"),
        F.coalesce(F.try_divide(digits(c("host")), F.length("host")), F.lit(0.0)).alias("host_digit_ratio"),
        count(c("host"), "-").cast("double").alias("hyphens"),
        _entropy(c("url")).alias("entropy"),
        _entropy(c("host")).alias("host_entropy"),
        F.when(query == "", 0.0).otherwise((1 + count(query, "&")).cast("double")).alias("n_params"),
        (F.instr("url", "?") > 0).cast("double").alias("has_query"),
        (F.instr("url", "#") > 0).cast("double").alias("has_fragment"),
        F.length(F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit(""))).cast("double").alias("first_segment_length"),
        F.substring_index("host", ".", -1).alias("_suffix1"),
        F.substring_index("host", ".", -2).alias("_suffix2"),
    )


def _fold(params: Params) -> Column:
    """The fold of a labelled URL; the others come after all folds."""
    return F.when(F.col("label").isNotNull(), F.pmod(F.xxhash64(F.lit(params.seed + 1), "url"), F.lit(params.folds))).otherwise(params.folds).cast("int")


def suffix_statistics(urls: DataFrame, params: Params = Params()) -> DataFrame:
    """(_labels, _suffix, _rows, _n, _blocked): URLs, and the smoothed shares of blocked ones among the labelled outside
    each fold and among all, by suffix of one label and of two."""
    level = lambda k: F.struct(F.lit(k).alias("_labels"), F.col(f"_suffix{k}").alias("_suffix"))
    rows = urls.select(F.explode(F.array(level(1), level(2))).alias("_s"), "label", _fold(params).alias("_f")).select("_s.*", "label", "_f")
    outside = lambda k: F.when(F.col("_f") != k, F.col("label"))
    shares = [((F.coalesce(F.sum(outside(k)), F.lit(0.0)) + 5.0) / (F.count(outside(k)) + 10.0)) for k in range(params.folds + 1)]
    return rows.groupBy("_labels", "_suffix").agg(F.count("*").alias("_rows"), F.log1p(F.count("*")).alias("_n"), F.array(*shares).alias("_blocked"))


def with_suffixes(urls: DataFrame, stats: DataFrame, params: Params = Params()) -> DataFrame:
    """Add the suffix features. Hot suffixes are broadcast; the others meet their URLs by shuffle."""
    total = stats.filter("_labels = 1").agg(F.sum("_rows")).first()[0] or 0
    is_hot = F.col("_rows") > total * params.hot_share
    urls = urls.withColumn("_f", _fold(params))
    for k, names in ((1, ("suffix_count", "suffix_blocked")), (2, (None, "second_suffix_blocked"))):
        mine = stats.filter(F.col("_labels") == k)
        # URLs of hot suffixes are dealt evenly: no host has a slash.
        key = F.when(F.col("_hot_blocked").isNull(), F.col(f"_suffix{k}")).otherwise(F.concat(F.lit("/"), F.xxhash64("url", "page_id").cast("string")))
        hot = F.broadcast(mine.filter(is_hot).select(F.col("_suffix").alias(f"_suffix{k}"), F.col("_n").alias("_hot_n"), F.col("_blocked").alias("_hot_blocked")))
        rest = mine.filter(~is_hot).select(F.col("_suffix").alias("_key"), "_n", "_blocked")
        urls = urls.join(hot, f"_suffix{k}", "left").withColumn("_key", key).join(rest, "_key", "left")
        values = dict(zip(names, (F.coalesce("_hot_n", "_n"), F.get(F.coalesce("_hot_blocked", "_blocked"), F.col("_f"))), strict=True))
        urls = urls.withColumns({name: v for name, v in values.items() if name}).drop("_key", "_hot_n", "_hot_blocked", "_n", "_blocked", f"_suffix{k}")
    return urls.drop("_f")


def training_urls(urls: DataFrame, params: Params = Params()) -> DataFrame:
    """(label, weight, features): distinct labelled URLs of a bounded sample, each class by a share of its own. A class
    with few distinct URLs gives them all, so none vanishes."""
    labelled = urls.filter(F.col("label").isNotNull())
    distinct = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.approx_count_distinct("url").alias("n")).collect()}
    share = lambda k: min(1.0, params.max_training / 2 / max(distinct.get(k, 0), 1))
    taken = F.when(F.col("label") == 1, share(1.0)).otherwise(share(0.0))
    unit = F.pmod(F.xxhash64(F.lit(params.seed), "url"), F.lit(2**53)) / F.lit(float(2**53))
    # Rows of one URL are alike.
    return labelled.filter(unit < taken).groupBy("url").agg(F.first("label").alias("label"), (F.count("*") / F.first(taken)).alias("weight"), *[F.first(c).alias(c) for c in FEATURES]).drop("url")


def url_verdicts(pages: DataFrame, rules: dict[str, str] = RULES, params: Params = Params()) -> DataFrame:
    """One row per page: host, path, rule, verdict and the trees' probability of blocking."""
    from siftspark.session import checkpointed

    base = checkpointed(lexical(with_rule(parsed(pages), rules)))
    stats = checkpointed(suffix_statistics(base, params))
    urls = checkpointed(with_suffixes(base, stats, params))
    training = checkpointed(training_urls(urls, params))
    seen = [r["label"] for r in training.select("label").distinct().collect()]
    if len(seen) == 2:
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
        boosted = GBTClassifier(featuresCol="_features", weightCol="weight", maxIter=params.trees, maxDepth=params.depth, seed=params.seed)
        model = boosted.fit(assemble.transform(training).select("label", "weight", "_features"))
        scored = model.transform(assemble.transform(urls)).withColumn("block_probability", vector_to_array("probability")[1])
    else:
        scored = urls.withColumn("block_probability", F.lit(next(iter(seen), 0.0)))
    verdict = F.coalesce(F.col("label"), F.col("block_probability")) >= 0.5
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(verdict, BLOCK).otherwise(ALLOW).alias("verdict"),
        F.round("block_probability", 6).alias("block_probability"),
    )
