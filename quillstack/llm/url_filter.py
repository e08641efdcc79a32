"""URL filter: allow and block rules by host and path, and a model for the URLs that no rule fits.

A rule is a host and the start of a path, written ``host/path``. It fits the URLs of that host
and its subdomains whose path starts with the rule's; of several that fit, the longest decides.
Rules are looked up by a join on the suffixes of the hosts, so the list may be large.

The model is a forest of gradient-boosted trees over lexical features of the URL: lengths, depth,
digit share, character entropy, counts of parameters and marks, and smoothed statistics of the
host's suffix (how often the labelled URLs with it are blocked, and how many there are). It is
trained from labelled URLs, at most ``max_train`` different ones, those with the smallest hashes;
the statistics of the suffixes are those of all labelled rows. While training, a URL sees the
statistics of the other folds only, hosts being dealt to ``FOLDS`` folds, so trees do not learn to
trust a rate that the URL's own label made. The query labels URLs by the rules themselves; ``held_out``
says how well the model does on hosts that it did not learn from. Without labels of both kinds every
other URL gets the one label there is, or allow.

Null URLs and those without ``://`` have an empty host and path, fit no rule and are judged by
the model. Very long URLs are read whole. Repeated rows get the same verdict, null ids are ids, further
columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, join_named

MAX_TRAIN = 20_000
TREES, DEPTH, STEP = 12, 4, 0.2
FOLDS = 4
#: Without a rule, a URL goes only if the model is this sure.
THRESHOLD = 0.8
#: Rules and suffixes are broadcast up to so many rows of about 100 bytes, and joined by a shuffle beyond.
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def _suffixes(host: Column) -> Column:
    labels = F.split(host, "\\.", -1)
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, label, times) for the host and path pairs that a rule fits; times is how many URLs have the pair.

    rules: (rule string as host/path, label string).
    """
    rules = rules.where(F.col("rule").isNotNull()).select(
        "rule", "label",
        F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("rule_host"),
        F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("start"),
    ).dropDuplicates(["rule"])
    pairs = urls.where("host != ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("times"))
    keyed = pairs.select("host", "path", "times", F.explode(_suffixes(F.col("host"))).alias("rule_host"))
    fits = keyed.join(broadcast_if_small(rules, rules.count(), BROADCAST_ROWS), "rule_host").where(F.startswith("path", "start"))
    best = F.max_by(F.struct("rule", "label"), F.struct(F.length("rule"), "rule"))
    return fits.groupBy("host", "path").agg(best.alias("best"), F.first("times").alias("times")).select("host", "path", "best.rule", "best.label", "times")


def _entropy(text: Column) -> Column:
    chars = F.array_distinct(F.split(text, ""))
    n = F.length(text)

    def term(c):
        k = n - F.length(F.replace(text, c, F.lit("")))
        return F.when((c != "") & (k > 0), k * F.log2(k.cast("double"))).otherwise(0.0)

    total = F.aggregate(chars, F.lit(0.0), lambda acc, c: acc + term(c))
    return F.when(n > 0, F.log2(n.cast("double")) - total / n).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that come from the URL alone."""
    text = F.coalesce(url, F.lit(""))
    count = lambda c, p: F.regexp_count(c, F.lit(p)).cast("double")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    return {
        "url_length": F.length(text).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": count(host, "[^.]+"),
        "depth": count(path, "[^/]+"),
        "digit_share": count(text, "[0-9]") / n,
        "host_digits": count(host, "[0-9]"),
        "hyphens": count(host, "-"),
        "marks": count(text, "[@%~_,;=+]"),
        "parameters": count(text, "[?&][^=&#]+"),
        "fragment": F.contains(text, F.lit("#")).cast("double"),
        "secure": F.startswith(text, F.lit("https")).cast("double"),
        "www": F.startswith(host, F.lit("www.")).cast("double"),
        "first_segment": F.length(F.regexp_extract(path, "^/?([^/]*)", 1)).cast("double"),
        "entropy": _entropy(text),
        "host_entropy": _entropy(host),
    }


def suffix(host: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host, ".", -2)


def fold(host: Column) -> Column:
    return F.pmod(F.xxhash64(host, F.lit("fold")), F.lit(FOLDS)).cast("int")


def suffix_statistics(weighted: DataFrame) -> DataFrame:
    """(suffix, fold, s_blocked, s_weight, s_seen): sums of each suffix over all of its rows (fold null) and without each fold."""
    per = weighted.groupBy(suffix(F.col("host")).alias("suffix"), fold(F.col("host")).alias("fold")).agg(
        F.sum(F.col("block") * F.col("weight")).alias("blocked"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("seen")
    )
    every = per.groupBy("suffix").agg(*[F.sum(c).alias(c) for c in ("blocked", "weight", "seen")], F.map_from_entries(F.collect_list(F.struct("fold", F.struct("blocked", "weight", "seen")))).alias("own"))
    folds = F.array(F.lit(None).cast("int"), *[F.lit(k) for k in range(FOLDS)])
    rows = every.withColumn("fold", F.explode(folds)).withColumn("less", F.when(F.col("fold").isNotNull(), F.try_element_at("own", "fold")))
    return rows.select("suffix", "fold", *[(F.col(c) - F.coalesce(F.col(f"less.{c}"), F.lit(0))).alias(f"s_{c}") for c in ("blocked", "weight", "seen")])


def featured(urls: DataFrame, statistics: DataFrame, n_suffixes: int, prior: float) -> DataFrame:
    """urls (url, host, path, fold, ...) with the column ``features``; with a fold, statistics are those without it."""
    made = lexical(F.col("url"), F.col("host"), F.col("path"))
    named = statistics.withColumnRenamed("fold", "of")
    keyed = urls.withColumn("suffix", suffix(F.col("host")))
    if n_suffixes <= BROADCAST_ROWS:
        joined = keyed.join(F.broadcast(named), (keyed["suffix"] == named["suffix"]) & keyed["fold"].eqNullSafe(named["of"]), "left")
    else:
        named = named.select("suffix", F.coalesce("of", F.lit(-1)).alias("__of"), "s_blocked", "s_weight", "s_seen", F.col("s_seen").alias("times"))
        keyed = keyed.withColumn("__of", F.coalesce("fold", F.lit(-1)))
        joined = join_named(keyed, named, ["suffix", "__of"], urls.count(), left=True)
    made["suffix_rate"] = (F.coalesce("s_blocked", F.lit(0.0)) + 5 * prior) / (F.coalesce("s_weight", F.lit(0.0)) + 5)
    made["suffix_seen"] = F.log1p(F.coalesce(F.col("s_seen"), F.lit(0)).cast("double"))
    wide = joined.select(*urls.columns, *[v.alias(f"f_{k}") for k, v in made.items()])
    return VectorAssembler(inputCols=[f"f_{k}" for k in made], outputCol="features").transform(wide).select(*urls.columns, "features")


def _weighted(rows: DataFrame, n: int, blocked: float) -> DataFrame:
    """Both labels weigh the same in all, as rules label far more URLs of one kind than of the other."""
    return rows.withColumn("weight", F.when(F.col("block") == 1, n / (2 * blocked)).otherwise(n / (2 * (n - blocked))))


def train(labelled: DataFrame, max_train: int = MAX_TRAIN):
    """A function from (url, host, path, ...) to these columns and ``blocked``, a rate from 0 to 1.

    labelled: (url, host, path, label 'allow' or 'block').
    """
    block = (F.col("label") == "block").cast("double")
    labelled = labelled.select("url", "host", "path", block.alias("block"))
    sample = checkpoint(labelled.distinct().orderBy(F.xxhash64("url"), "url", "block").limit(max_train))
    n, blocked = sample.agg(F.count(F.lit(1)), F.sum("block")).first()
    if not n or blocked in (0, n):
        constant = float(blocked / n) if n else 0.0
        return lambda urls: urls.withColumn("blocked", F.lit(constant))
    prior = 0.5
    sample = _weighted(sample, n, blocked)
    # the trees learn from the sample, the statistics are those of all labelled rows
    statistics = checkpoint(suffix_statistics(_weighted(labelled, *labelled.agg(F.count(F.lit(1)), F.sum("block")).first())))
    n_suffixes = statistics.count()
    known = featured(sample.withColumn("fold", fold(F.col("host"))), statistics, n_suffixes, prior)
    model = GBTClassifier(labelCol="block", featuresCol="features", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(known)

    def apply(urls: DataFrame) -> DataFrame:
        rows = urls.withColumn("fold", F.lit(None).cast("int"))
        scored = model.transform(featured(rows, statistics, n_suffixes, prior))
        return scored.select(*urls.columns, vector_to_array("probability")[1].alias("blocked"))

    return apply


def held_out(labelled: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row (n, blocks, found, wrong) of the labelled URLs of one fold of hosts, judged by a model of the other folds.

    blocks: URLs to block; found: those of them that are blocked; wrong: URLs blocked that are to be allowed.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.select("url", host.alias("host"), path.alias("path"), "label")
    scored = train(rows.where(fold(F.col("host")) != 0), max_train)(rows.where(fold(F.col("host")) == 0))
    bad, gone = F.col("label") == "block", F.col("blocked") >= threshold
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("blocks"), F.count_if(bad & gone).alias("found"), F.count_if(~bad & gone).alias("wrong"))


def judge_urls(pages: DataFrame, rules: DataFrame, labelled: DataFrame | None = None, id_col="page_id", url="url",
               threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """(id, url, host, path, rule, blocked, verdict) for every row of pages.

    labelled: (url, label) to train from; the URLs that a rule fits if None.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"), host.alias("host"), path.alias("path"))
    matched = checkpoint(match_rules(urls, rules))
    ruled = join_named(urls, matched, ["host", "path"], matched.agg(F.sum("times")).first()[0] or 0, left=True, alone=F.col("host") == "")
    if labelled is None:
        known = ruled.where(F.col("label").isNotNull()).select("url", "host", "path", "label")
    else:
        h, p = host_and_path(F.col("url"))
        known = labelled.select("url", h.alias("host"), p.alias("path"), "label")
    scored = train(known, max_train)(ruled)
    verdict = F.coalesce("label", F.when(F.col("blocked") >= threshold, "block").otherwise("allow"))
    return scored.select(F.col("id").alias(id_col), F.col("url").alias(url), "host", "path", "rule", "blocked", verdict.alias("verdict"))
