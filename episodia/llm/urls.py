"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, hash_below, materialize, small, table

Rule = tuple[str, str, str]  # host, path, verdict
RULES: tuple[Rule, ...] = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
FEATURES = ("chars", "host_chars", "path_chars", "labels", "depth", "digit_ratio", "entropy", "params", "hyphens", "secure", "suffix_rate", "suffix_share")


def split_url(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """urls plus host (A-Z lower-cased) and path; both empty without ://."""
    rest = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return urls.withColumns({"host": ascii_lower(rest), "path": path})


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits the host or a parent domain and begins the path; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, begin, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(begin)
        found = F.when(fits, F.struct(F.lit(name + begin).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def lexical_features(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """urls (with host and path) plus the lexical features and the host's suffix, its last label."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    chars = F.length(url).cast("double")
    count = lambda pattern: F.regexp_count(url, F.lit(pattern)).cast("double")
    share = lambda c: (chars - F.length(F.replace(url, c, F.lit("")))) / chars
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda total, c: total - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))
    return urls.withColumns({
        "chars": chars,
        "host_chars": F.length("host").cast("double"),
        "path_chars": F.length("path").cast("double"),
        "labels": F.size(F.split("host", r"\.")).cast("double"),
        "depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "digit_ratio": F.when(chars > 0, count("[0-9]") / chars).otherwise(0.0),
        "entropy": F.when(chars > 0, entropy).otherwise(0.0),
        "params": count(r"[?&][^&#?]"),
        "hyphens": count("-"),
        "secure": url.startswith("https:").cast("double"),
        "suffix": F.substring_index("host", ".", -1),
    })


#: Parts of the labelled urls; a training url's suffix statistics come from the other parts.
FOLDS = 5


def suffix_sums(labelled: DataFrame) -> DataFrame:
    """(suffix, fold, n, bad) of all rows of labelled (suffix, fold, label)."""
    return labelled.groupBy("suffix", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad"))


def suffix_features(n: Column, bad: Column, all_n: float, all_bad: float, smoothing: float = 5.0) -> dict[str, Column]:
    """The smoothed rate of blocked urls among a suffix's labelled ones, and its share of them; a suffix without any has the common rate."""
    n, bad = F.coalesce(n, F.lit(0)), F.coalesce(bad, F.lit(0.0))
    prior = all_bad / max(all_n, 1)
    return {"suffix_rate": (bad + smoothing * prior) / (n + smoothing), "suffix_share": n / F.lit(float(max(all_n, 1)))}


def judge_urls(
    urls: DataFrame,
    labelled: DataFrame,
    rules: Sequence[Rule] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    max_training_rows: int = 20_000,
    trees: int = 12,
    depth: int = 4,
) -> DataFrame:
    """id, url, host, path, rule, score and verdict of every url.

    labelled has url and label (1: block). The trees are fitted on a repeatable hash sample of about max_training_rows
    different labelled rows, and every url is scored. The suffixes' rates and shares come from all different labelled
    rows; a training row's come from the other folds, so that its own label is not among them. A rule's verdict comes
    before the trees'; score >= 0.5 blocks.
    Repeated labelled rows count once, so a url that holds a third of all rows does not fill the sample.

    Null urls and urls without :// have empty host and path and are judged by the trees as an empty text. Repeated
    rows are judged alike. With no labelled rows, or labels of one kind only, every score is that kind's share (0
    without any). Further columns of urls are ignored.
    """
    labelled = labelled.select(F.col(url_col), F.col("label").cast("double").alias("label")).where("label is not null").distinct()
    labelled = split_url(labelled, url_col).withColumns({"suffix": F.substring_index("host", ".", -1), "fold": F.pmod(F.xxhash64(F.col(url_col), F.lit(1)), F.lit(FOLDS))})
    sums = materialize(suffix_sums(labelled), "suffixes")
    whole = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad"), F.count(F.lit(1)).alias("rows")).first()
    rows = lexical_features(split_url(urls.select(F.col(id_col), F.col(url_col)), url_col), url_col)
    if 0 < whole.bad < whole.n:
        sample = labelled.where(hash_below(F.col(url_col), min(1.0, max_training_rows / whole.n)))
        sample = materialize(lexical_features(sample, url_col), "url_sample")
    if whole.bad in (0, whole.n) or sample.select("label").distinct().count() < 2:
        rows = rows.withColumn("score", F.lit(float(whole.bad / whole.n) if whole.n else 0.0))
    else:
        by_suffix = small(sums.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), whole.rows)
        by_fold = small(sums.select("suffix", "fold", F.col("n").alias("own_n"), F.col("bad").alias("own_bad")), whole.rows)
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        others = suffix_features(F.col("n") - F.col("own_n"), F.col("bad") - F.col("own_bad"), whole.n * (FOLDS - 1) / FOLDS, whole.bad * (FOLDS - 1) / FOLDS)
        training = sample.join(by_suffix, "suffix").join(by_fold, ["suffix", "fold"]).withColumns(others)
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32).fit(assembler.transform(training))
        rows = rows.join(by_suffix, "suffix", "left").withColumns(suffix_features(F.col("n"), F.col("bad"), whole.n, whole.bad))
        rows = model.transform(assembler.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    found = matching_rule(rules, F.col("host"), F.col("path"))
    return rows.select(id_col, url_col, "host", "path", found.alias("found"), "score").select(id_col, url_col, "host", "path", F.col("found.rule").alias("rule"), "score", F.coalesce(F.col("found.verdict"), F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' own verdicts are the labels: pages has no others."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = split_url(pages).withColumn("found", matching_rule(RULES, F.col("host"), F.col("path")))
    labelled = ruled.where("found is not null").select("url", (F.col("found.verdict") == "block").cast("int").alias("label"))
    return judge_urls(pages, labelled, RULES).select("page_id", "host", "path", "rule", "verdict", "score")


#: The part of query() that needs no trees: page_id, host, path, rule.
URL_SQL = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages), r AS (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
SELECT page_id, host, path, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p
"""
