"""URL filters: rules on host and path, and boosted trees on what an address looks like for all others.

The trees learn from the addresses that rules decide. All features are column expressions; the suffix statistics come from all labelled
addresses, in a fixed number of hash buckets; the trees are ``pyspark.ml``'s, fitted on a bounded sample. A rule that decides a whole suffix
says nothing about what its addresses look like: suffixes of one label have no statistics, and a labelled address is described by
the other folds' addresses, never by its own label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.sources.scratch import stored

BLOCK, ALLOW = "block", "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: labelled addresses that trees are fitted on, and hash buckets of suffixes
MOST, BUCKETS = 100_000, 1024
#: folds of labelled addresses, and how many addresses the overall share counts for in a suffix's own
FOLDS, WEIGHT = 5, 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?`` or ``#``. Else empty."""
    whole = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matched(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or NULL."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""

    def of(character: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, character, F.lit("")))) / F.length(text)
        return -share * F.log2(share)

    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.when(F.length(text) > 0, F.aggregate(letters, F.lit(0.0), lambda total, c: total + of(c))).otherwise(0.0)


def _suffix(host: Column, labels: int) -> Column:
    """Hash bucket of the last labels of the host."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -labels), F.lit(labels)), F.lit(BUCKETS)).cast("int")


LEXICAL = ["url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio", "entropy", "host_entropy", "parameters", "hyphens", "has_fragment", "secure"]
STATISTICS = ["rate_1", "seen_1", "rate_2", "seen_2"]


def features(pages: DataFrame) -> DataFrame:
    """Lexical features and suffix buckets beside page_id, url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    count = lambda text, sign: F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    query = F.when(F.instr(url, "?") > 0, F.substr(url, F.instr(url, "?") + 1)).otherwise("")
    values = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "host_labels": count(host, ".") + 1,
        "path_depth": count(path, "/"),
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.when(query != "", count(query, "&") + 1).otherwise(0),
        "hyphens": count(host, "-"),
        "has_fragment": (F.instr(url, "#") > 0).cast("int"),
        "secure": F.startswith(url, F.lit("https")).cast("int"),
    }
    lexical = [values[n].cast("double").alias(n) for n in LEXICAL]
    return pages.select("*", *lexical, _suffix(host, 1).alias("suffix_1"), _suffix(host, 2).alias("suffix_2"))


def _statistics(labelled: DataFrame, labels: int) -> DataFrame:
    """Sums by suffix bucket and fold, of buckets with both labels: at most BUCKETS * FOLDS rows."""
    key = f"suffix_{labels}"
    sums = labelled.groupBy(key, "fold").agg(F.sum("label").alias("blocked"), F.count("*").alias("n"))
    whole = sums.groupBy(key).agg(F.sum("blocked").alias("all_blocked"), F.sum("n").alias("all_n"))
    return sums.join(whole.filter("all_blocked > 0 AND all_blocked < all_n"), key)


def _rates(sums: DataFrame, labels: int, prior: float, own_fold: bool) -> DataFrame:
    """Blocked share, drawn to the overall one where a suffix is rare, and count; with ``own_fold`` by the fold that is left out."""
    key = f"suffix_{labels}"
    keys = [key, "fold"] if own_fold else [key]
    blocked, n = F.col("all_blocked"), F.col("all_n")
    if own_fold:
        blocked, n = blocked - F.col("blocked"), n - F.col("n")
    rate = (blocked + F.lit(WEIGHT * prior)) / (n + F.lit(float(WEIGHT)))
    return sums.select(*keys, rate.alias(f"rate_{labels}"), F.log1p(n).alias(f"seen_{labels}")).distinct()


def _with_statistics(rows: DataFrame, tables: list[DataFrame], prior: float, own_fold: bool) -> DataFrame:
    for labels, t in enumerate(tables, 1):
        rows = rows.join(F.broadcast(_rates(t, labels, prior, own_fold)), [f"suffix_{labels}", "fold"] if own_fold else f"suffix_{labels}", "left")
    rows = rows.fillna({"rate_1": prior, "rate_2": prior, "seen_1": 0.0, "seen_2": 0.0})
    return VectorAssembler(inputCols=LEXICAL + STATISTICS, outputCol="features").transform(rows)


def verdicts(pages: DataFrame, rules: list[Rule], rounds: int = 10, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of ``pages`` (page_id, url; other columns are ignored).

    ``score`` is the trees' probability of "block", given for all rows; where no rule fits it decides at one half. Without labelled addresses of
    both kinds, score is the share of blocked ones (0 without any). NULL urls have empty host and path. Repeated rows stay; an empty
    table gives an empty table.
    """
    host, path = host_and_path()
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = features(split.withColumn("found", matched(F.col("host"), F.col("path"), rules)))
    labelled = rows.filter("found IS NOT NULL").withColumn("label", (F.col("found.verdict") == BLOCK).cast("double"))
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64("page_id", "url", F.lit(1)), F.lit(FOLDS)))
    tables = [stored(_statistics(labelled, k), f"suffix-{k}") for k in (1, 2)]
    kinds = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    n = sum(kinds.values())
    if len(kinds) < 2:
        share = kinds.get(1.0, 0) / n if n else 0.0
        scored = rows.withColumn("score", F.lit(share))
    else:
        drawn = labelled if n <= MOST else labelled.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(n)) < MOST)
        training = stored(_with_statistics(drawn, tables, kinds[1.0] / n, True).select("features", "label"), "url-training")
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, featuresCol="features", labelCol="label").fit(training)
        scored = trees.transform(_with_statistics(rows, tables, kinds[1.0] / n, False)).withColumn("score", vector_to_array("probability")[1])
    guessed = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", guessed).alias("verdict"), "score")
