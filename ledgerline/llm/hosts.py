"""URL filter: fixed rules first, then empirical-Bayes reputation of the host.

A host's share of bad pages is judged by its beta posterior: the prior's mean is
the posterior mean of its registered domain, that one's comes from its suffix,
and that one's from all pages; how many pages a level's prior counts for is
found by likelihood. A host is blocked if the lower bound of its posterior is
over the limit, which is the share of bad pages among all labelled ones times a
stated lift.

A null url, or one without ``://``, has an empty host and path; its pages are a
host too. A host without labels, and every host if there are no labels, is
allowed unless its parents are surely bad. Repeated pages count each. Of several
labels of a document the worst counts. Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, written

# Fixed rules: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Suffixes of more than one label; any other suffix is the last label.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr", "co.in", "co.za", "com.br", "com.cn", "com.mx", "com.tr")
# A host is blocked if its share of bad pages is over LIFT times that of all labelled pages, with this certainty.
LIFT, SURE = 1.0, 0.8
# Pages a prior may count for. With more, a prior would outweigh what most hosts have of labelled pages.
WEIGHTS = tuple(2.0 ** (k / 4) for k in range(4, 25))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The last two labels if they are a listed suffix, else the last label."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1)) if suffixes else F.substring_index(host, ".", -1)


def parsed(pages: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``pages`` with host, path, domain (a label and the suffix) and suffix."""
    split = pages.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))).withColumn("path", F.coalesce(path_of(F.col("url")), F.lit("")))
    split = split.withColumn("suffix", suffix_of(F.col("host"), suffixes))
    return split.withColumn("domain", F.expr("substring_index(host, '.', -(size(split(suffix, '[.]')) + 1))"))


def ruled(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Adds rule and rule_verdict of the longest rule that fits host (or a parent of it) and path; else null."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = None
    for word, host, path in ordered:
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, F.lit(host + path)) if name is None else name.when(fits, F.lit(host + path))
        verdict = F.when(fits, F.lit(word)) if verdict is None else verdict.when(fits, F.lit(word))
    return pages.withColumn("rule", name if ordered else F.lit(None).cast("string")).withColumn("rule_verdict", verdict if ordered else F.lit(None).cast("string"))


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled pages and bad ones by host: a page's label is that of the document its path names (/lang/number), bad if toxic or of low quality."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("number")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    )
    numbered = pages.select("host", "domain", "suffix", F.expr("try_cast(regexp_extract(path, '^/[^/]*/([0-9]{1,18})', 1) as bigint)").alias("number"))
    # pages of one number and host are counted before they meet the labels
    counted = numbered.groupBy("number", "host", "domain", "suffix").agg(F.count("*").alias("n"))
    met = counted.join(marks.where("bad is not null"), "number", "left")
    return met.groupBy("host", "domain", "suffix").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("n"))), F.lit(0)).alias("seen"),
        F.coalesce(F.sum(F.col("n") * F.col("bad")), F.lit(0)).alias("bad"),
    )


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.array([lgamma(x) + lgamma(y) - lgamma(x + y) for x, y in zip(a, b)])


def below(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Probability that a beta variable is under ``x``: the continued fraction of the incomplete beta function."""
    turn = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(turn, b, a), np.where(turn, a, b), np.where(turn, 1 - x, x)
    tiny = 1e-300
    with np.errstate(divide="ignore", invalid="ignore", over="ignore", under="ignore"):
        front = np.exp(p * np.log(z) + q * np.log1p(-z) - _log_beta(p, q)) / p
        c, d = np.ones_like(z), 1 - (p + q) * z / (p + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        fraction = d.copy()
        for m in range(1, 400):
            for step in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d, c = 1 + step * d, 1 + step / c
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = np.where(np.abs(c) < tiny, tiny, c)
                fraction = fraction * d * c
            if np.all(np.abs(d * c - 1) < 1e-13):
                break
    share = np.where(z <= 0, 0.0, front * fraction)
    return np.where(turn, 1 - share, share)


def quantile(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """The value a beta variable is under with probability ``p``; of a variable without spread its only value."""
    low, high = np.zeros_like(a), np.ones_like(a)
    for _ in range(60):
        middle = (low + high) / 2
        under = below(np.maximum(a, 1e-9), np.maximum(b, 1e-9), middle) < p
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return np.where(a <= 0, 0.0, np.where(b <= 0, 1.0, (low + high) / 2))


def weight_of(children: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> float:
    """The weight under which the children's outcomes (seen, bad, prior mean) are likeliest, by the beta-binomial law.

    Tasks add up one figure a weight; of equals, and where nothing tells them apart, the largest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, bad, mean = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("seen", "bad", "prior"))
            sums = [float((_log_beta(bad + mean * w, seen - bad + (1 - mean) * w) - _log_beta(mean * w, (1 - mean) * w)).sum()) for w in weights]
            yield pa.RecordBatch.from_arrays([pa.array(weights, pa.float64()), pa.array(sums, pa.float64())], ["weight", "likelihood"])

    told = children.where("seen > 0 and prior > 0 and prior < 1").select(F.col("seen").cast("double"), F.col("bad").cast("double"), "prior")
    likelihoods = arrow_map(told, run, "weight double, likelihood double").groupBy("weight").agg(F.sum("likelihood").alias("likelihood"))
    best = likelihoods.orderBy(F.round("likelihood", 9).desc(), F.col("weight").desc()).first()
    return best["weight"] if best else max(weights)


def reputation(found: DataFrame, lift: float = LIFT, sure: float = SURE) -> DataFrame:
    """host, seen, bad, share (posterior mean), low (its bound) and blocked for every host of ``found`` (see ``outcomes``)."""
    whole = found.agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad")).first()
    base = whole["bad"] / whole["seen"] if whole["seen"] else 0.0

    def under(children: DataFrame, parents: DataFrame | None, key: str | None) -> DataFrame:
        """``children`` with the mean and weight of their prior."""
        placed = children.withColumn("prior", F.lit(base)) if parents is None else children.join(parents, key)
        return placed.withColumn("weight", F.lit(weight_of(placed)))

    posterior = (F.col("bad") + F.col("prior") * F.col("weight")) / (F.col("seen") + F.col("weight"))
    totals = (F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    suffixes = under(found.groupBy("suffix").agg(*totals), None, None).select("suffix", posterior.alias("prior"))
    domains = under(found.groupBy("domain", "suffix").agg(*totals), suffixes, "suffix").select("domain", posterior.alias("prior"))
    hosts = under(found.select("host", "domain", "seen", "bad"), domains, "domain")
    limit = min(1.0, lift * base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, bad, prior, weight = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("seen", "bad", "prior", "weight"))
            a, b = bad + prior * weight, seen - bad + (1 - prior) * weight
            low = quantile(a, b, 1 - sure)
            columns = [batch.column("host"), batch.column("seen"), batch.column("bad"), pa.array(a / (a + b)), pa.array(low), pa.array((low > limit) & (base > 0))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "seen", "bad", "share", "low", "blocked"])

    return arrow_map(hosts.select("host", "seen", "bad", "prior", "weight"), run, "host string, seen bigint, bad bigint, share double, low double, blocked boolean")


def judge(
    pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, lift: float = LIFT, sure: float = SURE,
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page: its rule's, else block if its host is surely bad, else allow.

    Hosts are counted once, before anything is shuffled, and stored; verdicts
    come back by host, where adaptive execution splits one that holds much of
    the table. The driver sees totals and one weight a level.
    """
    split = ruled(parsed(pages.select("page_id", "url"), suffixes), rules)
    verdicts = reputation(written(outcomes(split, labels), "outcomes"), lift, sure).select("host", "blocked")
    method = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return split.join(verdicts, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"))
