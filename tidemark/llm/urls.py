"""URL filter: rules first, then gradient-boosted trees on lexical features (operator 2).

A rule such as ``example.org/es/`` fits its host and all subdomains, if the
url's path starts with the rule's; the longest fitting rule decides. Other
urls are judged by boosted regression trees on the log-loss, fitted to
labelled urls: length of the url, host and path, depth, labels of the host,
digit ratio, entropy of the characters, numbers of parameters, dashes and
dots, fragment, and two suffix statistics: the shrunk share of bad labels of
the url's domain (last two labels of the host) and of its file suffix.

Scale. Suffix statistics cover all labelled urls (combinable aggregates,
joined back; AQE broadcasts them when small and splits hot domains). The trees
are fitted on the driver to at most ``TRAIN_ROWS`` labelled urls, those of
least hash: a documented bound on the fit alone, the same for any partitioning.
Scoring is one pass of numpy; only url columns are read.

Edge cases. A null url, or one without ``://``, has empty host and path, and
is judged by its (empty) features. Without labels, or with one kind of label
only, every url without a rule is allowed. Rows that repeat are judged each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, settled

#: Rules, each with its verdict.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAF = 40, 3, 0.2, 32, 20
#: A url is blocked if its probability of being bad is over this.
THRESHOLD = 0.5
#: Labels that a suffix's share is shrunk by.
PRIOR = 20.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHARES = ("domain_share", "suffix_share")


def parts(urls: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path`` of the ``url`` column."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(F.col("url"), pattern, i), F.lit(""))
    return urls.withColumn("host", F.translate(part(1), _UPPER, _LOWER)).withColumn("path", part(2))


def rule(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _suffixes(urls: DataFrame) -> DataFrame:
    """Adds ``domain`` and ``suffix``, what the statistics are kept by."""
    domain = F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0)
    return urls.withColumn("domain", domain).withColumn("suffix", F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1))


def _shares(labelled: DataFrame, by: str, name: str, mean: float) -> DataFrame:
    """The suffixes' shrunk shares, written out: the joins then see plain scans, which AQE broadcasts or splits."""
    share = (F.sum("bad") + mean * PRIOR) / (F.count(F.lit(1)) + PRIOR)
    return settled(labelled.groupBy(F.col(by).alias(f"{by}_key")).agg(share.alias(name)), name)


def _with_shares(urls: DataFrame, shares: dict[str, DataFrame], mean: float) -> DataFrame:
    for (by, share), name in zip(shares.items(), _SHARES, strict=True):
        urls = urls.join(share, F.col(by) == F.col(f"{by}_key"), "left").drop(f"{by}_key")
        urls = urls.withColumn(name, F.coalesce(name, F.lit(mean)))
    return urls


def lexical(url: str) -> list[float]:
    """The lexical features of a url."""
    head, _, rest = url.partition("://")
    host = rest.split("/")[0].split("?")[0].split("#")[0]
    tail = rest[len(host) :]
    path = tail.split("?")[0].split("#")[0]
    query = tail.partition("?")[2].split("#")[0]
    n = max(len(url), 1)
    _, counts = np.unique(np.frombuffer(url.encode("utf-8", "replace"), np.uint8), return_counts=True)
    share = counts / max(counts.sum(), 1)
    return [
        len(url), len(host), len(path), sum(1 for x in path.split("/") if x), host.count(".") + 1, sum(c.isdigit() for c in url) / n,
        float(-(share * np.log2(share)).sum()), query.count("=") + 0.0, query.count("&") + bool(query), url.count("-"), path.count("."),
        "#" in tail, head == "https", host.startswith("www."),
    ]


def matrix(urls: list[str | None], *shares: np.ndarray) -> np.ndarray:
    rows = np.array([lexical(u or "") for u in urls], np.float64).reshape(len(urls), len(lexical("")))
    return np.column_stack([rows, *shares])


class Trees:
    """Gradient-boosted trees of fixed depth on binned features, for the log-loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        mean = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 1e-6
        self.base, self.trees = float(np.log(mean / (1 - mean))), []
        if len(set(y.tolist())) < 2:
            return
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned, score = self._bins(x), np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._leaves(tree, binned)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)])

    def _grow(self, x: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Splits (feature, bin) of all inner nodes, level by level, and leaf values."""
        node, splits = np.zeros(len(x), np.int64), []
        for depth in range(DEPTH):
            width = 1 << depth
            gain, best = np.zeros(width), [(0, BINS)] * width  # the last bin: all go left
            for f in range(x.shape[1]):
                cell = node * BINS + x[:, f]
                g, h, n = (np.bincount(cell, weights=v, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for v in (gradient, weight, np.ones(len(x))))
                a, b = g[:, -1:], h[:, -1:]
                with np.errstate(all="ignore"):
                    won = g**2 / (h + 1) + (a - g) ** 2 / (b - h + 1) - a**2 / (b + 1)
                won[(n < LEAF) | (n[:, -1:] - n < LEAF)] = 0
                at = won.argmax(axis=1)
                for k in np.flatnonzero(won[np.arange(width), at] > gain + 1e-9):
                    gain[k], best[k] = won[k, at[k]], (f, int(at[k]))
            splits += best
            feature, cut = np.array([b[0] for b in best]), np.array([b[1] for b in best])
            node = 2 * node + (x[np.arange(len(x)), feature[node]] > cut[node])
        size = 1 << DEPTH
        g, h = (np.bincount(node, weights=v, minlength=size) for v in (gradient, weight))
        return splits, RATE * g / (h + 1)

    @staticmethod
    def _leaves(tree: tuple, x: np.ndarray) -> np.ndarray:
        splits, leaves = tree
        feature, cut = np.array([s[0] for s in splits]), np.array([s[1] for s in splits])
        node = np.zeros(len(x), np.int64)
        for depth in range(DEPTH):
            own = (1 << depth) - 1 + node
            node = 2 * node + (x[np.arange(len(x)), feature[own]] > cut[own])
        return leaves[node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability that each row is bad."""
        score = np.full(len(x), self.base)
        if self.trees and len(x):
            binned = self._bins(x)
            for tree in self.trees:
                score += self._leaves(tree, binned)
        return 1 / (1 + np.exp(-score))


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[Trees, dict[str, DataFrame], float]:
    """Trees from ``labelled(url, bad)``, the suffix statistics of all labelled urls, and the mean label."""
    labelled = _suffixes(parts(labelled.select("url", F.col("bad").cast("double").alias("bad")).where(F.col("url").isNotNull() & F.col("bad").isNotNull())))
    mean = float(labelled.agg(F.avg("bad")).first()[0] or 0.0)
    some = labelled.orderBy(F.xxhash64("url"), "url", "bad").limit(rows)
    stats = {by: _shares(labelled, by, name, mean) for by, name in zip(("domain", "suffix"), _SHARES, strict=True)}
    got = _with_shares(some, stats, mean).select("url", "bad", *_SHARES).toPandas().sort_values(["url", "bad"], ignore_index=True)
    shares = [got[c].to_numpy() for c in _SHARES]
    return Trees(matrix(got["url"].tolist(), *shares), got["bad"].to_numpy()), stats, mean


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row of ``pages(page_id, url)``."""
    trees, stats, mean = fit(labelled)
    name, says = rule(rules)
    pages = _with_shares(_suffixes(parts(pages.select("page_id", F.col("url").cast("string").alias("url")))), stats, mean)
    pages = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "host", "path", name.alias("rule"), says.alias("says"), *_SHARES)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        x = matrix(column("url").to_pylist(), *[column(c).to_numpy(zero_copy_only=False) for c in _SHARES])
        names = ["page_id", "host", "path", "rule", "says"]
        return pa.RecordBatch.from_arrays([*[column(c) for c in names], pa.array(trees.predict(x))], names=[*names, "score"])

    kind = dict(pages.dtypes)["page_id"]
    scored = mapped(pages, score, f"page_id {kind}, host string, path string, rule string, says string, score double", "url")
    verdict = F.coalesce("says", F.when(F.col("score") > threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
