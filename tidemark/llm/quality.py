"""Quality rules with host verdicts (operator 8).

Each document gets rule features from its whole text. It fails the base rules
by its size and repetition, and each of ``RULES`` (symbols, repeated lines, mean word
length) where a share is over the rule's limit. Failures of every rule are
aggregated by host (the ``source`` column), and each host's failure rate is
shrunk by a beta prior fitted to all hosts, one prior for each rule. The
verdict joins them back:

* a document that fails a base rule goes;
* a host whose shrunk rate in any rule is over a threshold loses all its documents;
* a host's shrunk rate lowers the rule's limit for its documents, which go if
  ``value > limit * (1 - rate)``.

:func:`quality_rules` (the query) reports that verdict, :func:`quality_filter` (the
pipeline's stage) keeps by it.

Method. ``rate = (failed + a) / (documents + a + b)`` with ``a + b`` and the
mean by moments over hosts, each host weighing by its documents. A host with
few documents is drawn to the mean and so is never judged on a handful of
them.

Scale. Features are one pass of numpy over slices of text. The host
aggregation combines map-side, so a host with a third of all rows costs one
row a task. Only host verdicts are joined back, and AQE broadcasts them when
they are small.

Edge cases. A null text has no words and fails the base rules. A null host
is a host of its own. Repeated rows are judged alike and stay repeated. An
empty table gives an empty result. Other columns, whatever their names, pass
through :func:`quality_filter` unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, packed, settled
from tidemark.llm.textscan import SEPARATORS, Words, inside, mix, ngrams, runs

MIN_WORDS = 50
#: A host goes if its shrunk failure rate is over this.
HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
#: Rules beside the base ones: a document fails where the share of the two features is over the limit.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.1),
    "dup_lines": ("n_dup_lines", "n_lines", 0.5),
    "long_words": ("word_chars", "n_words", 10.0),
    "short_words": ("n_words", "word_chars", 1 / 3),
}
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTED = (*FEATURES, "n_lines")

_NOT_NEWLINE = np.zeros(256, bool)
_NOT_NEWLINE[0x0A] = True
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_WORD_CHAR = ~SEPARATORS & ((np.arange(256) & 0xC0) != 0x80)


def _own(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys that are equal only within one text."""
    return mix(keys ^ mix(text.astype(np.uint64)))


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags)][at])


def text_features(texts: pa.Array) -> dict[str, np.ndarray]:
    """The rule features of each text."""
    w = Words(texts)
    n = len(w.count)
    out = {"n_words": w.count, "word_chars": _per_text(_WORD_CHAR[w.data], w.at), "n_symbols": _per_text(_SYMBOL[w.data], w.at)}

    lines = Words(texts, _NOT_NEWLINE)
    full = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    of = lines.text[full]
    once = np.unique(_own(lines.hash()[full], of), return_index=True)[1]
    out["n_lines"] = np.bincount(of, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(of[once], minlength=n)

    repeated = np.zeros(len(w), bool)
    if len(w) >= 3:
        at = np.flatnonzero(inside(w, 3))
        keys = _own(ngrams(w.hash(), 3)[at], w.text[at])
        order = np.argsort(keys, kind="stable")
        start, length = runs(keys[order])
        twice = at[order[np.repeat(length > 1, length)]]
        for j in range(3):
            repeated[twice + j] = True
    out["n_repeat_words"] = np.bincount(w.text[repeated], minlength=n)
    return out


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = text_features(batch.column(1))
    return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(found[c], pa.int64()) for c in COUNTED]], names=["row", *COUNTED])


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows as a struct ``row``, their rule features, and ``base_failed``."""
    rows = packed(docs, text)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in COUNTED)
    out = mapped(rows, _features, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, rules: tuple[str, ...] = ("base_failed",)) -> DataFrame:
    """``host`` and its shrunk failure rate in each rule; ``judged`` has ``host`` and whether each rule failed."""
    hosts = settled(judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in rules]), "hosts")
    share = {r: F.col(r) / F.col("n") for r in rules}
    sums = [x for r in rules for x in (F.sum(r).alias(r), F.sum(F.col("n") * share[r] * share[r]).alias(f"{r}_squares"))]
    fit = hosts.agg(F.sum("n").alias("n"), *sums).first()
    shrunk = []
    for r in rules:
        mean = fit[r] / fit.n if fit.n else 0.0
        spread = max(fit[f"{r}_squares"] / fit.n - mean * mean, 1e-9) if fit.n else 1e-9
        strength = max(mean * (1 - mean) / spread - 1, 0.0)  # the prior's documents, a + b
        shrunk.append(((F.col(r) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))).alias(r))
    return hosts.select("host", *shrunk)


def _value(rule: str) -> Column:
    part, whole, _ = RULES[rule]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def with_verdict(judged: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """Adds ``kept``; ``judged`` has ``host``, ``base_failed`` and each rule's share."""
    rules = ("base_failed", *RULES)
    failed = judged.select("host", "base_failed", *[(F.col(r) > RULES[r][2]).alias(r) for r in RULES])
    rates = settled(host_rates(failed, rules).select(F.col("host").alias("rated"), *[F.col(r).alias(f"{r}_rate") for r in rules]), "host-rates")
    kept = ~F.col("base_failed")
    for r in rules:
        kept = kept & (F.col(f"{r}_rate") <= host_rate)
    for r in RULES:
        kept = kept & (F.col(r) <= RULES[r][2] * (1 - F.col(f"{r}_rate")))
    out = judged.join(rates, F.col("host").eqNullSafe(F.col("rated")))
    return out.select(*judged.columns, kept.alias("kept"))


def quality_rules(docs: DataFrame, host_rate: float = HOST_RATE, host: str = "source") -> DataFrame:
    """Features and verdict of every document: ``doc_id``, the features, ``base_failed``, ``kept``."""
    judged = with_features(docs.select("doc_id", "text", host)).select(
        F.col("row.doc_id").alias("doc_id"), F.col(f"row.{host}").alias("host"), *FEATURES, "base_failed", *[_value(r).alias(r) for r in RULES]
    )
    return with_verdict(settled(judged, "quality"), host_rate).select("doc_id", *FEATURES, "base_failed", "kept")


def quality_filter(docs: DataFrame, host_rate: float = HOST_RATE, host: str = "source") -> DataFrame:
    """The documents that the verdict keeps, with their own columns."""
    judged = with_features(docs).select("row", "base_failed", F.col(f"row.`{host}`").alias("host"), *[_value(r).alias(r) for r in RULES])
    return with_verdict(judged, host_rate).where("kept").select("row.*")
