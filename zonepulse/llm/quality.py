"""Quality rules whose cutoffs are certified on labelled documents.

Each rule compares one measurement of the text with a cutoff.  For every stratum (a band of
document length) and rule, a fixed sequence of cutoffs runs from loose to strict.  A cutoff
is certified if the exact (Clopper-Pearson) upper bound of its false-rejection rate, from
the labelled good documents of the stratum, is at most the rule's share of ``risk``.  The
first failure ends the sequence, which needs no further correction (fixed-sequence testing);
of the certified cutoffs the one that gains most on the labelled bad documents is used.  The level is divided by the number of strata x rules (Bonferroni).  With probability
``1 - delta`` all chosen cutoffs together reject at most ``risk`` of the good documents of
every stratum.  Without enough labels nothing is certified and only the base rules act.

Nulls: a null text counts as empty (0 words: base failure); a null label or doc_id is no
label.  Repeated rows each get their verdict; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable_once
from .words import IS_SPACE, SMALL_SLICE, SpanHash, mix, row_sums, slices, spans_of, windows, words

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BANDS = (100, 400, 1500)  # n_words below which a stratum ends; the last is open

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _grid(lo: float, hi: float, n: int) -> tuple[float, ...]:
    """``n`` cutoffs in equal ratios from ``hi`` down to ``lo``."""
    return tuple(round(hi * (lo / hi) ** (i / (n - 1)), 6) for i in range(n))


@dataclass(frozen=True)
class Rule:
    """Rejects where ``over / under`` exceeds the cutoff; cutoffs from loose to strict."""

    name: str
    over: str
    under: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", _grid(0.02, 4.0, 24)),
    Rule("repeated_words", "n_repeat_words", "n_words", _grid(0.02, 1.0, 24)),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", _grid(0.02, 1.0, 24)),
    Rule("long_words", "word_chars", "n_words", _grid(6.0, 40.0, 24)),
    Rule("short_words", "n_words", "word_chars", _grid(0.25, 1.0, 24)),
)


@dataclass
class QualityModel:
    """Certified cutoff of each (stratum, rule); pairs without one are absent."""

    cutoffs: dict[tuple[int, str], float]
    report: list[dict] = field(default_factory=list)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def counts_of(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of every row of a slice."""
    w = words(data, bounds, lower=False)
    n = len(bounds) - 1
    chars = row_sums(~IS_SPACE[data] & ((data & 0xC0) != 0x80), bounds)
    symbols = row_sums(SYMBOLS[data], bounds)
    # lines that hold a word, and those equal to an earlier one of the same row
    ls, le = spans_of(data != 10, bounds)
    full = np.searchsorted(w.starts, le) > np.searchsorted(w.starts, ls)
    ls, le = ls[full], le[full]
    line_row = np.searchsorted(bounds, ls, side="right") - 1
    key = mix(SpanHash(data)(ls, le) + mix(line_row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[1:] = key[order][1:] == key[order][:-1]
    dup_lines = np.bincount(line_row[order][again], minlength=n)
    n_lines = np.bincount(line_row, minlength=n)
    # words covered by 8-word windows that occur at least twice in the row
    at, h = windows(w, 8)
    h = mix(h + mix(w.row[at].astype(np.uint64)))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(w.row) + 9, dtype=np.int32)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + 8, -1)
    repeats = row_sums(np.cumsum(edge)[: len(w.row)] > 0, w.first)
    found = (np.diff(w.first), chars, symbols, n_lines, dup_lines, repeats)
    return {name: x.astype(np.int64) for name, x in zip(COUNTS, found)}


def measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column(1), SMALL_SLICE):
            counts = counts_of(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *(pa.array(counts[c]) for c in COUNTS)], names=["doc_id", *COUNTS]
            )


def measurements(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, plus ``base_failed`` and the stratum; one row per input row."""
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        measure_batches,
        "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS),
    )
    stratum = F.lit(len(BANDS))
    for i, end in reversed(list(enumerate(BANDS))):
        stratum = F.when(F.col("n_words") < end, i).otherwise(stratum)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("stratum", stratum)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly summed."""
    if p <= 0:
        return 1.0
    if p >= 1:
        return 0.0 if k < n else 1.0
    terms = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson upper bound of a rate of which ``k`` of ``n`` were seen."""
    if n == 0 or k >= n:
        return 1.0
    lo, hi = k / n, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if binomial_cdf(k, n, mid) > level:
            lo = mid
        else:
            hi = mid
    return hi


def certified(k: int, n: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound is at most ``risk`` (one evaluation; long sums only near it)."""
    if n == 0 or k > risk * n:
        return False
    return binomial_cdf(k, n, risk) <= level


def fit(measured: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> QualityModel:
    """Cutoffs from all labelled documents that pass the base rules.

    Spark counts labelled rows per (stratum, rule, number of cutoffs exceeded); at most
    strata x rules x (cutoffs + 1) rows reach the driver, whatever the size of the corpus.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("good"))
    )
    rows = measured.where(~F.col("base_failed")).join(known, F.col("doc_id") == F.col("label_id"))
    exceeded = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            sum((F.col(rule.over) / F.col(rule.under) > F.lit(c)).cast("int") for c in rule.cutoffs).alias("hits"),
        )
        for rule in RULES
    ]
    counts = (
        rows.select("stratum", "good", F.explode(F.array(*exceeded)).alias("x"))
        .groupBy("stratum", "x.rule", "x.hits", "good")
        .count()
        .collect()
    )
    bad: dict[tuple[int, str], np.ndarray] = {}
    good: dict[tuple[int, str], np.ndarray] = {}
    size = {r.name: len(r.cutoffs) + 1 for r in RULES}
    for stratum, rule, hits, is_good, n in counts:
        into = good if is_good == 1 else bad
        into.setdefault((stratum, rule), np.zeros(size[rule], dtype=np.int64))[hits or 0] += n
    share, level = risk / len(RULES), delta / (len(RULES) * (len(BANDS) + 1))
    model = QualityModel({})
    for (stratum, name), seen in sorted(good.items()):
        rule = next(r for r in RULES if r.name == name)
        n, best = int(seen.sum()), 0
        for i, cutoff in enumerate(rule.cutoffs):
            least = len(rule.cutoffs) - i  # a row above this cutoff is above all stricter ones too
            k = int(seen[least:].sum())
            if not certified(k, n, share, level):
                break
            caught = int(bad.get((stratum, name), np.zeros(size[name], dtype=np.int64))[least:].sum())
            if caught - k > best:  # the loosest of the certified cutoffs that gain the most
                best = caught - k
                model.cutoffs[stratum, name] = cutoff
                model.report.append({"stratum": stratum, "rule": name, "cutoff": cutoff, "good": n, "rejected_good": k, "rejected_bad": caught})
    return model


def verdict(measured: DataFrame, model: QualityModel) -> DataFrame:
    """Adds ``kept``: false on base failure or where a certified cutoff is exceeded."""
    rejected = F.lit(False)
    rules = {r.name: r for r in RULES}
    for (stratum, name), cutoff in sorted(model.cutoffs.items()):
        ratio = F.try_divide(F.col(rules[name].over), F.col(rules[name].under))
        rejected = rejected | ((F.col("stratum") == stratum) & F.coalesce(ratio > F.lit(cutoff), F.lit(False)))
    return measured.withColumn("kept", ~(F.col("base_failed") | rejected))


def keep_rows(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs``, with all columns, that ``verdict`` keeps; no shuffle."""
    cutoffs = dict(model.cutoffs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in slices(batch.column(batch.schema.get_field_index("text")), SMALL_SLICE):
                c = counts_of(data, bounds)
                kept = (c["n_words"] >= MIN_WORDS) & (100 * c["n_repeat_words"] <= MAX_REPEAT_PERCENT * c["n_words"])
                stratum = np.searchsorted(BANDS, c["n_words"], side="right")
                for rule in RULES:
                    limit = np.array([cutoffs.get((s, rule.name), np.inf) for s in range(len(BANDS) + 1)])[stratum]
                    kept &= ~(c[rule.over] / np.maximum(c[rule.under], 1) > limit)
                yield batch.slice(lo, hi - lo).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def filter_documents(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``docs`` without the documents that the base rules or the certified cutoffs reject."""
    return keep_rows(docs, fit(durable_once(measurements(docs)), labels, risk, delta))


def quality_filter(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept``.  The measurements are narrow
    and written once; the fit and the verdict read them."""
    measured = durable_once(measurements(docs))
    return verdict(measured, fit(measured, labels, risk, delta))
