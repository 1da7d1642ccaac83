"""Counts by brute force, exact bounds, and the two ways a verdict is applied."""

from __future__ import annotations

import re
from collections import Counter

from zonepulse.llm import quality

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    twice = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(twice)


def test_counts_and_base_rule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    odd = spark.createDataFrame(
        [(None, None), (-1, ""), (-2, "\n\n \t"), (-3, "a b c d e f g h i " * 9), (-4, "x\nx\n x\nx"), (-4, "é# ß|")], "doc_id long, text string"
    )
    docs = docs.select("doc_id", "text").union(odd)
    rows = quality.measurements(docs).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    want = Counter()
    for d in docs.collect():
        c = counts(d.text)
        want[(d.doc_id, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
    assert got == want


def test_exact_bounds():
    # no rejection among n: the upper bound is 1 - level ** (1 / n)
    assert abs(quality.upper_bound(0, 50, 0.05) - (1 - 0.05 ** (1 / 50))) < 1e-9
    for k, n in ((1, 30), (5, 80), (20, 90)):
        bound = quality.upper_bound(k, n, 0.05)
        assert abs(quality.binomial_cdf(k, n, bound) - 0.05) < 1e-6
        assert quality.certified(k, n, bound + 1e-6, 0.05) and not quality.certified(k, n, bound - 1e-6, 0.05)
    assert quality.upper_bound(0, 0, 0.05) == 1.0 and not quality.certified(0, 0, 0.5, 0.05)


def _labelled(spark, n_good, n_bad):
    good = [(i, f"word{i} " + " ".join(f"w{i}x{j}" for j in range(150))) for i in range(n_good)]
    bad = [(10_000 + i, " ".join(f"v{i}y{j}###" for j in range(150))) for i in range(n_bad)]
    docs = spark.createDataFrame([(i, t, "keep", 1) for i, t in good + bad], "doc_id long, text string, stratum string, kept int")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (1, None)], "doc_id long, quality int")
    return docs, labels


def test_cutoffs_need_enough_labels(spark):
    docs, labels = _labelled(spark, 1500, 60)
    model = quality.fit(quality.measurements(docs), labels)
    assert (1, "symbols_per_word") in model.cutoffs
    assert all(r["rejected_good"] <= 0.02 / len(quality.RULES) * r["good"] for r in model.report)
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(1500))
    verdict = quality.verdict(quality.measurements(docs), model).where("kept").select("doc_id")
    assert {r.doc_id for r in verdict.collect()} == set(range(1500))
    few, few_labels = _labelled(spark, 100, 20)
    assert quality.fit(quality.measurements(few), few_labels).cutoffs == {}
    assert quality.filter_documents(few, few_labels).count() == 120


def test_empty(spark):
    docs, labels = _labelled(spark, 1, 1)
    assert quality.quality_filter(docs.limit(0), labels).count() == 0
    assert quality.quality_filter(docs, labels.limit(0)).where("kept").count() == 2
