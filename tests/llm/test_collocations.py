"""Phrase mining against plain counting of every run of words."""

from __future__ import annotations

import random
import re
from collections import Counter

from zonepulse.llm import collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def expected(rows, least, longest=4, covered=80, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    covering = Counter()
    for (lang, words), f in candidates.items():
        for s in range(2, len(words)):
            for i in range(len(words) - s + 1):
                covering[lang, words[i : i + s]] = max(covering[lang, words[i : i + s]], f)
    kept = {}
    for (lang, words), a in candidates.items():
        if covering[lang, words] and 100 * covering[lang, words] >= covered * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            first, rest = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (first + rest), k, first, rest))
        score, _, first, rest = min(cuts)
        kept.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), first, rest))
    out = []
    for lang, found in kept.items():
        for rank, (score, a, phrase, first, rest) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, first, rest, totals[lang], -score))
    return sorted(out)


def made(n, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Red", "fox", "été", "jumps", "over", "lazy", "dog", "a-b", "x'y"]
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, weights=[9, 7, 5, 5, 3, 3, 2, 2, 2, 1, 1], k=rng.randint(0, 60))
        marks = rng.choices([" ", "  ", "\t", ", ", ".\n", " ! ", "\r\n"], weights=[20, 3, 1, 2, 2, 1, 1], k=len(words))
        rows.append(("".join(w + m for w, m in zip(words, marks)), rng.choice(["en", "fr", None, "en"])))
    return rows


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(t, g, "a", 1) for t, g in rows], "text string, lang string, key string, n int").repartition(3)
    out = collocations.collocations(docs, **options)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def test_against_counting(spark):
    rows = made(120, 3) + [(None, "en"), ("", None), ("one", "de"), (" \t\n", "de")]
    got = mined(spark, rows, min_count=6)
    assert got == expected(rows, 6) and len({r[0] for r in got}) == 3


def test_top_and_ties(spark):
    rows = [("b a. a b. c d", "en")] * 4 + [("é f. e f", "en")] * 4
    assert mined(spark, rows, min_count=2, top=3) == expected(rows, 2, top=3)


def test_very_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 40)
    rows = [(" ".join(t for t, _ in made(20, 5)), "en"), ("x" * 200 + " fox jumps over the lazy dog", "en"), ("fox jumps over the dog", "en")] * 2
    assert mined(spark, rows, min_count=3) == expected(rows, 3)


def test_shuffled_semi_join_gives_the_same(spark):
    rows = made(60, 9)
    assert mined(spark, rows, min_count=4, max_bits=4) == expected(rows, 4)


def test_repeated_rows_count_each_time(spark):
    rows = [("hot word pair", "en")] * 500
    assert mined(spark, rows) == expected(rows, 30) and mined(spark, rows)[0][2] == "hot word pair"


def test_empty_table(spark):
    assert mined(spark, []) == []

