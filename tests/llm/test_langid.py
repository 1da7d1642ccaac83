"""Kneser-Ney models: they are distributions, equal a plain recursion, and tell languages apart."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np

from zonepulse.llm import langid
from zonepulse.llm.langid import ORDER, build, encoded, gram_hashes, letter_table, string_hashes

SF = "/root/testdata/sf0.1"
TEXTS = {"a": ["abc abd abe", "bad cab", "Abba! dad"], "b": ["xyz zyx", "abc xyz yy", "zz"]}


def grams(texts):
    out = Counter()
    for t in texts:
        s = " " * (ORDER - 1) + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split())
        out.update(s[i : i + ORDER] for i in range(len(s) - ORDER + 1))
    return dict(out)


def plain(counts, alphabet):
    """p(c | context) by the textbook recursion."""
    levels, level = {}, counts
    for n in range(ORDER, 0, -1):
        ones, twos = (sum(v == k for v in level.values()) for k in (1, 2))
        total, kinds = Counter(), Counter()
        for g, v in level.items():
            total[g[:-1]] += v
            kinds[g[:-1]] += 1
        levels[n] = (level, total, kinds, ones / (ones + 2 * twos) if ones and twos else 0.5)
        lower = defaultdict(set)
        for g in level:
            lower[g[1:]].add(g[0])
        level = {g: len(v) for g, v in lower.items()}

    def p(context, c, n=ORDER):
        if n == 0:
            return 1 / (alphabet + 1)
        level, total, kinds, d = levels[n]
        context = context[len(context) - n + 1 :]
        if context not in total:
            return p(context, c, n - 1)
        return max(level.get(context + c, 0) - d, 0) / total[context] + d * kinds[context] / total[context] * p(context, c, n - 1)

    return p


def test_models_equal_the_recursion():
    counts = {k: grams(v) for k, v in TEXTS.items()}
    model = build(counts)
    alphabet = {g[-1] for c in counts.values() for g in c}
    letters = letter_table()
    for j, lang in enumerate(model.languages):
        p = plain(counts[lang], len(alphabet))
        assert abs(sum(p("  a", c) for c in {*alphabet, "?"}) - 1) < 1e-9
        for text in ("abc", "xyz abq", "q", "Bad-dad"):
            s = "   " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
            want = -sum(math.log(p(s[i - 3 : i], s[i])) for i in range(3, len(s))) / (len(s) - 3)
            got, n = model.cross_entropies([text], letters)
            assert n[0] == len(s) - 3 and abs(got[0, j] - want) < 1e-9


def test_encoding_and_hashes():
    codes, bounds = encoded(["Ab  c!", "", "éé"], letter_table())
    assert "".join(map(chr, codes)) == "   ab c " + "   " + "   éé" and bounds.tolist() == [0, 8, 11, 16]
    assert (string_hashes(["   a"]) == gram_hashes(codes)[4][3:4]).all()
    assert (string_hashes(["ab c"]) == gram_hashes(codes)[4][6:7]).all()


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(3000)
    odd = spark.createDataFrame([(-1, None, "en", None, None), (-2, "", "en", None, None), (-3, "12 !?", "en", None, None), (None, "the and of it", None, None, None)], docs.schema)
    model = langid.fit(docs.union(odd))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = langid.predict(docs.union(odd), model).collect()
    assert len(rows) == 3004 and all(0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id >= 0]
    assert len(held) > 500 and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.99
    assert {r.lang_pred for r in rows if r.doc_id is not None and r.doc_id < 0} == {"und"}
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs.limit(20), none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0
