"""Both models and all losses by plain counting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

import math
import random
from collections import Counter

from zonepulse.llm import lmscore
from zonepulse.llm.words import slices


def plain(docs, target_ids, least):
    words = {i: (t or "").lower().split() for i, t in docs}
    uni, pair = [Counter(), Counter()], [Counter(), Counter()]
    for i, w in words.items():
        for m in (0, 1) if i in target_ids else (0,):
            uni[m].update(w)
    vocabulary = {w for w, n in uni[0].items() if n >= least}
    mapped = {i: [x if x in vocabulary else None for x in w] for i, w in words.items()}
    for i, w in mapped.items():
        for m in (0, 1) if i in target_ids else (0,):
            pair[m].update(zip(["<s>", *w], w))
    listed = {p for p, n in pair[0].items() if n >= least}
    total = [sum(u.values()) for u in uni]
    c = [{x: u[x] for x in vocabulary} for u in uni]
    for m in (0, 1):
        c[m][None] = total[m] - sum(c[m].values())
        c[m]["<s>"] = max(sum(pair[m][p] for p in listed if p[0] == "<s>"), 1)
    out = {}
    for i, w in mapped.items():
        loss = [0.0, 0.0]
        for m in (0, 1):
            for v, x in zip(["<s>", *w], w):
                kept = sum(pair[m][p] for p in listed if p[0] == v)
                ctx = max(c[m][v], kept, 1)
                uniform = (c[m][x] + 0.5) / (total[m] + 0.5 * (len(vocabulary) + 1))
                p = (1 - 0.7 * kept / ctx) * uniform
                if (v, x) in listed:
                    p += 0.7 * pair[m][v, x] / ctx
                loss[m] -= math.log(p)
        out[i] = (len(w), loss[1] / len(w), loss[0] / len(w)) if w else (0, None, None)
    return out


def test_equals_plain_counting(spark):
    rnd = random.Random(3)
    words = ["the", "The", "a", "b", "c", "d", "rare1", "rare2", "rare3"]
    rows = [(i, " ".join(rnd.choice(words[: 3 + i % 7]) for _ in range(rnd.randint(0, 25)))) for i in range(60)]
    rows += [(100, None), (101, "")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 3)] + [(1, 0, 0), (2, 1, 1), (4, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = lmscore.fit(docs, labels)
    want = plain([(i, t) for i, t in rows], set(range(0, 60, 3)), 2)
    for r in lmscore.score(docs, model).collect():
        n, target, background = want[r.doc_id]
        assert r.n_tokens == n
        if n:
            assert abs(r.loss_target - target) < 1e-9 and abs(r.loss_background - background) < 1e-9
            assert abs(r.score - (target - background)) < 1e-9
        else:
            assert r.score is None
    none = lmscore.score(docs, lmscore.fit(docs, labels.limit(0)))
    assert {r.score for r in none.collect()} == {None}
    assert lmscore.score(docs.limit(0), lmscore.fit(docs.limit(0), labels)).count() == 0


def test_good_documents_score_lower(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scores = lmscore.score(docs, lmscore.fit(docs, labels)).join(labels, "doc_id")
    by = {r.quality: r.m for r in scores.groupBy("quality").agg({"score": "avg"}).withColumnRenamed("avg(score)", "m").collect()}
    assert by[1] < by[0]


def test_rare_words_and_bigrams_count_at_any_size(spark):
    # words and bigrams of two tokens are listed, however many are broadcast, and words of one
    # token stand beside each other, at the start and at the end
    rnd = random.Random(5)
    rows = []
    for i in range(80):
        w = [f"w{int(rnd.paretovariate(0.6)) % 400}" for _ in range(rnd.randint(1, 30))]
        for at in rnd.sample(range(len(w) + 1), min(len(w), 3)):
            w.insert(at, f"once{i}x{at}")
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame([*rows, rows[7], (None, rows[8][1])], "doc_id long, text string")
    counted = [*rows, rows[7], (None, rows[8][1])]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 4)], "doc_id long, quality int, toxic int")
    keyed = [(n if i is None else i if n != 80 else "again", t) for n, (i, t) in enumerate(counted)]
    want = plain(keyed, set(range(0, 80, 4)), 2)
    for bits in (4, 7, 20):
        got = lmscore.score(docs, lmscore.fit(docs, labels, bits)).collect()
        assert len(got) == len(counted) and sum(r.doc_id == 7 for r in got) == 2
        for r in got:
            n, target, background = want[81 if r.doc_id is None else r.doc_id]
            assert r.n_tokens == n
            assert abs(r.loss_target - target) < 1e-9 and abs(r.loss_background - background) < 1e-9


def test_tokens_come_in_bounded_groups(monkeypatch):
    monkeypatch.setattr(lmscore, "GROUP_TOKENS", 1000)
    texts = [" ".join(f"w{i % 7}" for i in range(150))] * 100
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([True] * 100)], names=["text", "good"])
    monkeypatch.setattr(lmscore, "slices", lambda column: slices(column, 1000))
    groups = list(lmscore._tokens(iter([batch, batch])))
    sizes = [len(g[0]) for g in groups]
    assert len(sizes) > 10 and max(sizes) < 2000
    whole = np.concatenate([g[0] for g in groups])
    monkeypatch.setattr(lmscore, "GROUP_TOKENS", 1 << 30)
    assert (whole == next(lmscore._tokens(iter([batch, batch])))[0]).all()


def test_difference_is_the_score_of_the_fitted_documents(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "GROUP_TOKENS", 40)
    rnd = random.Random(9)
    rows = [(i, " ".join(f"w{int(rnd.paretovariate(0.7)) % 90}" for _ in range(rnd.randint(0, 30)))) for i in range(60)]
    rows += [rows[3], rows[3], (70, None), (71, " \t"), (None, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 4)] + [(3, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    good = {*range(0, 60, 4), 3}
    keyed = [(n if i is None or n > 59 else i, t) for n, (i, t) in enumerate(rows)]
    want = plain(keyed, good | {60, 61}, 2)
    order = lambda rows: sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens))
    whole = order(lmscore.score(docs, lmscore.fit(docs, labels)).collect())
    for bits in (3, 20):
        got = order(lmscore.difference(docs, labels, bits).collect())
        assert len(got) == len(rows)
        for r, s in zip(got, whole):
            assert (r.doc_id, r.n_tokens) == (s.doc_id, s.n_tokens)
            n, target, background = want[64 if r.doc_id is None else {70: 62, 71: 63}.get(r.doc_id, r.doc_id)]
            assert r.n_tokens == n and (r.score is None) == (n == 0)
            if n:
                assert max(abs(r.loss_target - target), abs(r.loss_background - background)) < 1e-9
                assert max(abs(s.loss_target - target), abs(s.loss_background - background)) < 1e-9


def test_scores_texts_that_were_not_fitted(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b a b c"), (2, "a b d d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = lmscore.fit(docs, labels)
    new = spark.createDataFrame([(1, "a b a b c"), (5, "zz a b"), (6, "new words")], "doc_id long, text string")
    got = {r.doc_id: r for r in lmscore.score(new, model).collect()}
    assert abs(got[1].score - {r.doc_id: r for r in lmscore.difference(docs, labels).collect()}[1].score) < 1e-12
    monkeypatch.setattr(lmscore, "PART_BITS", 0)  # more texts than were fitted: parts have copies
    assert {r.doc_id: r for r in lmscore.score(new, model).collect()} == got
    assert got[5].n_tokens == 3 and got[6].n_tokens == 2
    unknown = (9 - 8 + 0.5) / (9 + 0.5 * 4)  # c of 9 tokens; a, b and d are known words
    # the first word stands after the start sign, all of whose bigrams (two "a") are listed
    assert abs(got[6].loss_background + (math.log(0.3 * unknown) + math.log(unknown)) / 2) < 1e-9


def test_a_frequent_word_is_asked_for_once_a_block(spark):
    # one row of arrays a block and part is shuffled, not one a token
    text = pa.array([" ".join(["the", "of"] * 500)] * 50)
    batch = pa.RecordBatch.from_arrays([text, pa.array([True] * 50), pa.array(range(50))], names=["text", "good", "id"])
    (block,) = (r for b in lmscore._blocks(iter([batch])) for r in b.to_pylist())
    assert (block["n"], block["n_words"], block["n_texts"], block["target"]) == (50_000, 4, 50, 50_000)
    own = lmscore.Block.of(block)
    asked = lmscore._asked(block["block"], own.words, 3, b=np.bincount(own.tokens, minlength=4))
    assert sum(asked["n"].to_pylist()) == 4 and asked.nbytes < 1000
