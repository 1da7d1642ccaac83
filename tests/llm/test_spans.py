"""Repeated runs by a dictionary over all runs."""

from __future__ import annotations

import random
import re

import numpy as np

from zonepulse.llm import spans
from zonepulse.llm.words import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentences(text):
    found = [(m.start(), m.end()) for m in WORD.finditer(text)]
    low = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[a:b]) for a, b in found]
    cuts, start = [], 0
    for i, (a, b) in enumerate(found):
        w = text[a:b]
        ends = w[-1] in ".!?" or (len(w) > 1 and w[-1] in "\"')]}" and w[-2] in ".!?") or i == len(found) - 1
        if ends or "\n" in text[b : found[i + 1][0]]:
            cuts.append((start, i + 1))
            start = i + 1
    out = []
    for a, b in cuts:
        if b - a > spans.LONG:
            for i in range(a, b):
                data = np.frombuffer(low[i].encode(), dtype=np.uint8)
                if i == b - 1 or words(data, np.array([0, len(data)]), True).hashes[0] % np.uint64(16) == 0:
                    out.append((a, i + 1))
                    a = i + 1
        else:
            out.append((a, b))
    return low, out


def expected(docs, run, least):
    first, out = {}, {}
    for doc, text in sorted(docs):
        low, cut = sentences(text or "")
        gone = set()
        for i in range(len(cut) - run + 1):
            a, b = cut[i][0], cut[i + run - 1][1]
            if b - a >= least and first.setdefault(tuple(low[a:b]), (doc, a)) != (doc, a):
                gone.update(range(a, b))
        if gone:
            out[doc] = ([w for i, w in enumerate(WORD.findall(text)) if i not in gone], len(gone))
    return out


def check(spark, docs, run, least):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, spans string, first int")
    got = {r.doc_id: (WORD.findall(r.text), r.n_removed) for r in spans.remove_repeats(frame, run, least).collect()}
    assert got == expected(docs, run, least)


def test_equals_plain_search(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows], spans.RUN, spans.MIN_WORDS)


def test_small_cases(spark):
    passage = "One two three four. Five six seven! Eight nine ten?"
    docs = [(1, f"Start here. {passage} End."), (2, f"Other text\n{passage}"), (3, passage + "\n" + passage), (4, None), (5, ""), (6, "Short. Text."),
            (7, "word " * 300), (8, "zero " + "word " * 300), (9, "(He said.) \"Yes!\" Again. (He said.) \"Yes!\" Again.")]
    check(spark, docs, 2, 3)
    check(spark, docs, 3, 8)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spans.remove_repeats(empty).count() == 0
    ids = spark.createDataFrame([(None, passage), (None, passage), (4, passage), (4, passage)], "doc_id long, text string")
    assert spans.remove_repeats(ids, 2, 3).count() == 0


def test_unaligned_passages_of_51_words_are_found(spark):
    rnd = random.Random(11)
    word = lambda: f"v{rnd.randrange(3000)}" + rnd.choice(["", "", "", "", "", "", "", "", "."])
    docs = {i: [word() for _ in range(rnd.randint(0, 200))] for i in range(60)}
    for n in range(40):  # from one document into the middle of another, or the same
        a, b = rnd.choice([i for i in docs if len(docs[i]) > 110]), rnd.randrange(60)
        at, to = rnd.randrange(len(docs[a]) - 55), rnd.randrange(len(docs[b]) + 1)
        docs[b][to:to] = docs[a][at : at + 51 + n % 4]
    docs[70] = ["same"] * 200
    first, want, k = {}, {}, spans.PASSAGE + 1
    for doc in sorted(docs):
        want[doc] = set()
        for at in range(len(docs[doc]) - k + 1):
            seen = first.setdefault(tuple(docs[doc][at : at + k]), (doc, at))
            if seen[0] < doc or at - seen[1] >= k:
                want[doc].update(range(at, at + k))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")

    def removed(**more):
        got = {i: set() for i in docs}
        for r in spans.remove_repeats(frame, **more).collect():
            for span in r.spans.split(","):
                got[r.doc_id].update(range(*map(int, span.split(":"))))
        return got

    base = removed()
    assert any(want[i] - base[i] for i in docs)  # what sentences alone miss
    assert removed(passage=spans.PASSAGE) == {i: want[i] | base[i] for i in docs}


def test_runs_are_listed_by_small_slices(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.Generator(np.random.PCG64(3))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 150)) + "." for _ in range(800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(800), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    go = spans._occurrences(1, 16)
    out = list(go(iter([batch])))
    assert len(out) >= sum(map(len, texts)) / spans.SLICE > 3
    assert len(list(spans._prints(50)(iter([batch])))) == len(out)
    monkeypatch.setattr(spans, "SLICE", 1 << 30)
    whole = list(go(iter([batch])))
    assert len(whole) == 1 and pa.Table.from_batches(out).to_pylist() == whole[0].to_pylist()
