"""Best fit against a plain search over all bins, and the conflicts of whole results."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from zonepulse.llm import packing


def plain(lengths, sources, clusters, capacity):
    bins, out = [], []
    for item in zip(lengths, sources, clusters):
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= item[0] and not b["s"] & item[1] and not b["c"] & item[2]]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"room": capacity, "s": 0, "c": 0})
            i = len(bins) - 1
        bins[i]["room"] -= item[0]
        bins[i]["s"] |= item[1]
        bins[i]["c"] |= item[2]
        out.append(i)
    return out


def test_tightest_compatible_bin():
    rnd = random.Random(4)
    for _ in range(60):
        n = rnd.randint(0, 80)
        lengths = sorted((rnd.randint(1, 50) for _ in range(n)), reverse=True)
        sources = [1 << rnd.randint(0, 5) if rnd.random() < 0.9 else 0 for _ in range(n)]
        clusters = [1 << rnd.randint(0, 20) for _ in range(n)]
        assert packing.best_fit(lengths, sources, clusters, 50) == plain(lengths, sources, clusters, 50)


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 50)
    rnd = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rnd.randint(1, 60))), f"src{rnd.choice([0, 0, 1, 2])}") for i in range(200)]
    rows += [(900, None, "src0"), (901, "", None), (902, " \n", "src1"), (None, "a b", None), (903, "long " * 205, "src2"), (5, "a b", "src1"), (5, "a b", "src1")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, piece int")
    got = packing.pack(docs, capacity=50).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
    for own in bins.values():
        assert sum(max(1, r.n_words) for r in own) <= 50
        for column in ("source", "cluster"):
            values = [r[column] for r in own if r[column] is not None]
            assert len(values) == len(set(values))
    assert sum(r.n_words for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    assert sorted((r.piece, r.start_word, r.n_words) for r in got if r.doc_id == 903) == [(i, 50 * i, min(50, 205 - 50 * i)) for i in range(5)]
    assert len({r.doc_id for r in got}) == len({r[0] for r in rows})
    assert packing.pack(docs.limit(0)).count() == 0


def test_repeated_rows_and_long_documents_are_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 64)
    monkeypatch.setattr(packing, "COPIES", 100)
    rows = [(5, "a b c", "s")] * 1000 + [(None, "d e", None)] * 1000 + [(6, "w " * 10_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = packing.pack(docs, capacity=10).collect()
    assert len(got) == 3000 and sum(r.n_words for r in got) == 15_000
    assert sorted(r.start_word for r in got if r.doc_id == 6) == list(range(0, 10_000, 10))
    shards = defaultdict(list)
    for r in got:
        shards[r.bin_id >> packing.BIN_BITS].append(r)
    assert len(shards) > 40 and max(map(len, shards.values())) < 150
    bins = Counter((r.bin_id, r.cluster) for r in got)
    assert max(bins.values()) == 1


def test_clusters_of_the_caller(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, "c d", None), (3, "e f", None), (4, "", None)], "doc_id long, text string, source string")
    clusters = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (None, 1)], "doc_id long, cluster long")
    got = {r.doc_id: r for r in packing.pack(docs, 8, clusters).collect()}
    assert len(got) == 4 and got[1].cluster == got[2].cluster == 1 and got[4].cluster is None
    assert got[1].bin_id != got[2].bin_id


def test_with_text(spark):
    rows = [(1, " a  b\tc d\ne ", "s"), (1, "x y", "s"), (1, "x y", "t"), (None, "x y", "s"), (None, None, "s"), (2, "", None), (3, " \n", None), (4, "é ü", "s")]
    docs = spark.createDataFrame([(*r, "other") for r in rows], "doc_id long, text string, source string, number string")
    packed = packing.pack(docs, 2)
    got = packing.with_text(packed, docs, 2)
    assert got.columns == [*packed.columns, "text"]
    want = [(1, 0, "a  b"), (1, 1, "c d"), (1, 2, "e"), (1, 0, "x y"), (1, 0, "x y"), (None, 0, "x y"), (None, 0, ""), (2, 0, ""), (3, 0, ""), (4, 0, "é ü")]
    key = lambda x: (x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.piece, r.text) for r in got.collect()), key=key) == sorted(want, key=key)
    assert packing.with_text(packing.pack(docs.limit(0)), docs.limit(0)).count() == 0
