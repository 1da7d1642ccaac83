"""The classifier's parts by brute force, and its held-out quality."""

from __future__ import annotations

import numpy as np

from zonepulse.llm import toxicity
from zonepulse.llm.toxicity import BUCKETS, DIM, FILTERS, PAD, WIDTHS, Network


def network(seed=1):
    rng = np.random.Generator(np.random.PCG64(seed))
    e = rng.normal(size=(BUCKETS + 1, DIM)).astype(np.float32)
    e[BUCKETS] = 0
    net = Network(e)
    net.filters = [rng.normal(size=(w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    net.biases = [rng.normal(size=FILTERS).astype(np.float32) for _ in WIDTHS]
    net.weights = rng.normal(size=len(WIDTHS) * FILTERS).astype(np.float32)
    return net


def test_forward_equals_plain_loops():
    net = network()
    docs = [[5, 7, 9, 5], [], [11], list(range(30))]
    ids = np.concatenate([np.array(d + [BUCKETS] * PAD, dtype=np.int64) for d in docs])
    starts = np.cumsum([0] + [len(d) + PAD for d in docs])[:-1]
    got = net.probabilities(ids, starts)
    for d, p in zip(docs, got):
        x = [net.embedding[i] for i in d + [BUCKETS] * (PAD + max(WIDTHS))]
        pooled = []
        for k, w in enumerate(WIDTHS):
            rows = [np.maximum(net.biases[k] + sum(x[i + j] @ net.filters[k][j] for j in range(w)), 0) for i in range(len(d) + PAD)]
            pooled.append(np.max(rows, axis=0))
        assert abs(1 / (1 + np.exp(-(np.concatenate(pooled) @ net.weights + net.bias))) - p) < 1e-4


def test_calibration_is_monotone_and_moves_the_cutoff():
    net = network()
    net.cutoffs = {-1: 0.5, 1: 0.2}
    p = np.linspace(0, 1, 101)
    for language, cut in ((0, 0.5), (1, 0.2), (-1, 0.5)):
        s = net.calibrated(p, np.full(101, language))
        assert (np.diff(s) > 0).all() and ((s >= 0.7) == (p >= cut)).all() and s[0] == 0 and s[-1] == 1
    y = np.array([0, 0, 1, 0, 1, 1])
    q = np.array([0.1, 0.2, 0.3, 0.35, 0.8, 0.9])
    cut = toxicity.best_cutoff(q, y, np.ones(6))
    f1 = lambda c: 2 * y[q >= c].sum() / ((q >= c).sum() + y.sum())
    assert f1(cut) == max(f1(c) for c in q)


def test_held_out_quality_and_odd_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", None, None, None), (None, "idiot", None, None, None)], docs.schema)
    more = spark.createDataFrame([(None, 1, 1), (-1, 1, None)], labels.schema)
    model = toxicity.fit(docs.union(odd), labels.union(more))
    rows = toxicity.score(docs.union(odd), model).collect()
    assert len(rows) == docs.count() + 3
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = np.array([(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth])
    rank = held[:, 0].argsort().argsort()
    positive = held[:, 1] == 1
    auc = (rank[positive].sum() - positive.sum() * (positive.sum() - 1) / 2) / (positive.sum() * (~positive).sum())
    assert auc > 0.9
    assert ((held[:, 0] >= 0.7) & ~positive).sum() <= 0.03 * (~positive).sum()


def test_one_class_and_empty(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) == 1.0 and toxicity.fit(docs, labels.limit(0)) == 0.0
    assert {r.predicted for r in toxicity.score(docs, 0.0).collect()} == {0}
    assert toxicity.score(docs.limit(0), 1.0).count() == 0


def test_all_labelled_rows_are_learnt_from(spark):
    size = 24_000  # 8,000 learnable rows a class; 4,000 were once drawn
    docs = spark.range(size).selectExpr("id as doc_id", "concat('w', id, if(id % 2 = 1, ' nasty', ' kind'), ' words') as text")
    labels = spark.range(size).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    model = toxicity.fit(docs, labels)
    learnt = labels.where(~toxicity.held_out(labels.doc_id)).where("pmod(xxhash64(doc_id), 1 << 30) % 4 <> 0").collect()
    texts = "".join(f"w{r.doc_id} " for r in learnt).encode()
    hashes, _ = toxicity.word_hashes(np.frombuffer(texts, np.uint8), np.array([0, len(texts)]))
    assert len(hashes) == len(learnt) > 2 * toxicity.SHARD_ROWS
    assert (model.embedding[(hashes % np.uint64(BUCKETS)).astype(np.int64)] != 0).any(1).all()
    rows = toxicity.score(docs, model).where("held_out").collect()
    assert len(rows) > 7000 and np.mean([r.predicted == r.doc_id % 2 for r in rows]) > 0.99
    assert (toxicity.fit(docs.repartition(5), labels).embedding == model.embedding).all()
