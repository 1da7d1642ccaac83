"""The pipeline: every stage against its operator's brute-force meaning, whole and on odd tables."""

from __future__ import annotations

import math
import re

import corpus_pipeline
from zonepulse.llm import decontaminate, pii, queries
from zonepulse.llm.common import BATCH_BYTES, BATCH_ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stages(spark, docs, sf, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], sf).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_stages(spark, scratch):
    sf = "/root/testdata/sf0.001"
    start, good, distinct, clean, private, packed = stages(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf, scratch)
    assert len(corpus_pipeline.STAGES) == 5
    assert all(x.columns == start.columns for x in (good, distinct, clean, private))
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    a, b, c, d, e = map(text, (start, good, distinct, clean, private))
    base = {i for i, t in a.items() if len(WORD.findall(t)) >= 20}
    assert set(b) <= base and len(b) > 0.7 * len(a)

    def shingles(t):
        w = WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in b.items()}
    similar = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    assert set(c) <= set(b) and not any(similar(i, j) for i in c for j in c if i < j)
    parent = {i: i for i in b}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in b:
        for j in b:
            if i < j and similar(i, j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert set(c) == {i for i in b if find(i) == i}
    items = [decontaminate.normalised(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items)
    assert set(d) == {i for i, t in c.items() if not matcher.hits(decontaminate.normalised(t))}
    assert not any(x in decontaminate.normalised(t) for t in d.values() for x in items)
    assert set(e) == set(d) and not any(pii.base_spans(t) for t in e.values())
    assert all(e[i] == d[i] for i in e if not pii.base_spans(d[i]) and "<" not in e[i])
    pieces = packed.collect()
    assert sum(r.n_words for r in pieces) == sum(len(WORD.findall(t)) for t in e.values())
    for i, t in e.items():
        own = sorted((r.piece, r.text) for r in pieces if r.doc_id == i)
        assert WORD.findall(" ".join(t for _, t in own)) == WORD.findall(t)


def test_odd_and_empty_tables(spark, scratch):
    sf = "/root/testdata/sf0.001"
    like = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words " * 40, None, None, None)] * 2
    odd = spark.createDataFrame(rows, like.schema).selectExpr("*", "1 as stratum", "'x' as component_id")
    stages(spark, odd, sf, f"{scratch}/odd")
    packed = stages(spark, like.limit(0), sf, f"{scratch}/empty")[-1]
    assert packed.count() == 0 and "bin_id" in packed.columns


def test_registered(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in queries.QUERIES} and "pipeline" in names
    assert set(queries.QUERIES) <= names and set(queries.ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None and corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_personal_data_is_learnt_from_all_documents(spark, monkeypatch):
    size = 21_000  # above the 20,000 documents that were once drawn
    docs = spark.range(size).selectExpr("id as doc_id", "concat('host ', pmod(hash(id, 1), 400), '.0.0.', pmod(hash(id, 2), 300), ' end') as text")
    seen = []
    monkeypatch.setattr(pii, "redact", lambda docs, detector: seen.append(detector))
    corpus_pipeline.personal_data(spark, docs, "")
    fitted = [r.text for r in docs.where("pmod(xxhash64(doc_id, text), 1 << 30) % 3 <> 0").collect()]
    n, k = sum(len(pii.candidates(t)) for t in fitted), sum(len(pii.base_spans(t)) for t in fitted)
    assert abs(seen[0].trees.bias - math.log((k + 1) / (n - k + 1))) < 1e-12


def test_stages_run_in_small_batches(spark, monkeypatch):
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    seen = []

    def stage(spark, docs, sf_dir):
        seen.append([int(spark.conf.get(n)) for n in names])
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage)])
    before = [spark.conf.get(n) for n in names]
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert seen == [[BATCH_BYTES, BATCH_ROWS]] and [spark.conf.get(n) for n in names] == before
