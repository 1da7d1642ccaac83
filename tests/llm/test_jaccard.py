"""The similarity join against all pairs, on families of copies, shared passages and odd rows."""

from __future__ import annotations

import random
import re
from itertools import combinations

import duckdb
import pytest

from zonepulse.llm import common, jaccard, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, k, num, den):
    sets = []
    for i, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None], 2):
        if x and y and den * len(x & y) >= num * len(x | y):
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return sorted((i, len(s), None if i is None else find(i)) for i, s in sets if i is not None) + sorted((len(s),) for i, s in sets if i is None)


def corpus(seed, copies=50):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(30))
    rows = [(None, "a b c d e f"), (None, None), (1, None), (2, ""), (3, " \n"), (4, "x y"), (5, "X  Y"), (6, "x"), (7, " ".join(base)), (8, " ".join(base).upper())]
    for i in range(copies):  # versions with few to many changes, some near the threshold
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((100 + i, " ".join(w)))
    for i in range(copies):  # documents with nothing in common but a passage
        w = " ".join(rnd.choice(vocabulary) + str(rnd.randrange(50)) for _ in range(rnd.randint(5, 60)))
        rows.append((1000 + i, f"{w} {passage}"))
    rows += [(1000, rows[-1][1]), (7, rows[20][1])]  # repeated ids
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k,num,den,heavy", [(1, 4, 17, 20, 64), (2, 5, 4, 5, 8), (3, 3, 1, 2, 8)])
def test_equals_all_pairs(spark, monkeypatch, seed, k, num, den, heavy):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, n int, token string")
    got = jaccard.jaccard_components(docs, k, num, den).collect()
    named = sorted(tuple(r) for r in got if r.doc_id is not None)
    assert named + sorted((r.n_shingles,) for r in got if r.doc_id is None) == expected(rows, k, num, den)


@pytest.mark.parametrize("copies", [2, 40])
def test_copies_add_no_candidates(spark, copies):
    words = [f"w{i}" for i in range(100)]
    other = words[:90] + [f"v{i}" for i in range(10)]  # 86 of 97 shingles at k = 4: below 17/20
    rows = [(i, " ".join(words)) for i in range(copies)] + [(1000 + i, " ".join(other)) for i in range(copies)]
    join = jaccard.JaccardJoin(spark.createDataFrame([*rows, *rows[:3], (1, "")], "doc_id long, text string"), 4, 17, 20)
    groups = join.groups()
    ids = spark.createDataFrame([(i, i // 1000 * 1000) for i, _ in rows], "id long, root long")
    heads = join.heads(groups, ids)
    assert sorted((r.doc_id, r.part) for r in heads.collect()) == [(0, 0), (1000, 1000)]
    assert [tuple(r) for r in join.prefix_candidates(heads).collect()] == [(0, 1000)]
    assert {r.component_id for r in join.run().where("n_shingles > 0").collect()} == {0, 1000}


def test_family_beside_a_lone_set(spark):
    """A token of one large part and one other set meets the large part once, not itself."""
    rows = [(i, 20, 3, i // 50, 0) for i in range(51)]
    rows = spark.createDataFrame([(7, *r) for r in rows] + [(8, *r) for r in rows[:50]], "token long, doc_id long, n long, p int, part long, rank int")
    join = jaccard.JaccardJoin(spark.createDataFrame([], "doc_id long, text string"), 4, 17, 20)
    mains = join._main_parts(rows)
    assert [tuple(r) for r in mains.collect()] == [(7, 0, 2)]
    assert sorted((r.doc_id1, r.doc_id2) for r in join._met_once(rows, mains).collect()) == [(i, 50) for i in range(50)]


def test_tokens_that_meet_nothing_are_not_joined(spark, monkeypatch):
    """Of the prefixes of versions of one text only shared tokens get the documents' parts."""
    monkeypatch.setattr(jaccard, "HEAVY", 8)
    seen = []
    for name in ("durable_once", "durable_freed"):
        monkeypatch.setattr(jaccard, name, lambda df, f=getattr(jaccard, name): seen.append(f(df)) or seen[-1])
    join = jaccard.JaccardJoin(spark.createDataFrame(corpus(2), "doc_id long, text string"), 5, 4, 5)
    heads = join.heads(join.groups(), spark.createDataFrame([], "id long, root long"))
    assert join.prefix_candidates(heads).count() > 0
    (at,) = [i for i, df in enumerate(seen) if "kind" in df.columns]
    prefixes = seen[at].where("kind = 0").groupBy("token").count()
    joined = next(df for df in seen[at:] if {"token", "rank", "part"} <= set(df.columns))
    assert sorted(r.token for r in joined.select("token").distinct().collect()) == sorted(r.token for r in prefixes.where("count > 1").collect())
    assert joined.count() < 0.7 * seen[at].where("kind = 0").count()


def test_small_tables_of_the_components_are_one_file(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(common, "durable", lambda *args, f=common.durable: seen.append(f(*args)) or seen[-1])
    links = spark.createDataFrame([(i, i + 1) for i in range(400) if i % 100] + [(7, 7)], "a long, b long")
    with common.settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        roots = common.components(links).collect()
    assert len({r.root for r in roots}) == 4 and all((r.id - 1) // 100 == (r.root - 1) // 100 for r in roots)
    assert len(seen) > 4 and all(len(df.inputFiles()) == 1 for df in seen[1:])


def test_keep_first_and_empty(spark):
    docs = spark.createDataFrame([(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "z"), (None, "z"), (4, None)], "doc_id long, text string")
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 4]
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(queries.ORACLE_SQL["op6_ngram_jaccard"]).fetchall())
    assert sorted(tuple(r) for r in queries.op6_ngram_jaccard(spark, sf).collect()) == want


def test_few_files_and_one_process_a_task(spark, monkeypatch):
    """With many shuffle partitions, tables of a row per document or less are few files, and no
    step of the join runs a chain of Python processes in its tasks."""
    seen = []
    for name in ("durable_once", "durable_freed"):
        monkeypatch.setattr(jaccard, name, lambda df, *rows, f=getattr(jaccard, name): seen.append((df, f(df, *rows))) or seen[-1][1])
    docs = spark.createDataFrame(corpus(3), "doc_id long, text string")
    with common.settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="40"):
        jaccard.JaccardJoin(docs, 5, 4, 5).run()
    many = [df.columns for df in (written for _, written in seen) if len(df.inputFiles()) > 2]
    assert not [c for c in many if c in (["n", "d1", "d2", "rep", "copies", *(f"m{i}" for i in range(6))], ["doc_id", "n_shingles", "rep"], ["doc_id", "n", "part"])]
    assert not [c for c in many if "head" in c and "d1" not in c]
    for plan, _ in seen:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not any("MapInArrow" in a and "MapInArrow" in b for a, b in zip(text.split("\n"), text.split("\n")[1:]))
