"""Edit matching against the full distance table."""

from __future__ import annotations

import random

from zonepulse.llm import decontaminate
from zonepulse.llm.decontaminate import Matcher


def table(item, text):
    """Smallest distance of ``item`` to a substring of ``text`` and the first end of one."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def test_matches_within_the_budget_are_all_found():
    rnd = random.Random(2)
    for _ in range(150):
        items = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 60))) for _ in range(4)]
        text = ""
        for _ in range(3):
            s = list(rnd.choice(items))
            for _ in range(rnd.randint(0, 4)):
                k = rnd.randrange(len(s))
                s[k : k + rnd.randint(0, 1)] = rnd.choice(["x", "", "yy"])
                s = s or ["x"]
            text += "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 30))) + "".join(s)
        got = {i: (d, a, b) for i, d, a, b in Matcher(items, 0.1).hits(text)}
        for i, item in enumerate(items):
            distance, end = table(item, text)
            assert (i in got) == (distance <= int(0.1 * len(item)))
            if i in got:
                assert (got[i][0], got[i][2]) == (distance, end)
                assert table(item, text[got[i][1] : end])[0] == distance


def test_operator(spark, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog and runs far away from here"
    edited = item.replace("quick", "quack").replace("far", "fur").upper()
    docs = spark.createDataFrame(
        [(1, f"start {item} end", 7), (2, f"x\n{edited}", 7), (3, "clean words only", 7), (4, None, 7), (5, "", 7), (None, item, 7), (1, item, 7)],
        "doc_id long, text string, item_id int",
    )
    benchmark = spark.createDataFrame([(10, item), (10, item), (11, None), (12, "  "), (13, "another item that is not there at all")], "item_id long, text string")
    for size in (decontaminate.BLOCK_CHARS, 40):  # one block, several blocks
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        hits = decontaminate.benchmark_hits(docs, benchmark).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in hits) == [(0, 10, 0), (1, 10, 0), (1, 10, 0), (2, 10, 2)]
        left = decontaminate.drop_contaminated(docs, benchmark)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5]
    assert decontaminate.benchmark_hits(docs.limit(0), benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == 7


def test_every_planted_item_is_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.doc_id: decontaminate.normalised(r.text) for r in docs.collect()}
    items = {r.item_id: decontaminate.normalised(r.text) for r in benchmark.collect()}
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_hits(docs, benchmark).collect()}
    assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= got
