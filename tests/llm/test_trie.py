"""The conversation trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from zonepulse.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    out = []
    for node, convs in members.items():
        below = [v for v in members if v[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not children[v] for v in below), sum((len(members[v]) - 1) * len(v[-1][1]) for v in below if v),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-120, 900), n):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bé", "ccc", "dddd"])))
    return rows


def found(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, kind int")
    out = trie.conversation_trie(table.repartition(3))
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_against_all_prefixes(spark):
    rows = made(150, 1)
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize(("turns", "paths"), [(30, 6), (200, 16)])
def test_shards_merge(spark, monkeypatch, turns, paths):
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(trie, "SHARD_PATHS", paths)
    rows = made(120, 2)
    copies = [(1000 + i, t, "user", "hot") for i in range(60) for t in range(7)]  # one path over many shards
    assert found(spark, rows + copies) == expected(rows + copies)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [
        (100, 0, None, "a"), (100, None, "user", None), (100, 0, None, "a"), (None, 0, "user", "lost"),
        (7, 0, "u", "x"), (101, 5, "u", "y"), (102, 0, "u", "😀é"), (5, 0, "", ""), (250, 3, "1", "u:z"), (251, 3, "1u", ":z"),
    ]
    assert found(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_findclose(spark):
    rng = np.random.default_rng(3)
    for _ in range(30):
        signs, height = [1], 1
        for _ in range(int(rng.integers(0, 400))):
            step = 1 if height == 1 or rng.random() < 0.5 else -1
            signs.append(step)
            height += step
        signs = np.array(signs + [-1] * height, dtype=np.int8)
        stack, close = [], {}
        for i, s in enumerate(signs):
            if s == 1:
                stack.append(i)
            else:
                close[stack.pop()] = i
        opens = np.flatnonzero(signs == 1)
        assert trie.Parentheses(signs).findclose(opens).tolist() == [close[i] for i in opens.tolist()]


def test_encoded_shards_balance(spark):
    table = spark.createDataFrame(made(60, 4), "conv_id long, turn long, role string, text string")
    for row in trie.prefix_trie(trie.rebuilt(table)).shards.collect():
        bits = np.unpackbits(np.frombuffer(row["code"], np.uint8))[: row["length"]].astype(int) * 2 - 1
        assert bits.sum() == 0 and (np.cumsum(bits)[:-1] > 0).all()
