"""Words, shingles, hashes and bit filters against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from zonepulse.llm import bits
from zonepulse.llm.common import components
from zonepulse.llm.words import shingle_sets, slices, windows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def texts(seed, n=40):
    rnd = random.Random(seed)
    out = [None, "", " \n\t", "One", "é É", "a b c", "   x", "x" * 5000]
    for _ in range(n):
        out.append("".join(rnd.choice(["ab ", "Ab\n", "é", "\t", "zz ", "\x0b", "\x1c", "日本 "]) for _ in range(rnd.randint(0, 60))))
    return out


def test_words_equal_the_pattern():
    column = pa.array(texts(1))
    got = []
    for lo, hi, data, bounds in slices(column, limit=200):
        w = words(data, bounds, lower=True)
        for r in range(hi - lo):
            own = slice(w.first[r], w.first[r + 1])
            got.append([data[a:b].tobytes().decode() for a, b in zip(w.starts[own], w.ends[own])])
    assert got == [WORD.findall(t or "") for t in texts(1)]


def test_hashes_tell_words_and_shingles_apart():
    column = pa.array(texts(2))
    by_hash, sizes = {}, []
    for lo, hi, data, bounds in slices(column):
        w = words(data, bounds, lower=True)
        for a, b, h in zip(w.starts, w.ends, w.hashes):
            assert by_hash.setdefault(int(h), ascii_lower(data[a:b].tobytes().decode())) == ascii_lower(data[a:b].tobytes().decode())
        sizes += [len(s) for s in shingle_sets(w, 3)]
        assert all(w.row[i] == w.row[i + 2] for i in windows(w, 3)[0])
    assert len(set(by_hash.values())) == len(by_hash)
    for t, n in zip(texts(2), sizes):
        own = WORD.findall(ascii_lower(t or ""))
        assert n == (len({tuple(own[i : i + 3]) for i in range(len(own) - 2)}) if len(own) >= 3 else bool(own))


def test_bit_filter_never_loses_a_key(spark):
    keys = [(i * 7919 - 5000,) for i in range(2000)] + [(None,)]
    test = bits.tester(bits.bit_filter(spark.createDataFrame(keys, "k long"), 14))
    assert test(np.array([k[0] for k in keys[:-1]], dtype=np.int64)).all()
    assert test(np.arange(10**9, 10**9 + 1000)).sum() < 400


def test_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    links += [(rnd.randint(1000, 1040), rnd.randint(1000, 1040)) for _ in range(30)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[find(a)] = find(b)
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got) == {x for l in links if l[0] != l[1] for x in l}
    assert all((got[a] == got[b]) == (find(a) == find(b)) for a in got for b in got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
