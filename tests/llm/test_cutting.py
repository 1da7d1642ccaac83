"""Cutting-stock packing: an exact round trip of all ids, and the linear program by enumeration."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zonepulse.llm import cutting

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(5)
    words = ["alpha", "Beta,", "gämma", "don't", "ΣΑΣ", "😀", "été", "x\x1cy", "１２3", "tab\tbed", "<|endoftext|>", "nb sp", "́mark", "ﬁn", "İ", "été.", "Wörter!?", "o'er,", "a.b", "é.́", "...", "Ŀ·l", "ÀÉÎ;", "x²."]
    out = [" ".join(rng.choices(words, k=rng.choice([1, 5, 40, 300]))) for _ in range(60)]
    long = "\n".join(" ".join(rng.choices(words, k=50)) for _ in range(120))
    return [*out, None, "", " \n ", "a", "a", "a", long, long.replace(" ", "  ")]


def check(spark, rows):
    """Every id in one piece, sequences without gaps, and no padding."""
    plain = Tokenizer.from_file(VOCABULARY)
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, piece string, length int").repartition(3)
    packed, width = cutting.pack(docs, VOCABULARY)
    got = cutting.with_crc32(packed, width).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == {i for i, _ in rows}
    for doc, copies in Counter(rows).items():
        ids = plain.encode(doc[1] or "", add_special_tokens=False).ids + [2]
        covered = Counter()
        for r in by_doc[doc[0]]:
            assert r.doc_tokens == len(ids) and 0 <= r.start and r.start + r.length <= len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
            covered.update(range(r.start, r.start + r.length))
        assert covered == Counter({i: copies for i in range(len(ids))})
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= 4096 and end & (end - 1) == 0
    return got


def test_round_trip(spark):
    got = check(spark, list(enumerate(texts())))
    assert len(got) < 2.5 * len(texts())


def test_parts_cache_blocks_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(cutting, "PART_CHARS", 50)
    monkeypatch.setattr(cutting, "CACHE", 5)
    monkeypatch.setattr(cutting, "BLOCK", 2)
    monkeypatch.setattr(cutting, "BUCKET", 7)
    check(spark, list(enumerate(texts())) + [(1000, "same words again")] * 40 + [(None, "no id")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    packed, width = cutting.pack(docs, VOCABULARY)
    assert cutting.with_crc32(packed, width).count() == 0


def patterns_of(classes, units):
    if not classes:
        return [()]
    first, *rest = classes
    return [(a, *p) for a in range(units // first + 1) for p in patterns_of(rest, units - a * first)]


@pytest.mark.parametrize("seed", range(4))
def test_knapsack_and_linear_program(monkeypatch, seed):
    monkeypatch.setattr(cutting, "GAP", 0)
    rng = np.random.default_rng(seed)
    units, weights = 20, np.array(sorted(rng.choice(np.arange(3, 15), 4, replace=False)))
    all_patterns = np.array(patterns_of(weights.tolist(), units))
    prices = rng.random(4)
    assert cutting.knapsack(prices, weights, units) @ prices == pytest.approx((all_patterns @ prices).max())
    demand = rng.integers(1, 500, 4).astype(float)
    basis, times = cutting.column_generation(weights, demand, units)
    assert np.allclose(basis @ times, demand) and (times > -1e-6).all()
    dual = cutting.inverted(basis).sum(axis=0)
    assert (all_patterns @ dual).max() <= 1 + 1e-5  # feasible prices: their value is the optimum
    assert dual @ demand == pytest.approx(times.sum())


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_the_histogram(seed):
    rng = random.Random(seed)
    histogram = {c: rng.randint(1, 400) for c in rng.sample(range(1, 129), 90)}
    held, sequences = Counter(), 0
    for pattern, n in cutting.cutting_plan(histogram, 128):
        assert sum(c * a for c, a in pattern.items()) <= 128
        held.update({c: a * n for c, a in pattern.items()})
        sequences += n
    assert held == Counter(histogram)
    classes = np.array(sorted(histogram))
    _, times = cutting.column_generation(classes, np.array([float(histogram[c]) for c in classes.tolist()]), 128)
    assert sequences <= 1.01 * times.sum() + 2


def test_known_chunks_are_looked_up_once():
    """A new word in a text costs no second lookup of the others, and words take no normalizer."""

    class Counted(dict):
        again = 0

        def __getitem__(self, key):
            Counted.again += 1
            return super().__getitem__(key)

    with open(VOCABULARY, encoding="utf-8") as f:
        encode = cutting.Encoder(f.read(), "H")
    known = " ".join(t for t in texts() if t)
    list(encode([known]))
    encode.chunks, Counted.again = Counted(encode.chunks), 0
    (ids,) = encode([f"{known} Neverseen ÀÉÎõŁ;"])
    assert np.frombuffer(ids, "<u2").tolist() == Tokenizer.from_file(VOCABULARY).encode(f"{known} Neverseen ÀÉÎõŁ;", add_special_tokens=False).ids
    assert Counted.again < 10
    assert encode.of_words.encode("É", add_special_tokens=False).ids != encode.tokenizer.encode("É", add_special_tokens=False).ids
