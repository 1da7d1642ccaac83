"""Benchmark passages in documents, found within an edit distance.

Both sides are lower-cased and runs of white space become one space.  An item of ``m``
characters may be hit with ``e = floor(rate * m)`` edits.  It is split into ``e + 1`` pieces;
by the pigeonhole principle an occurrence within ``e`` edits holds at least one piece
unchanged.  One Aho-Corasick pass finds all exact piece hits in a whole text, and Myers'
bit-parallel algorithm verifies the stretches around them, so no occurrence is lost.

The items are read in blocks of at most ``BLOCK_CHARS`` characters on average (the number of
blocks grows with the benchmark, not their size); each block is sent to the tasks in turn.

Nulls: a null or empty text or item hits nothing.  Repeated items or documents each count;
a document with a null doc_id can be hit.  Further columns pass through ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.06
BLOCK_CHARS = 4_000_000


def normalised(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, rate: float = RATE) -> tuple[int, list[tuple[int, str]]]:
    """Edit budget of an item and its (offset, piece) split into budget + 1 parts."""
    budget = int(rate * len(item))
    edges = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class Pattern:
    """One item, ready for Myers' algorithm (rows of the distance matrix as bits)."""

    def __init__(self, item: str):
        self.m = len(item)
        self.peq: dict[str, int] = {}
        for i, c in enumerate(item):
            self.peq[c] = self.peq.get(c, 0) | 1 << i
        self.mask = (1 << self.m) - 1
        self.top = 1 << (self.m - 1)

    def best(self, text: str, anchored: bool = False) -> tuple[int, int]:
        """Smallest distance of the item to a substring of ``text`` and the first end of such
        a substring; with ``anchored`` the substring starts at 0."""
        peq, mask, top = self.peq, self.mask, self.top
        pv, mv, score = mask, 0, self.m
        low, end = score, 0
        carry = 1 if anchored else 0
        for j, c in enumerate(text):
            eq = peq.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv) & mask
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = (ph << 1 | carry) & mask
            mh = (mh << 1) & mask
            pv = mh | ~(xv | ph) & mask
            mv = ph & xv
            if score < low:
                low, end = score, j + 1
        return low, end


class Matcher:
    """All items of a block; ``hits`` gives (item index, distance, start, end) per text."""

    def __init__(self, items: list[str], rate: float = RATE):
        self.items = items
        self.rate = rate
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        self.budgets: list[int] = []
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            budget, parts = pieces(item, rate)
            self.budgets.append(budget)
            for offset, part in parts:
                owners.setdefault(part, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for part, own in owners.items():
            self.automaton.add_word(part, (len(part), own))
        if owners:
            self.automaton.make_automaton()

    def _pattern(self, i: int) -> tuple[Pattern, Pattern]:
        if i not in self.patterns:
            self.patterns[i] = Pattern(self.items[i]), Pattern(self.items[i][::-1])
        return self.patterns[i]

    def hits(self, text: str) -> list[tuple[int, int, int, int]]:
        """The best occurrence of every item within its budget, the first of equal ones."""
        if not text or not len(self.automaton):
            return []
        found: dict[int, list[list[int]]] = {}
        for last, (length, own) in self.automaton.iter(text):
            for i, offset in own:
                budget, m = self.budgets[i], len(self.items[i])
                at = last + 1 - length - offset
                lo, hi = max(0, at - budget), min(len(text), at + m + budget)
                runs = found.setdefault(i, [])
                if runs and lo <= runs[-1][1] and lo >= runs[-1][0]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
        out = []
        for i, runs in sorted(found.items()):
            forward, backward = self._pattern(i)
            best = None
            for lo, hi in _merged(runs):
                distance, end = forward.best(text[lo:hi])
                if distance <= self.budgets[i] and (best is None or distance < best[0]):
                    best = distance, lo + end
            if best:
                distance, end = best
                _, length = backward.best(text[max(0, end - len(self.items[i]) - distance) : end][::-1], anchored=True)
                out.append((i, distance, end - length, end))
        return out


def _merged(runs: list[list[int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(map(tuple, runs)):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """(item_id, normalised text) of the benchmark, in blocks of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().toArrow()
        rows = sorted(
            ((i, normalised(t)) for i, t in zip(part["item_id"].to_pylist(), part["text"].to_pylist())),
            key=lambda r: (r[0] is None, r[0] or 0, r[1]),
        )
        yield [r for r in rows if r[1]]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, budget, start, end): each item that occurs in a document
    within its budget; positions are those of its best occurrence in the normalised text."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int, budget int, start int, end int"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids = [i for i, _ in shared.value]
            matcher = Matcher([t for _, t in shared.value], rate)
            for batch in batches:
                rows = [
                    (doc, ids[i], distance, matcher.budgets[i], start, end)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for i, distance, start, end in matcher.hits(normalised(text.as_py()))
                ]
                columns = list(zip(*rows)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "distance", "budget", "start", "end"],
                )

        out = out.union(source.mapInArrow(find, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; one scan per block, no shuffle."""
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher([t for _, t in shared.value], rate)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([not matcher.hits(normalised(t.as_py())) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
