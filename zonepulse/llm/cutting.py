"""Packing by cutting stock: a linear program over patterns of lengths, by column generation.

A document's ids are cut into full pieces of ``CAPACITY`` and a rest.  Full pieces are sequences
of their own.  The rests fall into classes of ``UNIT`` ids (rounded up), and the histogram of the
classes, at most ``CAPACITY / UNIT`` numbers, is all the driver sees.  A pattern says how many
rests of each class fill a sequence; the linear program that covers the histogram with the fewest
patterns is solved by column generation: a knapsack by dynamic programming over the dual prices
finds the pattern to enter, until none costs less than it saves.  Patterns are used their whole
number of times; what that leaves is packed first-fit by falling class.

Documents are ranked within their class (by hashed buckets, then within a bucket, so no class goes
to one task), and pattern by pattern the next ranks take the next places.  Sequences are dealt
to blocks of about ``BLOCK``; in a block the emptiest ones are given up and their ids, cut where
needed, fill the others.  What is left of a block, less than a sequence, becomes sequences whose
lengths are powers of two.  So nothing is padded, and of each sequence only the emptiest few are cut.

Defined cases: null text is empty, and an empty text is its end id alone; very long texts are read
in parts cut at spaces; repeated rows and null doc_ids are documents of their own; equal lengths are
ranked by a number given to each piece; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import types
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress, count, pairwise, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable_once

CAPACITY = 4096
UNIT = 32
END_ID = 2
BLOCK = 1024  # sequences that share their gaps
BUCKET = 1 << 13  # documents ranked in one group, whatever their number
PART_CHARS = 1 << 18  # of a very long text read at once
GROUP_CHARS = 1 << 14  # of shorter texts looked up together: their chunks stay in the processor's cache
CACHE = 1_000_000  # chunks of text whose ids a worker process remembers
#: Latin letters (those whose lower case is one letter) and marks after them.
PLAIN = re.compile("^(?:([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]*)|(.*))$", re.MULTILINE).findall
WORDS_AT_ONCE = 1000
GAP = 1e-3  # the linear program is solved to this share of its optimum


class Encoder:
    """Ids of texts as bytes.

    The vocabulary in use never joins over a space, so a text's ids are those of its chunks
    between spaces and line ends, one after another; chunks are encoded once and remembered.
    A chunk that is ``PLAIN`` is its lower-cased word and the marks after it.
    Words are encoded many at a time: each ends with the only id in it that stands for a word's end.
    Lower-cased letters of ``PLAIN`` are what the vocabulary's normalizer would make of them, so it is left out there.
    """

    def __init__(self, vocabulary: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tokenizer, self.kind = Tokenizer.from_str(vocabulary), kind
        self.of_words = Tokenizer.from_str(vocabulary)
        self.of_words.normalizer = normalizers.Sequence([])
        words = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(words.values()) + 1, dtype=bool)
        self.closes[[i for word, i in words.items() if word.endswith("</w>")]] = True
        self.chunks, self.words = {"": b""}, {}

    @staticmethod
    def of_process(vocabulary: str, kind: str) -> Encoder:
        """The encoder of this worker process, kept for its next tasks."""
        kept = sys.modules.setdefault("zonepulse_worker_state", types.ModuleType("zonepulse_worker_state")).__dict__
        key = (len(vocabulary), zlib.crc32(vocabulary.encode()), kind)
        if kept.get("key") != key:
            kept["key"], kept["encoder"] = key, Encoder(vocabulary, kind)
        return kept["encoder"]

    def _forget(self) -> None:
        self.chunks = {"": b""}
        if len(self.words) > CACHE:
            self.words = {}

    def _encode(self, tokenizer, texts: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        plain, odd = [], set()
        for chunk, (word, marks, other) in zip(new, PLAIN("\n".join(new))):
            if word:
                plain.append((chunk, word.lower(), marks))
                odd.add(marks)
            else:
                odd.add(other)
        odd = [x for x in odd if x not in self.chunks]
        self.chunks.update(zip(odd, self._encode(self.tokenizer, odd)))
        words = list({w for _, w, _ in plain if w not in self.words})
        for lo in range(0, len(words), WORDS_AT_ONCE):
            some = words[lo : lo + WORDS_AT_ONCE]
            ids = self._encode(self.of_words, [" ".join(some)])[0]
            ends = ((np.flatnonzero(self.closes[np.frombuffer(ids, dtype=self.kind)]) + 1) * array(self.kind).itemsize).tolist()
            if len(ends) != len(some):
                raise ValueError("the vocabulary doesn't mark the end of each word once")
            self.words.update((w, ids[i:j]) for w, i, j in zip(some, [0, *ends], ends))
        known, tails = self.words, self.chunks
        self.chunks.update([(chunk, known[word] + tails[marks] if marks else known[word]) for chunk, word, marks in plain])

    def _run(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHE:
            self._forget()
        chunks, ends = [], [0]
        for text in texts:
            chunks += text.replace("\n", " ").split(" ")
            ends.append(len(chunks))
        found = list(map(self.chunks.get, chunks))
        lacking = list(compress(count(), map(is_, found, repeat(None))))
        if lacking:
            self._learn(list({chunks[i] for i in lacking}))
            for i in lacking:
                found[i] = self.chunks[chunks[i]]
        return [b"".join(found[lo:hi]) for lo, hi in pairwise(ends)]

    def __call__(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order; texts are looked up together, long ones in parts."""
        held, size = [], 0
        for text in texts:
            if len(text) > PART_CHARS:
                yield from self._run(held)
                held, size, out, lo = [], 0, [], 0
                while lo < len(text):
                    hi = text.find(" ", lo + PART_CHARS)
                    hi = len(text) if hi < 0 else hi
                    out += self._run([text[lo:hi]])
                    lo = hi
                yield b"".join(out)
                continue
            held.append(text)
            size += len(text)
            if size > GROUP_CHARS:
                yield from self._run(held)
                held, size = [], 0
        yield from self._run(held)


def encoded(docs: DataFrame, vocabulary: str) -> tuple[DataFrame, int]:
    """(piece, doc_id, start, length, doc_tokens, ids) of pieces of up to ``CAPACITY`` ids, written,
    and the bytes of an id; ``vocabulary`` is the file of a tokenizer."""
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as f:
        content = f.read()
    kind = "H" if Tokenizer.from_str(content).get_vocab_size() <= 1 << 16 else "I"
    width = array(kind).itemsize
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the collector would walk the remembered chunks again and again
        try:
            yield from pieces_of(batches)
        finally:
            gc.enable()

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = Encoder.of_process(shared.value, kind), array(kind, [END_ID]).tobytes()
        piece = TaskContext.get().partitionId() << 40
        names = ["piece", "doc_id", "start", "length", "doc_tokens", "ids"]
        for batch in batches:
            rows, held = [], 0
            texts = (text.as_py() or "" for text in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                ids += end
                n = len(ids) // width
                for start in range(0, n, CAPACITY):
                    part = ids[start * width : (start + CAPACITY) * width]
                    rows.append((piece, doc, start, len(part) // width, n, part))
                    piece += 1
                held += len(ids)
                if held > 1 << 24:
                    yield _table(rows, names)
                    rows, held = [], 0
            if rows:
                yield _table(rows, names)

    ddl = "piece long, doc_id long, start long, length long, doc_tokens long, ids binary"
    return durable_once(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ddl)), width


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def knapsack(prices: np.ndarray, weights: np.ndarray, units: int) -> np.ndarray:
    """How often each item (weights rise) is taken for the highest price within ``units``, repetition allowed."""
    best, took = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(int(weights[0]), units + 1):  # weights rise
        gain = prices[: (k := int(np.searchsorted(weights, room, side="right")))] + best[room - weights[:k]]
        i = int(gain.argmax())
        best[room], took[room] = (gain[i], i) if gain[i] > best[room - 1] else (best[room - 1], -1)
    pattern, room = np.zeros(len(weights)), units
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[took[room]] += 1
            room -= weights[took[room]]
    return pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination, a row at a time; numpy's own uses threads, which may hang beside a JVM."""
    n = len(matrix)
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        factors = work[:, i].copy()
        factors[i] = 0
        work -= factors[:, None] * work[i]
    return work[:, n:]


def column_generation(weights: np.ndarray, demand: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, times) of the linear program: fewest patterns that hold the demand.

    Prices divided by what the best pattern earns at them are feasible duals, so their value bounds
    the optimum from below; the search ends within ``GAP`` of the best bound.  Patterns are priced
    halfway between the current prices and those of the best bound, which keeps them from
    swinging, and at the current ones where that finds none to enter."""
    basis, turn = np.diag((units // weights).astype(float)), 0
    inverse = inverted(basis)
    bound, centre = 0.0, np.zeros(len(weights))
    while True:
        times, prices = (inverse * demand).sum(axis=1), inverse.sum(axis=0)
        for tried in ((centre + prices) / 2, prices) if bound else (prices,):
            tried = np.maximum(tried, 0)
            pattern = knapsack(tried, weights, units)
            lower = float(tried @ demand) / max(float(tried @ pattern), 1e-12)
            if lower > bound:
                bound, centre = lower, tried / max(float(tried @ pattern), 1e-12)
            if prices @ pattern > 1 + 1e-6:
                break
        if times.sum() <= bound * (1 + GAP) or prices @ pattern <= 1 + 1e-6:
            return basis, (inverted(basis) * demand).sum(axis=1)
        change = (inverse * pattern).sum(axis=1)
        ratio = np.full(len(times), np.inf)
        falls = change > 1e-9
        ratio[falls] = np.maximum(times[falls], 0) / change[falls]
        out = int(np.argmin(ratio))
        basis[:, out], turn = pattern, turn + 1
        if turn % 50:  # the inverse follows by one elimination, and is computed anew now and then
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
        else:
            inverse = inverted(basis)


def cutting_plan(histogram: dict[int, int], units: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (class -> copies) with the number of sequences of each; together they hold the
    histogram exactly."""
    if not histogram:
        return []
    classes = np.array(sorted(histogram))
    demand = np.array([histogram[c] for c in classes.tolist()], dtype=float)
    basis, times = column_generation(classes, demand, units)
    left, plan = Counter(histogram), []
    for column, x in zip(basis.T, times):
        n = int(np.floor(x + 1e-9))
        pattern = {int(c): int(a) for c, a in zip(classes, np.rint(column)) if a > 0}
        n = min([n, *(left[c] // a for c, a in pattern.items())])
        if n > 0:
            plan.append((pattern, n))
            left.subtract({c: a * n for c, a in pattern.items()})
    bins: list[list] = []  # room, pattern
    for c in sorted(left, reverse=True):
        n = left[c]
        for b in bins:
            a = min(n, b[0] // c)
            if a > 0:
                b[0], b[1][c], n = b[0] - a * c, a, n - a
        while n > 0:
            a = min(n, units // c)
            bins.append([units - a * c, {c: a}])
            n -= a
    return plan + [(pattern, 1) for _, pattern in bins]


def _places(plan: list[tuple[dict[int, int], int]]) -> tuple[dict[int, np.ndarray], int]:
    """Per class, a row per pattern that uses it: first rank, first sequence, copies, first slot;
    and the number of sequences."""
    rows: dict[int, list] = {}
    ranked: Counter = Counter()
    sequence = 0
    for pattern, n in plan:
        slot = 0
        for c in sorted(pattern, reverse=True):
            rows.setdefault(c, []).append((ranked[c], sequence, pattern[c], slot))
            ranked[c] += pattern[c] * n
            slot += pattern[c]
        sequence += n
    return {c: np.array(r, dtype=np.int64).T for c, r in rows.items()}, sequence


def fill_gaps(sequence: np.ndarray, length: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Items in sequences, sorted by sequence, to (item, cut, length, sequence, offset) without a
    gap: sequences 0, 1, ... are full, and the last ones have powers of two as lengths."""
    first = np.flatnonzero(np.diff(sequence, prepend=-1))
    total = np.add.reduceat(length, first)
    n, tokens = len(first), int(length.sum())
    full, rest = divmod(tokens, capacity)
    order = np.argsort(-total, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    item_place = np.repeat(place, np.diff(np.append(first, len(length))))
    stays = item_place < full
    before = np.cumsum(length) - length
    offset = before - np.repeat(before[first], np.diff(np.append(first, len(length))))

    gaps = capacity - total[order[:full]]
    powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    room = np.concatenate([gaps, np.array(powers, dtype=np.int64)])
    room_offset = np.concatenate([total[order[:full]], np.zeros(len(powers), np.int64)])
    given = np.flatnonzero(~stays)
    item_end, room_end = np.cumsum(length[given]), np.cumsum(room)
    ends = np.unique(np.concatenate([item_end, room_end[room > 0]]))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    i = np.searchsorted(item_end, starts, side="right")
    r = np.searchsorted(room_end, starts, side="right")
    item_start, room_start = item_end - length[given], room_end - room
    kept = np.flatnonzero(stays)
    return (
        np.concatenate([kept, given[i]]),
        np.concatenate([np.zeros(len(kept), np.int64), starts - item_start[i]]),
        np.concatenate([length[kept], ends - starts]),
        np.concatenate([item_place[kept], r]),
        np.concatenate([offset[kept], room_offset[r] + starts - room_start[r]]),
    )


def assigned(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """(piece, cut, length, sequence_id, offset) of every (piece, length), lengths below ``capacity``."""
    units = capacity // unit
    items = pieces.select("piece", F.col("length").cast("long").alias("length"), F.expr(f"cast((length + {unit - 1}) div {unit} as int)").alias("class"))
    histogram = {r["class"]: r["count"] for r in items.groupBy("class").count().collect()}
    places, sequences = _places(cutting_plan(histogram, units))
    blocks = sequences // BLOCK + 1

    buckets = sum(histogram.values()) // BUCKET + 1
    items = items.withColumn("bucket", F.pmod(F.xxhash64("piece"), F.lit(buckets)))
    sums = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = items.groupBy("class", "bucket").count().select("class", "bucket", F.coalesce(F.sum("count").over(sums), F.lit(0)).alias("base"))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("class", "bucket").orderBy("piece")) - 1).join(base, ["class", "bucket"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            sequence, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for c in np.unique(classes).tolist():
                at = np.flatnonzero(classes == c)
                first, start, copies, first_slot = places[c]
                k = np.searchsorted(first, rank[at], side="right") - 1
                beyond = rank[at] - first[k]
                sequence[at], slot[at] = start[k] + beyond // copies[k], first_slot[k] + beyond % copies[k]
            arrays = [pa.array(sequence % blocks), pa.array(sequence), pa.array(slot), batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "sequence", "slot", "piece", "length"])

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("sequence", "ascending"), ("slot", "ascending")])
        block = rows["block"][0].as_py()
        item, cut, n, sequence, offset = fill_gaps(rows["sequence"].to_numpy(), rows["length"].to_numpy(), capacity)
        arrays = [rows["piece"].to_numpy()[item], cut, n, (block << 24) + sequence, offset]
        return pa.Table.from_arrays([pa.array(a) for a in arrays], names=["piece", "cut", "length", "sequence_id", "offset"])

    rank = (F.col("rank") + F.col("base")).cast("long").alias("rank")
    return (
        ranked.select("piece", "length", "class", rank).mapInArrow(place, "block long, sequence long, slot long, piece long, length long")
        .groupBy("block").applyInArrow(fill, "piece long, cut long, length long, sequence_id long, offset long")
    )


def pack(docs: DataFrame, vocabulary: str) -> tuple[DataFrame, int]:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every piece, and the bytes of an id."""
    pieces, width = encoded(docs, vocabulary)
    full = pieces.where(F.col("length") == CAPACITY).select(
        "doc_id", "start", "length", "doc_tokens", (F.col("piece") + (1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids"
    )
    rests = pieces.where(F.col("length") < CAPACITY)
    plan = durable_once(assigned(rests))
    joined = rests.drop("length").join(plan, "piece").select(
        "doc_id", (F.col("start") + F.col("cut")).alias("start"), "length", "doc_tokens", "sequence_id", "offset",
        F.expr(f"substring(ids, cast(cut * {width} + 1 as int), cast(length * {width} as int))").alias("ids"),
    )
    return full.union(joined), width


def with_crc32(packed: DataFrame, width: int) -> DataFrame:
    """The packed pieces with the crc32 of their ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(x.as_buffer(), dtype=f"<u{width}").astype("<u4")) for x in batch.column(6)]
            columns = [batch.column(i) for i in range(6)]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=[*names, "ids_crc32"])

    return packed.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long")
