"""Repeated runs of sentences, removed from all documents but the first.

A sentence ends at a word that ends in ``.``, ``!`` or ``?`` (closing quotes and brackets may
follow), at a line feed, or at the end of the text.  Text without such marks is cut as well:
a sentence of more than ``LONG`` words ends after every word whose hash is divisible by 16,
so copies are cut at the same places wherever they stand.  Every run of ``RUN`` consecutive
sentences with at least ``MIN_WORDS`` words is hashed on its lower-cased words (A-Z) and joined
over all documents.  A run is a repeat if a document with a smaller doc_id, or an earlier
place of the same document, has it; the sentences that repeats cover are removed.

With ``passage`` = n every run of more than n words that is repeated is found too, wherever
sentences end: all its words are removed, and of a text that repeats itself the first n + 1
words of a passage stay.  Of every ``n + 2 - PRINT`` consecutive runs of ``PRINT`` words the one
of the smallest hash is a print, so any n + 1 words have one, the same in every copy.  The
neighbouring runs of n + 1 words with one print are a chunk; chunks whose print occurs twice
are joined as a whole, like runs of sentences.  Only where a print has chunks that differ,
the single runs of each chunk's first document are joined as well: any other document with
that chunk loses all of it, and a run's first document is the first of its chunk.

A null or empty text has no runs.  Rows with the same doc_id count as one document, so they
don't repeat one another; a null doc_id takes no part.  Further columns are ignored by
``repeated_spans`` and pass through ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_filter, tester
from .common import BATCH_BYTES, BATCH_ROWS, durable_freed, settings
from .words import BASE, INVERSE, Words, _powers, mix, slices, words

RUN = 2
MIN_WORDS = 16
LONG = 40
ID_BITS = 23
PASSAGE = 50
PRINT = 16
PRINT_BITS = 26
SLICE = 1 << 18  # bytes of text whose runs are listed at once

END = np.zeros(256, dtype=bool)
END[[ord(c) for c in ".!?"]] = True
CLOSING = np.zeros(256, dtype=bool)
CLOSING[[ord(c) for c in "\"')]}"]] = True


def sentence_bounds(data: np.ndarray, bounds: np.ndarray, w: Words) -> np.ndarray:
    """Whether each word ends a sentence."""
    n = len(w.starts)
    if not n:
        return np.zeros(0, dtype=bool)
    last = data[w.ends - 1]
    before = data[np.maximum(w.ends - 2, w.starts)]
    ends = END[last] | (CLOSING[last] & END[before])
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    ends[:-1] |= (lines[w.starts[1:]] > lines[w.ends[:-1]]) | (w.row[1:] != w.row[:-1])
    ends[-1] = True
    number = np.concatenate([[0], np.cumsum(ends)[:-1]])
    return ends | ((np.bincount(number)[number] > LONG) & (w.hashes % np.uint64(16) == 0))


def runs_of(data: np.ndarray, bounds: np.ndarray, w: Words, run: int, min_words: int):
    """Row, first word and end word (counted in the row), and hash, of each run of sentences."""
    ends = np.flatnonzero(sentence_bounds(data, bounds, w)) + 1
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    k = len(starts) - run + 1
    if k <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    first, last = starts[:k], ends[run - 1 :]
    good = (w.row[first] == w.row[last - 1]) & (last - first >= min_words)
    first, last = first[good], last[good]
    n = len(w.hashes)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(w.hashes * _powers(BASE, n), out=sums[1:])
    h = mix((sums[last] - sums[first]) * _powers(INVERSE, n + 1)[first])
    row = w.row[first]
    return row, first - w.first[row], last - w.first[row], h


def _occurrences(run: int, min_words: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in slices(batch.column(1), SLICE):
                w = words(data, bounds, lower=True)
                row, first, last, h = runs_of(data, bounds, w, run, min_words)
                # an earlier run of the row with the same hash
                key = mix(h + mix(row.astype(np.uint64)))
                order = np.argsort(key, kind="stable")
                again = np.zeros(len(key), dtype=bool)
                again[order[1:]] = key[order][1:] == key[order][:-1]
                ids = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), ids.take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(again)],
                    names=["h", "doc_id", "first", "last", "again"],
                )

    return go


def word_runs(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each run of ``k`` words inside one row, as in ``runs_of``."""
    n = len(w.hashes)
    at = np.flatnonzero(w.row[: max(n - k + 1, 0)] == w.row[k - 1 :])
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(w.hashes * _powers(BASE, n), out=sums[1:])
    return at, mix((sums[at + k] - sums[at]) * _powers(INVERSE, n + 1)[at])


def prints(w: Words, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and hash of the prints, and the number of the print of each run of
    ``passage + 1`` words (in the order of ``word_runs``), which its words alone decide."""
    k = min(PRINT, passage + 1)
    at, h = word_runs(w, k)
    wide = passage + 2 - k
    if len(at) < wide:
        return at[:0], h[:0], at[:0]
    inside = np.flatnonzero(w.row[at[wide - 1 :]] == w.row[at[: len(at) - wide + 1]])
    least = np.lib.stride_tricks.sliding_window_view(h, wide).argmin(axis=1)[inside]
    chosen, own = np.unique(inside + least, return_inverse=True)
    return at[chosen], h[chosen], own


def _prints(passage: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in slices(batch.column(1), SLICE):
                h, n = np.unique(prints(words(data, bounds, lower=True), passage)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return go


def _chunks(passage: int, repeated: Broadcast):
    """Per repeated print the words of all runs of ``passage + 1`` words that have it: one row
    (p, h, doc_id, first, last, again), ``h`` being the hash of those words."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(repeated)
        for batch in batches:
            for lo, hi, data, bounds in slices(batch.column(1), SLICE):
                w = words(data, bounds, lower=True)
                p, first, last, h = chunks_of(w, passage)
                good = test(p.view(np.int64))
                yield _runs(batch.column(0).slice(lo, hi - lo), w, passage, first[good], last[good], h[good], p[good])

    return go


def _passages(passage: int, wanted: Broadcast):
    """The runs of ``passage + 1`` words in the chunks whose hash and doc_id pass ``wanted``."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(wanted)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, bounds in slices(batch.column(1), SLICE):
                w = words(data, bounds, lower=True)
                _, start, last, chunk = chunks_of(w, passage)
                first, h = word_runs(w, passage + 1)
                rows = _runs(batch.column(0).slice(lo, hi - lo), w, passage, first, first + passage + 1, h)
                good = test(chunk.view(np.int64) ^ ids[lo:hi][w.row[start]])
                yield rows.filter(pa.array(np.repeat(good, last - start - passage)))

    return go


def chunks_of(w: Words, passage: int):
    """Print, first word, end word and hash of the words of all consecutive runs of
    ``passage + 1`` words with the same print, at the same place."""
    _, p, own = prints(w, passage)
    at, _ = word_runs(w, passage + 1)
    lead = np.flatnonzero(np.diff(own, prepend=-1))
    first, last = at[lead], at[np.append(lead[1:], len(at)) - 1] + passage + 1 if len(lead) else at
    n = len(w.hashes)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(w.hashes * _powers(BASE, n), out=sums[1:])
    h = (sums[last] - sums[first]) * _powers(INVERSE, n + 1)[first]
    return p[own[lead]], first, last, mix(mix(h) + (last - first).astype(np.uint64))


def _runs(ids: pa.Array, w: Words, passage: int, first: np.ndarray, last: np.ndarray, h: np.ndarray, p: np.ndarray | None = None) -> pa.RecordBatch:
    row = w.row[first]
    # an earlier run of the row with the same hash that doesn't overlap
    _, earliest, same = np.unique(mix(h + mix(row.astype(np.uint64))), return_index=True, return_inverse=True)
    again = first - first[earliest][same] >= passage + 1
    columns = [pa.array(h.view(np.int64)), ids.take(pa.array(row)), *(pa.array((x - w.first[row]).astype(np.int32)) for x in (first, last)), pa.array(again)]
    names = ["h", "doc_id", "first", "last", "again"]
    if p is not None:
        columns, names = [pa.array(p.view(np.int64)), *columns], ["p", *names]
    return pa.RecordBatch.from_arrays(columns, names=names)


def repeated_spans(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, passage: int | None = None) -> DataFrame:
    """(doc_id, first, last): word ranges of the repeated runs; they may overlap.

    The runs are written once.  Their first documents are found by an aggregation that is
    combined before the shuffle, and joined back; a run that very many documents share is a
    skewed join key, which Spark splits.
    """
    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "h long, doc_id long, first int, last int, again boolean"
    found = _later(durable_freed(source.mapInArrow(_occurrences(run, min_words), schema)))
    if passage is None:
        return found
    twice = source.mapInArrow(_prints(passage), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    chunks = durable_freed(source.mapInArrow(_chunks(passage, bit_filter(twice.select("h"), PRINT_BITS)), f"p long, {schema}"))
    distinct = durable_freed(chunks.groupBy("p", "h").agg(F.min("doc_id").alias("lo")))
    several = distinct.groupBy("p").count().where("count > 1").select("p")
    firsts = distinct.join(several, "p", "left_semi").select(F.col("h").bitwiseXOR(F.col("lo")))
    runs = durable_freed(source.mapInArrow(_passages(passage, bit_filter(firsts, PRINT_BITS)), schema))
    return found.union(_later(chunks.drop("p"))).union(_later(runs))


def _later(runs: DataFrame) -> DataFrame:
    """The runs that a smaller doc_id, or an earlier place of the document, has too."""
    shared = (
        runs.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("h", "lo")
    )
    others = runs.join(shared, "h").where("doc_id > lo and not again").select("doc_id", "first", "last")
    return others.union(runs.where("again").select("doc_id", "first", "last"))


def merged_spans(spans: DataFrame) -> DataFrame:
    """(doc_id, spans): per document its repeated words as sorted disjoint ranges."""
    merge = """aggregate(array_sort(collect_set(struct(first, last))), cast(array() as array<struct<first:int,last:int>>),
        (acc, x) -> if(size(acc) > 0 and x.first <= element_at(acc, -1).last,
            concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first, 'last', greatest(element_at(acc, -1).last, x.last)))),
            concat(acc, array(named_struct('first', x.first, 'last', x.last)))))"""
    return spans.groupBy("doc_id").agg(F.expr(merge).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(2).to_pylist()
        texts, total, gone = [], [], []
        for lo, hi, data, bounds in slices(batch.column(1)):
            w = words(data, bounds, lower=False)
            for r in range(hi - lo):
                starts = w.starts[w.first[r] : w.first[r + 1]]
                at, parts, removed = int(bounds[r]), [], 0
                for span in spans[lo + r]:
                    first, last = span["first"], min(span["last"], len(starts))
                    parts.append(data[at : starts[first]].tobytes())
                    at = int(starts[last]) if last < len(starts) else int(bounds[r + 1])
                    removed += last - first
                parts.append(data[at : bounds[r + 1]].tobytes())
                texts.append(b"".join(parts).decode("utf-8", "replace"))
                total.append(len(starts))
                gone.append(removed)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array([",".join(f"{s['first']}:{s['last']}" for s in x) for x in spans], pa.string()), pa.array(texts, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "spans", "text"],
        )


def remove_repeats(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, passage: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, text) of the documents that lose words: their
    removed word ranges and what is left of the text.  All other documents stay as they are."""
    small = {
        "spark__sql__execution__arrow__maxBytesPerBatch": str(BATCH_BYTES),
        "spark__sql__parquet__columnarReaderBatchSize": str(BATCH_ROWS),
    }
    with settings(docs.sparkSession, **small):  # whole texts go through Python several times
        found = durable_freed(merged_spans(repeated_spans(docs, run, min_words, passage)))
    wanted = bit_filter(found.select("doc_id"), ID_BITS)

    def affected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = tester(wanted)
        for batch in batches:
            yield batch.filter(pa.array(test(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))))

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, text string"
    return source.mapInArrow(affected, schema).join(found, "doc_id").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, spans string, text string"
    )
