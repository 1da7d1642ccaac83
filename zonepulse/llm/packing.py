"""Best-fit packing of documents into sequences under conflicts.

A document of ``n`` words is cut into pieces of ``capacity`` words and a rest.  Pieces are
placed largest first.  Open bins stand in order of the room they have left, and carry bitmaps
of the sources and duplicate clusters inside.  The search starts at the successor of the
piece's length and goes on until the first, that is tightest, bin whose bitmaps are disjoint
from the piece's; a new bin is opened if there is none.  So no bin holds two pieces of one
source or of one cluster of copies (or of one document).

Pieces are dealt by hash to shards of about ``SHARD_DOCUMENTS`` pieces, whatever the size of
the corpus, source, cluster or document, and each shard is packed on its own: no shard grows
with the corpus, a hot source is spread evenly over all of them, and so are the pieces of a
very long document and the copies of a repeated row (equal rows are counted before they are
dealt, and the number of the copy is part of the hash).  Only the number of words, source and
cluster of a document are shuffled.

A cluster are the documents of one text, or what the caller names: ``clusters`` (doc_id,
cluster), for example the components of a similarity join.

A document without words (null or empty text too) is one piece of no words that takes one
unit of room.  Null sources conflict with nothing, and so do texts that are null or empty.
Repeated rows are pieces of their own, and copies of each other.  Ties: by doc_id, piece.
Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable_once
from .words import IS_SPACE, slices, spans_of

CAPACITY = 2048
SHARD_DOCUMENTS = 4096  # pieces of documents
BIN_BITS = 20  # bins of a shard have ids below 2 ** BIN_BITS
COPIES = 1 << 16  # of a row, that are numbered in one step


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin of each piece, in the order given; bitmaps are Python integers."""
    rooms: list[tuple[int, int]] = []  # (room left, bin), in order
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        i = bisect_left(rooms, (length, -1))
        while i < len(rooms) and (source_bits[rooms[i][1]] & source or cluster_bits[rooms[i][1]] & cluster):
            i += 1
        if i < len(rooms):
            room, b = rooms.pop(i)
        else:
            room, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= source
        cluster_bits[b] |= cluster
        if room > length:
            insort(rooms, (room - length, b))
        placed.append(b)
    return placed


def _bits(values: list) -> list[int]:
    """Each distinct value as a bit of its own, null as no bit."""
    place: dict = {}
    return [0 if v is None else 1 << place.setdefault(v, len(place)) for v in values]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column(1)):
            starts, _ = spans_of(~IS_SPACE[data], bounds)
            n = np.diff(np.searchsorted(starts, bounds))
            rest = [batch.column(i).slice(lo, hi - lo) for i in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays([rest[0], pa.array(n), rest[1], rest[2]], names=["doc_id", "n", "source", "cluster"])


def _pieces(docs: DataFrame, capacity: int, clusters: DataFrame | None) -> DataFrame:
    """(doc_id, source, cluster, copy, piece, start_word, n_words): a row a piece."""
    text = F.col("text").cast("string")
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.col("source").cast("string").alias("source"),
        F.when(F.length(text) > 0, F.xxhash64(text)).alias("cluster"),
    ).mapInArrow(_count_words, "doc_id long, n long, source string, cluster long")
    rows = durable_once(counted.groupBy("doc_id", "n", "source", "cluster").agg(F.count("*").alias("rows")))
    if clusters is not None:
        named = clusters.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("cluster").alias("named"))
        rows = rows.join(named, F.col("doc_id") == F.col("id"), "left").withColumn("cluster", F.when(F.col("cluster").isNotNull(), F.coalesce("named", "cluster")))
    numbered = rows.withColumn("many", F.explode(F.expr(f"sequence(0, (rows - 1) div {COPIES})"))).withColumn(
        "copy", F.explode(F.expr(f"sequence(many * {COPIES}, least((many + 1) * {COPIES}, rows) - 1)"))
    )
    return numbered.withColumn("piece", F.explode(F.expr(f"sequence(0, (greatest(n, 1) - 1) div {capacity})"))).select(
        "doc_id", "source", "cluster", "copy", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("start_word"),
        F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("n_words"),
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, clusters: DataFrame | None = None) -> DataFrame:
    """(bin_id, doc_id, piece, start_word, n_words, source, cluster): every piece in its bin."""
    pieces = _pieces(docs, capacity, clusters)
    shards = pieces.count() // SHARD_DOCUMENTS + 1

    def pack_shard(rows: pa.Table) -> pa.Table:
        names = ["doc_id", "piece", "start_word", "n_words", "source", "cluster"]
        own = list(zip(*(rows[c].to_pylist() for c in names)))
        own.sort(key=lambda p: (-max(p[3], 1), p[0] is None, p[0] or 0, p[1], p[5] or 0, p[4] or ""))
        columns = list(zip(*own))
        bins = best_fit([max(n, 1) for n in columns[3]], _bits(columns[4]), _bits(columns[5]), capacity)
        if max(bins) >> BIN_BITS:
            raise ValueError(f"a shard has more than 2 ** {BIN_BITS} bins")
        first = rows["shard"][0].as_py() << BIN_BITS
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip([[first + b for b in bins], *columns], kinds)], names=["bin_id", *names]
        )

    return (
        pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "source", "n_words", "copy", "piece"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(pack_shard, "bin_id long, doc_id long, piece int, start_word long, n_words long, source string, cluster long")
    )


def _cut_pieces(capacity: int):
    """(doc_id, text_hash, piece, text): the words of each piece as they stand in the text, with
    what is between them; white space before a piece's first word and after its last is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in slices(batch.column(1)):
                starts, ends = spans_of(~IS_SPACE[data], bounds)
                first = np.searchsorted(starts, bounds)
                row, piece, text = [], [], []
                for r in range(hi - lo):
                    for number, w in enumerate(range(first[r], max(first[r + 1], first[r] + 1), capacity)):
                        last = min(w + capacity, first[r + 1]) - 1
                        row.append(lo + r)
                        piece.append(number)
                        text.append(data[starts[w] : ends[last]].tobytes().decode("utf-8", "replace") if last >= w else "")
                rows = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(piece, pa.int32()), pa.array(text, pa.string())],
                    names=["doc_id", "text_hash", "piece", "text"],
                )

    return run


def with_text(packed: DataFrame, docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``packed`` (clusters by text) with the text of each piece."""
    text = F.col("text").cast("string")
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.when(F.length(text) > 0, F.xxhash64(text)).alias("text_hash"))
        .mapInArrow(_cut_pieces(capacity), "doc_id long, text_hash long, piece int, text string")
        .dropDuplicates(["doc_id", "text_hash", "piece"])
        .select(F.col("doc_id").alias("id"), "text_hash", F.col("piece").alias("number"), "text")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("cluster").eqNullSafe(F.col("text_hash")) & (F.col("piece") == F.col("number"))
    return packed.join(texts, same).select(*packed.columns, "text")
